"""Queries over the driver's tables, each one or more operators; their SQL is in ``oracle``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import codes, geometry, timeutil
from ..operators import actors, camera, ego, ingest, markers, navigation, recording, series, ticks, vectormap
from ..sources import framed, tables
from ..streaming import stateful
from . import adapters

HOUR, DAY = 3_600_000_000, 86_400_000_000
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def r6(x: Column | str) -> Column:
    return F.round(x, 6)


@query
def ego_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ego.trajectory_points(adapters.ego(adapters.events(spark, sf_dir)))
    return rows.select("ingest_seq", "stamp_us", r6("position.x").alias("x"), r6("position.y").alias("y"), r6("orientation.z").alias("qz"), r6("orientation.w").alias("qw"), r6("yaw").alias("yaw"), r6("speed").alias("speed"))


@query
def ego_clock_tf(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapters.ego(adapters.events(spark, sf_dir))
    return ego.clock(rows).join(ego.transforms(rows), "ingest_seq").select("ingest_seq", "sec", "nanosec", "parent", "child", r6("translation.x").alias("tx"))


@query
def time_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("stamp_us") - 1_705_363_200_000_000  # half of them are below zero
    return adapters.events(spark, sf_dir).select("event_id", timeutil.seconds_part(d).alias("sec"), timeutil.nanoseconds_part(d).alias("nanosec"), timeutil.to_microseconds(timeutil.seconds_part(d), timeutil.nanoseconds_part(d)).alias("back_us"), timeutil.from_seconds((F.col("k") * 2 + 1) * 0.5 / 1e6).alias("rounded_us"))


@query
def rollout_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.rollouts(adapters.ego_by_user(adapters.events(spark, sf_dir)).select("ingest_seq", "stamp_us")).select("ingest_seq", "rollout_id")


@query
def executed_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapters.ego_by_user(adapters.events(spark, sf_dir)).select("ingest_seq", "stamp_us", *ego.FRAMES)
    return ego.executed_path(rows, ego.PathConfig(interval_us=6 * HOUR)).select("segment", "ingest_seq", "stamp_us", "offset_us", "source")


@query
def executed_path_age_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapters.ego(adapters.events(spark, sf_dir)).select("ingest_seq", "stamp_us", "user_id", *ego.FRAMES)
    return ego.executed_path(rows, ego.PathConfig(interval_us=6 * HOUR, history_us=2 * DAY), by=["user_id"]).select("user_id", "stamp_us", "offset_us")


@query
def executed_path_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapters.ego(adapters.events(spark, sf_dir)).select("ingest_seq", "stamp_us", "user_id", *ego.FRAMES)
    return ego.path_summary(ego.executed_path(rows, ego.PathConfig(interval_us=6 * HOUR, max_points=20), by=["user_id"]), ["user_id"])


CONFIG = actors.ActorConfig(history_us=2 * DAY, future_us=7 * DAY, period_us=12 * HOUR, stale_us=5 * DAY)


@query
def actor_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapters.actors(adapters.events(spark, sf_dir))
    return rows.select(F.col("ingest_seq").alias("event_id"), "track_id", "label_class", "is_static", r6("dimensions.x").alias("dx"), r6("dimensions.z").alias("dz"), r6("speed").alias("speed"))


def _futures(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = adapters.events(spark, sf_dir)
    ahead = Window.partitionBy("user_id").orderBy("stamp_us").rangeBetween(0, 10 * DAY)
    rows = e.select("event_id", "user_id", F.col("stamp_us").alias("ref_us"), F.collect_list(F.struct(F.col("stamp_us").alias("timestamp_us"))).over(ahead).alias("available_future_points"))
    return actors.future(rows, CONFIG)


@query
def actor_future(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = F.aggregate("points", F.lit(0).cast("long"), lambda a, p: a + p["timestamp_us"] - F.col("ref_us"))
    return _futures(spark, sf_dir).select("event_id", F.size("points").alias("n_points"), total.alias("offsets_us"), "actual_us", "source")


@query
def actor_prediction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return actors.prediction(_futures(spark, sf_dir), CONFIG).select("event_id", F.size("points").alias("n_points"), "source", "producer", "is_model_generated")


def _track_rows(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    return adapters.events(spark, sf_dir).select("user_id", F.col("event_id").alias("ingest_seq"), F.col("event_type").alias("track_id"), "stamp_us", F.col("stamp_us").alias("ref_us"), *more)


@query
def actor_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _track_rows(spark, sf_dir)
    out = actors.history(rows, rows.select("user_id", "ingest_seq", "ref_us"), CONFIG, by=["user_id"])
    return out.select(F.col("ingest_seq").alias("event_id"), "track_id", F.size("points").alias("n_points"), F.get("points", F.lit(0))["t"].alias("first_us"), F.element_at("points", -1)["t"].alias("last_us"), "actual_us")


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = adapters.events(spark, sf_dir).groupBy("user_id").agg(F.min("stamp_us").alias("start_us"), F.max("stamp_us").alias("end_us"))
    u = F.col("user_id")
    asked = users.select("user_id", u.alias("request_id"), F.when(u % 7 == 0, F.col("start_us") - 1).otherwise(F.col("start_us") + DAY * (u % 3) + 12345).alias("reference_us"), F.lit(7 * DAY).alias("future_duration_us"), (u % 4).alias("known_revision"))
    cached = users.where("user_id % 11 <> 0").select("user_id", F.lit(1).cast("long").alias("revision"), "start_us", "end_us")
    return recording.answer_status(asked, cached, on=["user_id"])


@query
def gt_request_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _requests(spark, sf_dir).select("request_id", "status", "revision", "until_us")


def _answers(spark: SparkSession, sf_dir: str, interval_us: int, most: int) -> DataFrame:
    e = adapters.events(spark, sf_dir)
    asked = _requests(spark, sf_dir).withColumns({"sampling_interval_us": F.lit(interval_us), "max_points": F.lit(most)})
    return recording.answers(asked, e.select("user_id", "stamp_us", adapters.motion(e).alias("point")), on=["user_id"], native=interval_us <= 0)


@query
def gt_future_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = "point"
    return _answers(spark, sf_dir, 6 * HOUR, 65).select("request_id", "stamp_us", "offset_us", r6(f"{p}.position.x").alias("x"), r6(f"{p}.position.y").alias("y"), r6(f"{p}.orientation.z").alias("qz"), r6(f"{p}.orientation.w").alias("qw"), r6(f"{p}.yaw").alias("yaw"), r6(f"{p}.speed").alias("speed"))


@query
def gt_future_native(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _answers(spark, sf_dir, 0, 0).select("request_id", "stamp_us", "offset_us", r6("point.position.x").alias("x"))


@query
def gt_future_thinned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _answers(spark, sf_dir, 6 * HOUR, 10).select("request_id", "stamp_us", "offset_us")


@query
def nav_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = adapters.events(spark, sf_dir)
    rows = e.select("user_id", F.col("event_id").alias("ingest_seq"), F.col("k").alias("sequence"), F.col("stamp_us").alias("reference_us"), (F.col("k") % 9 != 0).alias("valid"))
    return navigation.gate(rows, ["user_id"]).select(F.col("ingest_seq").alias("event_id"), "accepted")


@query
def nav_gate_rollback(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapters.ego_by_user(adapters.events(spark, sf_dir))
    rows = rows.select((F.col("user_id") % 16).alias("stream"), "ingest_seq", F.col("k").alias("sequence"), F.col("stamp_us").alias("reference_us"), (F.col("k") % 9 != 0).alias("valid"))
    return navigation.gate(rows, ["stream"]).select("stream", "ingest_seq", "accepted", "rollback")


@query
def nav_enums(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    name = F.when(k % 4 == 0, "Route_Recorded").when(k % 4 == 1, "from_map").when(k % 4 == 2, "MAP_RECORDED").otherwise("other")
    source = F.when(k % 3 == 0, "model_planning").when(k % 3 == 1, "CONTROLLER_REFERENCE").otherwise("MODEL_PLANNING ")
    return adapters.events(spark, sf_dir).select("event_id", codes.route_generator(name).alias("generator"), codes.plan_source(source).alias("source"))


@query
def nav_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    return adapters.events(spark, sf_dir).withColumns(navigation.publication(k % 5 != 0, k % 3 != 0, k % 2 == 0)).select("event_id", "emit_map", "emit_input", "emit_plan", "valid")


@query
def nav_layers_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = ["click", "purchase", "view", "error"]
    rows = adapters.events(spark, sf_dir).select("user_id", F.col("event_id").alias("ingest_seq"), F.col("event_type").alias("kind"), "value")
    return navigation.latest_layers(rows, kinds, by=["user_id"]).select(F.col("ingest_seq").alias("event_id"), *(r6(c).alias(f"latest_{c}") for c in kinds))


def _map_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapters.events(spark, sf_dir).select(F.col("event_id").alias("ingest_seq"), "user_id", F.col("event_type").alias("scene_id"), F.lit("m").alias("map_id"), (F.col("k") % 3).alias("source_revision"))
    return rows


@query
def map_revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectormap.cache(_map_versions(spark, sf_dir)).select(F.col("ingest_seq").alias("event_id"), "scene_id", "revision")


@query
def map_request_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    current = ingest.latest(vectormap.cache(_map_versions(spark, sf_dir), by=["user_id"]).select(F.col("user_id").alias("slot"), "ingest_seq", "scene_id", "revision"), ["slot"])
    u = F.col("user_id")
    users = adapters.events(spark, sf_dir).select("user_id").distinct()
    asked = users.select(F.when(u % 5 == 0, -u).otherwise(u).alias("slot"), F.when(u % 3 == 0, "").when(u % 3 == 1, "click").otherwise("view").alias("requested_scene_id"), (u % 2 * (40 + u % 20)).alias("known_revision"))
    return vectormap.answer_status(asked, current).select("slot", "status", "revision")


@query
def map_polylines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = markers.line_strips(adapters.polylines(spark, sf_dir), "left_boundary")
    return lines.select("vec_id", "ns", F.posexplode("line").alias("at", "p")).select("vec_id", "ns", "at", r6("p.x").alias("x"), r6("p.z").alias("z"))


@query
def lane_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = Window.partitionBy("label").orderBy("vec_id")
    ids = lambda x: F.when(x.isNotNull(), F.array(x.cast("string")))
    lanes = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("label").alias("scene_id"), F.col("vec_id").cast("string").alias("id"), ids(F.lead("vec_id").over(near)).alias("successor_ids"), ids(F.lag("vec_id").over(near)).alias("predecessor_ids"))
    lanes = lanes.withColumns({c: F.array().cast("array<string>") for c in vectormap.LANE_IDS if c not in lanes.columns})
    return vectormap.lane_edges(lanes, ["scene_id"])


@query
def wait_line_style(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.element_at(F.array(F.lit("stop"), F.lit("Yield"), F.lit("other")), (F.col("p_partkey") % 3 + 1).cast("int"))
    rows = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", kind.alias("kind"), (F.col("p_size") % 2 == 0).alias("implicit"))
    return rows.withColumn("c", codes.wait_line_colour(F.col("kind"), F.col("implicit"))).select("p_partkey", F.concat(F.lit("map/wait_lines/"), F.lower("kind")).alias("ns"), "c.r", "c.g", "c.b", "c.a")


@query
def actor_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapters.actors(adapters.events(spark, sf_dir)).withColumn("label_class", F.when(F.col("label_class") == "click", "pedestrian").when(F.col("label_class") == "view", "trailer").otherwise(F.col("label_class")))
    return markers.boxes(rows).select(F.col("ingest_seq").alias("event_id"), "ns", r6("scale.x").alias("sx"), r6("scale.z").alias("sz"), "color.r", "color.g", "color.b", "color.a")


@query
def actor_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markers.labels(adapters.actors(adapters.events(spark, sf_dir)).withColumn("speed", F.col("dimensions.x") * 5.0)).select(F.col("ingest_seq").alias("event_id"), "text", r6("at.z").alias("z"))


@query
def actor_arrows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markers.arrows(adapters.actors(adapters.events(spark, sf_dir))).select(F.col("ingest_seq").alias("event_id"), r6("start.z").alias("z"), r6("end.x").alias("x"), r6("end.y").alias("y"))


def _snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return actors.snapshots(ingest.parse(adapters.actor_packets(adapters.events(spark, sf_dir)), "actors")[0])


@query
def actor_snapshot_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every actor of every accepted packet, in the packet's order."""
    return _snapshots(spark, sf_dir).select("ingest_seq", "ref_us", "pose_frame_id", "at", "track_id", "label_class", "is_static", r6("dimensions.x").alias("dx"), r6("state.position.x").alias("x"), r6("state.speed").alias("speed"))


@query
def actor_marker_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Markers of each packet in order; their ids are in ``marker_ids``."""
    rows = _snapshots(spark, sf_dir).select("ingest_seq", F.col("at").alias("ordinal"), "track_id", "label_class", "is_static", "dimensions", "pose_frame_id", "dynamics_frame_id", "state.position", "state.orientation", "state.linear_velocity", "state.speed")
    return markers.actor_markers(rows).drop("id")


@query
def marker_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.events(spark, sf_dir).select("event_id", codes.stable_id(F.col("user_id").cast("string"), F.lit("box")).alias("box_id"), codes.stable_id(F.lit("map/road_edges"), F.col("event_id").cast("string")).alias("edge_id"))


@query
def actor_stale_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _track_rows(spark, sf_dir)
    return actors.stale_tracks(rows, rows.select("user_id", "ingest_seq", "ref_us"), CONFIG, by=["user_id"]).select("user_id", "track_id", "last_seen_us", F.col("ingest_seq").alias("event_id"), "ref_us")


@query
def actor_history_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the newest sample inside the history says of its track."""
    rows = _track_rows(spark, sf_dir, "value")
    return actors.history(rows, rows.select("user_id", "ingest_seq", "ref_us"), CONFIG, by=["user_id"], meta=["value"]).select(F.col("ingest_seq").alias("event_id"), "track_id", r6("value").alias("value"))


EVICTING = actors.ActorConfig(history_us=9 * DAY, period_us=12 * HOUR, stale_us=5 * DAY)


@query
def actor_history_evicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A history longer than the stale time: tracks that come again after an eviction have lost their samples."""
    rows = _track_rows(spark, sf_dir)
    out = actors.history(rows, rows.select("user_id", "ingest_seq", "ref_us"), EVICTING, by=["user_id"])
    return out.select(F.col("ingest_seq").alias("event_id"), "track_id", F.size("points").alias("n_points"), F.get("points", F.lit(0))["t"].alias("first_us"), F.element_at("points", -1)["t"].alias("last_us"))


@query
def actor_history_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _track_rows(spark, sf_dir)
    packets = rows.select("user_id", "ingest_seq", "ref_us")
    out = actors.packet_duration(actors.history(rows, packets, CONFIG, by=["user_id"]), packets, ["user_id", "ingest_seq"])
    return actors.header(out, CONFIG, "HISTORY").select(F.col("ingest_seq").alias("event_id"), "actual_us", "n_tracks", "source", "requested_us", "interval_us")


@query
def actor_future_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracks of packets with an odd number are left out, so that these have a span of 0."""
    packets = adapters.events(spark, sf_dir).select("event_id", F.col("stamp_us").alias("ref_us"))
    out = actors.packet_duration(_futures(spark, sf_dir).where("event_id % 2 = 0"), packets, ["event_id"])
    return actors.header(out, CONFIG, "FUTURE").select("event_id", "actual_us", "n_tracks", "source", "is_model_generated", "requested_us", "interval_us")


@query
def actor_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actor packets with what is missing in them at any depth; null where nothing is."""
    return ingest.records(adapters.actor_packets(adapters.events(spark, sf_dir)), "actors").select("ingest_seq", "reason", F.size("actors").alias("n_actors"))


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return navigation.judge(ingest.records(adapters.navigation_packets(adapters.events(spark, sf_dir)), "navigation"))


@query
def nav_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = (F.when(F.col("reason").isNull(), F.col(c)).alias(c) for c in ("emit_map", "emit_input", "emit_plan"))
    return _judged(spark, sf_dir).select(F.col("ingest_seq").alias("event_id"), F.coalesce("reason", F.lit("ok")).alias("reason"), *flags)


def _routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = _judged(spark, sf_dir).where("reason IS NULL")
    first, second = (navigation.routes(good.where(f), c, "producer").withColumn("section", F.lit(n)) for f, c, n in (("emit_map", "route_map", "map"), ("emit_input", "route_model_input", "model_input")))
    return first.unionByName(second)


@query
def nav_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _routes(spark, sf_dir).select("ingest_seq", "section", "generator_type", "sequence", "expected_point_count", F.posexplode("points").alias("at", "p"))
    return rows.select(F.col("ingest_seq").alias("event_id"), "section", F.col("generator_type").alias("generator"), "sequence", F.col("expected_point_count").alias("expected"), "at", "p.valid", r6("p.position.x").alias("x"), "p.longitudinal_distance")


@query
def nav_plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = navigation.plans(_judged(spark, sf_dir).where("reason IS NULL AND emit_plan"))
    speed = F.aggregate("points", F.lit(0.0), lambda a, p: a + p["speed"])
    return rows.select(F.col("ingest_seq").alias("event_id"), "source", "producer", "is_model_generated", "force_gt_active", "requested_us", "actual_us", F.size("points").alias("n_points"), F.get("points", F.lit(2))["time_from_reference_us"].alias("last_us"), r6(speed).alias("speeds"))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markers.navigation_lines(navigation.line_messages(_judged(spark, sf_dir).where("reason IS NULL")))


@query
def navigation_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    z = F.get("line", F.lit(0))["z"]
    return _lines(spark, sf_dir).select(F.col("ingest_seq").alias("event_id"), "section", "marker_id", "ns", "frame", "action", "width", F.size("line").alias("n_points"), "color.g", r6(z).alias("z"))


def _viewer_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of ten viewers; a packet's route comes before its plan."""
    seq = F.col("ingest_seq") * 2 + (F.col("section") == "plan").cast("int")
    return _lines(spark, sf_dir).where("section <> 'model_input'").select((F.col("ingest_seq") % 10).alias("viewer"), seq.alias("seq"), "marker_id", "ns", "frame", "action", F.size("line").alias("n_points"))


@query
def navigation_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines that go out with each message."""
    return navigation.layer_arrays(_viewer_lines(spark, sf_dir), [i for i, *_ in markers.NAVIGATION_LAYERS.values()], by=["viewer"])


@query
def navigation_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The array that is retained for each viewer: what went out last, of which removed layers are no part."""
    return navigation.layer_snapshot(_viewer_lines(spark, sf_dir), by=["viewer"])


def _maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectormap.valid_maps(ingest.parse(adapters.vector_maps(spark, sf_dir), "map")[0])


@query
def map_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    maps = _maps(spark, sf_dir).withColumn("extent_x", F.col("extent.maximum.x") - F.col("extent.minimum.x"))
    return vectormap.element_counts(maps, ["scene_id", "map_id", "source_revision", "frame_id", "extent_x"])


@query
def map_marker_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = markers.map_markers(_maps(spark, sf_dir), ["map_id"])
    return rows.select("map_id", "layer", "at", "part", "ns", "id", "frame", "action", F.when(F.col("layer") == 0, 0).otherwise(F.size("line")).alias("n_points"), r6("width").alias("width"), r6(F.get("line", F.lit(0))["z"]).alias("z"))


@query
def map_signs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markers.signs(vectormap.elements(_maps(spark, sf_dir), "traffic_signs", ["map_id"])).select("map_id", "at", "text", r6("sphere.x").alias("x"), r6("sphere.z").alias("sphere_z"), r6("label.z").alias("label_z"))


@query
def map_lane_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectormap.lane_edges(vectormap.elements(_maps(spark, sf_dir), "lanes", ["map_id"]), ["map_id"])


@query
def map_client_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clients that ask every three days, from a day before the first map on."""
    e = adapters.events(spark, sf_dir)
    versions = _map_versions(spark, sf_dir).join(e.select(F.col("event_id").alias("ingest_seq"), "stamp_us"), "ingest_seq")
    polls = ticks.ticks(e.select("user_id", (F.col("stamp_us") - DAY).alias("stamp_us")), 3 * DAY, ["user_id"])
    cached = vectormap.cache(versions, by=["user_id"]).withColumn("scene_id", F.when(F.col("scene_id") != "error", F.col("scene_id")).otherwise(""))  # answers without a map
    return ticks.map_polls(polls, cached, ["user_id"]).select("user_id", "tick", "tick_us", "revision", "action")


@query
def gt_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recordings as they come: some empty, some whose times don't rise, some again."""
    k, t = F.col("k"), F.col("stamp_us")
    points = F.when(k % 7 == 0, F.array().cast("array<bigint>")).when(k % 7 == 1, F.array(t, t)).otherwise(F.array(t, t + 1, t + 2 + k))
    rows = adapters.events(spark, sf_dir).select("user_id", F.col("event_id").alias("ingest_seq"), F.col("event_type").alias("scene_id"), F.when(k % 3 != 0, k % 2).alias("source_revision"), F.transform(points, lambda x: F.struct(x.alias("timestamp_us"))).alias("points"))
    return recording.cache(rows, by=["user_id"]).select(F.col("ingest_seq").alias("event_id"), "status", "revision", "start_us", "end_us")


@query
def gt_future_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a client publishes that asks every week."""
    e = adapters.events(spark, sf_dir)
    config = recording.FutureConfig(future_us=7 * DAY, interval_us=6 * HOUR)
    asked = ticks.ticks(e, 7 * DAY, ["user_id"]).withColumn("request_id", F.col("user_id") * 1000 + F.col("tick"))
    held = e.where("user_id % 11 <> 0").groupBy("user_id").agg(F.lit(1).cast("long").alias("revision"), F.min("stamp_us").alias("start_us"), F.max("stamp_us").alias("end_us"))
    status = recording.answer_status(recording.tick_requests(asked, config), held, on=["user_id"])
    rows = recording.answers(status, e.select("user_id", "stamp_us", adapters.motion(e).alias("point")), on=["user_id"], native=config.interval_us <= 0)
    points = rows.groupBy("request_id").agg(F.sort_array(F.collect_list(F.struct("offset_us", F.col("point.position.x").alias("x")))).alias("points"))  # as many as a request may have
    answered = recording.usable(status.join(points, "request_id", "left"))
    last = F.element_at("points", -1)
    return answered.select("user_id", "tick", F.col("reference_us").alias("tick_us"), F.size("points").alias("n_points"), last["offset_us"].alias("last_us"), r6(last["x"]).alias("last_x"))


@query
def executed_path_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The path as published every five days."""
    e = adapters.events(spark, sf_dir)
    rows = adapters.ego(e).select("user_id", "ingest_seq", "stamp_us", *ego.FRAMES)
    return ticks.path_snapshots(rows, ticks.ticks(e, 5 * DAY, ["user_id"]), ego.PathConfig(interval_us=6 * HOUR, max_points=20), ["user_id"]).drop("segment")


@query
def executed_path_ticks_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The path of the last day as published every two days, four points at most."""
    e = adapters.events(spark, sf_dir)
    rows = adapters.ego(e).select("user_id", "ingest_seq", "stamp_us", *ego.FRAMES)
    config = ego.PathConfig(interval_us=3 * HOUR, history_us=DAY, max_points=4)
    return ticks.path_snapshots(rows, ticks.ticks(e, 2 * DAY, ["user_id"]), config, ["user_id"]).drop("segment")


@query
def frame_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments of each user where the frame changes, and rows without one."""
    rows = adapters.ego(adapters.events(spark, sf_dir)).withColumn("pose_frame_id", F.when(F.col("k") % 20 == 0, "").when(F.expr("(ingest_seq div 7) % 2") == 0, "map").otherwise("odom"))
    return ego.path_segments(rows.select("user_id", "ingest_seq", "stamp_us", *ego.FRAMES), by=["user_id"]).select(F.col("ingest_seq").alias("event_id"), "segment")


@query
def duration_rounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = (F.col("k") * 2 + 1) * 0.5
    return adapters.events(spark, sf_dir).select("event_id", timeutil.nanoseconds_from_seconds(s / 1e9).alias("ns"), timeutil.from_seconds(s).alias("us"))


@query
def framed_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = framed.decode_frames(adapters.framed_bytes(adapters.events(spark, sf_dir)), "raw", ["stream"], images=True)
    return rows.select("stream", "at", "payload", F.octet_length("data").alias("image_bytes"))


def _calibrations(spark: SparkSession, sf_dir: str) -> DataFrame:
    packets = adapters.camera_packets(adapters.events(spark, sf_dir), camera.CAMERAS)
    return camera.calibration_once(ingest.parse(packets, "camera")[0])


@query
def camera_static_transforms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return camera.static_transforms(_calibrations(spark, sf_dir), camera.camera_table(spark)).select("camera", "parent", "child", r6("translation.x").alias("x"), r6("rotation.z").alias("qz"))


@query
def camera_calibration_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return camera.calibration_json(_calibrations(spark, sf_dir))


@query
def camera_magic(spark: SparkSession, sf_dir: str) -> DataFrame:
    heads = ["FFD8FFE0", "89504E470D0A1A0A00", "524946460000000057454250", "524946460000000041564920", ""]
    data = F.unhex(F.element_at(F.array(*(F.lit(h) for h in heads)), (F.col("k") % 5 + 1).cast("int")))
    frames = adapters.events(spark, sf_dir).select(F.col("event_id").alias("ingest_seq"), F.element_at(F.array(*(F.lit(c) for c in (*camera.CAMERAS, "unknown"))), (F.col("event_id") % 6 + 1).cast("int")).alias("camera_logical_id"), F.col("stamp_us").alias("end_timestamp_us"), data.alias("data"))
    return camera.images(frames, camera.camera_table(spark)).select(F.col("ingest_seq").alias("event_id"), "camera", "frame_id", "stamp_us", "format")


@query
def camera_calibration_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = adapters.events(spark, sf_dir).select(F.col("event_type").alias("camera_logical_id"), F.col("event_id").alias("ingest_seq"), F.when(F.col("k") > 50, F.col("k")).alias("camera_metadata"))
    return camera.calibration_once(frames)


@query
def topic_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.counts(adapters.events(spark, sf_dir), ["event_type"])


@query
def retained_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapters.events(spark, sf_dir).select("event_type", "user_id", F.col("event_id").alias("ingest_seq"), r6("value").alias("value"))
    return ingest.latest(rows, ["event_type", "user_id"])


@query
def receive_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.keep_latest(adapters.events(spark, sf_dir).select("event_type", F.col("event_id").alias("ingest_seq")), ["event_type"], 8)


@query
def packet_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ego packets as JSON; some broken, some without a field."""
    rows = ingest.records(adapters.ego_packets(adapters.events(spark, sf_dir)), "ego")
    good = lambda c: F.when(F.col("reason").isNull(), c)
    return rows.select(F.col("ingest_seq").alias("event_id"), F.coalesce("reason", F.lit("ok")).alias("reason"), good(F.col("timestamp_us")).alias("stamp_us"), good(r6("position.x")).alias("x"), good(F.coalesce("pose_frame_id", F.lit("map"))).alias("pose_frame_id"))


@query
def finite_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = F.when(F.col("k") % 7 == 0, F.lit(float("nan"))).when(F.col("k") % 7 == 1, F.lit(float("inf"))).otherwise(F.col("value"))
    return adapters.events(spark, sf_dir).select("event_id", geometry.finite(x).alias("finite"))


@query
def topic_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packets of all channels as they were recorded into an append table by a stream, and two channels of it."""
    path = tables.shared_path(spark, "topic")
    packets = adapters.events_stream(spark, sf_dir).select(F.col("event_id").alias("ingest_seq"), F.to_json(F.struct("user_id", "k")).alias("payload"), F.col("event_type").alias("channel"))
    tables.append(packets, path, f"{path}-progress", partition_by=["channel"]).awaitTermination()
    return tables.topic(spark, path, "ingest_seq long, payload string, channel string", channels=["click", "view"])


@query
def gate_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Updates that the stream's gate lets pass, user by user."""
    path = tables.shared_path(spark, "gate")
    k = F.col("k")
    updates = adapters.events_stream(spark, sf_dir).select("user_id", F.col("event_id").alias("ingest_seq"), k.alias("sequence"), F.col("stamp_us").alias("reference_us"), (k % 9 != 0).alias("valid"))
    tables.append(stateful.gate(updates, "user_id"), path, f"{path}-progress").awaitTermination()
    return spark.read.schema("user_id long, ingest_seq long, sequence long").parquet(path).select("user_id", F.col("ingest_seq").alias("event_id"), "sequence")
