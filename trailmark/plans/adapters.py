"""The driver's tables in the shapes that the operators take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, user_id, event_type, value, stamp_us, k."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    return e.select("event_id", "user_id", "event_type", "value", F.unix_micros(F.col("ts").cast("timestamp")).alias("stamp_us"), F.regexp_extract("props", r"(\d+)", 1).cast("long").alias("k"))


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same columns, as a stream of the table's files."""
    path = f"{sf_dir}/events.parquet"
    e = spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{path[:-1]}[t]")  # a pattern, for a stream takes a file's name for that of a folder
    return e.select("event_id", "user_id", "event_type", "value", F.unix_micros(F.col("ts").cast("timestamp")).alias("stamp_us"), F.regexp_extract("props", r"(\d+)", 1).cast("long").alias("k"))


def vector(x, y, z):
    return F.struct(*(F.lit(v).cast("double").alias(n) for v, n in zip((x, y, z), "xyz", strict=True)))


def turn(k) -> F.Column:
    """A quaternion about z: k hundredths of a circle."""
    half = k * F.lit(0.0314)
    return F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("y"), F.sin(half).alias("z"), F.cos(half).alias("w"))


def ego(e: DataFrame) -> DataFrame:
    """Ego states in the order of event_id."""
    return e.select(
        F.col("event_id").alias("ingest_seq"), "user_id", "stamp_us", "k", *(F.lit(v).alias(c) for c, v in (("pose_frame_id", "map"), ("child_frame_id", "base_link"), ("dynamics_frame_id", "base_link"))),
        vector(F.col("value"), (F.col("event_id") % 1000) / 10.0, 0.0).alias("position"), turn(F.col("k")).alias("orientation"), F.col("value").alias("speed"),
    )


def ego_by_user(e: DataFrame) -> DataFrame:
    """The same states user by user: one series, whose time goes back where a user ends."""
    rank = F.row_number().over(Window.partitionBy("user_id").orderBy("stamp_us", "ingest_seq"))
    return ego(e).withColumn("ingest_seq", F.col("user_id") * 100_000_000 + rank)


def motion(e: DataFrame) -> F.Column:
    """The recorded point of an event."""
    v = vector(F.col("value") / 10, F.col("k") / 10.0, 0.0)
    return F.struct(
        F.col("stamp_us").alias("timestamp_us"), vector(F.col("value"), (F.col("event_id") % 1000) / 10.0, 0.0).alias("position"), turn(F.col("k")).alias("orientation"), v.alias("linear_velocity"),
        vector(0, 0, 0).alias("linear_acceleration"), (F.col("k") * F.lit(0.0628)).alias("yaw"), F.lit(0.0).alias("yaw_rate"), F.lit(0.0).alias("yaw_acceleration"), F.col("value").alias("speed"),
    )


def actors(e: DataFrame) -> DataFrame:
    """One packet with one actor for each event."""
    return e.select(
        F.col("event_id").alias("ingest_seq"), F.col("stamp_us").alias("ref_us"), "stamp_us", F.lit(0).alias("ordinal"), F.col("user_id").cast("string").alias("track_id"), F.col("event_type").alias("label_class"), (F.col("event_type") == "error").alias("is_static"),
        vector(F.col("k") / 20.0, F.col("k") / 50.0, F.col("k") / 40.0).alias("dimensions"), vector(F.col("value"), (F.col("event_id") % 1000) / 10.0, 0.0).alias("position"), turn(F.col("k")).alias("orientation"),
        vector(F.col("value") / 10, F.col("k") / 10.0, 0.0).alias("linear_velocity"), (F.col("value") / 100).alias("speed"),
    )


def polylines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id and 21 points of each embedding."""
    e = F.col("embedding").cast("array<double>")
    points = F.transform(F.sequence(F.lit(0), F.lit(20)), lambda i: F.struct(*(F.get(e, i * 3 + n).alias(c) for n, c in enumerate("xyz"))))
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").cast("string").alias("id"), "vec_id", "label", points.alias("points"))


def navigation_packets(e: DataFrame) -> DataFrame:
    """A navigation update as JSON for each event; the rests of k make other types, wrong frames, counts, times and NaN."""
    k, nan = F.col("k"), F.lit(float("nan"))
    number = lambda i: F.lit(float(i))

    def point(i: int):
        x = F.when((k % 11).isin(2, 3) & (i == 1), nan).otherwise(F.col("value") + i)
        valid = F.when((k % 11 == 3) & (i == 1), False).otherwise((k + i) % 4 != 0) if i == 1 else (k + i) % 4 != 0
        return F.struct(valid.alias("valid"), F.struct(x.alias("x"), number(i).alias("y"), number(0).alias("z")).alias("position"), number(4 * i).alias("longitudinal_distance"))

    route = F.struct(F.when(k % 11 == 0, "odom").otherwise("map").alias("frame_id"), F.lit("base_link").alias("source_frame_id"), F.col("value").alias("lookahead_distance"), F.when(k % 11 == 1, 5).otherwise(3).alias("expected_point_count"), F.array(*(point(i) for i in range(3))).alias("points"))
    own = F.struct(F.lit(True).alias("valid"), vector(F.col("value"), 0, 0).alias("position"), number(0).alias("longitudinal_distance"))
    local = F.struct(F.when(k % 7 == 0, "map").otherwise("base_link").alias("frame_id"), F.lit("base_link").alias("source_frame_id"), number(80).alias("lookahead_distance"), F.lit(0).alias("expected_point_count"), F.array(own).alias("points"))

    def planned(i: int):
        w = F.when((k % 13 == 2) & F.lit(i == 2), nan).otherwise(number(1))
        return F.struct(
            F.when(k % 13 == 1, F.col("stamp_us")).otherwise(F.col("stamp_us") + 500_000 * i).alias("timestamp_us"), vector(F.col("value") + i, 0, 1).alias("position"), F.struct(*(number(0).alias(c) for c in "xyz"), w.alias("w")).alias("orientation"),
            *(vector(0, 0, 0).alias(c) for c in ("linear_velocity", "linear_acceleration")), *(number(0).alias(c) for c in ("yaw", "yaw_rate", "yaw_acceleration")), (F.col("value") + i).alias("speed"),
        )

    plan = F.struct(
        F.when(k % 13 == 3, "odom").otherwise("map").alias("pose_frame_id"), F.when(k % 2 == 1, "model_planning").otherwise("CONTROLLER_REFERENCE").alias("source"), F.lit("planner").alias("producer"), (k % 2 == 1).alias("is_model_generated"),
        F.col("stamp_us").alias("start_timestamp_us"), F.when(k % 13 == 0, F.col("stamp_us") - 1).otherwise(F.col("stamp_us") + 3_000_000).alias("end_timestamp_us"), F.array(*(planned(i) for i in range(3))).alias("points"),
    )
    packet = F.struct(
        F.when(k % 17 == 0, "other").otherwise("navigation_update").alias("message_type"), (k + 1).alias("sequence"), F.col("stamp_us").alias("reference_timestamp_us"), F.when(k % 2 == 1, "Route_Map").otherwise("recorded").alias("route_generator_type"),
        (k % 3 == 0).alias("force_gt_active"), route.alias("route_map"), F.when(k % 5 != 0, local).alias("route_model_input"), F.when(k % 4 != 0, plan).alias("planned_trajectory"),
    )
    return e.select(F.col("event_id").alias("ingest_seq"), F.to_json(packet).alias("payload"))


def actor_packets(e: DataFrame) -> DataFrame:
    """Snapshots of five events each as JSON; every ninth is of another type, and where the rest of k by 46 is 0 or 1 an actor has no track or no y."""
    k, zero = F.col("k"), lambda name: F.lit(0.0).alias(name)
    at = F.struct(F.col("value").alias("x"), F.when(k % 46 != 1, k.cast("double")).alias("y"), zero("z"))
    state = F.struct(
        F.col("stamp_us").alias("timestamp_us"), at.alias("position"), turn(k).alias("orientation"), vector(F.col("value") / 10, 0, 0).alias("linear_velocity"), vector(0, 0, 0).alias("linear_acceleration"),
        zero("yaw"), zero("yaw_rate"), zero("yaw_acceleration"), (F.col("value") / 100).alias("speed"),
    )
    actor = F.struct(F.when(k % 46 != 0, F.col("user_id")).alias("track_id"), F.col("event_type").alias("label_class"), (F.col("event_type") == "error").alias("is_static"), vector(k / 20.0, 1, k / 40.0).alias("dimensions"), state.alias("current_state"))
    packet = F.expr("event_id div 5")
    each = e.select(packet.alias("ingest_seq"), "stamp_us", F.struct("event_id", actor.alias("actor")).alias("a")).groupBy("ingest_seq").agg(F.max("stamp_us").alias("timestamp_us"), F.sort_array(F.collect_list("a")).alias("all"))  # five rows a packet
    kind = F.when(F.col("ingest_seq") % 9 == 0, "other").otherwise("actor_snapshot")
    frame = F.when(F.col("ingest_seq") % 4 == 0, "odom")
    return each.select("ingest_seq", F.to_json(F.struct(kind.alias("message_type"), "timestamp_us", frame.alias("dynamics_frame_id"), F.transform("all", lambda x: x["actor"]).alias("actors"))).alias("payload"))


def ego_packets(e: DataFrame) -> DataFrame:
    """Ego states as JSON by the last digit of k: 0 broken, 1 without a time, 2 without x, 3 without w, 4 without an acceleration."""
    d = F.col("k") % 10
    but = lambda n, c: F.when(d != n, F.col(c)).alias(c.split(".")[-1])
    still = vector(0, 0, 0)
    body = F.struct(
        F.when(d != 1, F.col("stamp_us")).alias("timestamp_us"), F.struct(but(2, "position.x"), "position.y", "position.z").alias("position"), F.struct("orientation.x", "orientation.y", "orientation.z", but(3, "orientation.w")).alias("orientation"),
        *(still.alias(c) for c in ("linear_velocity", "angular_velocity", "linear_acceleration")), F.when(d != 4, still).alias("angular_acceleration"), "speed",
    )
    return ego(e).select("ingest_seq", F.when(d == 0, "{broken").otherwise(F.to_json(body)).alias("payload"))


def camera_packets(e: DataFrame, cameras: tuple[str, ...]) -> DataFrame:
    """Headers of camera frames as JSON; those of k over 50 have metadata with fields, lists and nulls that no schema names, the pose under names by the rest of k."""
    k = F.col("k")
    axes = lambda names: F.concat(F.lit("{"), *(x for i, (n, v) in enumerate(names) for x in (F.lit(f'{", " if i else ""}"{n}": '), v.cast("string"))), F.lit("}"))
    half = k / 2.0
    shift, turned = axes([("z", half), ("y", half + 1), ("x", half + 2)]), axes([("w", F.lit(1)), ("x", F.lit(0.0)), ("y", F.lit(0.0)), ("z", half)])
    names = [("vec", "quat"), ("translation", "rotation"), ("vec3", "orientation"), ("position", None)]
    pose = F.coalesce(*(F.when(k % 4 == i, F.concat(F.lit(f'"{v}": '), shift, *((F.lit(f', "{q}": '), turned) if q else ()))) for i, (v, q) in enumerate(names)))
    camera = F.element_at(F.array(*(F.lit(c) for c in (*cameras, "unknown"))), (F.col("event_id") % 6 + 1).cast("int"))
    meta = F.concat(F.lit('{"sensor": {"zoom": null, "lens": ['), k.cast("string"), F.lit(', 0.50, {"b": true, "a": "\u00e9"}, []], "model": "f"}, "available_camera": {"rig_to_camera": {'), pose, F.lit('}, "logical_id": "'), camera, F.lit('"}}'))
    header = F.concat(F.lit('{"camera_logical_id": "'), camera, F.lit('", "end_timestamp_us": '), F.col("stamp_us").cast("string"), F.lit(', "camera_metadata": '), F.when(k > 50, meta).otherwise("null"), F.lit("}"))
    return e.select(F.col("event_id").alias("ingest_seq"), header.alias("payload"))


def vector_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maps of up to 64 lanes each as JSON, in scenes by label; those of label 3 are of another type, and a lane in 97 has a heading too few."""
    v, points = F.col("vec_id"), F.col("points")
    line = lambda n, headings=None: F.struct(F.slice(points, 1, n).alias("points"), (F.array() if headings is None else headings).cast("array<double>").alias("headings"))
    two = F.when(v % 97 == 0, F.array(F.lit(0.1))).otherwise(F.array(F.lit(0.1), F.lit(0.2)))
    lane = F.struct("id", line(3).alias("centerline"), line(2, two).alias("left_boundary"), line(1).alias("right_boundary"), F.array((v + 1).cast("string")).alias("successor_ids"))
    edge = F.struct("id", line(2).alias("polyline"))
    sign = F.struct("id", F.concat(F.lit("S"), "label").alias("sign_type"), F.get(points, F.lit(0)).alias("position"))
    wait = F.struct("id", F.lit("STOP").alias("wait_line_type"), (v % 2 == 0).alias("is_implicit"), line(2).alias("polyline"))
    every = F.sort_array(F.collect_list(F.struct("vec_id", lane.alias("lane"), edge.alias("edge"), sign.alias("sign"), wait.alias("wait"))))  # 64 rows a map
    maps = polylines(spark, sf_dir).withColumn("n", F.expr("vec_id div 64")).groupBy("label", "n").agg(every.alias("all"))
    some = lambda c, m: F.transform(F.filter("all", lambda x: x["vec_id"] % m == 0), lambda x: x[c]).alias(c + "s")
    packet = F.struct(
        F.when(F.col("label") == 3, "other").otherwise("vector_map").alias("message_type"), F.col("label").cast("string").alias("scene_id"), F.concat_ws("-", "label", "n").alias("map_id"),
        F.struct(vector(-1, 0, 0).alias("minimum"), vector(F.size("all"), 0, 0).alias("maximum")).alias("extent"),
        F.transform("all", lambda x: x["lane"]).alias("lanes"), some("edge", 3).alias("road_edges"), some("sign", 4).alias("traffic_signs"), some("wait", 5).alias("wait_lines"),
    )
    return maps.select((F.col("label") * 1_000_000 + F.col("n")).cast("long").alias("ingest_seq"), F.to_json(packet).alias("payload"))


def framed_bytes(e: DataFrame) -> DataFrame:
    """Byte strings ``raw`` of twenty camera frames each (``stream``); every k in 25 sends a length of 0."""
    length = lambda n, digits: F.lpad(F.hex(n), digits, "0")
    text, image = F.concat(F.lit('{"n":'), F.col("k"), F.lit("}")), F.expr("repeat('FF', cast(k % 4 as int))")
    frame = F.concat(length(F.octet_length(text), 8), F.hex(text.cast("binary")), length(F.col("k") % 4, 16), image)
    rows = e.select(F.expr("event_id div 20").alias("stream"), F.struct("event_id", F.when(F.col("k") % 25 == 0, "00000000").otherwise(frame).alias("hex")).alias("f"))
    return rows.groupBy("stream").agg(F.unhex(F.array_join(F.transform(F.sort_array(F.collect_list("f")), lambda x: x["hex"]), "")).alias("raw"))  # twenty rows a stream
