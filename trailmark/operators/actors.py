"""Actor tracks: current states, history, future and prediction."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.timeutil import history_capacity
from ..schemas import ACTOR_SOURCES
from .series import bracket, downsample


@dataclass(frozen=True)
class ActorConfig:
    history_us: int = 2_000_000
    future_us: int = 5_000_000
    period_us: int = 500_000
    max_points: int = 64
    stale_us: int = 5_000_000
    producer: str = "ground_truth"
    placeholder: str = "ground_truth_placeholder"

    def __post_init__(self) -> None:
        if min(self.history_us, self.future_us, self.stale_us) < 0 or self.period_us <= 0 or self.max_points < 1:
            raise ValueError("durations must not be negative, the period must be above 0, and a track needs a point")

    @property
    def capacity(self) -> int:
        return history_capacity(self.history_us / 1e6, self.period_us / 1e6, self.max_points)


def snapshots(records: DataFrame) -> DataFrame:
    """A row for each actor of each packet, in its order: ``ref_us``, ``at``, track fields, ``state``."""
    each = records.select("ingest_seq", F.col("timestamp_us").alias("ref_us"), *(F.coalesce(c, F.lit("map")).alias(c) for c in ("pose_frame_id", "dynamics_frame_id")), F.posexplode("actors").alias("at", "a"))
    return each.select("ingest_seq", "ref_us", "pose_frame_id", "dynamics_frame_id", "at", *(F.col(f"a.{c}").alias(c) for c in ("track_id", "label_class", "is_static", "dimensions", "available_future_points")), F.col("a.current_state").alias("state"))


def _slot(us: Column, width: int) -> Column:
    return ((us - F.pmod(us, F.lit(width))) / width).cast("long")


def _evicting(spans: DataFrame, packets: DataFrame, config: ActorConfig, by: list[str]) -> DataFrame:
    """The first packet that comes more than the stale time behind each span's ``last_seen_us``, as ``after`` (ingest_seq, ref_us); null if none does."""
    first = packets.groupBy(*by, "ref_us").agg(F.min("ingest_seq").alias("ingest_seq"))
    points = first.select(*by, F.col("ref_us").alias("stamp_us"), F.struct("ingest_seq", "ref_us").alias("point"))
    return bracket(spans.withColumn("stamp_us", F.col("last_seen_us") + config.stale_us + 1), points, by, chunk_us=max(config.stale_us, 1) * 16).drop("before", "stamp_us")


def life_times(rows: DataFrame, packets: DataFrame, config: ActorConfig, *, by: list[str]) -> DataFrame:
    """``rows`` with ``life``: it grows where a packet between a track's last row and this one evicted the track, whoever sent it."""
    of_track = Window.partitionBy(*by, "track_id").orderBy("ingest_seq")
    placed = rows.withColumn("last_seen_us", F.lag("ref_us").over(of_track))
    own = ["track_id", "ingest_seq"]
    late = placed.where(F.col("ref_us") - F.col("last_seen_us") > config.stale_us).select(*by, *own, "last_seen_us")
    evicted = _evicting(late.withColumnRenamed("ingest_seq", "_at"), packets, config, by).where(F.col("after.ingest_seq") < F.col("_at"))
    evicted = evicted.select(*(F.col(c).alias(f"_by_{c}") for c in by), F.col("track_id").alias("_track"), "_at")
    same = (F.col("track_id") == F.col("_track")) & (F.col("ingest_seq") == F.col("_at"))
    for c in by:
        same &= F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    marked = placed.join(evicted, same, "left").withColumn("life", F.sum(F.col("_at").isNotNull().cast("int")).over(of_track.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.select(*rows.columns, "life")


def rings(rows: DataFrame, packets: DataFrame, config: ActorConfig, *, by: list[str], time: str, meta: list[str] | None = None) -> DataFrame:
    """Each row with ``ring``: the samples in its track's buffer behind it, oldest first. An evicted track starts with an empty one."""
    living = life_times(rows, packets, config, by=by)
    of_life = Window.partitionBy(*by, "track_id", "life").orderBy("ingest_seq")
    seen = living.withColumn("_again", F.col(time).eqNullSafe(F.lag(time).over(of_life)) & F.lag("ingest_seq").over(of_life).isNotNull())
    sample = F.struct(F.col(time).alias("t"), "ingest_seq", *(meta or []))
    # the place among the buffered samples; a row that isn't buffered has that of the last one
    seen = seen.withColumn("_place", F.sum((~F.col("_again")).cast("int")).over(of_life.rowsBetween(Window.unboundedPreceding, 0)))
    newest = Window.partitionBy(*by, "track_id", "life").orderBy("_place").rangeBetween(-(config.capacity - 1), 0)
    return seen.withColumn("ring", F.collect_list(F.when(~F.col("_again"), sample)).over(newest)).drop("_again", "_place")


def history(rows: DataFrame, packets: DataFrame, config: ActorConfig, *, by: list[str] | None = None, time: str = "stamp_us", meta: list[str] | None = None) -> DataFrame:
    """For each packet and buffered track: the ring's samples inside the history, thinned, and what they span.

    ``rows``: by, ingest_seq, track_id, ``time``, ref_us; ``packets``: by, ingest_seq, ref_us, and maybe
    others. ``by`` tells rollouts apart: inside one, ref_us doesn't fall. A track also appears in
    packets that it isn't in, until it is stale. A state whose time equals the track's last one is
    not buffered, but the track counts as seen. Any packet evicts the tracks that are stale by its
    time, so a track that comes again after one has lost its samples. ``meta``: columns of ``rows``, returned as they are
    in the newest sample inside the history.

    Packets meet the tracks that they may see by slots of the stale time: a track is in two at most
    for each time that it is seen. Which of its rows a packet sees is told by one scan of both in
    their order, so that no packet meets all rows of a slot.
    """
    by, meta = by or [], meta or []
    of_track = Window.partitionBy(*by, "track_id").orderBy("ingest_seq")
    seen = rings(rows, packets, config, by=by, time=time, meta=meta).withColumn("_next", F.lead("ingest_seq").over(of_track))
    width = max(config.stale_us, 1)
    slots = F.explode(F.array_distinct(F.array(_slot(F.col("ref_us"), width), _slot(F.col("ref_us") + config.stale_us, width)))).alias("_slot")
    spans = seen.where("_next IS NULL OR _next > ingest_seq").select(*by, "track_id", "ingest_seq", F.lit(None).cast("long").alias("ref_us"), F.struct("_next", F.col("ref_us").alias("last_seen_us"), "ring").alias("_span"), slots)
    placed = packets.select(*by, "ingest_seq", "ref_us", _slot(F.col("ref_us"), width).alias("_slot"))
    pairs = placed.join(rows.select(*by, "track_id", slots).distinct(), [*by, "_slot"])
    both = spans.withColumn("_packet", F.lit(False)).unionByName(pairs.withColumns({"_packet": F.lit(True), "_span": F.lit(None).cast(spans.schema["_span"].dataType)}))
    scan = Window.partitionBy(*by, "track_id", "_slot").orderBy("ingest_seq", "_packet").rowsBetween(Window.unboundedPreceding, 0)
    joined = both.withColumn("s", F.last("_span", ignorenulls=True).over(scan))
    joined = joined.where(F.col("_packet") & (F.col("s._next").isNull() | (F.col("ingest_seq") < F.col("s._next"))) & (F.col("ref_us") - F.col("s.last_seen_us") <= config.stale_us))
    inside = F.filter("s.ring", lambda x: (x["t"] >= F.col("ref_us") - config.history_us) & (x["t"] <= F.col("ref_us")))
    out = joined.select(*by, "ingest_seq", "ref_us", "track_id", "s.last_seen_us", inside.alias("_inside"))
    out = out.where(F.size("_inside") > 0).withColumns({"valid": F.array_sort("_inside"), **{c: F.element_at("_inside", -1)[c] for c in meta}}).drop("_inside")
    out = out.withColumn("points", downsample("valid", "t", config.period_us, config.max_points))
    return out.withColumn("actual_us", F.greatest(F.col("ref_us") - F.get("points", F.lit(0))["t"], F.lit(0))).withColumn("source", F.lit(ACTOR_SOURCES["HISTORY"]))


def stale_tracks(rows: DataFrame, packets: DataFrame, config: ActorConfig, *, by: list[str] | None = None) -> DataFrame:
    """Tracks that a packet evicts: track_id, last_seen_us, and the packet's ingest_seq and ref_us.

    It is the first packet that comes more than the stale time behind the last one that has the track.
    """
    by = by or []
    of_track = Window.partitionBy(*by, "track_id").orderBy("ingest_seq")
    spans = rows.select(*by, "track_id", F.col("ref_us").alias("last_seen_us"), F.lead("ingest_seq").over(of_track).alias("_next"))
    out = _evicting(spans, packets, config, by).where("after IS NOT NULL AND (_next IS NULL OR after.ingest_seq < _next)")
    return out.select(*by, "track_id", "last_seen_us", "after.ingest_seq", "after.ref_us")


def future(rows: DataFrame, config: ActorConfig, *, points: str = "available_future_points", time: str = "timestamp_us") -> DataFrame:
    """Tracks of the packet with the coming points inside the future, thinned."""
    ref = F.col("ref_us")
    inside = F.filter(F.coalesce(F.col(points), F.array().cast(rows.schema[points].dataType)), lambda p: (p[time] >= ref) & (p[time] <= ref + config.future_us))
    out = rows.withColumn("_sorted", F.array_sort(inside, lambda a, b: F.when(a[time] < b[time], -1).when(a[time] > b[time], 1).otherwise(0)))
    out = out.where(F.size("_sorted") > 0).withColumn("points", downsample("_sorted", time, config.period_us, config.max_points)).drop("_sorted")
    actual: Column = F.greatest(F.element_at("points", -1)[time] - ref, F.lit(0))
    return out.withColumns({"actual_us": actual, "source": F.lit(ACTOR_SOURCES["FUTURE"]), "producer": F.lit(config.producer), "is_model_generated": F.lit(False)})


def prediction(futures: DataFrame, config: ActorConfig) -> DataFrame:
    """The future in the place of a model's prediction."""
    return futures.withColumns({"source": F.lit(ACTOR_SOURCES["PLACEHOLDER"]), "producer": F.lit(config.placeholder)})


def header(packets: DataFrame, config: ActorConfig, kind: str) -> DataFrame:
    """What an array of tracks says of itself: source, producer, requested_us, interval_us. ``kind``: HISTORY, FUTURE or PLACEHOLDER."""
    asked = config.history_us if kind == "HISTORY" else config.future_us
    producer = config.placeholder if kind == "PLACEHOLDER" else config.producer
    return packets.withColumns({"source": F.lit(ACTOR_SOURCES[kind]), "producer": F.lit(producer), "is_model_generated": F.lit(False), "requested_us": F.lit(asked), "interval_us": F.lit(config.period_us)})


def packet_duration(tracks: DataFrame, packets: DataFrame, by: list[str]) -> DataFrame:
    """The span of all points of each packet from its own time (0 without tracks), and the number of tracks.

    ``tracks``: by, points, whose times are ``t`` or ``timestamp_us``; ``packets``: by, ref_us.
    """
    time = "t" if "t" in tracks.schema["points"].dataType.elementType.names else "timestamp_us"
    spans = tracks.groupBy(*by).agg(F.min(F.get("points", F.lit(0))[time]).alias("_first"), F.max(F.element_at("points", -1)[time]).alias("_last"), F.count("*").alias("n_tracks"))
    ref = F.col("ref_us")
    duration = F.greatest(F.greatest(ref, F.coalesce("_last", ref)) - F.least(ref, F.coalesce("_first", ref)), F.lit(0))
    return packets.join(spans, by, "left").withColumn("actual_us", duration).withColumn("n_tracks", F.coalesce("n_tracks", F.lit(0))).drop("_first", "_last")
