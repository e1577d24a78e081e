"""What is published on a clock: tick tables, and states as of each tick."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .ego import PathConfig, path_segments
from .series import admit, bracket, ranked


def ticks(clock: DataFrame, period_us: int, by: list[str], time: str = "stamp_us") -> DataFrame:
    """Ticks of each key from its first time to its last: by, ``tick`` (from 0), ``tick_us``."""
    spans = clock.groupBy(*by).agg(F.min(time).alias("_from"), F.max(time).alias("_to"))
    return spans.select(*by, F.posexplode(F.sequence("_from", "_to", F.lit(period_us).cast("long"))).alias("tick", "tick_us"))


def as_of(tick_rows: DataFrame, rows: DataFrame, by: list[str], time: str = "stamp_us", seq: str | None = None) -> DataFrame:
    """``row``: the last of ``rows`` at or before each tick, as a struct; null before the first. ``seq`` orders rows of one time."""
    order = [F.col(seq).alias("_seq")] if seq else []
    held = rows.select(*by, F.col(time).alias("tick_us"), *order, F.struct(*(c for c in rows.columns if c not in by)).alias("point"))
    return bracket(tick_rows.withColumn("_us", F.col("tick_us")), held, by, time="tick_us", seq="_seq" if seq else None).withColumn("row", F.col("before")).drop("before", "after", "_us")


def path_snapshots(ego: DataFrame, tick_rows: DataFrame, config: PathConfig, by: list[str]) -> DataFrame:
    """The executed path as published at each tick: by, tick, tick_us, segment, reference_us, duration_us, n_points.

    ``by`` tells rollouts apart, so that time doesn't fall inside one. A tick before the first
    sample publishes nothing, nor does one whose history holds no sample. The samples of a path
    aren't copied to each tick: a sample carries its place in the path, and the difference of two
    places is a number of points. With a limit of age, the first sample inside it is looked up as
    of the latest time received before the tick, less the limit.
    """
    rows = path_segments(ego, by)
    path = [*by, "segment"]
    samples = ranked(admit(rows, path, "ingest_seq", "stamp_us", config.interval_us), path, "ingest_seq").select(*path, "ingest_seq", "stamp_us", "rank")
    oldest = samples.select(*path, F.col("rank").alias("_from"), F.col("stamp_us").alias("oldest_us"))
    samples = samples.withColumn("_from", F.greatest(F.col("rank") - config.max_points + 1, F.lit(1))).join(oldest, [*path, "_from"])
    marks = samples.select(*path, "stamp_us", "ingest_seq", F.struct("stamp_us", "rank", "oldest_us").alias("point"))
    received = rows.select(*by, "segment", "ingest_seq", "stamp_us", F.col("stamp_us").alias("latest_us"))
    out = as_of(tick_rows, received, by, seq="ingest_seq").where("row IS NOT NULL")
    return _published(out.select(*by, "tick", "tick_us", "row.segment", "row.latest_us"), marks, path, config)


def _published(out: DataFrame, marks: DataFrame, path: list[str], config: PathConfig) -> DataFrame:
    """The ticks with the samples that are retained at each: the last one, and the first by number and by age."""
    at = lambda df, us: df.withColumn("stamp_us", us)
    out = bracket(at(out, F.col("latest_us")), marks, path, seq="ingest_seq").withColumnRenamed("before", "last").drop("after", "stamp_us").where("last IS NOT NULL")
    first, n = F.col("last.oldest_us"), F.least(F.col("last.rank"), F.lit(config.max_points))
    if config.history_us:
        out = bracket(at(out, F.col("latest_us") - config.history_us), marks, path, seq="ingest_seq").withColumnRenamed("after", "first").drop("before", "stamp_us")
        n = F.least(n, F.col("last.rank") - F.col("first.rank") + 1)
        first = F.greatest(first, F.col("first.stamp_us"))
        out = out.where("first IS NOT NULL AND first.rank <= last.rank")
    return out.select(*path[:-1], "tick", "tick_us", "segment", first.alias("reference_us"), (F.col("last.stamp_us") - first).alias("duration_us"), n.alias("n_points"))


@dataclass(frozen=True)
class MapClientConfig:
    """How often a client asks for the map, and sends again what it has."""

    request_us: int = 1_000_000
    republish_us: int = 2_000_000

    def __post_init__(self) -> None:
        if self.republish_us <= 0:
            raise ValueError("the map must be sent again after a time above 0")

    @property
    def periods(self) -> tuple[int, int]:
        """Neither clock runs faster than ten times a second."""
        return max(self.request_us, 100_000), max(self.republish_us, 100_000)


def map_polls(tick_rows: DataFrame, cached: DataFrame, by: list[str]) -> DataFrame:
    """What a map client does at each tick: ``action`` none (no map yet, or no news without one), publish (a new revision) or republish (the one it has).

    ``cached``: by, stamp_us, revision, and maybe ingest_seq (the order of maps of one time) and
    scene_id, a row for each map that came. An answer without a scene has no map: the client stays
    with what it knows.
    """
    seq = "ingest_seq" if "ingest_seq" in cached.columns else None
    usable = F.length("scene_id") > 0 if "scene_id" in cached.columns else F.lit(True)
    held = cached.select(*by, "stamp_us", "revision", F.coalesce(usable, F.lit(False)).alias("usable"), *([seq] if seq else []))
    out = as_of(tick_rows, held, by, seq=seq).withColumn("asked", F.when(F.col("row.usable"), F.col("row.revision"))).drop("row")
    so_far = Window.partitionBy(*by).orderBy("tick")
    shown = F.last("asked", ignorenulls=True)
    out = out.withColumn("revision", shown.over(so_far.rowsBetween(Window.unboundedPreceding, 0))).withColumn("_known", shown.over(so_far.rowsBetween(Window.unboundedPreceding, -1)))
    same = F.col("asked").eqNullSafe(F.col("_known"))
    out = out.withColumn("action", F.when(F.col("asked").isNull(), "none").when(same, "republish").otherwise("publish"))
    return out.drop("asked", "_known")
