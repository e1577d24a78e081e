"""Recorded trajectories: cache, request, time grid and interpolation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.geometry import lerp, lerp_vector, nlerp, norm
from .series import bracket, max_points, ranked, regular_grid, revisions, thin


def increasing(points: Column | str, time: str = "timestamp_us") -> Column:
    """There is a point, and times rise strictly."""
    points = F.col(points) if isinstance(points, str) else points
    later = F.slice(points, 2, F.greatest(F.size(points), F.lit(1)))
    pairs = F.zip_with(F.slice(points, 1, F.greatest(F.size(points) - 1, F.lit(0))), later, lambda a, b: a[time] < b[time])
    return (F.size(points) > 0) & F.forall(pairs, lambda x: x)


@dataclass(frozen=True)
class FutureConfig:
    """What a client asks of a recording at each tick."""

    future_us: int = 6_400_000
    interval_us: int = 100_000
    max_points: int = 65
    rate_hz: float = 2.0

    def __post_init__(self) -> None:
        if min(self.future_us, self.interval_us) < 0 or self.max_points < 1 or self.rate_hz <= 0:
            raise ValueError("durations must not be negative; points and rate must be above 0")

    @property
    def period_us(self) -> int:
        return round(1_000_000 / self.rate_hz)


def cache(packets: DataFrame, by: list[str] | None = None) -> DataFrame:
    """What each recording does to the cache: ``status`` invalid, duplicate or cached, the revision it is or makes, and its bounds.

    ``packets``: by, ingest_seq, scene_id, source_revision, points. A recording without points, or
    whose times don't rise, leaves the cache alone; one with the key of the cached one is no news.
    """
    by = by or []
    rows = packets.withColumns({"source_revision": F.coalesce("source_revision", F.lit(1)), "_good": F.coalesce(increasing("points"), F.lit(False))})
    rows = rows.withColumns({"start_us": F.get("points", F.lit(0))["timestamp_us"], "end_us": F.get("points", F.size("points") - 1)["timestamp_us"]}).drop("points")
    good = revisions(rows.where("_good"), ["scene_id", "source_revision"], by=by)
    first = F.min("ingest_seq").over(Window.partitionBy(*by, "revision"))
    good = good.withColumn("status", F.when(F.col("ingest_seq") == first, "cached").otherwise("duplicate"))
    bad = rows.where("NOT _good").withColumn("status", F.lit("invalid"))
    return good.unionByName(bad, allowMissingColumns=True).select(*by, "ingest_seq", "scene_id", "source_revision", "status", "revision", "start_us", "end_us")


def tick_requests(ticks: DataFrame, config: FutureConfig) -> DataFrame:
    """A request for each tick. ``ticks``: keys, request_id, tick_us. Each asks for another window, so none names a revision."""
    asked = {"future_duration_us": config.future_us, "sampling_interval_us": config.interval_us, "max_points": config.max_points}
    return ticks.withColumnRenamed("tick_us", "reference_us").withColumns({**{c: F.lit(v) for c, v in asked.items()}, "known_revision": F.lit(0)})


def usable(responses: DataFrame, points: str = "points") -> DataFrame:
    """Answers that a client publishes: they succeeded, say something new, and aren't empty."""
    return responses.where((F.col("status") == "ok") & (F.size(points) > 0))


def answer_status(requests: DataFrame, recordings: DataFrame, *, on: list[str]) -> DataFrame:
    """Requests with ``status``: no_recording, not_modified, out_of_range or ok, in this order, and the clipped window.

    ``requests``: on, reference_us, future_duration_us, known_revision...; ``recordings``: on, revision,
    start_us, end_us (one row for each cached recording).
    """
    both = requests.join(recordings, on, "left")
    known = (F.col("known_revision") != 0) & (F.col("known_revision") == F.col("revision"))
    status = (
        F.when(F.col("revision").isNull(), "no_recording").when(known, "not_modified").when(~F.col("reference_us").between(F.col("start_us"), F.col("end_us")), "out_of_range").otherwise("ok")
    )
    until = F.least(F.col("reference_us") + F.greatest(F.col("future_duration_us"), F.lit(0)), F.col("end_us"))
    return both.withColumn("status", status).withColumn("until_us", until).withColumn("revision", F.coalesce("revision", F.lit(0)))


def _once(rows: DataFrame, **columns: Column) -> DataFrame:
    """Add columns behind a generator: what reads them finds columns, where a projection would be merged and its expressions copied."""
    own = F.struct(*(c.alias(n) for n, c in columns.items()))
    return rows.select("*", F.explode(F.array(own)).alias("_own")).select(*rows.columns, *(F.col(f"_own.{n}").alias(n) for n in columns))


def interpolate(rows: DataFrame, time: str = "stamp_us") -> DataFrame:
    """``point`` at ``time`` between the columns ``before`` and ``after``; a recorded point keeps its own quaternion and speed, a new one has the speed of its velocity."""
    before, after, t = F.col("before"), F.col("after"), F.col(time)
    span = after["timestamp_us"] - before["timestamp_us"]
    first = before.isNotNull() & (after.isNull() | (before["timestamp_us"] == t) | (span <= 0))
    stored = F.when(first, before).when(before.isNull() | (after["timestamp_us"] == t), after)
    out = _once(rows, _stored=stored, _alpha=F.greatest(F.least(F.try_divide(t - before["timestamp_us"], span), F.lit(1.0)), F.lit(0.0)))
    alpha = F.col("_alpha")
    out = _once(out, _velocity=lerp_vector(before["linear_velocity"], after["linear_velocity"], alpha), _turn=nlerp(before["orientation"], after["orientation"], alpha))
    new = {
        "position": lerp_vector(before["position"], after["position"], alpha), "orientation": F.col("_turn"), "linear_velocity": F.col("_velocity"), "linear_acceleration": lerp_vector(before["linear_acceleration"], after["linear_acceleration"], alpha),
        **{c: lerp(before[c], after[c], alpha) for c in ("yaw", "yaw_rate", "yaw_acceleration")}, "speed": norm(F.col("_velocity")),
    }
    fields = (F.when(F.col("_stored").isNotNull(), F.col("_stored")[c]).otherwise(v).alias(c) for c, v in new.items())
    return out.select(*rows.columns, F.struct(t.alias("timestamp_us"), *fields).alias("point"))


def time_grid(requests: DataFrame) -> DataFrame:
    """``grid``: the times of each answer at regular steps, from sampling_interval_us and max_points."""
    most = max_points("max_points")
    grid = regular_grid(F.col("reference_us"), F.col("until_us"), F.col("sampling_interval_us"), most)
    return requests.withColumn("_all", grid).withColumn("grid", thin(F.col("_all"), most)).drop("_all")


def native_times(requests: DataFrame, points: DataFrame, *, on: list[str], chunk_us: int = 86_400_000_000) -> DataFrame:
    """on, request_id, reference_us and ``stamp_us``: the recorded times of each request's window, with its ends if they aren't recorded (the later one if there is room), thinned to max_points.

    No request gathers the times of its recording: the places of the first and last one inside say
    how many there are, and those that stay after thinning are looked up by place.
    """
    numbered = ranked(points.select(*on, "stamp_us"), on, "stamp_us", name="place", chunk=chunk_us)
    marks = numbered.withColumn("point", F.struct("stamp_us", "place"))
    at = lambda df, c: df.withColumn("stamp_us", F.col(c))
    asked = requests.select(*on, "request_id", "reference_us", "until_us", max_points("max_points").alias("most"))
    asked = bracket(at(asked, "reference_us"), marks, on, chunk_us=chunk_us).withColumnRenamed("after", "first").drop("before", "stamp_us")
    asked = bracket(at(asked, "until_us"), marks, on, chunk_us=chunk_us).withColumnRenamed("before", "last").drop("after", "stamp_us")
    inside = F.greatest(F.coalesce(F.col("last.place") - F.col("first.place") + 1, F.lit(0)), F.lit(0))
    asked = _once(asked, _inside=inside)
    within = F.col("_inside") > 0
    asked = _once(asked, _head=(~within | (F.col("first.stamp_us") != F.col("reference_us"))).cast("long"), _end=F.when(within, F.col("last.stamp_us")).otherwise(F.col("reference_us")))
    asked = _once(asked, _tail=((F.col("_end") != F.col("until_us")) & (F.col("_head") + F.col("_inside") < F.col("most"))).cast("long"))
    total, most = F.col("_total"), F.col("most").cast("long")
    spread = F.transform(F.sequence(F.lit(0).cast("long"), F.greatest(most, F.lit(2)) - 1), lambda i: F.rint(i * (total - 1) / (F.greatest(most, F.lit(2)) - 1)).cast("long"))
    kept = F.when(total <= most, F.sequence(F.lit(0).cast("long"), total - 1)).when(most == 1, F.array(F.lit(0).cast("long"))).otherwise(spread)
    asked = _once(asked, _total=F.col("_head") + F.col("_inside") + F.col("_tail"))
    rows = asked.select("*", F.explode(kept).alias("_i"))
    own = F.when((F.col("_i") == 0) & (F.col("_head") == 1), F.col("reference_us")).when((F.col("_i") == F.col("_total") - 1) & (F.col("_tail") == 1), F.col("until_us"))
    rows = rows.select(*on, "request_id", "reference_us", own.alias("_own"), F.when(own.isNull(), F.col("first.place") + F.col("_i") - F.col("_head")).alias("place"))
    return rows.join(numbered, [*on, "place"], "left").select(*on, "request_id", "reference_us", F.coalesce("_own", "stamp_us").alias("stamp_us"))


def answers(requests: DataFrame, points: DataFrame, *, on: list[str], native: bool = True) -> DataFrame:
    """Points of every request that is ok: request columns, ``stamp_us``, ``offset_us``, ``point``.

    ``points``: on, stamp_us, point. A request whose sampling_interval_us isn't over 0 gets the
    recorded times (``native``: there may be such). The bracket of each time comes from one scan of
    the recording.
    """
    wanted = requests.where("status = 'ok'")
    regular = wanted.where("sampling_interval_us > 0") if native else wanted
    times = time_grid(regular).select(*on, "request_id", "reference_us", F.explode("grid").alias("stamp_us"))
    if native:
        times = times.unionByName(native_times(wanted.where("sampling_interval_us <= 0"), points, on=on))
    out = interpolate(bracket(times, points, on))
    return out.withColumn("offset_us", F.col("stamp_us") - F.col("reference_us")).drop("before", "after")
