"""Operators on time series: segments, greedy thinning, time grids, as-of brackets."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Rows of a chunk when one long series is worked on in parallel.
CHUNK = 1_000_000


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def segment(df: DataFrame, seq: str, columns: list[str], breaks: Callable[[dict[str, Column], dict[str, Column]], Column], *, by: list[str] | None = None, name: str = "segment", chunk: int = CHUNK) -> DataFrame:
    """Number the segments of each series ordered by ``seq``: one begins where ``breaks(before, row)`` holds.

    A single long series is no obstacle: chunks of ``seq`` are scanned side by side, and only a row
    of each chunk (its first and last values, its number of breaks) meets in one window.
    """
    by = by or []
    work = df.withColumn("_chunk", F.floor(F.col(seq) / chunk))
    inside = Window.partitionBy(*by, "_chunk").orderBy(seq)
    now = {c: F.col(c) for c in columns}
    work = work.withColumn("_break", F.coalesce(breaks({c: F.lag(c).over(inside) for c in columns}, now), F.lit(False)).cast("int"))
    work = work.withColumn("_breaks", F.sum("_break").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    whole = F.struct(F.col(seq).alias("_seq"), *columns)
    ends = [F.min(whole).alias("_first"), F.max(whole).alias("_last")]
    chunks = work.groupBy(*by, "_chunk").agg(*ends, F.sum("_break").alias("_inside"))
    order = Window.partitionBy(*by).orderBy("_chunk")
    border = breaks({c: F.lag("_last").over(order)[c] for c in columns}, {c: F.col("_first")[c] for c in columns})
    chunks = chunks.withColumn("_border", F.coalesce(border, F.lit(False)).cast("int"))
    sums = F.sum(F.col("_border")).over(order.rowsBetween(Window.unboundedPreceding, 0)) + F.coalesce(F.sum("_inside").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    chunks = chunks.select(*(F.col(c).alias(f"_by_{c}") for c in by), F.col("_chunk").alias("_at"), sums.alias("_base"))
    same = F.col("_chunk") == F.col("_at")
    for c in by:
        same &= F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    return work.join(chunks, same).withColumn(name, F.col("_base") + F.col("_breaks")).drop("_chunk", "_break", "_breaks", "_at", "_base", *(f"_by_{c}" for c in by))


def rollouts(df: DataFrame, seq: str = "ingest_seq", time: str = "stamp_us", by: list[str] | None = None, name: str = "rollout_id") -> DataFrame:
    """A new rollout begins where time goes backwards."""
    return segment(df, seq, [time], lambda before, row: row[time] < before[time], by=by, name=name)


def revisions(df: DataFrame, key: list[str], seq: str = "ingest_seq", by: list[str] | None = None, name: str = "revision") -> DataFrame:
    """Revision from 1; it grows where the key differs from the one that is cached, so A, B, A are 1, 2, 3."""
    changed = lambda before, row: before[seq].isNotNull() & ~_all_same(before, row, key)
    return segment(df, seq, [seq, *key], changed, by=by, name=name).withColumn(name, F.col(name) + 1)


def _all_same(before: dict[str, Column], row: dict[str, Column], key: list[str]) -> Column:
    same = F.lit(True)
    for c in key:
        same &= before[c].eqNullSafe(row[c])
    return same


def _thinned(times: pa.ListArray, period_us: int, most: int) -> pa.ListArray:
    """The places that :func:`downsample` keeps of each list, a place of all lists at a time."""
    ends, flat = times.offsets.to_numpy(), times.values.fill_null(0).to_numpy()
    long = np.argsort(-np.diff(ends), kind="stable")  # the longest first, so that those with a place lie ahead
    start, size = ends[:-1][long], np.diff(ends)[long]
    keep, count, last = np.zeros(flat.size, bool), np.zeros(size.size, np.int64), np.zeros(size.size, np.int64)
    for place in range(size.max(initial=0)):
        live = int(np.searchsorted(-size, -place, side="left"))
        t = flat[start[:live] + place]
        take = (count[:live] < most) & ((place == 0) | (t - last[:live] >= period_us))
        keep[start[:live][take] + place] = True
        last[:live] = np.where(take, t, last[:live])
        count[:live] += take
    final = (start + size - 1)[size > 0]
    keep[final[(count[size > 0] < most) & (flat[final] != last[size > 0])]] = True
    at = np.flatnonzero(keep)
    row = np.searchsorted(ends, at, side="right") - 1
    offsets = np.append(0, np.cumsum(np.bincount(row, minlength=len(times)))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array((at - ends[row]).astype(np.int32)), mask=times.is_null())


def downsample(points: Column | str, time: str, period_us: int, most: int) -> Column:
    """Thin an array of point structs sorted by ``time``: keep the first, then each at least ``period_us`` behind the last kept, then the final one if there is room."""
    points = _c(points)

    @F.arrow_udf("array<int>")
    def kept(times: pa.Array) -> pa.Array:
        return _thinned(times, period_us, most)

    return F.transform(kept(F.transform(points, lambda p: p[time])), lambda i: F.get(points, i))


def _next_kept(stamps: np.ndarray, interval_us: int) -> np.ndarray:
    """The place of the next one that stays behind each one (the size, where there is none)."""
    return np.searchsorted(stamps, stamps + interval_us, side="left")


def _last_kept(stamps: np.ndarray, interval_us: int) -> np.ndarray:
    """For each time as the first that stays: the last one that stays, by doubling the steps."""
    n = stamps.size
    jump = np.append(_next_kept(stamps, interval_us), n)
    jumps = [jump]
    while (jumps[-1][:n] < n).any():
        jumps.append(jumps[-1][jumps[-1]])
    at = np.arange(n)
    for jump in reversed(jumps):
        at = np.where(jump[at] < n, jump[at], at)
    return stamps[at]


def admit(df: DataFrame, by: list[str], seq: str, time: str, interval_us: int, *, chunk_us: int | None = None) -> DataFrame:
    """Greedy admission on a stream: a row stays if it is at least ``interval_us`` behind the last that stayed; no rule for the final one.

    Times don't fall within ``by``. A long series is no obstacle: chunks of time are worked on side
    by side. Each tells, for every time at which admission may enter it, the last that stays; a row
    a chunk meets in a chain that says where admission does enter, and then each chunk is thinned.
    """
    if interval_us <= 0:
        return df
    names, columns = [f"_by_{c}" for c in by], df.columns
    work = df.withColumn("_chunk", F.floor(F.col(time) / (chunk_us or 4096 * interval_us)))

    def enter(group: pa.Table) -> pa.Table:
        stamps = np.sort(group.column("_t").to_numpy())
        many = int(np.searchsorted(stamps, stamps[0] + interval_us, side="left")) + 1  # no later one can be the first that stays
        first, lists = group.select([*names, "_chunk"]).slice(0, 1), pa.list_(pa.int64())
        return first.append_column("enter", pa.array([stamps[:many]], lists)).append_column("leave", pa.array([_last_kept(stamps, interval_us)[:many]], lists))

    kinds = ", ".join(f"{n} {dict(df.dtypes)[c]}" for c, n in zip(by, names, strict=True))
    slim = work.select(*(F.col(c).alias(n) for c, n in zip(by, names, strict=True)), "_chunk", F.col(time).alias("_t"))
    tables = slim.groupBy(*names, "_chunk").applyInArrow(enter, f"{kinds}, _chunk long, enter array<long>, leave array<long>")

    def chain(group: pa.Table) -> pa.Table:
        group = group.sort_by("_chunk")
        last, out = None, []
        for enter, leave in zip(group.column("enter"), group.column("leave"), strict=True):
            enter, leave = enter.values.to_numpy(), leave.values.to_numpy()
            at = 0 if last is None else int(np.searchsorted(enter, last + interval_us, side="left"))
            out.append(int(enter[at]) if at < enter.size else None)
            last = int(leave[at]) if at < enter.size else last
        return group.select([*names, "_chunk"]).rename_columns([*names, "_at"]).append_column("_enter", pa.array(out, pa.int64()))

    entries = tables.groupBy(*names).applyInArrow(chain, f"{kinds}, _at long, _enter long").where("_enter IS NOT NULL")
    same = F.col("_chunk") == F.col("_at")
    for c, n in zip(by, names, strict=True):
        same &= F.col(c).eqNullSafe(F.col(n))

    def thin_out(group: pa.Table) -> pa.Table:
        group = group.sort_by(seq)
        stamps, kept = group.column(time).to_numpy(), []
        at, following = int(np.searchsorted(stamps, group.column("_enter")[0].as_py(), side="left")), _next_kept(stamps, interval_us)
        while at < stamps.size:
            kept.append(at)
            at = int(following[at])
        return group.take(pa.array(kept, pa.int64())).select(columns)

    return work.join(entries, same).select(*columns, "_chunk", "_enter").groupBy(*by, "_chunk").applyInArrow(thin_out, df.schema)


def _joined(work: DataFrame, chunks: DataFrame, by: list[str]) -> DataFrame:
    """Rows of a chunk with what its chunk's row says; ``chunks`` has ``_at`` and ``_by_...`` for the keys."""
    same = F.col("_chunk") == F.col("_at")
    for c in by:
        same &= F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    return work.join(chunks, same).drop("_at", *(f"_by_{c}" for c in by))


def ranked(df: DataFrame, by: list[str], seq: str, *, name: str = "rank", chunk: int = CHUNK) -> DataFrame:
    """The place of each row of its series by ``seq``, from 1. Chunks are numbered side by side; a row a chunk meets in a window."""
    work = df.withColumn("_chunk", F.floor(F.col(seq) / chunk))
    order = Window.partitionBy(*by).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = work.groupBy(*by, "_chunk").agg(F.count("*").alias("_n"))
    counts = counts.select(*(F.col(c).alias(f"_by_{c}") for c in by), F.col("_chunk").alias("_at"), F.coalesce(F.sum("_n").over(order), F.lit(0)).alias("_base"))
    own = F.row_number().over(Window.partitionBy(*by, "_chunk").orderBy(seq))
    return _joined(work.withColumn("_own", own), counts, by).withColumn(name, F.col("_base") + F.col("_own")).drop("_chunk", "_own", "_base")


def last_values(df: DataFrame, by: list[str], seq: str, kind: str, kinds: list, value: Column | str, *, names: list[str] | None = None, chunk: int = CHUNK) -> DataFrame:
    """With each row the last value of every kind up to it, in a column a kind; scanned in chunks, of which each leaves one row for those behind it."""
    names = names or [str(k) for k in kinds]
    work = df.withColumn("_chunk", F.floor(F.col(seq) / chunk)).withColumn("_value", _c(value))
    of = lambda k, c: F.when(F.col(kind) == k, F.col(c))
    inside = Window.partitionBy(*by, "_chunk").orderBy(seq).rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy(*by).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    ends = work.groupBy(*by, "_chunk").agg(*(F.max_by(of(k, "_value"), of(k, seq)).alias(f"_end_{i}") for i, k in enumerate(kinds)))
    ends = ends.select(*(F.col(c).alias(f"_by_{c}") for c in by), F.col("_chunk").alias("_at"), *(F.last(f"_end_{i}", ignorenulls=True).over(ahead).alias(f"_old_{i}") for i in range(len(kinds))))
    work = work.select("*", *(F.last(of(k, "_value"), ignorenulls=True).over(inside).alias(f"_new_{i}") for i, k in enumerate(kinds)))
    out = _joined(work, ends, by)
    return out.select(*df.columns, *(F.coalesce(f"_new_{i}", f"_old_{i}").alias(n) for i, n in enumerate(names)))


def newest(df: DataFrame, by: list[str], time: str, seq: str, *, history_us: int = 0, most: int = 512, latest: DataFrame | None = None, chunk: int = CHUNK) -> DataFrame:
    """Retention: rows within ``history_us`` of the latest time received (if over 0), then the newest ``most``.

    ``latest``: by, ``latest_us``, the latest time received of each series; that of ``df`` if none is
    given. Both rules keep a tail of the series, so places from the end and one row a series suffice.
    """
    numbered = ranked(df, by, seq, name="_rank", chunk=chunk)
    ends = numbered.groupBy(*by).agg(F.max("_rank").alias("_total"), F.max(time).alias("_last"))
    if latest is not None:
        ends = ends.drop("_last").join(latest.withColumnRenamed("latest_us", "_last"), by)
    tail = F.col("_rank") > F.col("_total") - most
    if history_us > 0:
        tail &= F.col(time) >= F.col("_last") - history_us
    ends = ends.select(*(F.col(c).alias(f"_by_{c}") for c in by), "_total", "_last")
    same = F.lit(True)
    for c in by:
        same &= F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    return numbered.join(ends, same).where(tail).select(*df.columns)


def max_points(asked: Column | str, default: int = 256) -> Column:
    return F.greatest(F.when(_c(asked) == 0, F.lit(default)).otherwise(_c(asked)), F.lit(1))


def regular_grid(start: Column, end: Column, step: Column, most: Column) -> Column:
    """Times from ``start`` by ``step``, with ``end`` behind them if it is off the grid and there is room."""
    grid = F.sequence(start, end, F.greatest(step, F.lit(1).cast("long")))
    return F.when((F.element_at(grid, -1) != end) & (F.size(grid) < most), F.array_append(grid, end)).otherwise(grid)


def thin(stamps: Column, most: Column) -> Column:
    """At most ``most`` times, evenly by index, ties to even."""
    last = F.size(stamps) - 1
    spread = F.transform(F.sequence(F.lit(0), F.greatest(most, F.lit(2)) - 1), lambda i: F.get(stamps, F.rint(i * last / (F.greatest(most, F.lit(2)) - 1)).cast("int")))
    return F.when(F.size(stamps) <= most, stamps).when(most == 1, F.slice(stamps, 1, 1)).otherwise(spread)


def bracket(grid: DataFrame, points: DataFrame, by: list[str], *, time: str = "stamp_us", value: str = "point", seq: str | None = None, chunk_us: int = 86_400_000_000) -> DataFrame:
    """As-of on both sides: for each grid row the last point not after it and the first not before it (``before``, ``after``).

    ``seq``: a column of ``points`` that orders those of one time; without it they must differ in
    time. Both tables are united and scanned once, the points first among equals, in chunks of
    time, so that one long series is many scans; a chunk's first and last points are one row, and
    these meet in a window, which fills what lies beyond the chunk.
    """
    cols = [c for c in grid.columns if c not in by]
    tie = F.col(seq).cast("long") if seq else F.lit(0).cast("long")
    left = grid.select(*by, F.col(time).alias("_t"), F.lit(1).alias("_kind"), F.lit(0).cast("long").alias("_tie"), F.struct(*cols).alias("_row"), F.lit(None).cast(points.schema[value].dataType).alias("_point"))
    right = points.select(*by, F.col(time).alias("_t"), F.lit(0).alias("_kind"), tie.alias("_tie"), F.lit(None).cast(left.schema["_row"].dataType).alias("_row"), F.col(value).alias("_point"))
    both = left.unionByName(right).withColumn("_chunk", F.floor(F.col("_t") / chunk_us))
    scan = Window.partitionBy(*by, "_chunk")
    forward = scan.orderBy("_t", "_kind", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    backward = scan.orderBy(F.desc("_t"), "_kind", F.desc("_tie")).rowsBetween(Window.unboundedPreceding, 0)
    near = both.withColumn("before", F.last("_point", ignorenulls=True).over(forward)).withColumn("after", F.last("_point", ignorenulls=True).over(backward)).where("_kind = 1")
    place = F.when(F.col("_kind") == 0, F.struct("_t", "_tie"))
    ends = both.groupBy(*by, "_chunk").agg(F.max_by("_point", place).alias("_last"), F.min_by("_point", place).alias("_first"))
    chunks = Window.partitionBy(*by).orderBy("_chunk")
    ends = ends.select(
        *(F.col(c).alias(f"_by_{c}") for c in by), F.col("_chunk").alias("_at"),
        F.last("_last", ignorenulls=True).over(chunks.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"), F.first("_first", ignorenulls=True).over(chunks.rowsBetween(1, Window.unboundedFollowing)).alias("_after"),
    )
    return _joined(near, ends, by).select(*by, "_row.*", F.coalesce("before", "_before").alias("before"), F.coalesce("after", "_after").alias("after"))


def next_below(values: np.ndarray) -> np.ndarray:
    """For each place the next one of a smaller value (the size, where there is none), by minima of windows that double."""
    n = values.size
    minima, width = [np.append(values, np.iinfo(values.dtype).min)], 1
    while 2 * width <= n + 1:
        minima.append(np.minimum(minima[-1][:-width], minima[-1][width:]))
        width *= 2
    at = np.arange(1, n + 1)
    for level in range(len(minima) - 1, -1, -1):
        low = minima[level]
        fits = np.flatnonzero(at < low.size)
        fits = fits[low[at[fits]] >= values[fits]]
        at[fits] += 1 << level
    return at
