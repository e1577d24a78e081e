"""Navigation updates: the sequence gate, routes, plans, and what of a packet is published."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.codes import plan_source, route_generator
from ..functions.geometry import finite
from .recording import increasing
from .series import CHUNK, last_values, next_below, ranked, segment


def gate_steps(state: tuple[int, int | None] | None, sequence: list[int], reference: list[int], valid: list[bool]) -> tuple:
    """The state machine of the gate: last sequence and last reference, kept from the last packet that passed whole.

    Returns the state, and for each packet whether time fell back and whether it passed.
    """
    last_seq, last_ref = state or (0, None)
    rollback, accepted = [], []
    for seq, ref, whole in zip(sequence, reference, valid, strict=True):
        back = last_ref is not None and ref < last_ref
        if back:
            last_seq = 0
        passed = last_seq == 0 or seq > last_seq or back
        if passed and whole:
            last_seq, last_ref = seq, ref
        rollback.append(back)
        accepted.append(passed)
    return (last_seq, last_ref), rollback, accepted


def _nth_true(flags: np.ndarray) -> np.ndarray:
    """For each place the first true one at or behind it (the size, where there is none); one more place at the end."""
    n = flags.size
    return np.append(np.minimum.accumulate(np.where(flags, np.arange(n), n)[::-1])[::-1], n)


def _apart(values: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Places of the values in their order, all those of a chunk below those of the chunk before it."""
    ranks = np.unique(values, return_inverse=True)[1]
    return ranks - of * (ranks.max(initial=-1) + 1)


class _Chunk:
    """Packets of chunks of streams in order, and where each packet that passes whole hands the gate on to.

    The gate holds what the last packet that passed whole left, so from each such packet on the
    rest of its chunk is settled: the next to pass whole is the first one of a greater number, or
    the first one from a fall of time on. Chunks lie one behind the other (``first``: where each
    begins) and are worked on at once, so that many short streams cost no more than a long one.
    """

    def __init__(self, group: pa.Table, first: np.ndarray | None = None):
        self.table = group
        self.seq, self.ref, self.valid = (group.column(c).to_numpy() for c in ("sequence", "reference_us", "valid"))
        self.seq, self.ref, self.valid = self.seq.astype(np.int64), self.ref.astype(np.int64), self.valid.astype(bool)
        n = self.seq.size
        self.first = np.zeros(1, np.int64) if first is None else first
        self.end = np.append(self.first[1:], n)
        self.of = np.repeat(np.arange(self.first.size), self.end - self.first)
        self.following = _nth_true(self.valid)
        whole = np.flatnonzero(self.valid)
        greater = np.append(whole, n)[next_below(_apart(-self.seq[whole], self.of[whole]))] if whole.size else whole
        greater = np.where(self.seq[whole] == 0, np.append(whole, n)[1:], greater)  # number 0 stands for none
        self.fall = next_below(_apart(self.ref, self.of))
        self.next = np.full(n + 1, n)
        self.next[whole] = self._inside(np.minimum(greater, self.following[self.fall[whole]]), self.of[whole])

    def _inside(self, places: np.ndarray, of: np.ndarray) -> np.ndarray:
        """The places, or the size of the whole for those behind their chunk."""
        return np.where(places < self.end[of], places, self.seq.size)

    @cached_property
    def jumps(self) -> list[np.ndarray]:
        """Where 1, 2, 4, ... steps lead."""
        n, jumps = self.seq.size, [self.next]
        while (jumps[-1][:n] < n).any():
            jumps.append(jumps[-1][jumps[-1]])
        return jumps

    def exits(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What the gate holds at the end, if the packets at ``places`` pass whole: number (0 once time fell and none passed since) and time."""
        n, at = self.seq.size, places
        for jump in reversed(self.jumps):
            at = np.where(jump[at] < n, jump[at], at)
        return np.where(self.fall[at] < self.end[self.of[at]], 0, self.seq[at]), self.ref[at]

    def _fallen(self, down: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For falls of time at ``down``: the packet that passes whole behind each (the size, where none does), and what the gate then holds at the end."""
        to = self._inside(self.following[down], self.of[down])
        inside = to < self.seq.size
        return to, *(np.where(inside, x, 0) for x in self.exits(np.where(inside, to, 0)))

    @cached_property
    def steps(self) -> tuple[np.ndarray, np.ndarray]:
        """The places of both ladders' steps, chunk by chunk. Where all steps of a chunk end alike, the last ones suffice."""
        n, whole = self.seq.size, np.flatnonzero(self.valid)
        top = np.maximum.accumulate(-_apart(-self.seq[whole], self.of[whole]))
        up = whole[np.append(True, np.diff(top) > 0)] if whole.size else whole
        down = np.append(0, np.flatnonzero(np.diff(np.minimum.accumulate(_apart(self.ref, self.of))) < 0) + 1)
        of_up, of_down = self.of[up], self.of[down]
        to, *fallen = self._fallen(down)
        last = np.cumsum(np.bincount(of_down)) - 1  # the last fall of each chunk
        differs = np.zeros(self.first.size, bool)
        differs[of_down[to == n]] = True
        for own, x in zip(self.exits(up), fallen, strict=True):
            differs[of_up[own != x[last[of_up]]]] = True
            differs[of_down[x != x[last[of_down]]]] = True
        final = lambda of: np.append(np.diff(of) > 0, True)[: of.size]
        return up[differs[of_up] | final(of_up)], down[differs[of_down] | final(of_down)]

    def table_row(self) -> list[np.ndarray]:
        """The states to enter with that make a difference, as two ladders: numbers that more and more packets exceed, and times that fall below.

        Each step has the place of the packet that passes whole there and what the gate holds at the
        end. The ladders of the chunks lie one behind the other.
        """
        up, down = self.steps
        base = self.first[self.of]
        to, *fallen = self._fallen(down)
        return [self.seq[up], up - base[up], *self.exits(up), self.ref[down], np.minimum(to, self.end[self.of[down]]) - base[down], *fallen]

    def marks(self, number: np.ndarray | int, time: np.ndarray | int | None, timed: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Whether time fell back at each packet, and whether it passed, for the state to enter each chunk with (``timed``: whether there is a time)."""
        n, of, first = self.seq.size, self.of, self.first
        timed = np.full(first.size, time is not None) if timed is None else timed
        number, time, timed = (np.broadcast_to(x, first.shape)[of] for x in (number, 0 if time is None else time, timed))
        early = timed & (self.ref < time)
        fall = np.minimum(_nth_true(early)[first], self.end)
        more = _nth_true(self.valid & ((number == 0) | (self.seq > number)))[first]
        passed = np.zeros(n + 1, bool)
        passed[self._inside(np.minimum(more, self.following[fall]), np.arange(first.size))] = True
        for jump in reversed(self.jumps):
            passed[jump[passed]] = True
        passed = passed[:n]
        held = np.append(-1, np.flatnonzero(passed))[np.cumsum(passed) - passed]  # the last that passed whole before each
        own = held >= first[of]
        numbers = np.where(own, self.seq[held], number)
        back = np.where(own, self.ref < self.ref[held], early)
        falls = np.append(0, np.cumsum(back))
        since = falls[:-1] - falls[np.where(own, held + 1, first[of])] > 0  # time fell, and none has passed whole since
        return back, back | since | (numbers == 0) | (self.seq > numbers)


def _whole_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Sorted batches as tables of whole chunks, and where each of these begins (``_at`` is 0); what a batch breaks off is held back."""
    held: list[pa.RecordBatch] = []
    starts = lambda rows: np.flatnonzero(rows.column("_at").to_numpy() == 0)
    for batch in batches:
        own = np.flatnonzero(batch.column("_at").to_numpy(zero_copy_only=False) == 0)
        if own.size and held or own.size > 1:
            table = pa.Table.from_batches([*held, batch.slice(0, own[-1])])
            yield table, starts(table)
            held = []
        held.append(batch.slice(own[-1]) if own.size else batch)
    if held and sum(b.num_rows for b in held):
        table = pa.Table.from_batches(held)
        yield table, starts(table)


#: Lists of :meth:`_Chunk.table_row`.
_LADDERS = ("up", "up_at", "up_number", "up_time", "down", "down_at", "down_number", "down_time")


def _enter(row: dict, number: int, time: int | None) -> tuple[int, int | None]:
    """The state behind a chunk, from the one before it and the chunk's ladders."""
    up, down = row["up"], row["down"]
    step = 0 if number == 0 else int(np.searchsorted(up, number, side="right"))
    at, after = (row["up_at"][step], (row["up_number"][step], row["up_time"][step])) if step < up.size else (None, None)
    fell = time is not None and down.size > 0 and down[-1] < time
    if fell:
        step = int(np.searchsorted(-down, -time, side="right"))
        if row["down_at"][step] < row["n"] and (at is None or row["down_at"][step] < at):
            after = (row["down_number"][step], row["down_time"][step])
    return after if after is not None else (0 if fell else number, time)


def gate(updates: DataFrame, by: list[str], *, chunk: int = 200_000) -> DataFrame:
    """``accepted`` and ``rollback`` for each update. ``updates``: by, ingest_seq, sequence, reference_us, valid.

    A stream of any length is many tasks: each chunk tells how it hands on whatever state it is
    entered with, a row a chunk meets in a chain that says which state that is, and then each chunk
    marks its packets. Streams of any number are batches: a chunk is a number of rows of a stream,
    and a batch holds the chunks of many. :func:`gate_steps` is the rule itself.
    """
    names = [f"_by_{c}" for c in by]
    kinds = dict(updates.dtypes)
    keys = ", ".join(f"`{n}` {kinds[c]}" for c, n in zip(by, names, strict=True))
    slim = updates.select(*(F.col(c).alias(n) for c, n in zip(by, names, strict=True)), "ingest_seq", "sequence", "reference_us", "valid")
    place = F.col("_rank") - 1
    work = ranked(slim, names, "ingest_seq", name="_rank").withColumns({"_chunk": F.floor(place / chunk), "_at": place % chunk})
    lists = ", ".join(f"{c} array<long>" for c in _LADDERS)
    ordered = lambda rows: rows.repartition(*names, "_chunk").sortWithinPartitions(*names, "_rank")

    def transfer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, first in _whole_chunks(batches):
            own = _Chunk(table, first)
            out = table.select([*names, "_chunk"]).take(pa.array(first)).append_column("n", pa.array(own.end - first, pa.int64()))
            ends = [np.append(0, np.cumsum(np.bincount(own.of[x], minlength=first.size))).astype(np.int32) for x in own.steps]
            for c, values in zip(_LADDERS, own.table_row(), strict=True):
                out = out.append_column(c, pa.ListArray.from_arrays(ends[c.startswith("down")], pa.array(values.astype(np.int64))))
            yield from out.to_batches()

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, state = None, (0, None)
        for batch in batches:
            rows, entered = [], []
            for k, number in enumerate(batch.column("_chunk").to_pylist()):
                if number == 0:
                    state = (0, None)
                else:
                    held, i = before
                    state = _enter({c: held.column(c)[i].values.to_numpy() for c in _LADDERS} | {"n": held.column("n")[i].as_py()}, *state)
                    rows.append(k)
                    entered.append(state)
                before = batch, k
            out = pa.Table.from_batches([batch]).select([*names, "_chunk"]).take(pa.array(rows, pa.int64())).rename_columns([*names, "_behind"])
            out = out.append_column("_number", pa.array([int(s) for s, _ in entered], pa.int64())).append_column("_time", pa.array([None if t is None else int(t) for _, t in entered], pa.int64()))
            yield from out.to_batches()

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, first in _whole_chunks(batches):
            own, at = _Chunk(table, first), pa.array(first)
            number, time = (table.column(c).take(at) for c in ("_number", "_time"))
            back, passed = own.marks(number.fill_null(0).to_numpy(), time.fill_null(0).to_numpy(), time.is_valid().to_numpy())
            yield from table.select([*names, "ingest_seq", "sequence", "reference_us", "valid"]).append_column("rollback", pa.array(back)).append_column("accepted", pa.array(passed)).to_batches()

    tables = ordered(work).mapInArrow(transfer, f"{keys}, _chunk long, n long, {lists}")
    entries = tables.repartition(*names).sortWithinPartitions(*names, "_chunk").mapInArrow(chain, f"{keys}, _behind long, _number long, _time long")
    entries = entries.select(*(F.col(n).alias(f"{n}_") for n in names), "_behind", "_number", "_time")
    same = F.col("_chunk") == F.col("_behind")
    for n in names:
        same &= F.col(n).eqNullSafe(F.col(f"{n}_"))
    entered = work.join(entries, same, "left").select(*work.columns, "_number", "_time")  # a stream's first chunk has none
    rest = ", ".join(f"{c} {kinds[c]}" for c in ("ingest_seq", "sequence", "reference_us", "valid"))
    out = ordered(entered).mapInArrow(mark, f"{keys}, {rest}, rollback boolean, accepted boolean")
    return out.select(*(F.col(n).alias(c) for c, n in zip(by, names, strict=True)), "ingest_seq", "sequence", "reference_us", "valid", "rollback", "accepted")


def _vector_finite(v: Column) -> Column:
    return finite(v["x"]) & finite(v["y"]) & finite(v["z"])


def route_valid(route: Column, frame: str) -> Column:
    """A route is absent, or in its frame, of the expected number of points, and finite where its points are valid."""
    points = F.coalesce(route["points"], F.array())
    count = F.coalesce(route["expected_point_count"], F.lit(0))
    whole = F.forall(points, lambda p: ~F.coalesce(p["valid"], F.lit(False)) | (_vector_finite(p["position"]) & finite(p["longitudinal_distance"])))
    return route.isNull() | ((route["frame_id"] == frame) & ((count <= 0) | (F.size(points) == count)) & finite(route["lookahead_distance"]) & whole)


def plan_valid(plan: Column, reference: Column) -> Column:
    """A plan is absent, or in the map frame, ends no earlier than it starts, with points that are finite in every field, at rising times."""
    start = F.coalesce(plan["start_timestamp_us"], reference)
    points = F.coalesce(plan["points"], F.array())
    vectors, numbers = ("position", "linear_velocity", "linear_acceleration"), ("yaw", "yaw_rate", "yaw_acceleration", "speed")

    def fields(p: Column) -> Column:
        whole = _vector_finite(p["orientation"]) & finite(p["orientation"]["w"])
        for c in vectors:
            whole &= _vector_finite(p[c])
        for c in numbers:
            whole &= finite(p[c])
        return whole

    rising = (F.size(points) == 0) | increasing(points)
    return plan.isNull() | ((F.coalesce(plan["pose_frame_id"], F.lit("map")) == "map") & (F.coalesce(plan["end_timestamp_us"], start) >= start) & rising & F.forall(points, fields))


def publication(ok_map: Column, ok_input: Column, ok_plan: Column) -> dict[str, Column]:
    """Sections are checked in turn, and what came before a bad one is already out."""
    ok_map, ok_input, ok_plan = (F.coalesce(x, F.lit(False)) for x in (ok_map, ok_input, ok_plan))
    return {"emit_map": ok_map, "emit_input": ok_map & ok_input, "emit_plan": ok_map & ok_input & ok_plan, "valid": ok_map & ok_input & ok_plan}


def judge(records: DataFrame) -> DataFrame:
    """Flags of each navigation record: emit_map, emit_input, emit_plan, valid. The sections are checked once, whatever reads the flags."""
    ref = F.col("reference_timestamp_us")
    checks = F.struct(route_valid(F.col("route_map"), "map").alias("map"), route_valid(F.col("route_model_input"), "base_link").alias("input"), plan_valid(F.col("planned_trajectory"), ref).alias("plan"))
    checked = records.select("*", F.explode(F.array(checks)).alias("_ok"))
    return checked.withColumns(publication(*(F.col(f"_ok.{c}") for c in ("map", "input", "plan")))).drop("_ok")


def line_messages(judged: DataFrame) -> DataFrame:
    """What each record publishes for a viewer's lines, in order: ingest_seq, section (map, model_input, plan), kind, frame, positions.

    One pass: the sections of a record are an array, which is exploded.
    """
    valid = lambda r: F.transform(F.filter(F.coalesce(r["points"], F.array()), lambda p: p["valid"]), lambda p: p["position"])
    plan = F.col("planned_trajectory")
    message = lambda flag, value, section, kind, frame, points: F.when(F.col(flag) & value.isNotNull(), F.struct(F.lit(section).alias("section"), F.lit(kind).alias("kind"), frame.alias("frame"), points.alias("positions")))
    routes = [message(f, F.col(c), n, "route", F.col(c)["frame_id"], valid(F.col(c))) for f, c, n in (("emit_map", "route_map", "map"), ("emit_input", "route_model_input", "model_input"))]
    planned = message("emit_plan", plan, "plan", "model_plan", F.coalesce(plan["pose_frame_id"], F.lit("map")), F.transform(F.coalesce(plan["points"], F.array()), lambda p: p["position"]))
    out = judged.select("ingest_seq", F.explode(F.filter(F.array(*routes, planned), lambda m: m.isNotNull())).alias("m"))
    return out.select("ingest_seq", "m.*")


def routes(records: DataFrame, section: str, producer: str) -> DataFrame:
    """Route rows; a point that isn't valid is zeros."""
    zero = F.struct(*(F.lit(0.0).alias(c) for c in "xyz"))
    r = F.col(section)
    point = lambda p: F.struct(
        F.coalesce(p["valid"], F.lit(False)).alias("valid"), F.when(p["valid"], p["position"]).otherwise(zero).alias("position"), F.when(p["valid"], p["longitudinal_distance"]).otherwise(0.0).alias("longitudinal_distance")
    )
    return records.where(r.isNotNull()).select(
        "ingest_seq", F.col("reference_timestamp_us").alias("reference_us"), r["frame_id"].alias("frame_id"), r["source_frame_id"].alias("source_frame_id"),
        route_generator(F.coalesce("route_generator_type", F.lit("UNKNOWN"))).alias("generator_type"), F.lit(producer).alias("producer"), "sequence",
        r["lookahead_distance"].alias("lookahead_distance"), r["expected_point_count"].alias("expected_point_count"), F.transform(F.coalesce(r["points"], F.array()), point).alias("points"),
    )


def plans(records: DataFrame) -> DataFrame:
    """Planned trajectories; durations come from the header."""
    p, ref = F.col("planned_trajectory"), F.col("reference_timestamp_us")
    start = F.coalesce(p["start_timestamp_us"], ref)
    end = F.coalesce(p["end_timestamp_us"], start)
    return records.where(p.isNotNull()).select(
        "ingest_seq", ref.alias("reference_us"), F.coalesce(p["pose_frame_id"], F.lit("map")).alias("pose_frame_id"), F.coalesce(p["dynamics_frame_id"], F.lit("map")).alias("dynamics_frame_id"),
        plan_source(F.coalesce(p["source"], F.lit("UNKNOWN"))).alias("source"), F.coalesce(p["producer"], F.lit("unknown")).alias("producer"), F.coalesce(p["is_model_generated"], F.lit(False)).alias("is_model_generated"),
        F.coalesce("force_gt_active", F.lit(False)).alias("force_gt_active"), F.greatest(end - ref, F.lit(0)).alias("requested_us"), F.greatest(end - start, F.lit(0)).alias("actual_us"),
        F.transform(F.coalesce(p["points"], F.array()), lambda x: x.withField("time_from_reference_us", x["timestamp_us"] - ref)).alias("points"),
    )


def latest_layers(messages: DataFrame, kinds: list[str], *, by: list[str], kind: str = "kind", seq: str = "ingest_seq", value: str = "value") -> DataFrame:
    """With each message the latest value of every kind."""
    return last_values(messages, by, seq, kind, kinds, value)


def layer_arrays(messages: DataFrame, layers: list[int], *, by: list[str], seq: str = "seq") -> DataFrame:
    """The array that goes out with each message: all layers that stand, in the order in which they came.

    ``messages``: by, ``seq``, marker_id (the layer), action (ADD, DELETE), and what else a marker
    has. A layer that is sent again keeps its place; DELETE goes out in the array once, in the place
    of its layer (at the end, if that wasn't there), and then the layer is gone. Result: by, seq,
    at (from 0), and the columns of each marker.
    """
    own = [*by, "marker_id"]
    renewed = lambda before, row: (before["action"] == "DELETE") & (row["action"] == "ADD")
    rows = segment(messages, seq, ["action"], renewed, by=own, name="_life")
    of = lambda a: F.min(F.when(F.col("action") == a, F.col(seq)))
    lives = rows.groupBy(*own, "_life").agg(of("ADD").alias("_since"), of("DELETE").alias("_gone"))
    rows = rows.join(lives, [*own, "_life"])
    place = F.when(F.col("action") == "ADD", F.col("_since")).when((F.col(seq) == F.col("_gone")) & F.col("_since").isNotNull(), F.col("_since")).otherwise(F.col(seq))
    marker = [c for c in messages.columns if c not in (*by, seq)]
    rows = rows.select(*by, seq, "marker_id", F.struct(place.alias("_place"), F.col(seq).alias("_seq"), *marker).alias("_marker"))
    names = [f"_layer_{k}" for k in layers]
    held = last_values(rows, by, seq, "marker_id", layers, "_marker", names=names)
    stands = lambda m: m.isNotNull() & ((m["action"] == "ADD") | (m["_seq"] == F.col(seq)))
    ordered = F.array_sort(F.filter(F.array(*names), stands), lambda a, b: F.when(a["_place"] < b["_place"], -1).when(a["_place"] > b["_place"], 1).otherwise(0))
    out = held.select(*by, seq, F.posexplode(ordered).alias("at", "m"))
    return out.select(*by, seq, "at", *(F.col(f"m.{c}").alias(c) for c in marker))


def layer_snapshot(messages: DataFrame, *, by: list[str], seq: str = "seq", chunk: int = CHUNK) -> DataFrame:
    """The last array of :func:`layer_arrays` for each ``by``, without those before it.

    Messages are scanned once, in chunks: each leaves for a layer its last message and since when that
    stands. Where it stands since the chunk began, the chunk before it tells, in a window of a row a chunk.
    """
    own, marker = [*by, "marker_id"], [c for c in messages.columns if c not in (*by, "marker_id", seq)]
    inside, chunks, last = Window.partitionBy(*own, "_chunk").orderBy(seq), Window.partitionBy(*own).orderBy("_chunk"), F.col("_last")
    added, before = F.col("action") == "ADD", F.coalesce(F.col("_before") == "ADD", F.lit(False))
    work = messages.withColumn("_chunk", F.floor(F.col(seq) / chunk)).withColumn("_before", F.lag("action").over(inside))
    start = F.max(F.when(added & ~before, F.col(seq))).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    work = work.withColumn("_since", F.when(added | before, start).otherwise(F.col(seq)))
    ends = work.groupBy(*own, "_chunk").agg(F.max_by(F.struct(seq, "_since", *marker), seq).alias("_last"), F.min(seq).alias("_first"))
    ends = ends.withColumn("_linked", (last["_since"] == F.col("_first")) & F.coalesce(F.lag(last["action"]).over(chunks) == "ADD", F.lit(False)))
    ends = ends.withColumn("_place", F.last(F.when(~F.col("_linked"), last["_since"]), ignorenulls=True).over(chunks.rowsBetween(Window.unboundedPreceding, 0)))
    layers = ends.groupBy(*own).agg(F.max_by(F.struct("_place", "_last"), "_chunk").alias("_m")).select(*own, "_m._place", "_m._last.*")
    newest = layers.withColumn("_newest", F.max(seq).over(Window.partitionBy(*by)))
    stands = newest.where((F.col("action") == "ADD") | (F.col(seq) == F.col("_newest")))
    at = F.row_number().over(Window.partitionBy(*by).orderBy("_place")) - 1
    return stands.select(*by, F.col("_newest").alias(seq), at.alias("at"), *(c for c in messages.columns if c not in (*by, seq)))
