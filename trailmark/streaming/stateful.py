"""Streaming twins of the rules that need state: paths, the sequence gate, rings of tracks, calibration once, caches.

No watermark: time that goes back is a new rollout, not late data. Rows of a batch are put in the
order of ``ingest_seq`` before they meet the state.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from ..operators.actors import ActorConfig
from ..operators.ego import FRAMES, PathConfig
from ..operators.navigation import gate_steps

#: The configuration that states of several variables and timers need.
STATE_STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


def _ordered(batches: Iterable[pd.DataFrame]) -> pd.DataFrame:
    return pd.concat(list(batches)).sort_values("ingest_seq", kind="stable")


def path_points(ego: DataFrame, key: str, interval_us: int) -> DataFrame:
    """Rows admitted to the path of each ``key``, with ``segment``. ``ego``: key, ingest_seq, stamp_us, and maybe frames.

    A segment ends when time falls back behind the last row received, or a frame changes; a row with an empty frame is left out.
    """
    frames = [c for c in FRAMES if c in ego.columns]

    def step(group: tuple, batches: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        received, stored, segment, held = state.get if state.exists else (None, None, 0, None)
        rows = []
        for row in _ordered(batches).itertuples():
            own = [getattr(row, c) for c in frames]
            if not all(own):
                continue
            if received is not None and (row.stamp_us < received or own != list(held)):
                stored, segment = None, segment + 1
            received, held = row.stamp_us, own
            if stored is None or interval_us <= 0 or row.stamp_us - stored >= interval_us:
                stored = row.stamp_us
                rows.append((group[0], row.ingest_seq, row.stamp_us, segment))
        if received is not None:
            state.update((received, stored, segment, held))
        yield pd.DataFrame(rows, columns=[key, "ingest_seq", "stamp_us", "segment"])

    kind = dict(ego.dtypes)[key]
    return ego.groupBy(key).applyInPandasWithState(step, f"{key} {kind}, ingest_seq long, stamp_us long, segment long", "received long, stored long, segment long, frames array<string>", "append", GroupStateTimeout.NoTimeout)


def gate(updates: DataFrame, key: str) -> DataFrame:
    """Accepted updates. ``updates``: key, ingest_seq, sequence, reference_us, valid."""

    def step(group: tuple, batches: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = _ordered(batches)
        before = state.get if state.exists else None
        (seq, ref), _, accepted = gate_steps(before, rows["sequence"].tolist(), rows["reference_us"].tolist(), rows["valid"].tolist())
        state.update((int(seq), None if ref is None else int(ref)))
        out = rows[accepted][["ingest_seq", "sequence"]]
        out.insert(0, key, group[0])
        yield out

    kind = dict(updates.dtypes)[key]
    return updates.groupBy(key).applyInPandasWithState(step, f"{key} {kind}, ingest_seq long, sequence long", "sequence long, reference long", "append", GroupStateTimeout.NoTimeout)


def _add(frame: DataFrame, key: str, processor: StatefulProcessor, columns: str, *, mode: str = "None") -> DataFrame:
    kind = dict(frame.dtypes)[key]
    return frame.groupBy(key).transformWithStateInPandas(processor, StructType.fromDDL(f"{key} {kind}, {columns}"), "Append", mode)


class _Rings(StatefulProcessor):
    """The buffers of a rollout's tracks, kept by track."""

    def __init__(self, key: str, config: ActorConfig):
        self.key, self.config = key, config

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.tracks = handle.getMapState("tracks", "track string", "seen long, times array<long>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N802, N803
        held = {k[0]: (v[0], list(v[1])) for k, v in self.tracks.iterator()}
        before, out = dict(held), []
        for seq, packet in _ordered(rows).groupby("ingest_seq", sort=True):
            ref = int(packet["ref_us"].iloc[0])
            for track, stamp in zip(packet["track_id"], packet["stamp_us"], strict=True):
                if pd.isna(track):  # a packet without tracks tells the time
                    continue
                times = held.get(track, (0, []))[1]
                if not times or times[-1] != stamp:
                    times = [*times, int(stamp)][-self.config.capacity :]
                held[track] = (ref, times)
                out.append((key[0], int(seq), track, times))
            held = {k: v for k, v in held.items() if ref - v[0] <= self.config.stale_us}
        for track in before.keys() - held.keys():
            self.tracks.removeKey((track,))
        for track, value in held.items():
            if before.get(track) != value:
                self.tracks.updateValue((track,), value)
        yield pd.DataFrame(out, columns=[self.key, "ingest_seq", "track_id", "ring"])

    def close(self) -> None:
        pass


def track_rings(states: DataFrame, key: str, config: ActorConfig) -> DataFrame:
    """With each state of a track the times in its ring, as :func:`trailmark.operators.actors.rings`.

    ``states``: key (a rollout), ingest_seq, ref_us, track_id (null in a packet without tracks),
    stamp_us. All tracks of a rollout are one state, for the packet of any of them evicts the stale
    ones. Needs a state store with map states (see :data:`STATE_STORE`).
    """
    return _add(states, key, _Rings(key, config), "ingest_seq long, track_id string, ring array<long>")


class _First(StatefulProcessor):
    """Passes the first row of a key whose ``column`` isn't null."""

    def __init__(self, names: list[str], column: str):
        self.names, self.column = names, column

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.known = handle.getValueState("known", "ingest_seq long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N802, N803
        if self.known.exists():
            return
        own = _ordered(rows)
        own = own[own[self.column].notna()].head(1)
        if len(own):
            self.known.update((int(own["ingest_seq"].iloc[0]),))
            yield own[self.names]

    def close(self) -> None:
        pass


def calibration_once(frames: DataFrame, *, key: str = "camera_logical_id", metadata: str = "camera_metadata") -> DataFrame:
    """The first metadata of each camera, once, across batches and restarts; frames without metadata don't count. As :func:`trailmark.operators.camera.calibration_once`."""
    names = [key, *(c for c in frames.columns if c != key)]
    kinds = dict(frames.dtypes)
    return _add(frames, key, _First(names, metadata), ", ".join(f"{c} {kinds[c]}" for c in names[1:]))


class _Revisions(StatefulProcessor):
    """The cached key and the revision that it made current."""

    def __init__(self, slot: str, columns: list[str], good: str | None):
        self.slot, self.columns, self.good = slot, columns, good

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.cached = handle.getValueState("cached", "key string, revision long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N802, N803
        held, revision = self.cached.get() if self.cached.exists() else (None, 0)
        own = _ordered(rows)
        keys = own[self.columns].astype(object).where(own[self.columns].notna(), None).to_numpy().tolist()
        good = own[self.good].fillna(False).tolist() if self.good else [True] * len(own)
        out = []
        for seq, values, passed in zip(own["ingest_seq"].tolist(), keys, good, strict=True):
            text = json.dumps(values, default=str)
            status = "invalid" if not passed else "duplicate" if text == held else "cached"
            if status == "cached":
                held, revision = text, revision + 1
            out.append((key[0], seq, *values, status, revision if passed else None))
        if held is not None:
            self.cached.update((held, revision))
        yield pd.DataFrame(out, columns=[self.slot, "ingest_seq", *self.columns, "status", "revision"]).astype({"revision": "Int64"})

    def close(self) -> None:
        pass


def revisions(packets: DataFrame, slot: str, columns: list[str], *, good: str | None = None) -> DataFrame:
    """What each packet does to its slot's cache: ``status`` invalid (its column ``good`` is not true), duplicate or cached, and the revision.

    As :func:`trailmark.operators.series.revisions` over the good ones, across batches and restarts.
    """
    kinds = dict(packets.dtypes)
    names = ", ".join(f"{c} {kinds[c]}" for c in columns)
    return _add(packets, slot, _Revisions(slot, columns, good), f"ingest_seq long, {names}, status string, revision long")


class _Published(StatefulProcessor):
    """The path of a key, sent again and again while rows may come or not."""

    def __init__(self, key: str, config: PathConfig, period_ms: int, frames: list[str]):
        self.key, self.config, self.period_ms, self.frames = key, config, period_ms, frames

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.path = handle.getValueState("path", "received long, stored long, segment long, frames array<string>, seqs array<long>, times array<long>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N802, N803
        fresh = not self.path.exists()
        received, stored, segment, held, seqs, times = (None, None, 0, None, [], []) if fresh else self.path.get()
        seqs, times = list(seqs), list(times)
        for row in _ordered(rows).itertuples():
            own = [getattr(row, c) for c in self.frames]
            if not all(own):
                continue
            if received is not None and (row.stamp_us < received or own != list(held)):
                stored, segment, seqs, times = None, segment + 1, [], []
            received, held = int(row.stamp_us), own
            if stored is None or self.config.interval_us <= 0 or row.stamp_us - stored >= self.config.interval_us:
                stored = received
                seqs, times = [*seqs, int(row.ingest_seq)], [*times, received]
            seqs, times = self._trimmed(received, seqs, times)
        if received is not None:
            self.path.update((received, stored, segment, held, seqs, times))
            if fresh:
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.period_ms)
        yield pd.DataFrame([], columns=[self.key, "published_ms", "segment", "ingest_seq", "stamp_us", "offset_us"])

    def _trimmed(self, received: int, seqs: list[int], times: list[int]) -> tuple[list[int], list[int]]:
        first = sum(t < received - self.config.history_us for t in times) if self.config.history_us else 0
        first = max(first, len(times) - self.config.max_points)
        return seqs[first:], times[first:]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N802, N803
        now = timerValues.getCurrentProcessingTimeInMs()
        _, _, segment, _, seqs, times = self.path.get()
        self.handle.registerTimer(now + self.period_ms)
        out = [(key[0], now, segment, n, t, t - times[0]) for n, t in zip(seqs, times, strict=True)]
        yield pd.DataFrame(out, columns=[self.key, "published_ms", "segment", "ingest_seq", "stamp_us", "offset_us"])

    def close(self) -> None:
        pass


def published_paths(ego: DataFrame, key: str, config: PathConfig, period_ms: int) -> DataFrame:
    """The executed path of each key every ``period_ms`` of the clock on the wall: key, published_ms, segment, ingest_seq, stamp_us, offset_us.

    What is sent is what :func:`trailmark.operators.ego.executed_path` has of the rows that came so
    far (of the newest segment). A path's state holds ``max_points`` samples at most.
    """
    frames = [c for c in FRAMES if c in ego.columns]
    return _add(ego, key, _Published(key, config, period_ms, frames), "published_ms long, segment long, ingest_seq long, stamp_us long, offset_us long", mode="ProcessingTime")
