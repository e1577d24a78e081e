"""Operator 9, best-fit packing with Martello-Toth dominance reduction.

Tokenising and cutting run in tasks. A packing depends on the lengths alone, so the packer works
on the histogram of lengths: at most ``capacity`` numbers, whatever the size of the corpus. It
first fixes sets that provably dominate every other set with their largest item, then places what
is left by best-fit decreasing, both for all equal items at once. The result is a table of slots
by length and rank; the pieces of a length take them in the order of (doc_id, piece).
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .arrowtext import CODE, FOLD, ragged, span_hashes, text_slices, words
from .shared import stage, tokenizer_path

#: Bytes between which the tokenizer always splits: ASCII letters, and punctuation that takes no part in its contractions and special tokens.
LETTER, PUNCTUATION = np.zeros(256, bool), np.zeros(256, bool)
LETTER[[*b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = True
PUNCTUATION[[*b"!\"#$%&()*+,-./:;=?@[\\]^_`{}~"]] = True

Pattern = tuple[tuple[int, int], ...]


class WordIds:
    """Token ids of words, kept from batch to batch; emptied beyond ``most`` words.

    The tokenizer splits at white space and drops it, so a text's ids are those of its words in
    turn. New words are encoded many at a time with a special token between them.
    """

    def __init__(self, tokenizer: str, most: int = 2_000_000, marker: str = "<|startoftext|>"):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path(tokenizer))
        self.marker, self.marker_id = marker, self.tokenizer.token_to_id(marker)
        self.most = most
        self._clear()

    def _clear(self) -> None:
        self.keys, self.rows = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.starts, self.lengths, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and their number for each text."""
        ids, lengths = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        run: list[str] = []
        for text in [*texts, None]:
            alone = text is None or "<|" in text
            if run and (alone or len(run) == 500):
                found = np.array(self.tokenizer.encode(self.marker.join(run), add_special_tokens=False).ids, np.uint32)
                ends = np.append(np.flatnonzero(found == self.marker_id), found.size)
                lengths.append(np.diff(ends, prepend=-1) - 1)
                ids.append(found[found != self.marker_id])
                run = []
            if alone and text is not None:
                ids.append(np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32))
                lengths.append(np.array([ids[-1].size]))
            elif text is not None:
                run.append(text)
        return np.concatenate(ids), np.concatenate(lengths)

    def lookup(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each word, where its ids begin in ``self.ids``, and how many they are."""
        if self.keys.size > self.most:
            self._clear()
        codes = CODE if b"<|" in data.tobytes() else FOLD  # case matters only in special tokens
        keys, first, back = np.unique(span_hashes(data, starts, ends, codes), return_index=True, return_inverse=True)
        place = np.searchsorted(self.keys, keys)
        new = np.flatnonzero(place == self.keys.size) if not self.keys.size else np.flatnonzero(self.keys[np.minimum(place, self.keys.size - 1)] != keys)
        if new.size:
            ids, lengths = self.encode([data[s:e].tobytes().decode("utf-8", "replace") for s, e in zip(starts[first[new]], ends[first[new]], strict=True)])
            begins = self.ids.size + np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
            self.keys = np.insert(self.keys, place[new], keys[new])
            self.rows = np.insert(self.rows, place[new], np.arange(self.starts.size, self.starts.size + new.size))
            self.ids, self.starts, self.lengths = (np.concatenate(x) for x in ((self.ids, ids), (self.starts, begins), (self.lengths, lengths)))
        rows = self.rows[np.searchsorted(self.keys, keys)][back]
        return self.starts[rows], self.lengths[rows]


def split_points(data: np.ndarray) -> np.ndarray:
    """Where a letter meets punctuation, so that a word with and without it shares its ids."""
    letter, mark = LETTER[data], PUNCTUATION[data]
    cut = np.zeros(data.size, bool)
    cut[1:] = letter[:-1] & mark[1:] | mark[:-1] & letter[1:]
    return cut


@lru_cache(maxsize=2)
def word_ids(tokenizer: str) -> WordIds:
    """One for all tasks of a worker."""
    return WordIds(tokenizer)


def cut_pieces(docs: DataFrame, *, tokenizer: str = "word_bpe_49k.json", capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """Pieces of at most ``capacity`` tokens: doc_id, piece, start, length, ids_crc32."""
    names = ("doc_id", "piece", "start", "length", "ids_crc32")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = word_ids(tokenizer)
        for batch in batches:
            ids = batch.column(0).cast(pa.int64())
            for low, high, data, offsets in text_slices(batch.column(1)):
                starts, ends, bounds = words(data, offsets, split_points(data))
                where, lengths = cache.lookup(data, starts, ends)
                flat = cache.ids[ragged(where, lengths)].astype("<u4")
                sums = np.concatenate([[0], np.cumsum(lengths)])[bounds]
                rows = []
                for k in range(high - low):
                    own = np.append(flat[sums[k] : sums[k + 1]], np.uint32(end_id)).astype("<u4")
                    rows += [(k, p, s, min(capacity, own.size - s), zlib.crc32(own[s : s + capacity].tobytes())) for p, s in enumerate(range(0, own.size, capacity))]
                columns = np.array(rows, np.int64).T
                yield pa.RecordBatch.from_arrays([ids.slice(low, high - low).take(pa.array(columns[0])), pa.array(columns[1], pa.int32()), *map(pa.array, columns[2:])], names=names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


class Lengths:
    """A multiset of item lengths with ordered search."""

    def __init__(self, histogram: dict[int, int]):
        self.count = {k: n for k, n in histogram.items() if n}
        self.order = sorted(self.count)

    def take(self, length: int, n: int) -> None:
        self.count[length] -= n
        if not self.count[length]:
            del self.count[length]
            del self.order[bisect_left(self.order, length)]

    def largest(self, room: int, without: dict[int, int]) -> int | None:
        """The largest length up to ``room`` that is left when ``without`` is set aside."""
        for i in range(bisect_right(self.order, room) - 1, -1, -1):
            if self.count[self.order[i]] > without.get(self.order[i], 0):
                return self.order[i]
        return None

    def smallest(self, n: int, without: dict[int, int]) -> list[int]:
        """The ``n`` smallest lengths that are left when ``without`` is set aside."""
        found: list[int] = []
        for x in self.order:
            found += [x] * min(n - len(found), self.count[x] - without.get(x, 0))
            if len(found) == n:
                break
        return found


def dominating(items: Lengths, length: int, capacity: int) -> Pattern | None:
    """A set with an item of ``length`` that dominates every feasible set with it, if one is proven.

    A set dominates another when the other's items can be grouped so that each group is no longer
    than an item of the set. With room = capacity - length: nothing fits: the item alone. One item
    fills the room, or no two items fit together: the longest that fits. No three fit together:
    the longest, where no pair is longer than it; or the longest with the longest beside it, where
    no fitting pair has a longer second item.
    """
    room, own = capacity - length, {length: 1}
    first = items.largest(room, own)
    if first is None:
        return ((length, 1),)
    low = items.smallest(3, own)
    if first == room or len(low) < 2 or low[0] + low[1] > room:
        return _pattern(length, first)
    if len(low) == 3 and sum(low) <= room:
        return None
    second = items.largest(room - first, {**own, first: own.get(first, 0) + 1})
    pairs = _longest_pair(items, room, own)
    if first >= pairs[0]:
        return _pattern(length, first)
    if second is not None and pairs[1] <= second:
        return _pattern(length, first, second)
    return None


def _pattern(*lengths: int) -> Pattern:
    return tuple((x, lengths.count(x)) for x in sorted(set(lengths), reverse=True))


def _longest_pair(items: Lengths, room: int, own: dict[int, int]) -> tuple[int, int]:
    """The largest sum of two fitting items, and the largest second item of a fitting pair."""
    total = second = 0
    for x in items.order:
        if 2 * x > room:
            break
        if items.count[x] <= own.get(x, 0):
            continue
        other = items.largest(room - x, {**own, x: own.get(x, 0) + 1})
        if other is not None and other >= x:
            total, second = max(total, x + other), max(second, x)
    return total, second


def reduce_instance(items: Lengths, capacity: int) -> list[tuple[int, Pattern]]:
    """Fix dominating sets, longest item first, and take their items out; (times, set) for each."""
    fixed = []
    for length in list(reversed(items.order)):
        while items.count.get(length) and (pattern := dominating(items, length, capacity)):
            times = min(items.count[x] // n for x, n in pattern)
            for x, n in pattern:
                items.take(x, n * times)
            fixed.append((times, pattern))
    return fixed


def best_fit(items: Lengths, capacity: int) -> list[tuple[int, Pattern]]:
    """Best-fit decreasing for all equal items at once: bins of equal content are one entry with a count."""
    open_bins: dict[int, list[tuple[int, Pattern]]] = {}
    rooms: list[int] = []

    def put(room: int, times: int, pattern: Pattern) -> None:
        if room not in open_bins:
            rooms.insert(bisect_left(rooms, room), room)
        open_bins.setdefault(room, []).append((times, pattern))

    for length in reversed(items.order):
        left = items.count[length]
        while left:
            at = bisect_left(rooms, length)
            room = rooms[at] if at < len(rooms) else capacity
            each = room // length
            times, pattern = open_bins[room].pop() if at < len(rooms) else (-(-left // each), ())
            if at < len(rooms) and not open_bins[room]:
                del open_bins[room], rooms[at]
            full = min(times, left // each)
            rest = min(left - full * each, each - 1) if full < times else 0
            if full:
                put(room - each * length, full, (*pattern, (length, each)))
            if rest:
                put(room - rest * length, 1, (*pattern, (length, rest)))
            if pattern and times > full + bool(rest):
                put(room, times - full - bool(rest), pattern)
            left -= full * each + rest
    return [x for room in rooms for x in open_bins[room]]


def plan_slots(histogram: dict[int, int], capacity: int) -> np.ndarray:
    """Slots as rows (length, first rank, items a bin, first bin, offset), ordered by length and rank."""
    items = Lengths(histogram)
    groups = reduce_instance(items, capacity) + best_fit(items, capacity)
    ranks: dict[int, int] = {}
    rows, bins = [], 0
    for times, pattern in groups:
        offset = 0
        for length, n in pattern:
            rows.append((length, ranks.get(length, 0), n, bins, offset))
            ranks[length] = ranks.get(length, 0) + times * n
            offset += length * n
        bins += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def rank_within(df: DataFrame, key: str, order: list[str], salts: int) -> DataFrame:
    """``rank`` (from 0) of each row among those of its key; salted, so that a hot key is many small sorts."""
    salted = df.withColumn("salt", F.pmod(F.xxhash64(*order), F.lit(salts)))
    sizes = salted.groupBy(key, "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy(key).orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(key, "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    numbered = salted.withColumn("at", F.row_number().over(Window.partitionBy(key, "salt").orderBy(*order)))
    return numbered.join(sizes, [key, "salt"]).withColumn("rank", F.col("before") + F.col("at") - 1).drop("salt", "before", "at")


def pack(docs: DataFrame, *, tokenizer: str = "word_bpe_49k.json", capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """Pack the tokens of all documents into few sequences of at most ``capacity`` tokens.

    Input columns: doc_id, text; others are ignored. Result, a row for each piece: doc_id, piece,
    start, length, ids_crc32, sequence_id, offset. A null or empty text is ``end_id`` alone.
    Repeated rows are packed as often as they come; long texts are as many pieces as they need.
    No rows give no rows.
    """
    pieces = stage(cut_pieces(docs, tokenizer=tokenizer, capacity=capacity, end_id=end_id), "pieces")
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most ``capacity`` rows
    slots = plan_slots(histogram, capacity)
    starts = slots[:, 0] * (1 << 44) + slots[:, 1]

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        at = np.searchsorted(starts, length.to_numpy() * (1 << 44) + rank.to_numpy(), side="right") - 1
        own, n = slots[at], rank.to_numpy() - slots[at, 1]
        return pd.DataFrame({"sequence_id": own[:, 3] + n // own[:, 2], "offset": own[:, 4] + n % own[:, 2] * own[:, 0]})

    salts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranked = rank_within(pieces, "length", ["doc_id", "piece", "ids_crc32"], salts)
    placed: Column = place("length", "rank")
    return ranked.withColumn("placed", placed).select("doc_id", "piece", "start", "length", "ids_crc32", "placed.sequence_id", "placed.offset")
