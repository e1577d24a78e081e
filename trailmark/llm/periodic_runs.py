"""Operator 12, periodic runs of words, by the runs theorem.

Every run has a root that is the longest Lyndon word at its place, under one of the two orders of
the words. Such a word ends before the next smaller value of the inverse suffix array (under the
reversed order: the next larger), so there are two candidates a word. Each is extended to both
sides by common prefixes and suffixes, range minima of the LCP arrays of the text and the
reversed text, answered by sparse tables.

The texts of a batch are worked on side by side as one sequence: words are numbered per text, and
a number of its own ends each text, so no suffix compares across texts, no run crosses an end, and
reversing the order of words reverses the order of suffixes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrowtext import ragged, span_hashes, text_slices, window_hashes, words

SCHEMA = "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def suffix_order(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks of the suffixes, and the LCP of each suffix in order with the one before it (0 first).

    No suffix may be a prefix of another. Prefixes double in length; only suffixes that still share
    one are sorted again. A rank is the place where the suffix's group begins, so groups that are
    parted keep the places of the others. The ranks of every length give the LCP, longest first.
    """
    n = symbols.size
    at = np.arange(n)

    def group_starts(keys: np.ndarray) -> np.ndarray:
        new = np.ones(keys.size, bool)
        new[1:] = keys[1:] != keys[:-1]
        return np.maximum.accumulate(np.where(new, at[: keys.size], 0))

    order = np.argsort(symbols, kind="stable")
    begin = group_starts(symbols[order])
    rank = np.empty(n, np.int32)
    rank[order] = begin
    levels, length = [], 1
    active = order[np.bincount(begin, minlength=n)[begin] > 1]
    while active.size:
        levels.append(rank)
        ahead = active + length
        second = np.where(ahead < n, rank[np.minimum(ahead, n - 1)], -1).astype(np.int64) + 1
        key = rank[active].astype(np.int64) * (n + 1) + second
        place = np.argsort(key, kind="stable")
        active, key = active[place], key[place]
        old, begin = rank[active], group_starts(key)
        rank = rank.copy()
        rank[active] = old + begin - group_starts(old)
        active = active[np.bincount(begin, minlength=begin.size)[begin] > 1]
        length *= 2
    order = np.empty(n, np.int64)
    order[rank] = at
    a, b = order[:-1].copy(), order[1:].copy()
    lcp = np.zeros(n, np.int32)
    for k in range(len(levels) - 1, -1, -1):  # a shared prefix of 2**k words is the same rank at that length
        same = np.flatnonzero((a < n) & (b < n))
        same = same[levels[k][a[same]] == levels[k][b[same]]]
        a[same] += 1 << k
        b[same] += 1 << k
        lcp[same + 1] += 1 << k
    return rank, lcp


def sparse_table(values: np.ndarray, longest: int) -> list[np.ndarray]:
    """Minima of all windows of 2**k values, for windows up to ``longest``."""
    out = [values]
    while (2 << (len(out) - 1)) <= min(longest, values.size):
        half = 1 << (len(out) - 1)
        out.append(np.minimum(out[-1][:-half], out[-1][half:]))
    return out


def range_minimum(table: list[np.ndarray], low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Minimum of ``values[low:high]`` for each pair, low < high."""
    k = np.frexp(high - low)[1] - 1
    out = np.empty(low.size, table[0].dtype)
    for level in np.unique(k).tolist():
        own = np.flatnonzero(k == level)
        row = table[level]
        out[own] = np.minimum(row[low[own]], row[high[own] - (1 << level)])
    return out


class CommonPrefixes:
    """Length of the common prefix of any two suffixes."""

    def __init__(self, symbols: np.ndarray):
        self.rank, lcp = suffix_order(symbols)
        self.table = sparse_table(lcp, lcp.size)

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        x, y = self.rank[a], self.rank[b]
        return range_minimum(self.table, np.minimum(x, y).astype(np.int64) + 1, np.maximum(x, y).astype(np.int64) + 1).astype(np.int64)


def next_smaller(values: np.ndarray) -> np.ndarray:
    """For each place the next one of a smaller value (its end: the size of the array).

    Pointers to places that are known not to come before it jump over each other for a few rounds;
    what is left goes down a sparse table of minima.
    """
    n = values.size
    to = np.arange(1, n + 1)
    padded = np.append(values, np.iinfo(values.dtype).min)
    todo = np.flatnonzero(padded[to] > values)
    for _ in range(6):
        to[todo] = to[to[todo]]
        todo = todo[padded[to[todo]] > values[todo]]
        if not todo.size:
            return to
    table, at, mine = sparse_table(padded, padded.size), to[todo], values[todo]
    for k in range(len(table) - 1, -1, -1):
        fits = np.flatnonzero(at + (1 << k) <= n + 1)
        fits = fits[table[k][at[fits]] > mine[fits]]
        at[fits] += 1 << k
    to[todo] = at
    return to


def find_runs(symbols: np.ndarray, bounds: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and period of every run of at least ``least`` symbols and two periods, in order of start and period.

    Text k is ``symbols[bounds[k]:bounds[k + 1]]`` (symbols not negative).
    """
    none = np.zeros(0, np.int64)
    n_texts = bounds.size - 1
    if not symbols.size:
        return none, none, none
    lengths = np.diff(bounds)
    width = int(symbols.max()) + 2
    text = np.repeat(np.arange(n_texts), lengths + 1)  # each text and its end
    joined = text * width
    ends = bounds[1:] + np.arange(n_texts)
    joined[np.delete(np.arange(joined.size), ends)] += symbols + 1
    joined = np.unique(joined, return_inverse=True)[1]
    size = joined.size
    forward = CommonPrefixes(joined)
    backward = CommonPrefixes(joined[::-1].copy())
    found = []
    for rank in (forward.rank, -forward.rank):
        period = next_smaller(rank) - np.arange(size)
        start = np.flatnonzero((2 * period <= lengths[text]) & (np.arange(size) + period <= ends[text]))  # no root holds the end
        period = period[start]
        right = forward.of(start, start + period)
        some = start > 0
        left = np.zeros(start.size, np.int64)
        left[some] = backward.of(size - start[some], size - start[some] - period[some])
        whole = left + right + period
        kept = (whole >= 2 * period) & (whole >= least)
        found.append(np.stack([start[kept] - left[kept], period[kept], whole[kept]]))
    runs = np.unique(np.concatenate(found, axis=1), axis=1)
    start, period, whole = runs
    start = start - text[start]  # the ends of the texts before it
    return start, start + whole, period


def _repeats(hashes: np.ndarray, bounds: np.ndarray, k: int) -> np.ndarray:
    """Whether each text has a window of ``k`` words twice."""
    windows, starts = window_hashes(hashes, bounds, k)
    owner = np.repeat(np.arange(bounds.size - 1), np.diff(starts))
    order = np.lexsort((windows, owner))
    same = (windows[order][1:] == windows[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    out = np.zeros(bounds.size - 1, bool)
    out[owner[order][1:][same]] = True
    return out


def periodic_runs(docs: DataFrame, *, least: int = 12) -> DataFrame:
    """The runs of words of every whole text, and the text without their repeats.

    Input columns: doc_id, text; others are ignored. A run is a stretch of words with a smallest
    period q, at least ``least`` words and two periods long, that can't be longer. Result, a row for
    each input row: doc_id, runs (start and period in words, by start, then period; length),
    collapsed (the words that no run has behind its first period, with one space between). Null
    and empty texts have no runs and an empty ``collapsed``; repeated rows and null ids come back.
    A text takes some 200 bytes of memory a word if it repeats six words, and else what its words
    take: a run of 12 words or more has as many at a period's distance, so others have no run.
    """
    again = (least + 1) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in text_slices(batch.column(1), 1_000_000):
                first, last, bounds = words(data, offsets)
                hashes = span_hashes(data, first, last)
                has = _repeats(hashes, bounds, again)
                counts = np.where(has, np.diff(bounds), 0)
                taken = ragged(bounds[:-1], counts)
                own = np.concatenate([[0], np.cumsum(counts)])
                start, end, period = find_runs(np.unique(hashes[taken], return_inverse=True)[1], own, least)
                marks = np.zeros(taken.size + 1, np.int64)
                np.add.at(marks, start + period, 1)
                np.add.at(marks, end, -1)
                gone = np.zeros(first.size, bool)
                gone[taken] = np.cumsum(marks)[:-1] > 0
                of = np.searchsorted(own, start, side="right") - 1
                per_text = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=counts.size))])
                struct = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start - own[of], end - start, period)], names=["start", "length", "period"])
                runs = pa.ListArray.from_arrays(pa.array(per_text, pa.int32()), struct)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), runs, kept_words(data, first, last, bounds, ~gone)], names=["doc_id", "runs", "collapsed"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCHEMA)


def kept_words(data: np.ndarray, first: np.ndarray, last: np.ndarray, bounds: np.ndarray, keep: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by one space."""
    widths = np.where(keep, last - first, 0)
    upto = np.concatenate([[0], np.cumsum(keep)])
    ends = np.concatenate([[0], np.cumsum(widths + keep)])[bounds]  # a space behind each word
    at = ragged(first[keep], widths[keep] + 1)
    out = data[np.minimum(at, data.size - 1)] if at.size else np.zeros(0, np.uint8)
    out[np.cumsum(widths[keep] + 1) - 1] = 32
    filled = np.diff(upto[bounds]) > 0
    solid = np.ones(out.size, bool)
    solid[ends[1:][filled] - 1] = False
    offsets = np.concatenate([[0], np.cumsum(np.diff(ends) - filled)])
    return pa.LargeStringArray.from_buffers(offsets.size - 1, pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(out[solid].tobytes())).cast(pa.string())


def summary(runs: str = "runs") -> list[Column]:
    """The number of runs and the longest one (ties: smallest start, then period); nulls without runs."""
    longest = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    return [
        F.size(runs).cast("long").alias("n_runs"), (-longest["start"]).alias("start"), longest["length"].alias("length"), (-longest["period"]).alias("period"),
        F.floor(1000 * longest["length"] / -longest["period"]).alias("exponent_milli"),
    ]


def repeated_from(doc_id: str, text: str) -> Column:
    """Texts into which repeats are planted, by the id's CRC-32, so that there are runs to find.

    With h the CRC of the decimal id and g = h div 10: where h is divisible by 10 and there are n > 0
    words, each word i >= a becomes word a + (i - a) mod p, where a = g mod n and
    p = 1 + (n - a) div (3 + g mod 8). Other texts, and those without an id, stay.
    """
    h = F.crc32(F.col(doc_id).cast("long").cast("string").cast("binary"))
    g = F.floor(h / 10)
    listed = F.regexp_extract_all(F.col(text), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    # one array a row carries the words, so that they are split once
    planted = F.transform(F.array(listed), lambda w: F.array_join(_periodic(w, g), " "))[0]
    return F.when((F.pmod(h, F.lit(10)) == 0) & F.col(text).rlike(r"[^\x20\x09-\x0D]"), planted).otherwise(F.col(text))


def _periodic(listed: Column, g: Column) -> Column:
    n = F.size(listed)
    a = F.pmod(g, n)
    p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(listed, F.when(i < a, i).otherwise(a + F.pmod(i - a, p)).cast("int")))
