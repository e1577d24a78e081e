"""Operator 1, substring dedup by collinear chaining of shared k-mer seeds.

1. *Seeds*: of every window of consecutive k-word hashes of a text the smallest one, so that equal
   passages give equal seeds wherever they stand; on several scales, from the longest run that is
   sure to be left between changes up to a whole passage.
2. *Matches*: every seed that occurs again points to its first occurrence in the corpus (smallest
   doc_id, then place). A seed of n occurrences gives n - 1 matches, not n * n.
   Long seeds point to a copy of a passage even where its parts occurred before on their own.
3. *Chains*: the matches of a pair of documents, as runs on a diagonal, are chained in order in both
   texts through a Fenwick tree; each run follows the best of all chains that end within a bounded
   gap before it.
4. *Alignment*: the words of both sides of a chain are aligned between its runs (banded) and
   extended at its ends while they agree; the alignment is kept when it is long and alike enough.
5. *Second round*: stretches that are full of matches but of which no passage came hold a passage
   whose parts occurred before, each in another text. These stretches are matched with each other
   alone: texts that hold but a part aren't among them, so the first occurrence is another whole one.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrowtext import FOLD, U64, mix, span_hashes, text_slices, words
from .ngram_join import by_block
from .shared import clear, stage

#: Words before and behind a chain that the alignment may extend into.
MARGIN = 64
#: Places of one text that a row asks for, give or take the dealing by hash; a text of more is read by several rows.
SPANS = 256
#: Seeds or matches that a task packs at once.
BLOCK = 2_000_000


def minimisers(hashes: np.ndarray, bounds: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the smallest hash of each run of ``window`` (the last one on ties), and the document of each."""
    count = np.diff(bounds)
    document = np.repeat(np.arange(count.size), count)
    if not hashes.size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    least, at = hashes.copy(), np.arange(hashes.size)
    reach = 1  # least and at hold the minimum over `reach` hashes from each place, inside the document
    left = np.repeat(bounds[1:], count) - np.arange(hashes.size)
    while reach < window:
        step = min(reach, window - reach)
        other, place = least[step:], at[step:]
        better = (left[: other.size] > step) & (other <= least[: other.size])
        least[: other.size] = np.where(better, other, least[: other.size])
        at[: other.size] = np.where(better, place, at[: other.size])
        reach += step
    whole = (left >= window) | (np.arange(hashes.size) == np.repeat(bounds[:-1], count))  # a short document is one window
    places = np.unique(at[whole])
    return places, document[places]


def scales_of(least_words: int, least_alike: float) -> list[tuple[int, int]]:
    """Words of a seed, and the window of which the smallest one counts.

    - *Short*: all runs of the length that even evenly spread changes leave in a passage.
    - *Middle*: minimisers of runs twice and five times as long; their first occurrence is more
      often that of the passage than that of a stock phrase.
    - *Whole*: minimisers of runs of three quarters of ``least_words``, one of which any run of
      ``least_words`` holds, so that an exact repeat meets one of nearly its own length.
    """
    changes = most_changes(least_words, least_alike)
    short = max(1, -(-(least_words - changes) // (changes + 1)))
    middle = [(m * short, max(1, m * short // 2 + m)) for m in (2, 5) if m * short < least_words]
    window = least_words // 4 + 1
    return [(k, w) for k, w in ((short, 1), *middle, (least_words - window + 1, window)) if k <= least_words]


def most_changes(least_words: int, least_alike: float) -> int:
    return int(least_words * (1 - least_alike) + 1e-9)


def least_seeds(least_words: int, least_alike: float) -> int:
    """Short seeds that a chain needs: those that a passage keeps when each change spoils as many as a seed has words, but no more than one seed of twice the length holds."""
    short = scales_of(least_words, least_alike)[0][0]
    return max(1, min(short + 1, least_words - short + 1 - short * most_changes(least_words, least_alike)))


def run_hashes(own: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` words from each place on, as ``window_hashes`` gives it for whole windows, but by doubling: log k steps."""
    factor, done, total = 0xC2B2AE3D27D4EB4F, 0, np.zeros(own.size, U64)
    part, reach = own, 1  # the value of `reach` words from each place
    while True:
        if k & reach:
            total, done = joined(total, done, part, reach, factor), done + reach
        if done == k:
            return mix(total)
        part, reach = joined(part, reach, part, reach, factor), 2 * reach


def joined(a: np.ndarray, n: int, b: np.ndarray, m: int, factor: int) -> np.ndarray:
    """The value of n + m words, of that of n words from each place and that of the m words behind them."""
    size = max(0, min(a.size, b.size - n))
    shift = n * sum(pow(factor, i, 1 << 64) for i in range(m)) % (1 << 64)
    return a[:size] * U64(pow(factor, m, 1 << 64)) + b[n : n + size] + U64(shift)


def buckets_of(docs: DataFrame) -> int:
    """Hash ranges that seeds and texts are dealt to: a power of two, and some for each partition of a shuffle."""
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(1 << 16, max(256, 1 << (2 * partitions).bit_length()))


def squeezed(column: np.ndarray) -> bytes:
    """Whole numbers as their differences, byte by byte (all lowest bytes first), in zstd."""
    steps = np.diff(column.astype(np.int64), prepend=0)
    plain = (steps << 1) ^ (steps >> 63)
    return pa.compress(plain.view(np.uint8).reshape(-1, 8).T.tobytes(), codec="zstd", asbytes=True)


def loosened(body: bytes, n: int) -> np.ndarray:
    plain = np.frombuffer(pa.decompress(body, decompressed_size=8 * n, codec="zstd", asbytes=True), np.uint8)
    plain = np.ascontiguousarray(plain.reshape(8, n).T).view(U64).ravel()
    return np.cumsum((plain >> U64(1)).view(np.int64) ^ -(plain & U64(1)).view(np.int64))


def cut(keys: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Key, first place and place behind the last of each run of equal keys."""
    edges = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if keys.size else np.zeros(0, np.int64)
    return zip(keys[edges].tolist(), edges.tolist(), np.append(edges[1:], keys.size).tolist(), strict=True)


def in_stretches(document: np.ndarray, at: np.ndarray, k: int, lists: list[list[dict]]) -> np.ndarray:
    """Whether the ``k`` words from ``at`` lie in one of the stretches of their document, which don't overlap."""
    edges = sorted((d << 32 | x["low"], d << 32 | x["high"]) for d, own in enumerate(lists) for x in own)
    low, high = (np.array([e[i] for e in edges], np.int64) for i in (0, 1))
    place = (document << 32) + at
    before = np.searchsorted(low, place, side="right") - 1
    return (before >= 0) & (place + k <= high[before]) if low.size else np.zeros(at.size, bool)


def seeds(docs: DataFrame, scales: list[tuple[int, int]], buckets: int) -> DataFrame:
    """The seeds of texts, packed: ``bucket`` (by scale and the seed's highest bits), ``n``, and of each seed in the order of doc_id and place its hash (7 bytes; the bucket has the eighth), doc_id and word.

    With a third column of stretches, the seeds whose words lie in one of their text. A row holds the
    seeds of many texts, so what names a text costs little.
    """
    shift = U64(64 - (buckets.bit_length() - 1))

    def emit(held: list[list[tuple[np.ndarray, np.ndarray, np.ndarray]]]) -> Iterator[pa.RecordBatch]:
        for scale, parts in enumerate(held):
            out: list[list] = [[] for _ in range(5)]
            if parts:
                hashes, doc, at = (np.concatenate(x) for x in zip(*parts, strict=True))
                if (doc[1:] < doc[:-1]).any():
                    order = np.argsort(doc, kind="stable")
                    hashes, doc, at = hashes[order], doc[order], at[order]
                bucket = (hashes >> shift).astype(np.uint16)
                order = np.argsort(bucket, kind="stable")
                hashes, doc, at = hashes[order], doc[order], at[order]
                for key, low, high in cut(bucket[order]):
                    body = hashes[low:high].view(np.uint8).reshape(-1, 8)[:, :7].tobytes()
                    for column, value in zip(out, (scale * buckets + key, high - low, body, squeezed(doc[low:high]), squeezed(at[low:high])), strict=True):
                        column.append(value)
                parts.clear()
            kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 3]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=["bucket", "n", "hashes", "docs", "places"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [[] for _ in scales], 0
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for low, high, data, offsets in text_slices(batch.column(1)):
                starts, ends, bounds = words(data, offsets)
                own = span_hashes(data, starts, ends, FOLD)
                lists = batch.column(2).slice(low, high - low).to_pylist() if batch.num_columns > 2 else None
                for scale, (k, window) in enumerate(scales):
                    windows = np.concatenate([[0], np.cumsum(np.maximum(np.diff(bounds) - k + 1, 0))])
                    document = np.repeat(np.arange(high - low), np.diff(windows))
                    hashes = run_hashes(own, k)[np.arange(document.size) + (bounds[:-1] - windows[:-1])[document]] if document.size else np.zeros(0, U64)
                    if window > 1:
                        places, document = minimisers(hashes, windows, window)
                    else:
                        places = np.arange(hashes.size)
                    at = places - windows[document]
                    if lists is not None:
                        inside = in_stretches(document, at, k, lists)
                        places, document, at = places[inside], document[inside], at[inside]
                    held[scale].append((hashes[places], ids[low:high][document], at.astype(np.int32)))
                    n += places.size
                if n >= BLOCK:
                    yield from emit(held)
                    n = 0
        yield from emit(held)

    return docs.mapInArrow(run, "bucket int, n int, hashes binary, docs binary, places binary")


def matches(docs: DataFrame, scales: list[tuple[int, int]]) -> DataFrame:
    """Each seed that occurred before, with its first occurrence, packed: ``part`` (of texts), ``size``, ``n``, and of each match doc_id, word, and doc_id and word of the first occurrence."""
    buckets = buckets_of(docs)

    def repeats(rows: pa.Table) -> Iterator[tuple[int, tuple[np.ndarray, ...]]]:
        counts = rows.column("n").to_numpy()
        for key, low, high in cut(rows.column("bucket").to_numpy()):
            own = rows.slice(low, high - low)
            whole = np.zeros((int(counts[low:high].sum()), 8), np.uint8)
            whole[:, :7] = np.concatenate([np.frombuffer(x.as_buffer(), np.uint8) for x in own.column("hashes")]).reshape(-1, 7)
            hashes = whole.view(U64).ravel()
            order = np.argsort(hashes)
            same = hashes[order][1:] == hashes[order][:-1]
            pick = order[np.append(False, same) | np.append(same, False)]
            if not pick.size:
                continue
            doc, at = (np.concatenate([loosened(x.as_buffer(), n) for x, n in zip(own.column(c), counts[low:high].tolist(), strict=True)])[pick] for c in ("docs", "places"))
            hashes = hashes[pick]
            order = np.lexsort((at, doc, hashes))
            hashes, doc, at = hashes[order], doc[order], at[order]
            first = np.maximum.accumulate(np.where(np.append(True, hashes[1:] != hashes[:-1]), np.arange(hashes.size), 0))
            later = (doc != doc[first]) | (at != at[first])
            yield scales[key // buckets][0], (doc[later], at[later], doc[first][later], at[first][later])

    def emit(held: dict[int, list[tuple[np.ndarray, ...]]]) -> Iterator[pa.RecordBatch]:
        for size, parts in held.items():
            columns = [np.concatenate(x) for x in zip(*parts, strict=True)]
            part = (mix(columns[0].view(U64)) & U64(buckets - 1)).astype(np.int64)
            order = np.lexsort((columns[1], columns[0], part))
            columns = [x[order] for x in columns]
            out: list[list] = [[] for _ in range(7)]
            for key, low, high in cut(part[order]):
                for column, value in zip(out, (key, size, high - low, *(squeezed(x[low:high]) for x in columns)), strict=True):
                    column.append(value)
            kinds = [*[pa.int32()] * 3, *[pa.binary()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=["part", "size", "n", "docs", "places", "srcs", "src_places"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, ...]]] = {}
        n = 0
        for size, columns in by_block(batches, repeats):
            held.setdefault(size, []).append(columns)
            n += columns[0].size
            if n >= BLOCK:
                yield from emit(held)
                held, n = {}, 0
        yield from emit(held)

    keyed = seeds(docs, scales, buckets).repartition("bucket").sortWithinPartitions("bucket")
    return keyed.mapInArrow(run, "part int, size int, n int, docs binary, places binary, srcs binary, src_places binary")


def uncovered(found: DataFrame, passages: DataFrame, *, least: int, gap: int) -> DataFrame:
    """``doc_id``, ``low``, ``high``: stretches of at least ``least`` words in which matches leave gaps of up to ``gap`` words, without the passages in them.

    ``found``: doc_id, low, high of the stretches full of matches, passages or not.
    """

    def work(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        doc, low, high, kept = (rows.column(c).to_numpy() for c in ("doc_id", "low", "high", "kept"))
        out: list[list[int]] = [[], [], []]
        edges = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
        for first, last in zip(edges, np.append(edges[1:], doc.size), strict=True):
            own, taken = slice(first, last), []
            some = kept[own]
            for a, b in merged(low[own][~some], high[own][~some], gap):
                free = a
                for c, d in [*merged(low[own][some], high[own][some], 0), (b, b)]:
                    if min(c, b) - free >= least:
                        taken.append((free, min(c, b)))
                    free = max(free, d)
            for a, b in taken:
                for column, value in zip(out, (int(doc[first]), a, b), strict=True):
                    column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.int32())], names=["doc_id", "low", "high"])

    spans = found.select("doc_id", "low", "high", F.lit(False).alias("kept"))
    spans = spans.unionByName(passages.select("doc_id", F.col("from_word").cast("int").alias("low"), F.col("to_word").cast("int").alias("high"), F.lit(True).alias("kept")))
    keyed = spans.distinct().repartition("doc_id").sortWithinPartitions("doc_id")  # a text's own stretches
    return keyed.mapInArrow(lambda batches: by_block(batches, work), "doc_id long, low int, high int")


def merged(low: np.ndarray, high: np.ndarray, gap: int) -> list[tuple[int, int]]:
    """The unions of intervals that lie up to ``gap`` apart, in order."""
    if not low.size:
        return []
    order = np.argsort(low, kind="stable")
    low, end = low[order], np.maximum.accumulate(high[order])
    edges = np.flatnonzero(np.append(True, low[1:] > end[:-1] + gap))
    return list(zip(low[edges].tolist(), end[np.append(edges[1:], low.size) - 1].tolist(), strict=True))


def runs_of(src_at: np.ndarray, at: np.ndarray, size: np.ndarray, k: int, most_gap: int = 40) -> np.ndarray:
    """Matches near each other on a diagonal as rows (start in src, start, words, seeds), in the order of start.

    ``seeds``: runs of ``k`` words that agree in both texts.
    """
    order = np.lexsort((at, at - src_at))
    i, j, n = (x[order].astype(np.int64) for x in (src_at, at, size))
    diagonal = np.cumsum(np.diff(j - i, prepend=j[0] - i[0]) != 0) * (1 << 32)
    end = np.maximum.accumulate(j + n + diagonal)
    gap = np.full(j.size, 1 << 40)
    gap[1:] = (j + diagonal)[1:] - end[:-1]
    fresh = np.where(gap > 0, n - k + 1, np.maximum(n + gap, 0))  # behind a gap, or what goes beyond the words so far
    edges = np.flatnonzero(gap > most_gap)
    last = np.append(edges[1:], i.size) - 1
    rows = np.stack([i[edges], j[edges], (end - diagonal)[last] - j[edges], np.add.reduceat(fresh, edges)], axis=1)
    return rows[np.lexsort((rows[:, 0], rows[:, 1]))]


class ReachTree:
    """A Fenwick tree of maxima over places 0..n-1 whose entries may be taken out again.

    Node i covers the ``i & -i`` places up to i. The best of a range is found by going down from its
    end, over whole nodes where they lie inside it; an entry that goes is made good from the nodes
    below, so both take the square of the logarithm at most.
    """

    NONE = (-1 << 60, -1)

    def __init__(self, n: int):
        self.own = [self.NONE] * (n + 1)
        self.best = [self.NONE] * (n + 1)

    def set(self, place: int, entry: tuple[int, int] = NONE) -> None:
        i = place + 1
        self.own[i] = entry
        while i < len(self.own):
            if entry < self.best[i]:
                low, j, top = i - (i & -i), i - 1, self.own[i]
                while j > low:
                    top = max(top, self.best[j])
                    j -= j & -j
                self.best[i] = top
            else:
                self.best[i] = entry
            i += i & -i

    def top(self, low: int, high: int) -> tuple[int, int]:
        """The best entry of places low..high-1."""
        found, i = self.NONE, high
        while i > low:
            if i - (i & -i) >= low:
                found = max(found, self.best[i])
                i -= i & -i
            else:
                found = max(found, self.own[i])
                i -= 1
        return found


def chains(runs: np.ndarray, *, gap_tenths: int = 1, most_gap: int = 40) -> list[list[int]]:
    """Chains of runs in order in both texts, best first; each run is in one chain.

    Score, in tenths: 10 for each word of a run, less ``gap_tenths`` for each word of the gaps on
    both sides. With e = end and s = start, that is [score(p) + g * (e1 + e2)] - g * (s1 + s2), so
    the best predecessor is the highest bracket in a Fenwick tree over the ends in the first text.
    A predecessor ends at most ``most_gap`` words before in both texts: p comes into the tree once
    its end in the second text is passed and leaves it ``most_gap`` words later, so that a far one
    never hides a near one.
    """
    n = len(runs)
    if n == 1:
        return [[0]]
    ends = runs[:, :2] + runs[:, 2:3]
    by_end = np.argsort(ends[:, 1], kind="stable").tolist()
    order = np.lexsort((np.arange(n), ends[:, 0]))
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    firsts, seconds, place = ends[order, 0].tolist(), ends[:, 1].tolist(), place.tolist()
    sums = (gap_tenths * ends.sum(1)).tolist()
    tree = ReachTree(n)
    offered = gone = 0
    score, before = [0] * n, [-1] * n
    for q, (s1, s2, size) in enumerate(runs[:, :3].tolist()):
        while offered < n and seconds[by_end[offered]] <= s2:
            p = by_end[offered]
            tree.set(place[p], (score[p] + sums[p], p))
            offered += 1
        while gone < offered and seconds[by_end[gone]] < s2 - most_gap:
            tree.set(place[by_end[gone]])
            gone += 1
        value, p = tree.top(bisect_left(firsts, s1 - most_gap), bisect_right(firsts, s1))
        score[q] = 10 * size
        if p >= 0 and value - gap_tenths * (s1 + s2) > 0:
            score[q] += value - gap_tenths * (s1 + s2)
            before[q] = p
    used, out = [False] * n, []
    for q in sorted(range(n), key=lambda q: -score[q]):
        chain = []
        while q >= 0 and not used[q]:
            used[q] = True
            chain.append(q)
            q = before[q]
        if chain:
            out.append(chain[::-1])
    return out


def chained(found: DataFrame, *, k: int, least_words: int, least: int, stretch: int, gap: int) -> DataFrame:
    """``src``, ``doc_id``, ``src_from``, ``src_to``, ``from``, ``to``, ``runs`` of every chain of at least ``least`` shared seeds that may reach ``least_words``.

    Rows without ``src`` are the stretches of a text (``from``, ``to``) of at least ``stretch`` words in
    which matches leave gaps of up to ``gap`` words. ``found`` is dealt by text: the matches of a text
    are as many as it has words, a few times.
    """
    names = ["src", "doc_id", "src_from", "src_to", "from", "to", "runs"]
    kinds = [pa.int64(), pa.int64(), *[pa.int32()] * 4, pa.list_(pa.int32())]

    def full(doc: np.ndarray, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        order = np.lexsort((at, doc))
        doc, at, size = doc[order], at[order], size[order]
        apart = np.cumsum(np.append(False, doc[1:] != doc[:-1])).astype(np.int64) << 32
        end = np.maximum.accumulate(at + size + apart)
        edges = np.flatnonzero(np.append(True, (at + apart)[1:] > end[:-1] + gap))
        doc, low, high = doc[edges], at[edges], (end - apart)[np.append(edges[1:], at.size) - 1]
        long = high - low >= stretch
        return doc[long], low[long], high[long]

    def work(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        counts = rows.column("n").to_numpy()
        for _, first, last in cut(rows.column("part").to_numpy()):
            own, ns = rows.slice(first, last - first), counts[first:last]
            doc, j, src, i = (np.concatenate([loosened(x.as_buffer(), n) for x, n in zip(own.column(c), ns.tolist(), strict=True)]) for c in ("docs", "places", "srcs", "src_places"))
            size = np.repeat(own.column("size").to_numpy(), ns).astype(np.int64)
            order = np.lexsort((doc, src))
            src, doc, i, j, size = src[order], doc[order], i[order], j[order], size[order]
            edges = np.flatnonzero(np.append(True, (np.diff(src) != 0) | (np.diff(doc) != 0)))
            shared = np.add.reduceat(size - k + 1, edges)
            out: list[list] = [[] for _ in names]
            for low, high in zip(edges[shared >= least], np.append(edges[1:], src.size)[shared >= least], strict=True):
                runs = runs_of(i[low:high], j[low:high], size[low:high], k)
                for chain in chains(runs):
                    links = runs[chain]
                    a, b = links[0, :2], links[-1, :2] + links[-1, 2]
                    if links[:, 3].sum() < least or b[1] - a[1] + 2 * MARGIN < least_words:
                        continue
                    for column, value in zip(out, (src[low], doc[low], a[0], b[0], a[1], b[1], links[:, :3].ravel().tolist()), strict=True):
                        column.append(value)
            for text, low, high in zip(*full(doc, j, size), strict=True):
                for column, value in zip(out, (None, text, None, None, low, high, None), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=names)

    keyed = found.repartition("part").sortWithinPartitions("part")
    return keyed.mapInArrow(lambda batches: by_block(batches, work), "src long, doc_id long, src_from int, src_to int, from int, to int, runs array<int>")


def narrow(hashes: np.ndarray) -> bytes:
    """Five bytes of each word hash: bodies are most of what is shuffled, and only words that stand against each other are compared."""
    return hashes.view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def wide(body: bytes) -> np.ndarray:
    raw = np.frombuffer(body, np.uint8).reshape(-1, 5)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :5] = raw
    return out.view(U64).ravel()


def passages_of(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """Word hashes of the wanted spans. ``spans``: doc_id, low, high; result: these, and ``body`` with as many words as there are."""
    spans = stage(spans.distinct(), "spans", release=True)
    parts = spans.groupBy("doc_id").agg(F.ceil(F.count("*") / SPANS).alias("parts"))
    dealt = spans.join(parts, "doc_id").withColumn("part", F.pmod(F.xxhash64("low", "high"), F.col("parts")))
    wanted = dealt.groupBy("doc_id", "part").agg(F.collect_list(F.struct("low", "high")).alias("spans"))  # some places of one text that are asked for

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in text_slices(batch.column(1)):
                starts, ends, bounds = words(data, offsets)
                hashes = span_hashes(data, starts, ends, FOLD)
                lists = batch.column(2).slice(low, high - low).to_pylist()
                out: list[list] = [[], [], [], []]
                for k, own in enumerate(lists):
                    for span in own:
                        body = hashes[bounds[k] + span["low"] : min(bounds[k] + span["high"], bounds[k + 1])]
                        for column, value in zip(out, (k, span["low"], span["high"], narrow(body)), strict=True):
                            column.append(value)
                ids = batch.column(0).slice(low, high - low).take(pa.array(out[0], pa.int64()))
                yield pa.RecordBatch.from_arrays([ids, pa.array(out[1], pa.int32()), pa.array(out[2], pa.int32()), pa.array(out[3], pa.binary())], names=["doc_id", "low", "high", "body"])

    return docs.join(stage(wanted, "wanted", release=True).drop("part"), "doc_id").select("doc_id", "text", "spans").mapInArrow(run, "doc_id long, low int, high int, body binary")


def common_words(a: np.ndarray, b: np.ndarray, band: int = 16) -> int:
    """Words of the longest common subsequence within a band around the diagonal."""
    if not a.size or not b.size:
        return 0
    if a.size == b.size and (a == b).all():
        return int(a.size)
    half = band + abs(a.size - b.size)
    row = np.zeros(b.size + 1, np.int64)
    for i in range(a.size):
        low, high = max(0, i - half), min(b.size, i + half + 1)
        best = np.maximum(row[low + 1 : high + 1], row[low:high] + (b[low:high] == a[i]))
        row[low + 1 : high + 1] = np.maximum(np.maximum.accumulate(best), row[low])
        row[high + 1 :] = row[high]
    return int(row[-1])


def extend(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """How far two word rows go together from their start: words, and those of them that agree. It ends on an agreement, at the best of 2 for one and -3 for none."""
    n = min(a.size, b.size)
    same = a[:n] == b[:n]
    score = np.cumsum(np.where(same, 2, -3))
    if not n or score.max() <= 0:
        return 0, 0
    end = int(score.argmax()) + 1
    return end, int(same[:end].sum())


def align(src: np.ndarray, own: np.ndarray, runs: np.ndarray, shift: int | None = None) -> tuple[int, int, int, int, int]:
    """From and to in ``src``, in ``own``, and the words that agree, for runs given by places in both rows.

    With ``shift``, both rows are of one text and ``own`` begins ``shift`` words behind ``src``: the
    part in ``src`` then ends where that in ``own`` begins.
    """
    i, j, _ = runs[0]
    back, more = extend(src[:i][::-1], own[:j][::-1])
    if shift is not None:
        src = src[: max(int(j - back + shift), 0)]
        runs = runs[runs[:, 0] < src.size]
        if not len(runs):
            return int(i - back), int(i), int(j - back), int(j), more
        runs = np.column_stack([runs[:, :2], np.minimum(runs[:, 2], src.size - runs[:, 0])])
    agree = 0
    for r, (i, j, n) in enumerate(runs):
        agree += int((src[i : i + n] == own[j : j + n]).sum())
        if r + 1 < len(runs):
            agree += common_words(src[i + n : runs[r + 1][0]], own[j + n : runs[r + 1][1]])
    i, j, _ = runs[0]
    end_i, end_j = runs[-1][0] + runs[-1][2], runs[-1][1] + runs[-1][2]
    ahead, most = extend(src[end_i:], own[end_j:])
    return int(i - back), int(end_i + ahead), int(j - back), int(end_j + ahead), agree + more + most


def repeated_passages(docs: DataFrame, *, least_words: int = 50, least_alike: float = 0.8) -> DataFrame:
    """Passages of at least ``least_words`` words that repeat one of an earlier document, or an earlier place of their own.

    Input columns: doc_id, text; others are ignored. Words are ``[^\\\\x20\\\\x09-\\\\x0D]+`` with A-Z as
    a-z. Result, a row for each passage: doc_id, src_id, from_word, to_word, src_from, src_to,
    n_words (to_word - from_word), n_agree (words that agree in the alignment, at least
    ``least_alike`` of the longer side). A group of n copies gives n - 1 rows, each naming the first
    occurrence of its seeds. Texts of under ``least_words`` words, null and empty ones have no passage. Rows
    without doc_id are left out; rows that repeat a doc_id are passages of one document. No rows
    give no rows.

    Every repeat of ``least_words`` words of which ``least_alike`` agree shares seeds, wherever the
    changes are. It meets the first texts that hold its seeds of 4, 8, 20 or 38 words (at the
    defaults); where these hold but parts of it, it meets in the second round the first one whose
    own passage wasn't found either. Texts of
    any length are worked on whole, in memory that grows with the text.
    """
    docs = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long"), "text")
    scales = scales_of(least_words, least_alike)
    rules = {"least_words": least_words, "least_alike": least_alike}
    first, full = aligned(docs, scales, **rules)
    first = stage(first, "passages", release=True)
    stretches = uncovered(full, first, least=int(least_words * least_alike), gap=most_changes(least_words, least_alike))
    lists = stretches.groupBy("doc_id").agg(F.collect_list(F.struct("low", "high")).alias("stretches"))  # of one text: fewer than its words
    again = stage(docs.join(stage(lists, "stretches", release=True), "doc_id").select("doc_id", "text", "stretches"), "again", release=True)
    second, _ = aligned(again, scales, **rules)
    return first.unionByName(second).distinct()


def aligned(docs: DataFrame, scales: list[tuple[int, int]], *, least_words: int, least_alike: float) -> tuple[DataFrame, DataFrame]:
    """The passages that the matches of the texts (in their stretches, if a third column has them) lead to; and the stretches full of matches.

    The seeds of the shortest scale are as many as words, those of the others together fewer: each
    lot is matched by itself, so that the disk never holds the seeds of both.
    """
    found = [stage(matches(docs, lot), "matches", release=True) for lot in (scales[:1], scales[1:]) if lot]
    changes = most_changes(least_words, least_alike)
    all_found = found[0].unionByName(found[1]) if len(found) > 1 else found[0]
    rows = chained(all_found, k=scales[0][0], least_words=least_words, least=least_seeds(least_words, least_alike), stretch=int(least_words * least_alike), gap=changes)
    rows = stage(rows, "chains", release=True)
    for lot in found:
        clear(lot)
    links = rows.where("src IS NOT NULL")
    full = rows.where("src IS NULL").select("doc_id", F.col("from").alias("low"), F.col("to").alias("high"))
    low = lambda c: F.greatest(F.col(c) - MARGIN, F.lit(0)).alias("low")
    high = lambda c: (F.col(c) + MARGIN).alias("high")
    spans = links.select("doc_id", low("from"), high("to")).union(links.select("src", low("src_from"), high("src_to")))
    bodies = stage(passages_of(docs.select("doc_id", "text"), spans), "bodies", release=True)
    own = bodies.select("doc_id", F.col("low").alias("own_low"), F.col("high").alias("own_high"), F.col("body").alias("own_body"))
    source = bodies.select(F.col("doc_id").alias("src"), F.col("low").alias("src_low"), F.col("high").alias("src_high"), F.col("body").alias("src_body"))
    both = links.withColumns({"own_low": low("from"), "own_high": high("to"), "src_low": low("src_from"), "src_high": high("src_to")})
    both = both.join(own, ["doc_id", "own_low", "own_high"]).join(source, ["src", "src_low", "src_high"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "src_id", "from_word", "to_word", "src_from", "src_to", "n_agree"]
        for batch in batches:
            src, doc, src_low, own_low = (batch.column(i).to_numpy() for i in range(4))
            rows = []
            for r in range(batch.num_rows):
                a, b = wide(batch.column(5)[r].as_buffer()), wide(batch.column(6)[r].as_buffer())
                runs = np.array(batch.column(4)[r].as_py(), np.int64).reshape(-1, 3) - [src_low[r], own_low[r], 0]
                i, i_end, j, j_end, agree = align(a, b, runs, int(own_low[r] - src_low[r]) if src[r] == doc[r] else None)
                if j_end - j >= least_words and agree >= least_alike * max(i_end - i, j_end - j) and (src[r] != doc[r] or i_end + src_low[r] <= j + own_low[r]):
                    rows.append((doc[r], src[r], j + own_low[r], j_end + own_low[r], i + src_low[r], i_end + src_low[r], agree))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in np.array(rows, np.int64).reshape(-1, 7).T], names=names)

    pairs = both.select("src", "doc_id", "src_low", "own_low", "runs", "src_body", "own_body")
    out = pairs.mapInArrow(run, "doc_id long, src_id long, from_word long, to_word long, src_from long, src_to long, n_agree long").distinct()
    return out.withColumn("n_words", F.col("to_word") - F.col("from_word")), full
