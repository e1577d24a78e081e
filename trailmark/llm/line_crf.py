"""Operator 3, quality classifier: a linear-chain conditional random field over lines.

Every line is good or bad. Its features are shares of kinds of characters, repeats and length, and
those of the lines above and below. The weights are fitted on a bounded sample of labelled
documents, each line labelled as its document. Forward-backward gives each line's marginal for
good; the square of their mean, weighted by length, is the document's quality: a document is
good where nearly all of it is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrowtext import span_hashes, text_slices, words
from .langid import held_out

KINDS = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"*$%&#<>^~", b"|", b"!", b".,;:?", b"0123456789", b"()[]{}/\\_=+-@\"'"]
KIND = np.zeros(256, np.uint8)
for _i, _kind in enumerate(KINDS):
    KIND[[*_kind]] = _i + 1
N_OWN = len(KINDS) + 6
N_FEATURES = 3 * N_OWN + 2


def lines_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each ``\\n``-split line, and each document's first line; an empty text has one empty line."""
    breaks = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
    per = np.bincount(np.searchsorted(offsets, breaks, side="right") - 1, minlength=offsets.size - 1) + 1 if offsets.size > 1 else np.zeros(0, np.int64)
    bounds = np.concatenate([[0], np.cumsum(per)])
    ends = np.empty(starts.size, np.int64)
    ends[:-1] = starts[1:] - 1
    ends[bounds[1:] - 1] = offsets[1:]
    return starts, ends, bounds


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of each line, its length, and each document's first line."""
    starts, ends, bounds = lines_of(data, offsets)
    size = ends - starts
    n = starts.size
    scale = np.maximum(size, 1)
    own = np.zeros((n, N_OWN))
    kind = KIND[data]
    at = np.flatnonzero(kind)
    of = np.searchsorted(starts, at, side="right") - 1
    for i in range(len(KINDS)):
        own[:, i] = np.bincount(of[kind[at] == i + 1], minlength=n) / scale
    begin, end, _ = words(data, offsets)
    line = np.searchsorted(starts, begin, side="right") - 1
    hashes = span_hashes(data, begin, end)
    count = np.bincount(line, minlength=n)
    again = np.zeros(begin.size, bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (line[1:] == line[:-1])
    k = len(KINDS)
    own[:, k] = np.bincount(line[again], minlength=n) / np.maximum(count, 1)
    # long words that the document has had before
    document = np.searchsorted(bounds, line, side="right") - 1
    long = end - begin > 4
    keys = hashes ^ (document.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    first = np.zeros(begin.size, bool)
    first[np.unique(keys, return_index=True)[1]] = True
    own[:, k + 1] = np.bincount(line[~first & long], minlength=n) / np.maximum(count, 1)
    whole = span_hashes(data, starts, ends) ^ (np.repeat(np.arange(offsets.size - 1), np.diff(bounds)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    repeated = np.ones(n, bool)
    repeated[np.unique(whole, return_index=True)[1]] = False
    own[:, k + 2] = repeated & (size > 20)
    own[:, k + 3] = np.log1p(size) / 8
    own[:, k + 4] = count == 0
    own[:, k + 5] = np.bincount(line, weights=end - begin, minlength=n) / np.maximum(count, 1) / 16
    above, below = np.zeros_like(own), np.zeros_like(own)
    inner = np.ones(n, bool)
    inner[bounds[:-1]] = False
    above[inner] = own[np.flatnonzero(inner) - 1]
    inner = np.ones(n, bool)
    inner[bounds[1:] - 1] = False
    below[inner] = own[np.flatnonzero(inner) + 1]
    edge = np.zeros((n, 2))
    edge[:, 0] = 1
    edge[bounds[:-1], 1] = 1
    return np.hstack([own, above, below, edge]), size, bounds


@dataclass(frozen=True)
class Chain:
    """``weights``: score of good against bad by feature; ``moves``: scores of [state before, state]; ``mean``, ``scale`` of features."""

    weights: np.ndarray
    moves: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def marginals(self, x: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """For each line the probability of good, by forward-backward over each document's lines."""
        return forward_backward((x - self.mean) / self.scale @ self.weights, self.moves, bounds)[0]


def forward_backward(score: np.ndarray, moves: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of good, and the expected number of each move; step t takes the t-th line of all documents that have one."""
    count = np.diff(bounds)
    order = np.argsort(-count, kind="stable")
    begin, count = bounds[:-1][order], count[order]
    node = np.stack([np.zeros_like(score), score])
    ahead, back = node.copy(), np.zeros_like(node)
    steps = int(count[0]) if count.size else 0
    alive = [int(np.searchsorted(-count, -t, side="left")) for t in range(steps)]  # documents of more than t lines
    for t in range(1, steps):
        at = begin[: alive[t]] + t
        for y in range(2):
            ahead[y, at] += np.logaddexp(ahead[0, at - 1] + moves[0, y], ahead[1, at - 1] + moves[1, y])
    for t in range(steps - 1, 0, -1):
        at = begin[: alive[t]] + t
        for y in range(2):
            back[y, at - 1] = np.logaddexp(moves[y, 0] + node[0, at] + back[0, at], moves[y, 1] + node[1, at] + back[1, at])
    total = np.logaddexp(ahead[0] + back[0], ahead[1] + back[1])
    good = np.exp(ahead[1] + back[1] - total)
    later = np.ones(score.size, bool)
    later[bounds[:-1]] = False
    at = np.flatnonzero(later)
    expected = np.array([[np.exp(ahead[a, at - 1] + moves[a, b] + node[b, at] + back[b, at] - total[at]).sum() for b in range(2)] for a in range(2)])
    return good, expected


def fit(x: np.ndarray, bounds: np.ndarray, labels: np.ndarray, rounds: int = 150, rate: float = 0.1, ridge: float = 1e-3) -> Chain:
    """Maximum likelihood with a ridge, by gradient steps of adapted size (Adam)."""
    mean, scale = x.mean(0), x.std(0)
    mean[scale < 1e-9], scale[scale < 1e-9] = 0, 1
    z = (x - mean) / scale
    y = np.repeat(labels, np.diff(bounds)).astype(float)
    later = np.ones(y.size, bool)
    later[bounds[:-1]] = False
    seen = np.zeros((2, 2))
    same = y[later].astype(int)  # lines of a document have one label
    seen[0, 0], seen[1, 1] = (same == 0).sum(), (same == 1).sum()
    theta = np.zeros(z.shape[1] + 4)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, rounds + 1):
        good, expected = forward_backward(z @ theta[:-4], theta[-4:].reshape(2, 2), bounds)
        slope = np.concatenate([z.T @ (y - good), (seen - expected).ravel()]) / y.size - ridge * theta
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        theta = theta + rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-8)
    return Chain(theta[:-4], theta[-4:].reshape(2, 2), mean, scale)


def quality(chain: Chain, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Squared mean marginal of each document's lines, weighted by their length and the line break."""
    x, size, bounds = features(data, offsets)
    good = chain.marginals(x, bounds)
    weight = size + 1.0
    return (np.add.reduceat(good * weight, bounds[:-1]) / np.add.reduceat(weight, bounds[:-1])) ** 2


def stretch(doc_id: int, n: int, most: int) -> tuple[int, int]:
    """Which ``most`` of n lines a long text teaches with: a run of neighbours that begins anywhere, drawn by the document's id."""
    start = int.from_bytes(hashlib.md5(str(doc_id).encode()).digest()[:8], "big") % (n - most + 1) if n > most else 0
    return start, min(n, start + most)


def training_set(docs: DataFrame, labels: DataFrame, most: int, most_lines: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of lines of at most ``most`` labelled documents that aren't held out, half of each label where there are.

    A document is one text (the least, where several share a doc_id), so ``most * most_lines`` rows of features bound what the driver gets.
    """
    rows = labels.where(~F.coalesce(held_out(), F.lit(True)) & F.col("quality").isin(0, 1)).select(F.col("doc_id").cast("long"), F.col("quality").cast("int").alias("quality")).distinct()
    chosen = [rows.where(F.col("quality") == q).orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(most // 2) for q in (0, 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in text_slices(batch.column(1)):
                x, _, bounds = features(data, offsets)
                ids = batch.column(0).slice(low, high - low)
                rows = []
                for doc_id, s, e in zip(ids.to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                    first, last = stretch(doc_id, e - s, most_lines)
                    rows.append(x[s + first : s + last].astype(np.float32).tobytes())
                yield pa.RecordBatch.from_arrays([ids, batch.column(2).slice(low, high - low), pa.array(rows, pa.binary())], names=["doc_id", "quality", "x"])

    known = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(chosen[0].union(chosen[1])), "doc_id")  # at most ``most`` ids
    known = known.groupBy("doc_id", "quality").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    found = known.select("doc_id", "text", "quality").mapInArrow(run, "doc_id long, quality int, x binary").collect()
    found.sort(key=lambda r: (r["doc_id"], r["quality"], r["x"]))
    parts = [np.frombuffer(r["x"], np.float32).reshape(-1, N_FEATURES) for r in found]
    bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    return np.vstack([*parts, np.zeros((0, N_FEATURES))]).astype(float), bounds, np.array([r["quality"] for r in found], np.int64)


def classify(docs: DataFrame, labels: DataFrame, *, most_training: int = 3000, most_lines: int = 200, threshold: float = 0.3) -> DataFrame:
    """The quality of every whole text.

    Input columns: doc_id, text, and labels' doc_id, quality; others are ignored. The weights are
    fitted on at most ``most_lines`` neighbouring lines, from anywhere in the text, of at most
    ``most_training`` labelled documents that aren't held out (crc32(doc_id as text) mod 5 is not
    0), about 100 MB of features at the defaults. Result, a row for each input row:
    doc_id, held_out, score (0 to 1), predicted (1 if score >= ``threshold``). A null or empty text
    is scored as one empty line. Labels of a document that contradict each other all count. With
    no labels of both kinds every score is 0.5. Repeated rows are judged each for itself; a null
    doc_id is held out as null. No rows give no rows.
    """
    x, bounds, y = training_set(docs, labels, most_training, most_lines)
    chain = fit(x, bounds, y) if len(set(y.tolist())) == 2 else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in text_slices(batch.column(1)):
                score = quality(chain, data, offsets) if chain else np.full(high - low, 0.5)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), batch.column(2).slice(low, high - low), pa.array(np.clip(score, 0, 1))], names=["doc_id", "held_out", "score"])

    rows = docs.select(F.col("doc_id").cast("long"), "text", held_out().alias("held_out"))
    scored = rows.mapInArrow(run, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
