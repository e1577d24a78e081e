"""Operator 4, language identification by nearest centroids.

Hashed byte n-grams (1 to 3) of a text make a TF-IDF vector of length 1. Each language has several
centroids, found by spherical k-means on a bounded sample of labelled texts. A text takes the
language of the centroid of the largest cosine; it is marked as rejected where that centroid is
farther than nearly all of its own training texts were.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .arrowtext import FOLD, U64, mix, text_slices
from .shared import stage

DIMENSIONS = 2048
#: Bytes of letters, of other alphabets and the space; n-grams with any other byte don't count.
PLAIN = np.arange(256) >= 128
PLAIN[[32, *range(65, 91), *range(97, 123)]] = True


def counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Documents x dimensions: how often each hashed n-gram of bytes occurs, A-Z as a-z."""
    n = offsets.size - 1
    out = np.zeros(n * DIMENSIONS, np.float32)
    if not data.size:
        return out.reshape(n, DIMENSIONS)
    code = FOLD[data]
    base = np.repeat(np.arange(n, dtype=np.int64) * DIMENSIONS, np.diff(offsets))
    left = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(data.size)  # bytes up to the document's end
    gram, some = np.zeros(data.size, U64), np.ones(data.size, bool)
    plain = PLAIN[data]
    for k in range(3):
        gram[: data.size - k] = gram[: data.size - k] * U64(31) + code[k:] if k else code
        some[: data.size - k] &= plain[k:]
        some &= left > k
        out += np.bincount(base[some] + (mix(gram[some]) % U64(DIMENSIONS)).astype(np.int64), minlength=out.size)
    return out.reshape(n, DIMENSIONS)


def vectors(tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(tf) * idf
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


@dataclass(frozen=True)
class Centroids:
    languages: list[str]
    idf: np.ndarray
    centres: np.ndarray
    owner: np.ndarray
    floor: np.ndarray

    def predict(self, tf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Language numbers, scores from 0 to 1, and whether the nearest centroid is too far."""
        cosine = vectors(tf, self.idf) @ self.centres.T
        best = cosine.argmax(1)
        top = cosine[np.arange(best.size), best]
        return self.owner[best], np.clip(top, 0, 1), top < self.floor[best]


def spherical_means(points: np.ndarray, k: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """Cluster centres on the unit sphere; the first ones are drawn, rather far from each other."""
    rng = np.random.default_rng(seed)
    centres = points[[int(rng.integers(len(points)))]]
    while len(centres) < min(k, len(points)):
        far = np.maximum(1 - (points @ centres.T).max(1), 1e-9).astype(np.float64)
        centres = np.vstack([centres, points[[int(rng.choice(len(points), p=far / far.sum()))]]])
    for _ in range(rounds):
        near = (points @ centres.T).argmax(1)
        sums = np.array([points[near == j].sum(0) if (near == j).any() else centres[j] for j in range(len(centres))])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centres


def fit(tf: np.ndarray, langs: list[str], clusters: int = 4) -> Centroids:
    """IDF, centroids, and for each the cosine below which 1 in 200 of its texts lies."""
    idf = (np.log((1 + len(langs)) / (1 + (tf > 0).sum(0))) + 1).astype(np.float32)
    points, names = vectors(tf, idf), sorted(set(langs))
    centres, owner, floor = [np.zeros((0, DIMENSIONS), np.float32)], [], []
    for i, name in enumerate(names):
        own = points[[x == name for x in langs]]
        found = spherical_means(own, clusters)
        cosine = own @ found.T
        near = cosine.argmax(1)
        centres.append(found)
        owner += [i] * len(found)
        floor += [float(np.quantile(cosine[near == j, j], 0.005)) if (near == j).any() else 0.0 for j in range(len(found))]
    return Centroids(names, idf, np.vstack(centres).astype(np.float32), np.array(owner, np.int64), np.array(floor))


def held_out() -> F.Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0


def even_share(counts: list[int], most: int) -> int:
    """The largest number, 1 at least, so that ``most`` rows are enough for that many of each count, or all where there are fewer."""
    left, share = most, most
    for i, n in enumerate(sorted(counts)):
        share = left // (len(counts) - i)
        if n > share:
            break
        left -= n
        share = max(n, 1)
    return max(1, share)


def drawn(rows: DataFrame, most: int) -> DataFrame:
    """``doc_id``, ``lang`` of at most an even share of ``most`` rows of each language, the first ones by md5(doc_id).

    Rows are counted by language and by the first digits of the key (a row each), so that only the
    slices that the share reaches into are ranked, not all rows of a hot language.
    """
    rows = rows.withColumn("key", F.md5(F.col("doc_id").cast("string"))).withColumn("slice", F.substring("key", 1, 3))
    counts = stage(rows.groupBy("lang", "slice").agg(F.count("*").alias("n")), "slices")
    share = even_share([r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()], most)  # one row a language
    before = Window.partitionBy("lang").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    reached = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).where(F.col("before") < share).select("lang", "slice")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("key", "doc_id"))
    return rows.join(reached, ["lang", "slice"], "left_semi").withColumn("rank", rank).where(F.col("rank") <= share).select("doc_id", "lang")


def training_set(docs: DataFrame, most: int) -> tuple[np.ndarray, list[str]]:
    """Counts and languages of at most ``most`` documents that aren't held out, evenly of each language, the same in each run; a row of numbers a document."""
    rows = docs.where(~F.coalesce(held_out(), F.lit(True)) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = rows.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"))
    chosen = drawn(rows, most).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in text_slices(batch.column(1), 200_000):
                tf = counts(data, offsets)
                body = pa.array([row.tobytes() for row in tf], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), batch.column(2).slice(low, high - low), body], names=["doc_id", "lang", "tf"])

    known = docs.select(F.col("doc_id").cast("long"), "text", F.col("lang").cast("string")).where("lang IS NOT NULL AND text IS NOT NULL").join(F.broadcast(chosen), ["doc_id", "lang"])  # at most ``most`` ids
    known = known.groupBy("doc_id", "lang").agg(F.min("text").alias("text"))  # one text a document, so that the ids bound the rows
    found = known.select("doc_id", "text", "lang").mapInArrow(run, "doc_id long, lang string, tf binary").collect()
    found.sort(key=lambda r: (r["doc_id"], r["lang"], r["tf"]))
    return np.array([np.frombuffer(r["tf"], np.float32) for r in found]).reshape(-1, DIMENSIONS), [r["lang"] for r in found]


def identify(docs: DataFrame, *, most_training: int = 3000, clusters: int = 4) -> DataFrame:
    """The language of every whole text.

    Input columns: doc_id, text, lang; others are ignored. Learned from text and lang of at most
    ``most_training`` rows that aren't held out (crc32(doc_id as text) mod 5 is not 0), the same
    number of each language or all where there are fewer, one at least; a prediction sees the text
    alone. Result, a row for each input row: doc_id, held_out, lang_pred (a learned
    language; ``und`` for a text that is null or has no letter, or if nothing was learned), score
    (cosine, 0 to 1; 0 for ``und``), rejected (too far from its centroid, or ``und``). A null doc_id
    is held out as null. Repeated rows are judged each for itself. No rows give no rows.
    """
    model = fit(*training_set(docs, most_training), clusters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.array([*model.languages, "und"], pa.string())
        for batch in batches:
            for low, high, data, offsets in text_slices(batch.column(1), 1_000_000):
                for at in range(0, high - low, 500):
                    part = offsets[at : at + 501]
                    lang, score, far = model.predict(counts(data[part[0] : part[-1]], part - part[0])) if model.languages else (np.zeros(part.size - 1, np.int64), np.zeros(part.size - 1), np.ones(part.size - 1, bool))
                    letter = batch.column(2).slice(low + at, part.size - 1).to_numpy(zero_copy_only=False) & bool(model.languages)
                    lang, score, far = np.where(letter, lang, len(names) - 1), np.where(letter, score, 0.0), far | ~letter
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(low + at, part.size - 1), batch.column(3).slice(low + at, part.size - 1), names.take(pa.array(lang)), pa.array(score.astype(np.float64)), pa.array(far)], names=["doc_id", "held_out", "lang_pred", "score", "rejected"])

    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long"), "text", letter.alias("letter"), held_out().alias("held_out"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")
