"""Operator 11, SimHash near-dedup by covering anchors.

The anchors are a linear code: 64 bits are parted into blocks, and each block has a small code
that covers it (two of 23 bits with radius 3, two of 7, one of 3 and one of 1 bit; 2**34 anchors
in all). A fingerprint is a member of its nearest anchor, at most the covering radius away, and
is sent to every anchor within the covering radius plus the threshold, counted block by block:
about 150 of them. Two fingerprints within the threshold differ by no more than that in the
blocks together, so one is sent to the anchor that the other is a member of, and they are compared there.

Fingerprints are compared once however many rows have them. An anchor with a crowd of members is
refined by the code in which every word is an anchor (radius 0): its members are sent to all
words within the threshold, so the work for each stays the same however large the crowd is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrowtext import ragged
from .components import components
from .shared import stage

U64 = np.uint64
#: Hashes whose bits are counted at once.
STEP = 1 << 15


def bit_majority(hashes: np.ndarray) -> int:
    """The word whose bits are set in over half of ``hashes``."""
    counts = np.zeros(64, np.int64)
    for low in range(0, hashes.size, STEP):
        counts += np.unpackbits(hashes[low : low + STEP].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > hashes.size, bitorder="little").view(U64)[0])


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """The SimHash of all word shingles of a text, repeats included; 0 without words."""
    words = (text or "").encode().lower().split()  # on bytes: A-Z and the white space of ASCII
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    last = max(len(words) - shingle + 1, 1)
    of = xxhash.xxh64_intdigest
    spans = zip(starts[:last].tolist(), ends[min(shingle, len(words)) - 1 :].tolist(), strict=True)
    return bit_majority(np.fromiter((of(line[a:b], seed) for a, b in spans), U64, last))


def fingerprints(docs: DataFrame, *, shingle: int = 3, seed: int = 42) -> DataFrame:
    """doc_id and fp (the fingerprint as a signed long) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.fromiter((fingerprint(t.as_py(), shingle, seed) for t in batch.column(1)), U64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fp long")


@dataclass(frozen=True)
class Block:
    """A linear code over ``bits`` bits: a syndrome for each bit (none: every word is a code word) and the covering radius."""

    bits: int
    syndromes: tuple[int, ...]
    radius: int

    def ways(self, beyond: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Patterns that lead a word to a code word, nearest first, for each syndrome: where its patterns begin, the patterns, and how far each lies beyond the radius (up to ``beyond``)."""
        found: dict[int, list[tuple[int, int]]] = {s: [] for s in range(1 << max(self.syndromes).bit_length())}
        for weight in range(self.radius + beyond + 1):
            for places in combinations(range(self.bits), weight):
                syndrome = 0
                for b in places:
                    syndrome ^= self.syndromes[b]
                found[syndrome].append((sum(1 << b for b in places), max(0, weight - self.radius)))
        assert all(x and x[0][1] == 0 for x in found.values()), "the radius doesn't cover"
        starts = np.concatenate([[0], np.cumsum([len(x) for x in found.values()])])
        flat = [w for x in found.values() for w in x]
        return starts, np.array([p for p, _ in flat], U64), np.array([e for _, e in flat], np.int64)


def cyclic(bits: int, generator: int, radius: int) -> Block:
    """The cyclic code of a generator polynomial: a bit's syndrome is the rest of its power of x."""
    rests, rest = [], 1
    for _ in range(bits):
        rests.append(rest)
        rest <<= 1
        if rest >> (generator.bit_length() - 1):
            rest ^= generator
    return Block(bits, tuple(rests), radius)


#: x^11+x^9+x^7+x^6+x^5+x+1 gives the perfect code of 23 bits, x^3+x+1 that of 7 and x^2+x+1 that of 3.
CODE = (cyclic(23, 0b101011100011, 3), cyclic(23, 0b101011100011, 3), cyclic(7, 0b1011, 1), cyclic(7, 0b1011, 1), cyclic(3, 0b111, 1), Block(1, (0,), 0))


@lru_cache(maxsize=8)
def _ways(block: Block, beyond: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return block.ways(beyond)


def anchors(words: np.ndarray, beyond: int, code: tuple[Block, ...] = CODE) -> tuple[np.ndarray, np.ndarray]:
    """For each word the anchors within the covering radius plus ``beyond``: index of the word, and anchor."""
    index, anchor, left = np.arange(words.size), words.copy(), np.full(words.size, beyond, np.int64)
    shift = 0
    for block in code:
        starts, patterns, excess = _ways(block, beyond)
        part = (anchor >> U64(shift)) & U64((1 << block.bits) - 1)
        syndrome = np.zeros(part.size, np.int64)
        for b, s in enumerate(block.syndromes):
            syndrome ^= ((part >> U64(b)) & U64(1)).astype(np.int64) * s
        lengths = starts[syndrome + 1] - starts[syndrome]
        to, way = np.repeat(np.arange(part.size), lengths), ragged(starts[syndrome], lengths)
        near = excess[way] <= left[to]
        to, way = to[near], way[near]
        index, anchor, left = index[to], anchor[to] ^ (patterns[way] << U64(shift)), left[to] - excess[way]
        shift += block.bits
    return index, anchor


def _sent(fps: DataFrame, beyond: int, code: tuple[Block, ...], name: str) -> DataFrame:
    """fp and its anchors within the radius plus ``beyond``, as ``name``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(0).to_numpy(zero_copy_only=False).view(U64)
            for low in range(0, words.size, 2048):
                index, anchor = anchors(words[low : low + 2048], beyond, code)
                if not beyond:  # a member has one anchor
                    index, first = np.unique(index, return_index=True)
                    anchor = anchor[first]
                yield pa.RecordBatch.from_arrays([pa.array(words[low + index].view(np.int64)), pa.array(anchor.view(np.int64))], names=["fp", name])

    return fps.select("fp").mapInArrow(run, f"fp long, {name} long")


def _apart(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def links(fps: DataFrame, *, most: int = 2, code: tuple[Block, ...] = CODE, crowd: int = 4096) -> DataFrame:
    """Pairs a, b of the distinct fingerprints ``fp`` that differ in 1 to ``most`` bits, each at least once."""
    members = stage(_sent(fps, 0, code, "anchor"), "members")
    crowded = stage(members.groupBy("anchor").count().where(F.col("count") > crowd).select("anchor"), "crowded")
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    visitors = _sent(fps.repartition(parts, "fp"), most, code, "anchor").withColumnRenamed("fp", "a")  # a fingerprint becomes a hundred rows: few files must not mean few tasks
    open_members = members.join(crowded.hint("merge"), "anchor", "left_anti").withColumnRenamed("fp", "b")
    near = visitors.join(open_members.hint("shuffle_hash"), "anchor").where((F.col("a") != F.col("b")) & (_apart("a", "b") <= most)).select("a", "b")
    inner = stage(members.join(crowded.hint("merge"), "anchor", "left_semi").select("fp"), "inner")
    fine = (Block(64, (0,) * 64, 0),)
    words = _sent(inner, most, fine, "b").where("fp < b")
    return near.unionByName(words.join(inner.select(F.col("fp").alias("b")).hint("merge"), "b").select(F.col("fp").alias("a"), "b"))


def near_duplicates(docs: DataFrame, *, most: int = 2, shingle: int = 3, seed: int = 42, code: tuple[Block, ...] = CODE, crowd: int = 4096) -> DataFrame:
    """Fingerprints of whole texts and their components under links of at most ``most`` differing bits.

    Input columns: doc_id, text; others are ignored. Result, a row for each input row: doc_id,
    fingerprint (16 hex digits), component_id (smallest doc_id reachable, a document of its own if
    none). Null texts and texts without words have fingerprint zero, which links like any other;
    texts of fewer words than a shingle are one shingle; long texts are hashed whole. Rows with
    equal fingerprints are linked. Null ids come back and name a component only where it has no
    other. No rows give no rows.
    """
    own = stage(fingerprints(docs, shingle=shingle, seed=seed), "fingerprints")
    fps = stage(own.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    parts = components(links(fps, most=most, code=code, crowd=crowd))
    placed = stage(fps.join(parts, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("component", "fp").alias("component")), "placed")
    least = placed.groupBy("component").agg(F.min("first").alias("component_id"))
    named = stage(placed.join(least, "component").select("fp", "component_id"), "named")
    return own.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
