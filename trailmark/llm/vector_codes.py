"""Operator 13, vector code compression: product quantisation in whole numbers.

Components become integers, vectors are cut into equal parts, and each part position learns a
codebook by Lloyd's rounds. The kept vectors lie in a table of columnar blocks (one row a block,
a block's bytes being its components one dimension behind the other), which every round reads as
an RDD of NumPy arrays: distances accumulate dimension by dimension, ``np.add.at`` gathers int64
sums and counts, and ``treeAggregate`` merges these tensors, whose size is that of the codebooks.
All numbers are integers, so the order of merging leaves no trace in the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructType

from .shared import stage

#: Components of one block at most (but one vector at least): 1 MB of int32.
BLOCK = 1 << 18
#: Integer components lie below this, so that squared distances and sums of 2**36 rows stay in int64.
REACH = 1 << 27
#: Labels that a table of error sums may have to be broadcast.
MOST_BROADCAST = 100_000


def whole(vectors: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)`` as int32."""
    x = np.floor(vectors.astype(np.float64) * scale)
    if x.size and np.abs(x).max() >= REACH:
        raise ValueError(f"components must lie within {REACH / scale:g} of 0")
    return x.astype(np.int32)


def squared_distances(part: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distances of the columns of ``part`` (dimension, row) to the entries of ``book`` (entry, dimension): (entry, row)."""
    out = np.zeros((book.shape[0], part.shape[1]), np.int64)
    for d in range(part.shape[0]):
        gap = part[d].astype(np.int64)[None, :] - book[:, d, None]
        out += gap * gap
    return out


def nearest(block: np.ndarray, books: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each part of a block (dimension, row): its columns, the nearest entries (ties: the lower) and the squared distances."""
    parts, _, width = books.shape
    for p in range(parts):
        part = block[p * width : (p + 1) * width]
        distances = squared_distances(part, books[p])
        code = distances.argmin(0)
        yield part, code, distances[code, np.arange(code.size)]


def tally(block: np.ndarray, books: np.ndarray) -> np.ndarray:
    """Sums and counts of the parts at each entry: (part, entry, dimension + 1), the count last."""
    parts, entries, width = books.shape
    out = np.zeros((parts, entries, width + 1), np.int64)
    for p, (part, code, _) in enumerate(nearest(block, books)):
        for d in range(width):
            np.add.at(out[p, :, d], code, part[d])
        np.add.at(out[p, :, width], code, 1)
    return out


def moved(books: np.ndarray, tensor: np.ndarray) -> np.ndarray:
    """Each entry at the floor of its parts' mean; unused ones where they were."""
    counts = tensor[:, :, -1:]
    return np.where(counts > 0, tensor[:, :, :-1] // np.maximum(counts, 1), books)


def blocks_of(vectors: DataFrame, scale: int) -> DataFrame:
    """The vectors as a written table of blocks: lists of ids and labels, the number of components, and the bytes."""
    schema = StructType().add("ids", ArrayType(LongType())).add("labels", ArrayType(vectors.schema["label"].dataType)).add("dims", IntegerType()).add("data", BinaryType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(2)
            lengths = np.diff(column.offsets.to_numpy())
            if not lengths.size:
                continue
            dims = int(lengths[0])
            if (lengths != dims).any():
                raise ValueError("vectors of one table must have one length")
            values = whole(column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims) if dims else np.zeros((lengths.size, 0)), scale)
            step = max(1, BLOCK // max(dims, 1))
            for low in range(0, lengths.size, step):
                ids, labels = (batch.column(k).slice(low, step) for k in (0, 1))
                bounds = pa.array([0, len(ids)], pa.int32())
                data = np.ascontiguousarray(values[low : low + step].T).tobytes()
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(bounds, ids), pa.ListArray.from_arrays(bounds, labels), pa.array([dims], pa.int32()), pa.array([data], pa.binary())], names=["ids", "labels", "dims", "data"])

    return stage(vectors.select("vec_id", "label", "vector").mapInArrow(run, schema), "blocks")


def columns_of(row: tuple) -> np.ndarray:
    """A row (dims, number of rows, bytes) of the block table as (dimension, row)."""
    dims, rows, data = row
    return np.frombuffer(bytes(data), np.int32).reshape(dims, rows)


def coded(blocks: DataFrame, books: np.ndarray) -> DataFrame:
    """vec_id, label, code and error of each vector of the block table."""
    label = blocks.schema["labels"].dataType.elementType
    schema = StructType().add("vec_id", LongType()).add("label", label).add("code", StringType()).add("error", LongType())
    names = np.array([f"{k:02x}" for k in range(books.shape[1])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                ids, labels = (batch.column(c).slice(k, 1).flatten() for c in (0, 1))
                code, error = np.full(len(ids), ""), np.zeros(len(ids), np.int64)
                for _, own, distance in nearest(columns_of((batch.column(2)[k].as_py(), len(ids), batch.column(3)[k].as_py())), books):
                    code = np.char.add(code, names[own])
                    error += distance
                yield pa.RecordBatch.from_arrays([ids, labels, pa.array(code.tolist(), pa.string()), pa.array(error)], names=["vec_id", "label", "code", "error"])

    return blocks.select("ids", "labels", "dims", "data").mapInArrow(run, schema)


def first_vectors(kept: DataFrame, entries: int) -> list[list[float]]:
    """The vectors of the ``entries`` smallest ids, in their order; of rows that share an id the smallest."""
    ids = [r.vec_id for r in kept.select("vec_id").distinct().orderBy(F.col("vec_id").asc_nulls_last()).limit(entries).collect()]
    named = kept.where(F.col("vec_id").isin([i for i in ids if i is not None]) | (F.col("vec_id").isNull() if None in ids else F.lit(False)))
    found = {r.vec_id: r.vector for r in named.groupBy("vec_id").agg(F.min("vector").alias("vector")).collect()}
    return [found[i] for i in ids]


def learn(blocks: DataFrame, books: np.ndarray, rounds: int) -> np.ndarray:
    """The codebooks after ``rounds`` of assigning all parts and moving the entries; each is one pass over the blocks."""
    context = blocks.sparkSession.sparkContext
    arrays = blocks.select("dims", F.size("ids").alias("rows"), "data").rdd.map(columns_of)
    for _ in range(rounds):
        sent = context.broadcast(books)  # parts x entries x width numbers, whatever the number of vectors
        tensor = arrays.treeAggregate(None, lambda have, block, sent=sent: merged(have, tally(block, sent.value)), merged)
        books = moved(books, tensor)
        sent.unpersist()
    return books


def merged(a: np.ndarray | None, b: np.ndarray | None) -> np.ndarray | None:
    if a is None or b is None:
        return b if a is None else a
    a += b
    return a


def compress(vectors: DataFrame, *, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> tuple[DataFrame, np.ndarray]:
    """Codes of all vectors, and the codebooks (part, entry, position within the part).

    Input columns: vec_id, embedding, label; others are ignored. Rows whose embedding is null or
    holds null or non-finite components are dropped. Result: vec_id, label, code (two hex digits a
    part), error (squared distances summed over parts), label_error (errors summed over the rows
    that share the label; null is a label). Codebooks start with the vectors of the ``entries``
    smallest vec_ids (fewer if there are fewer; of rows that share an id the smallest vector, a
    null id last). Equal rows each come back. No rows give no rows and empty codebooks. Vectors of
    different lengths, a length that ``parts`` doesn't divide, and components whose integers
    leave 27 bits raise ValueError.
    """
    if not 0 < entries <= 256:
        raise ValueError("an entry's number must fit two hex digits")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = vectors.select(F.col("vec_id").cast("long"), "label", F.col("embedding").alias("vector")).where(F.col("vector").isNotNull() & finite)
    blocks = blocks_of(kept, scale)
    first = first_vectors(kept, entries)
    books = whole(np.array(first, np.float64), scale) if len({len(v) for v in first}) == 1 else np.zeros((0, 0), np.int32)
    if not books.size and any(first):
        raise ValueError("vectors of one table must have one length")
    if books.shape[-1] % parts:
        raise ValueError(f"{books.shape[-1]} components can't be cut into {parts} equal parts")
    books = books.astype(np.int64).reshape(books.shape[0], parts, books.shape[-1] // parts).transpose(1, 0, 2)
    if first:
        if blocks.where(F.col("dims") != books.shape[0] * books.shape[2]).limit(1).count():
            raise ValueError("vectors of one table must have one length")
        books = learn(blocks, books, rounds)
    out = stage(coded(blocks, books), "codes")
    sums = stage(out.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "errors")
    if sums.count() <= MOST_BROADCAST:
        sums = F.broadcast(sums)
    return out.join(sums, F.col("label").eqNullSafe(F.col("of"))).select("vec_id", "label", "code", "error", "label_error"), books


def digest(books: np.ndarray) -> str:
    """Hex SHA-256 of all components in decimal, by part, entry and position, behind commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
