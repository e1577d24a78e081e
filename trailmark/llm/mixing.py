"""Operator 8, mixing sources to target weights with a low-discrepancy schedule.

Each source's documents, in a shuffled order, are one stream of words that is cut into blocks of
equal size. The schedule has a slot for each point of a van der Corput sequence. A point falls
into one source's part of the cumulative weights, here counted in blocks, so that each source
gets its number of slots exactly and spread evenly. The rank of a slot within its source names
the block: the next of the stream, again from the first when the stream is used up. The last
slot of a source stops at its target.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import stage


#: Sources up to which their totals (three columns each) are broadcast.
MOST_BROADCAST = 100_000


def word_count(text: str) -> F.Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def sizes(docs: DataFrame, row: str | None = None) -> DataFrame:
    """doc_id, source, size, row if it is named, and the shuffled order key; ``slice``, the key's first 10 bits, makes a hot source 1,024 sorts."""
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return docs.select(
        F.col("doc_id").cast("long"), F.col("source").cast("string"), word_count("text").alias("size"), key.alias("key"),
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("source_key"),
        F.shiftright(F.conv(F.substring(key, 1, 3), 16, 10).cast("int"), 2).alias("slice"),
        *([F.col(row).alias("row")] if row else []),
    )


def targets(totals: list[tuple[str, int]], weights: tuple[float, ...], most: float) -> dict[str, float]:
    """Words to take of each source: shares by weight, none above ``most`` times its size.

    ``totals`` is in the order in which ``weights`` repeat. What a full source can't take goes to
    the others by weight, until none is above.
    """
    weight = {s: float(weights[i % len(weights)]) for i, (s, _) in enumerate(totals)}
    free, left = dict(totals), float(sum(n for _, n in totals))
    full: dict[str, float] = {}
    while free:
        level = left / sum(weight[s] for s in free)
        above = [s for s, n in free.items() if level * weight[s] > most * n]
        if not above:
            return full | {s: level * weight[s] for s in free}
        for s in above:
            full[s] = most * free.pop(s)
            left -= full[s]
    return full


def points_below(index: np.ndarray, limit: np.ndarray, bits: int) -> np.ndarray:
    """How many of the points 0..index-1 have bits that, reversed, are below ``limit``."""
    total, fixed = np.zeros(index.size, np.int64), np.zeros(index.size, np.int64)
    for j in range(bits - 1, -1, -1):  # points that agree with index above bit j and have 0 there: their low j bits are free
        own = (index >> j) & 1
        step = bits - j  # the free bits are the high ones when reversed
        total += own * np.clip(-((fixed - limit) >> step), 0, 1 << j)
        fixed |= own << (step - 1)
    return total


def reversed_bits(index: np.ndarray, bits: int) -> np.ndarray:
    out = np.zeros_like(index)
    for j in range(bits):
        out |= ((index >> j) & 1) << (bits - 1 - j)
    return out


def schedule(df_of: DataFrame, plan: list[tuple[str, int, int]], block: int) -> DataFrame:
    """The slots in use: slot, source_key, epoch, block_no, upto (words of the block that count).

    ``plan``: source key, its words, the words to take of it.
    """
    spark = df_of.sparkSession
    size = np.array([n for _, n, _ in plan], np.int64)
    take = np.array([t for _, _, t in plan], np.int64)
    blocks = -(-size // block)
    need = np.where(size > 0, take // np.maximum(size, 1) * blocks + -(-(take % np.maximum(size, 1)) // block), 0)
    bounds = np.concatenate([[0], np.cumsum(need)])
    bits = max(1, int(bounds[-1] - 1).bit_length())
    keys = pa.array([s for s, _, _ in plan], pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            index = batch.column(0).to_numpy()
            value = reversed_bits(index, bits)
            index, value = index[value < bounds[-1]], value[value < bounds[-1]]
            own = np.searchsorted(bounds, value, side="right") - 1
            rank = points_below(index, bounds[own + 1], bits) - points_below(index, bounds[own], bits)
            epoch, number = rank // blocks[own], rank % blocks[own]
            upto = np.where(rank == need[own] - 1, take[own] - epoch * size[own] - number * block, block)
            yield pa.RecordBatch.from_arrays([pa.array(index), keys.take(pa.array(own)), pa.array(epoch), pa.array(number), pa.array(upto)], names=["slot", "source_key", "epoch", "block_no", "upto"])

    return spark.range(1 << bits).mapInArrow(run, "slot long, source_key string, epoch long, block_no long, upto long")


def positions(sized: DataFrame) -> DataFrame:
    """``start``: the word of its source's stream at which each document begins."""
    parts = sized.groupBy("source_key", "slice").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source_key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("source_key", "slice", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("source_key", "slice").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    return sized.withColumn("upto_here", F.sum("size").over(inside)).join(parts, ["source_key", "slice"]).withColumn("start", F.col("base") + F.col("upto_here") - F.col("size")).drop("base", "upto_here")


def mixture(docs: DataFrame, *, weights: tuple[float, ...] = (5, 2, 1), most: float = 3.0, block_words: int = 256, row: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sized documents with positions, one row of totals and target a source, and the slots that use document parts.

    Sources are mixture components with weights of their own; their totals (one row a source) pass
    through the driver. Documents, blocks and slots don't.
    """
    sized = stage(sizes(docs, row), "sizes")
    spark = docs.sparkSession
    totals = sorted((r["source_key"], r["n"]) for r in sized.groupBy("source_key").agg(F.sum("size").alias("n")).collect())
    totals = sorted(totals, key=lambda x: (x[0] == "", x[0].encode("utf-8", "surrogatepass")))  # by code point, null last
    goal = targets(totals, weights, most)
    plan = [(s, n, int(goal[s] + 0.5)) for s, n in totals]
    sources = spark.createDataFrame([(s, n, float(goal[s])) for s, n in totals], "source_key string, source_size long, target double")
    placed = positions(sized)
    spans = placed.where("size > 0").withColumn("block_no", F.explode(F.sequence(F.expr(f"start div {block_words}"), F.expr(f"(start + size - 1) div {block_words}"))))
    spans = spans.select(
        "doc_id", "source_key", "start", "block_no",
        F.greatest("start", F.col("block_no") * block_words).alias("from_word"),
        F.least(F.col("start") + F.col("size"), (F.col("block_no") + 1) * block_words).alias("to_word"),
    )
    slots = schedule(sized, plan, block_words)
    used = slots.join(spans, ["source_key", "block_no"]).withColumn("to_word", F.least("to_word", F.col("block_no") * block_words + F.col("upto"))).where("to_word > from_word")
    return placed, sources, used


def mix(docs: DataFrame, *, weights: tuple[float, ...] = (5, 2, 1), most: float = 3.0, block_words: int = 256, row: str | None = None) -> DataFrame:
    """Words that the mix takes of each document.

    Input columns: doc_id, text, source; others are ignored. Result, a row for each input row:
    doc_id, source, size, source_size, target, taken, first_slot (the first slot of the schedule in
    which words of it come; null if none do), by which the mix is in its order. Null and empty texts have size 0 and are
    never taken; a null source is a source of its own, behind all others. Rows that repeat a
    doc_id are taken each for itself. Long texts count whole and come
    in as many blocks as they have. No rows give no rows. ``row``: the column that numbers the rows, returned as row.
    """
    placed, sources, used = mixture(docs, weights=weights, most=most, block_words=block_words, row=row)
    taken = used.groupBy("source_key", "start").agg(F.sum(F.col("to_word") - F.col("from_word")).alias("taken"), F.min("slot").alias("first_slot"))
    placed = placed.withColumn("start", F.when(F.col("size") > 0, F.col("start")))  # an empty document begins where the next one does
    if sources.count() <= MOST_BROADCAST:
        sources = F.broadcast(sources)
    return placed.join(taken, ["source_key", "start"], "left").join(sources, "source_key").select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"), "first_slot", *(["row"] if row else []))
