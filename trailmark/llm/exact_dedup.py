"""Operator 7, exact dedup by deterministic block naming, in DataFrame operations only.

A text without white space falls into blocks of a fixed number of characters. Every distinct
block gets an integer name, then every distinct pair of adjacent names, again and again, until
one name stands for the whole document. A name is a pair of integers: a 64-bit hash, and the
rank of the content in the sort of all contents with that hash (0 unless hashes collide). So
equal names mean equal contents, level by level, with no appeal to luck; and rows need not meet
their content again to learn a name: only those whose hash has several contents do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import row_number, stage

SPACES = r"[\x20\x09-\x0D]+"


def normalised(text: str) -> Column:
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), SPACES, "")


def hash_of(content: list[str]) -> Column:
    return F.xxhash64(*content)


def named(parts: DataFrame, content: list[str]) -> DataFrame:
    """Replace the columns ``content`` by ``hash`` and ``tie``, which are equal only for equal contents."""
    hashed = parts.withColumn("hash", hash_of(content))
    distinct = hashed.groupBy("hash", *content).agg(F.count("*").alias("n"))
    clashing = distinct.groupBy("hash").agg(F.count("*").alias("kinds")).where("kinds > 1").select("hash")
    if clashing.isEmpty():
        return hashed.drop(*content).withColumn("tie", F.lit(0))
    ranks = distinct.join(clashing, "hash", "left_semi").withColumn("tie", F.row_number().over(Window.partitionBy("hash").orderBy(*content)) - 1)
    ranks = ranks.where("tie > 0").select(F.col("hash").alias("clash"), F.col("tie"), *(F.col(c).alias(f"clash_{c}") for c in content))
    same = F.col("hash") == F.col("clash")
    for c in content:
        same &= F.col(c).eqNullSafe(F.col(f"clash_{c}"))
    kept = [c for c in hashed.columns if c not in content]
    return hashed.join(ranks, same, "left").select(*kept, F.coalesce("tie", F.lit(0)).alias("tie"))


def identities(texts: DataFrame, *, block_chars: int) -> DataFrame:
    """``n_blocks``, ``hash`` and ``tie`` of each row's ``body``, equal exactly where the bodies are; other columns stay."""
    facts = [c for c in texts.columns if c not in ("row", "body")]
    parts = texts.withColumn("parts", F.regexp_extract_all("body", F.lit(f"(?s).{{1,{block_chars}}}"), F.lit(0))).drop("body")
    blocks = parts.select("row", *facts, F.posexplode_outer("parts").alias("at", "block"))
    blocks = blocks.select("row", F.coalesce("at", F.lit(0)).alias("at"), F.coalesce("block", F.lit("")).alias("block"), *(F.when(F.coalesce("at", F.lit(0)) == 0, F.col(c)).alias(c) for c in facts))
    names = stage(named(blocks, ["block"]), "names")
    first = names.where("at = 0").select("row", *facts)
    counts = names.groupBy("row").agg(F.count("*").alias("n_blocks"))
    most = counts.agg(F.max("n_blocks")).first()[0] or 1
    names = names.join(counts, "row")
    done = [names.where("n_blocks = 1").select("row", "n_blocks", "hash", "tie")]
    level = names.where("n_blocks > 1").select("row", "n_blocks", "at", "hash", "tie")
    width = 1
    while width < most:
        width *= 2
        side = lambda bit: F.max(F.when(F.col("at") % 2 == bit, F.struct("hash", "tie")))
        pairs = level.groupBy("row", "n_blocks", F.floor(F.col("at") / 2).alias("at")).agg(side(0).alias("left"), side(1).alias("right"))
        pairs = pairs.select("row", "n_blocks", "at", *(F.col(f"{s}.{c}").alias(f"{s}_{c}") for s in ("left", "right") for c in ("hash", "tie")))
        level = stage(named(pairs, ["left_hash", "left_tie", "right_hash", "right_tie"]), "names")
        done.append(level.where(f"n_blocks <= {width}").select("row", "n_blocks", "hash", "tie"))
        level = level.where(f"n_blocks > {width}")
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.join(first, "row")


def duplicate_groups(docs: DataFrame, *, block_chars: int = 4096, row: str | None = None) -> DataFrame:
    """The group of equal texts of every row, and which row of it stays.

    Texts are equal when they are without the characters ``[\\x20\\x09-\\x0D]``; null counts as empty.
    Of equal texts the one with most code points stays, then the smallest doc_id. Result, a row for
    each input row: doc_id, keep_id, group_size, kept, text_sha256 (of the text without white space).
    Of rows that agree in doc_id and text one is kept. Null ids come last. A long text is as many
    blocks as it needs, which are rows. No rows give no rows.
    ``row``: the column that numbers the rows, returned as row.
    """
    texts = docs.select(
        row_number(row).alias("row"), F.col("doc_id").cast("long"), F.coalesce(F.length("text"), F.lit(0)).alias("chars"), normalised("text").alias("body")
    ).withColumn("text_sha256", F.sha2("body", 256))
    keyed = stage(identities(texts, block_chars=block_chars), "keyed")
    identity = ["n_blocks", "hash", "tie"]
    best = F.max(F.struct("chars", (-F.col("doc_id")).alias("order"), (-F.col("row")).alias("row")))
    groups = stage(keyed.groupBy(*identity).agg(F.count("*").alias("group_size"), best.alias("best")), "groups")
    groups = groups.select(*identity, "group_size", (-F.col("best.order")).alias("keep_id"), (-F.col("best.row")).alias("keep_row"))
    return keyed.join(groups, identity).select("doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "text_sha256", "row")
