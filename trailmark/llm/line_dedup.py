"""Operator 6, line dedup by content-defined chunks, in DataFrame operations only.

A rolling hash over the hashes of the last two lines chooses the chunk borders of a document, so a
run of lines gets the same borders wherever it stands. Chunks of several lines that occur again
anywhere are removed, but for the first one; that they are equal is settled by their bytes
(:func:`trailmark.llm.exact_dedup.named`), not by a hash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .exact_dedup import named
from .shared import stage


def chunked(docs: DataFrame, divisor: int) -> DataFrame:
    """doc_id, text_hash, n_lines and ``chunks``: array of (n, body) with its number of lines."""
    text = F.coalesce("text", F.lit(""))
    out = docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("text_hash"), F.split(text, "\n").alias("lines"))
    out = out.withColumn("hashes", F.transform("lines", lambda x: F.conv(F.substring(F.md5(x), 1, 8), 16, 10).cast("long")))
    before = F.concat(F.array(F.lit(0).cast("long")), F.slice("hashes", 1, F.size("hashes") - 1))
    rolled = F.zip_with("hashes", before, lambda own, last: F.pmod(own + 31 * last, F.lit(divisor)) == 0)
    out = out.withColumn("borders", F.transform(rolled, lambda border, i: border & (i < F.size("hashes") - 1)))
    # every line gets a first letter, so that two line ends in a row are a border and nothing else
    marked = F.array_join(F.zip_with("lines", "borders", lambda x, border: F.concat(F.lit("+"), x, F.when(border, "\n").otherwise(""))), "\n")
    bodies = F.transform(F.split(marked, "\n\n"), lambda c: F.replace(F.substr(c, F.lit(2)), F.lit("\n+"), F.lit("\n")))
    chunks = F.transform(bodies, lambda c: F.struct((F.length(c) - F.length(F.replace(c, F.lit("\n"), F.lit(""))) + 1).alias("n"), c.alias("body")))
    return out.select("doc_id", "text_hash", F.size("lines").cast("long").alias("n_lines"), chunks.alias("chunks"))


def repeated_chunks(docs: DataFrame, divisor: int = 3) -> DataFrame:
    """doc_id, text_hash and ``gone``: the places of the document's chunks that came earlier, here or elsewhere."""
    each = chunked(docs, divisor).select("doc_id", "text_hash", F.posexplode("chunks").alias("at", "chunk"))
    several = each.where("chunk.n > 1").select("doc_id", "text_hash", "at", F.col("chunk.body").alias("body"))
    names = stage(named(stage(several, "bodies"), ["body"]), "chunks")  # naming reads the chunks twice
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash", "at")
    groups = names.groupBy("hash", "tie").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1").drop("n")
    again = names.join(stage(groups, "groups"), ["hash", "tie"]).where(place != F.col("first"))
    return again.groupBy("doc_id", "text_hash").agg(F.collect_set("at").alias("gone"))


def without_repeats(docs: DataFrame, *, divisor: int = 3) -> DataFrame:
    """Remove multi-line chunks that occurred before.

    Input columns: doc_id, text; others are ignored. Lines end at ``\\n``; a border follows a line
    where the rolling hash is divisible by ``divisor``. Of equal chunks of two lines or more, the
    one of the smallest doc_id, then of the first place in it stays (a null doc_id comes last).
    Result, a row for each input row: doc_id, n_lines, n_chunks, removed_chunks, removed_lines,
    text. A null text counts as empty, which is one empty line. Rows that agree in doc_id and text
    count as one and come out alike; of texts that share a doc_id, the order is that of their
    hashes. No rows give no rows.
    """
    gone = repeated_chunks(docs, divisor).select(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash"), "gone")
    parts = chunked(docs, divisor)
    parts = parts.join(gone, parts["doc_id"].eqNullSafe(gone["gone_id"]) & (parts["text_hash"] == gone["gone_hash"]), "left")
    kept = F.array_except(F.sequence(F.lit(0), F.size("chunks") - 1), F.coalesce("gone", F.array().cast("array<int>")))
    parts = parts.withColumn("kept", F.transform(kept, lambda i: F.get("chunks", i)))
    left = F.aggregate("kept", F.lit(0).cast("long"), lambda total, c: total + c["n"])
    return parts.select(
        "doc_id", "n_lines", F.size("chunks").cast("long").alias("n_chunks"),
        (F.size("chunks") - F.size("kept")).cast("long").alias("removed_chunks"), (F.col("n_lines") - left).alias("removed_lines"),
        F.array_join(F.transform("kept", lambda c: c["body"]), "\n").alias("text"),
    )
