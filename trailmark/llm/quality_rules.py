"""Operator 5, quality rules: base rules and a hashed n-gram log-likelihood ratio, in DataFrame operations only.

Word 1-grams and 2-grams are hashed into a fixed number of buckets. One multinomial is counted
over all documents, another over trusted ones; a document's score is the mean over its n-grams of
the logarithm of their ratio, in millionths and added up as integers, so that the verdict of every
document is the same in each run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import stage

SPACES = r"[\x20\x09-\x0D]+"
WINDOW = 5
#: N-grams of a bucket that count as seen in the expected share.
PRIOR = 4.0


def pairs_of(items: str) -> tuple[Column, Column]:
    """An array without its last item, and without its first."""
    return F.slice(items, 1, F.greatest(F.size(items) - 1, F.lit(0))), F.slice(items, 2, F.greatest(F.size(items), F.lit(1)))


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, row (the whole input row), the counts of the base rules, and ``hashes`` of the words."""
    text = F.coalesce("text", F.lit(""))
    out = docs.select(F.col("doc_id").cast("long"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), text.alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda x: F.length(F.trim(F.translate(x, "\t\x0b\x0c\r", "    "))) > 0)
    out = out.select(
        "doc_id", "row",
        F.transform(F.array_remove(F.split("text", SPACES), ""), lambda w: F.xxhash64(w)).alias("hashes"),
        F.length(F.regexp_replace("text", SPACES, "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        lines.alias("lines"),
    ).withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long")).drop("lines")
    return with_repeats(out.withColumn("n_words", F.size("hashes").cast("long")))


def with_repeats(df: DataFrame) -> DataFrame:
    """``n_repeat_words``: words inside 5-word windows that the document has twice or more."""
    kept = df.columns
    at = F.sequence(F.lit(0), F.size("hashes") - WINDOW)
    window = F.transform(at, lambda i: F.xxhash64(*(F.get("hashes", i + k) for k in range(WINDOW))))
    df = df.withColumn("windows", F.when(F.size("hashes") > WINDOW, window).otherwise(F.array().cast("array<long>")))
    # only a document with a repeated window needs its places: neighbours in the order of (window, place)
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    df = df.withColumn("placed", F.when(repeats, F.sort_array(F.transform("windows", lambda w, i: F.struct(w.alias("window"), i.alias("at"))))))
    couples = F.filter(F.zip_with(*pairs_of("placed"), lambda a, b: F.struct(a.alias("a"), b.alias("b"))), lambda p: p["a"]["window"] == p["b"]["window"])
    df = df.withColumn("places", F.when(F.col("placed").isNotNull(), F.sort_array(F.array_distinct(F.flatten(F.transform(couples, lambda p: F.array(p["a"]["at"], p["b"]["at"])))))))
    steps = F.zip_with(*pairs_of("places"), lambda a, b: F.least(b - a, F.lit(WINDOW)))
    covered = F.aggregate(steps, F.lit(WINDOW).cast("long"), lambda total, x: total + x)
    return df.select(*kept, F.coalesce(F.when(F.col("places").isNotNull(), covered), F.lit(0)).cast("long").alias("n_repeat_words"))


def grams(hashes: str, buckets: int) -> Column:
    """The buckets of the words and of the pairs of words next to each other."""
    first, second = pairs_of(hashes)
    return F.transform(F.concat(F.col(hashes), F.zip_with(first, second, lambda a, b: F.xxhash64(a, b))), lambda g: F.pmod(g, F.lit(buckets)).cast("int"))


def trusted_ids(labels: DataFrame, most: int) -> DataFrame:
    """Ids of at most ``most`` documents labelled good, the same in each run."""
    good = labels.where("quality = 1").select(F.col("doc_id").cast("long")).distinct()
    return good.orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(most).select("doc_id", F.lit(1).alias("trusted"))


def bucket_ratios(docs: DataFrame, trusted: DataFrame, buckets: int) -> DataFrame:
    """``bucket`` and ``ratio``: millionths of ln(p(bucket | trusted) / p(bucket | all)).

    Both sides are counts on the scale of the trusted documents, with ``PRIOR`` added to each, so
    that a bucket of few n-grams has a ratio near 1 in a small corpus as in a large one.
    """
    words = docs.select(F.col("doc_id").cast("long"), F.transform(F.array_remove(F.split(F.coalesce("text", F.lit("")), SPACES), ""), lambda w: F.xxhash64(w)).alias("hashes"))
    flagged = words.join(F.broadcast(trusted), "doc_id", "left")
    each = flagged.select("trusted", F.explode(grams("hashes", buckets)).alias("bucket"))
    counts = stage(each.groupBy("bucket").agg(F.count("*").alias("everywhere"), F.count("trusted").alias("trusted")), "buckets")
    total = counts.agg(F.sum("everywhere").alias("everywhere"), F.sum("trusted").alias("trusted")).first()
    if not total["trusted"]:
        return counts.select("bucket", F.lit(0).cast("long").alias("ratio"))
    expected = F.col("everywhere") * F.lit(total["trusted"] / total["everywhere"])
    return counts.select("bucket", F.round(F.log((F.col("trusted") + PRIOR) / (expected + PRIOR)) * 1_000_000).cast("long").alias("ratio"))


def ratio_table(ratios: DataFrame, buckets: int) -> Column:
    """The ratios as one constant array by bucket (``buckets`` numbers, whatever the corpus), 0 for a bucket that never occurs."""
    values = [0] * buckets
    for r in ratios.collect():  # one row a bucket
        values[r["bucket"]] = r["ratio"]
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def judge(docs: DataFrame, labels: DataFrame, *, threshold: float = -0.15, buckets: int = 1 << 16, most_trusted: int = 20_000) -> DataFrame:
    """Base rules and the verdict of every document.

    Input columns: doc_id, text, and labels' doc_id, quality. The trusted multinomial is fitted on
    at most ``most_trusted`` documents labelled good (by the order of md5(doc_id)); the other one
    covers all documents. Result, a row for each input row: doc_id, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed (under 10 words, or over a fifth of them in repeated
    windows), score (mean ratio; 0 without words), kept (score >= threshold, and not base_failed),
    and row, the whole input row with whatever columns it has. Null text counts as empty. With no
    trusted document every score is 0. Repeated rows are judged each for itself. Texts of
    any length are judged whole, as one row. No rows give no rows.

    Documents are scored where they are read: no row is shuffled. Verdicts come out of a generator,
    so that a filter on them isn't pushed down into the expressions that they come from.
    """
    table = ratio_table(bucket_ratios(docs, trusted_ids(labels, most_trusted), buckets), buckets)
    facts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    each = measures(docs).withColumn("grams", grams("hashes", buckets))
    total = F.aggregate("grams", F.lit(0).cast("long"), lambda sum_, g: sum_ + F.get(table, g))
    score = F.when(F.size("grams") > 0, total / F.size("grams") / 1_000_000).otherwise(F.lit(0.0))
    out = each.select("doc_id", "row", F.inline(F.array(F.struct(*facts, score.alias("score")))))
    out = out.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
    return out.select("doc_id", *facts, "base_failed", "score", (~F.col("base_failed") & (F.col("score") >= threshold)).alias("kept"), "row")
