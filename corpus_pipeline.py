"""The corpus pipeline: stages over documents, each one an operator of ``trailmark.llm``.

Every stage works on all rows that the one before kept and returns the columns of ``documents``
(but the last, which returns packed pieces). :func:`run` applies them one behind the other; a
caller that writes each stage's result and reads it again gets the same rows. Verdicts are of rows:
rows that share a doc_id, or have none, are judged each for itself. Null and empty texts have no
words: the first stage rejects them. Columns that aren't those of ``documents`` are dropped by the
first stage. Empty tables give empty tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark.llm.exact_dedup import duplicate_groups
from trailmark.llm.mixing import mix
from trailmark.llm.ngram_join import near_duplicates
from trailmark.llm.packing import pack
from trailmark.llm.quality_rules import judge
from trailmark.llm.shared import stage, table


def _columns(docs: DataFrame) -> list[str]:
    return [c for c in ("doc_id", "text", "lang", "source", "n_chars") if c in docs.columns]


#: Files that a table may have for their names to be broadcast.
MOST_FILES = 200_000


def _numbered(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` and ``row_no``, which a row has however often it is read.

    Rows of files are numbered by their file and their place in it, without a copy. Other tables are
    written with a number.
    """
    columns = _columns(docs)
    relation = docs._jdf.queryExecution().analyzed().getClass().getSimpleName()
    if relation == "LogicalRelation":
        named = docs.select(*columns, F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
        files = sorted(r.file for r in named.select("file").distinct().limit(MOST_FILES + 1).collect())
        if len(files) <= MOST_FILES:
            bases = docs.sparkSession.createDataFrame([(f, i << 36) for i, f in enumerate(files)], "file string, base long")
            return named.join(F.broadcast(bases), "file").select(*columns, (F.col("base") + F.col("at")).alias("row_no"))
    return stage(docs.select(*columns, F.monotonically_increasing_id().alias("row_no")), "numbered")


def _only(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose number is a ``row`` of ``rows``; a merge join at every size."""
    kept = stage(rows.select(F.col("row").alias("row_no")), "kept")
    return docs.join(kept.hint("merge"), "row_no", "left_semi").select(*_columns(docs))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the base rules or the n-gram ratio reject go, each by its own text. No row is shuffled."""
    docs = docs.select(*_columns(docs))
    return judge(docs, table(spark, sf_dir, "labels")).where("kept").select("row.*")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays."""
    docs = _numbered(docs)
    return _only(docs, duplicate_groups(docs, row="row_no").where("kept"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of similar texts stays: that of its smallest doc_id (null behind all others)."""
    docs = _numbered(docs)
    near = near_duplicates(docs.select(F.col("row_no").alias("doc_id"), "text")).select(F.col("doc_id").alias("row_no"), "component_id")
    ids = docs.select("row_no", F.col("doc_id").cast("long").alias("id"))
    first = F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "row_no"))
    return _only(docs, near.join(ids, "row_no").groupBy("component_id").agg(first.alias("first")).select(F.col("first.row_no").alias("row")))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows come as often as the mix takes their words: ``taken / size``, rounded, and once at least if any are taken."""
    docs = _numbered(docs)
    times = F.greatest(F.lit(1), F.round(F.col("taken") / F.col("size"))).cast("int").alias("times")
    taken = stage(mix(docs, row="row_no").where("taken > 0").select(F.col("row").alias("row_no"), times), "taken")
    repeated = docs.join(taken.hint("merge"), "row_no").withColumn("copy", F.explode(F.sequence(F.lit(1), "times")))
    return repeated.select(*_columns(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces in sequences of at most 4,096 tokens. A document that comes several times is packed as often; (sequence_id, offset) is a piece's own."""
    return pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", near_dedup),
    ("mixing sources to target weights", source_mix),
    ("best-fit packing", packing),
]

#: Hashed n-gram ratios and tokenizers have no SQL; tests/llm/test_pipeline.py compares with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
