"""Very long texts and empty tables, through operators and through each stage of the pipeline."""

import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from trailmark.llm.exact_dedup import duplicate_groups
from trailmark.llm.mixing import mix
from trailmark.llm.ngram_join import near_duplicates
from trailmark.llm.packing import pack
from trailmark.llm.periodic_runs import periodic_runs
from trailmark.llm.quality_rules import judge
from trailmark.llm.simhash import fingerprint, near_duplicates as simhash_components

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i * 7919 % 9973}" for i in range(200_000))  # 1.2 million characters
ROWS = [(1, LONG), (2, LONG.replace(" ", "\n")), (3, LONG + " more"), (4, "a short text of ten words or a few more of them"), (5, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in ROWS], COLUMNS)


def test_long_texts_are_judged_whole(spark, docs):
    got = {r.doc_id: r for r in judge(docs, spark.createDataFrame([(4, 1)], "doc_id long, quality int")).select("doc_id", "n_words", "word_chars", "n_repeat_words", "kept").collect()}
    assert got[1].n_words == 200_000 and got[3].n_words == 200_001 and got[1].word_chars == len(LONG) - 199_999
    assert got[1].n_repeat_words == 200_000 and not got[1].kept  # the words come again and again


def test_long_texts_have_one_identity(docs):
    got = {r.doc_id: r for r in duplicate_groups(docs).collect()}
    assert [(got[i].keep_id, got[i].group_size) for i in range(1, 6)] == [(1, 2), (1, 2), (3, 1), (4, 1), (5, 1)]
    assert got[1].text_sha256 == hashlib.sha256(LONG.replace(" ", "").encode()).hexdigest()


def test_long_texts_are_mixed_linked_and_fingerprinted(docs):
    sizes = {r.doc_id: (r.size, r.taken) for r in mix(docs).collect()}
    assert sizes[1][0] == 200_000 and sum(t for _, t in sizes.values()) == sum(n for n, _ in sizes.values())
    assert {r.doc_id: r.component_id for r in near_duplicates(docs).collect()} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5}
    got = {r.doc_id: r for r in simhash_components(docs).collect()}
    assert got[1].fingerprint == f"{fingerprint(LONG):016x}" and got[1].component_id == got[2].component_id == 1


def test_long_periods_are_found(docs):
    runs = {r.doc_id: [tuple(x) for x in r.runs] for r in periodic_runs(docs.where("doc_id IN (1, 4)")).collect()}
    assert runs == {1: [(0, 200_000, 9973)], 4: []}


def test_a_long_text_is_packed_in_pieces(docs):
    pieces = pack(docs.where("doc_id = 1")).orderBy("piece").collect()
    assert [r.start for r in pieces] == [4096 * i for i in range(len(pieces))] and all(r.length == 4096 for r in pieces[:-1])


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_empty_tables_and_long_texts(spark, docs, tmp_path, name):
    step = dict(corpus_pipeline.STAGES)[name]
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert step(spark, docs.limit(0), str(tmp_path)).count() == 0
    docs.limit(0).write.parquet(f"{tmp_path}/none.parquet")
    assert step(spark, spark.read.parquet(f"{tmp_path}/none.parquet"), str(tmp_path)).count() == 0
    long = spark.createDataFrame([(i, " ".join(f"d{i}w{k}" for k in range(20_000)), "en", "s", 1) for i in (1, 2)], COLUMNS)
    long.write.parquet(f"{tmp_path}/long.parquet")
    out = step(spark, spark.read.parquet(f"{tmp_path}/long.parquet"), str(tmp_path))
    if name == corpus_pipeline.STAGES[-1][0]:
        assert {r.doc_id for r in out.collect()} == {1, 2}
    else:
        assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"] and {(r.doc_id, r.n) for r in out.select("doc_id", F.length("text").alias("n")).collect()} == {(r.doc_id, r.n) for r in long.select("doc_id", F.length("text").alias("n")).collect()}
