import math
import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trailmark.llm.quality_rules import judge, measures, trusted_ids


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


@settings(max_examples=15, deadline=None)
@given(texts=st.lists(st.one_of(st.none(), st.text(st.sampled_from("ab \n\t#é"), max_size=80), st.lists(st.sampled_from("a b c".split()), max_size=40).map(" ".join)), min_size=1, max_size=20))
def test_base_counts(spark, texts):
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, n_words string")
    for r in measures(docs).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base(texts[r.doc_id])


def brute(spark, rows, good, buckets, threshold):
    hashed = {}
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", t or "") for i, t in rows}
    every = sorted({w for ws in words.values() for w in ws})
    for r in spark.createDataFrame([(w,) for w in every], "w string").select("w", F.xxhash64("w").alias("h")).collect():
        hashed[r.w] = r.h
    pairs = sorted({(hashed[a], hashed[b]) for ws in words.values() for a, b in zip(ws, ws[1:], strict=False)})
    of = {(r.a, r.b): r.h for r in spark.createDataFrame(pairs, "a long, b long").select("a", "b", F.xxhash64("a", "b").alias("h")).collect()}
    grams = {i: [hashed[w] % buckets for w in ws] + [of[hashed[a], hashed[b]] % buckets for a, b in zip(ws, ws[1:], strict=False)] for i, ws in words.items()}
    raw = Counter(g for gs in grams.values() for g in gs)
    target = Counter(g for i, gs in grams.items() if i in good for g in gs)
    ratio = {g: round(math.log((target[g] + 4.0) / (raw[g] * (sum(target.values()) / sum(raw.values())) + 4.0)) * 1e6) for g in raw}
    out = {}
    for i, t in rows:
        n, *_, repeats = base(t)
        score = sum(ratio[g] for g in grams[i]) / len(grams[i]) / 1e6 if grams[i] else 0.0
        failed = n < 10 or 100 * repeats > 20 * n
        out[i] = (failed, round(score, 9), not failed and score >= threshold)
    return out


def test_verdicts_equal_brute_force(spark):
    rows = [(i, " ".join(f"w{(i * 7 + k * k) % 23}{'&&' if i % 5 == 0 else ''}" for k in range(i % 40))) for i in range(120)] + [(500, None), (501, ""), (502, "x " * 50)]
    labels = [(i, 0 if i % 5 == 0 else 1, 0) for i in range(0, 120, 2)] + [(7, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    good = {i for i, q, _ in labels if q == 1}
    got = {r.doc_id: (r.base_failed, round(r.score, 9), r.kept) for r in judge(docs, table, buckets=1 << 10, threshold=-0.1).collect()}
    want = brute(spark, rows, good, 1 << 10, -0.1)
    assert got == want
    assert {k for *_, k in want.values()} == {True, False}


def test_no_trust_no_rows_and_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h i j k"), (1, "a b c d e f g h i j k"), (None, "z")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = judge(docs, none).collect()
    assert len(got) == 3 and all(r.score == 0 for r in got) and [r.kept for r in got].count(True) == 2
    assert judge(docs.limit(0), none).count() == 0
    many = spark.range(50).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    assert trusted_ids(many, 7).count() == 7
