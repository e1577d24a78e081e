"""The pipeline against brute force, stage by stage, on a small corpus."""

import random
import re
from collections import Counter

import pytest
from test_exact_dedup import brute as brute_exact
from test_ngram_join import brute as brute_near
from test_quality_rules import brute as brute_quality
from tokenizers import Tokenizer

import corpus_pipeline
from trailmark.llm.mixing import mix, targets
from trailmark.llm.shared import tokenizer_path


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    rng = random.Random(11)
    word = lambda: rng.choice(["the", "of", "and"]) if rng.random() < 0.3 else f"w{rng.randrange(500)}"
    rows = []
    for i in range(90):
        kind = rng.random()
        if rows and kind < 0.2:
            text = rng.choice(rows)[1]
            text = text.replace(" ", "\n") if text and rng.random() < 0.5 else text
        elif rows and kind < 0.4:
            words = (rng.choice(rows)[1] or "").split()
            for _ in range(len(words) // 60):
                words[rng.randrange(len(words))] = word()
            text = " ".join(words)
        elif kind < 0.5:
            text = " ".join(f"{word().upper()}&&&" for _ in range(60))
        else:
            text = " ".join(word() for _ in range(rng.choice([4, 30, 120, 300])))
        rows.append((i, text, "en", rng.choice(["a", "b", "c", None]), len(text or "")))
    rows.append((90, None, "en", "a", 0))
    folder = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    labels = [(r[0], 0 if "&&&" in (r[1] or "") else 1, 0) for r in rows if r[0] % 2 == 0]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder), rows, {i for i, q, _ in labels if q == 1}


def test_stages_equal_brute_force(spark, sf_dir):
    folder, rows, good = sf_dir
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = [(r[0], r[1]) for r in rows]
    source = {r[0]: r[3] for r in rows}

    steps = dict(corpus_pipeline.STAGES)
    out = {}
    for name in list(steps)[:-1]:
        docs = corpus_pipeline.stage(steps[name](spark, docs, folder), "test")
        assert docs.columns == columns
        out[name] = sorted((r.doc_id, r.text) for r in docs.collect())

    verdict = brute_quality(spark, kept, good, 1 << 16, -0.15)
    kept = [r for r in kept if verdict[r[0]][2]]
    assert out["quality rules"] == kept and len(kept) < 91
    groups = brute_exact(kept)
    kept = [r for r in kept if groups[re.sub(r"[\x20\x09-\x0D]", "", r[1])][0] == r[0]]
    assert out["exact dedup"] == kept
    near = brute_near(kept)
    kept = [r for r in kept if near[r[0]][1] == r[0]]
    assert out["n-gram Jaccard join"] == kept and len(kept) < len(out["exact dedup"])

    size = {i: len(t.split()) for i, t in kept}
    totals = Counter()
    for i, n in size.items():
        totals[source[i]] += n
    order = sorted(totals, key=lambda s: (s is None, s or ""))
    goal = targets([(s or "null", totals[s]) for s in order], (5, 2, 1), 3)
    times = Counter(i for i, _ in out["mixing sources to target weights"])
    for s in order:
        words = sum(size[i] * n for i, n in times.items() if source[i] == s)
        assert abs(words - goal[s or "null"]) <= max(size[i] for i in size if source[i] == s)
    assert max(times.values()) <= 3 and set(times) <= set(size)

    pieces = corpus_pipeline.run(spark, folder).collect()
    tokenizer = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    length = {i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in kept}
    assert Counter((r.doc_id, r.length) for r in pieces) == Counter({(i, length[i]): n for i, n in times.items()})
    assert len({r.sequence_id for r in pieces}) == -(-sum(r.length for r in pieces) // 4096)
    assert mix(docs.limit(0)).count() == 0


def test_repeated_rows_and_null_ids(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    text = lambda c: " ".join(f"{c}{i}" for i in range(60))
    a, b, c = text("a"), text("b"), text("c")
    rows = [(1, a), (1, a), (2, b), (2, "too short"), (None, c), (None, c), (None, "short"), (3, f"{a} end")]
    schema = "doc_id long, text string, source string, kept_id int, taken_id int, times int, row_no int, row int"
    frame = lambda rows: spark.createDataFrame([(*r, "s", 1, 1, 1, 1, 1) for r in rows], schema)
    steps = dict(corpus_pipeline.STAGES)
    after = lambda name, rows: Counter((r.doc_id, r.text) for r in steps[name](spark, frame(rows), str(tmp_path)).collect())
    judged = [(1, a), (1, a), (2, b), (None, c), (None, c), (3, f"{a} end")]
    assert after("quality rules", rows) == Counter(judged)
    assert after("exact dedup", judged) == Counter([(1, a), (2, b), (None, c), (3, f"{a} end")])
    assert after("n-gram Jaccard join", judged) == Counter([(1, a), (2, b), (None, c)])
    assert after("mixing sources to target weights", judged) == Counter(judged)
