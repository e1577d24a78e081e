import hashlib
import random

from pyspark.sql import functions as F

from trailmark.llm import exact_dedup
from trailmark.llm.line_dedup import without_repeats


def chunks_of(text, divisor=3):
    lines = (text or "").split("\n")
    hashes = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in lines]
    out, own = [], []
    for i, line in enumerate(lines):
        own.append(line)
        if (hashes[i] + 31 * (hashes[i - 1] if i else 0)) % divisor == 0 or i == len(lines) - 1:
            out.append(own)
            own = []
    return out


def brute(rows):
    seen, out = set(), {}
    for i, text in sorted(rows):
        kept, gone = [], []
        for c in chunks_of(text):
            body = "\n".join(c)
            (gone if len(c) > 1 and body in seen else kept).append(c)
            seen |= {body} if len(c) > 1 else set()
        out[i] = (len((text or "").split("\n")), len(kept) + len(gone), len(gone), sum(map(len, gone)), "\n".join(x for c in kept for x in c))
    return out


def corpus(seed=4):
    rng = random.Random(seed)
    lines = [f"line {i}" for i in range(60)]
    passages = [[rng.choice(lines) for _ in range(9)] for _ in range(4)]
    rows = []
    for i in range(80):
        body = [f"own {i} {k}" for k in range(rng.randrange(5))] + (rng.choice(passages) if rng.random() < 0.6 else []) + [rng.choice(lines) for _ in range(rng.randrange(8))]
        rows.append((i, "\n".join(body * rng.choice([1, 1, 2]))))
    return rows + [(100, None), (101, ""), (102, "\n\n\n"), (103, "\n\n\n")]


def test_equals_brute_force(spark):
    rows = corpus()
    got = without_repeats(spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, lines string, n int")).collect()
    want = brute(rows)
    assert sum(w[2] for w in want.values()) > 20
    assert {r.doc_id: (r.n_lines, r.n_chunks, r.removed_chunks, r.removed_lines, r.text) for r in got} == want and len(got) == len(rows)


def test_colliding_hashes_keep_different_chunks(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "hash_of", lambda content: F.pmod(F.xxhash64(*content), F.lit(3)))
    rows = corpus(5)
    got = without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.text for r in got} == {i: w[4] for i, w in brute(rows).items()}


def test_odd_rows(spark):
    text = "\n".join(f"x{i}" for i in range(12))
    got = without_repeats(spark.createDataFrame([(1, text), (1, text), (None, text), (2, "l\n" * 30000)], "doc_id long, text string")).collect()
    assert len(got) == 4 and all(r.text == text for r in got if r.doc_id == 1)
    several = sum(len(c) for c in chunks_of(text) if len(c) > 1)
    assert several and [r.removed_lines for r in got if r.doc_id is None] == [several]
    assert without_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0
