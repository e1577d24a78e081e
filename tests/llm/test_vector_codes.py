import hashlib
import math

import numpy as np
import pytest

from trailmark.llm import vector_codes
from trailmark.llm.vector_codes import compress, digest

SCHEMA = "vec_id long, embedding array<float>, label int, code int"


def brute(rows, parts, entries, rounds):
    """Codes, errors, label errors and codebooks by plain loops over Python integers."""
    kept = [(i, [math.floor(4096 * x) for x in v], label) for i, v, label, *_ in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    first = {}
    for i, v, _ in kept:
        first[i] = min(first.get(i, v), v)
    width = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    seeds = sorted(first, key=lambda i: (i is None, i))[:entries]
    books = [[cut(first[i], p) for i in seeds] for p in range(parts)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for _, v, _ in kept:
                groups.setdefault(near(cut(v, p), books[p])[1], []).append(cut(v, p))
            books[p] = [[sum(c) // len(groups[k]) for c in zip(*groups[k], strict=True)] if k in groups else e for k, e in enumerate(books[p])]
    out, sums = [], {}
    for i, v, label in kept:
        best = [near(cut(v, p), books[p]) for p in range(parts)]
        out.append((i, "".join(f"{k:02x}" for _, k in best), sum(d for d, _ in best), label))
        sums[label] = sums.get(label, 0) + out[-1][2]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, c, e, sums[label]) for i, c, e, label in out), key=str), sha


def check(spark, rows, parts=8, entries=16, rounds=6, slices=3):
    df = spark.createDataFrame(spark.sparkContext.parallelize(rows, slices), SCHEMA)
    got, books = compress(df, parts=parts, entries=entries, rounds=rounds)
    want, sha = brute(rows, parts, entries, rounds)
    assert sorted(((r.vec_id, r.code, r.error, r.label_error) for r in got.collect()), key=str) == want
    assert digest(books) == sha


def vectors(n, dims, seed=0):
    rng = np.random.default_rng(seed)
    return [[float(np.float32(x)) for x in v] for v in rng.normal(size=(n, dims))]


def test_codes_of_random_vectors(spark, monkeypatch):
    rows = [(i * 7 % 301, v, i % 4 or None, 1) for i, v in enumerate(vectors(150, 16))]
    check(spark, rows)
    monkeypatch.setattr(vector_codes, "BLOCK", 40)
    monkeypatch.setattr(vector_codes, "MOST_BROADCAST", 0)
    check(spark, rows, parts=4, entries=5, rounds=3, slices=7)


def test_ties_repeats_and_odd_rows(spark):
    flat = [[float(i % 2)] * 8 for i in range(6)]  # equal entries: the lower wins, the others stay unused
    rows = [(i, v, 1, 0) for i, v in enumerate(flat)] + [(3, flat[3], 1, 0), (None, [0.5] * 8, None, 0), (50, None, 1, 0), (-9, [None] + [0.0] * 7, 1, 0), (-8, [float("nan")] * 8, 2, 0), (-7, [float("-inf")] * 8, None, 0)]
    check(spark, rows)
    check(spark, rows, entries=2)
    check(spark, [(None, [1.0] * 8, None, 0), (None, [-1.0] * 8, None, 0)])


def test_a_hot_vector(spark):
    rows = [(i, v if i % 3 else [0.25] * 8, 7 if i % 3 else 0, 1) for i, v in enumerate(vectors(200, 8, 1))]
    check(spark, rows)


def test_empty_tables_and_what_is_refused(spark):
    for rows in ([], [(1, None, 1, 1)]):
        got, books = compress(spark.createDataFrame(rows, SCHEMA))
        assert got.count() == 0 and books.size == 0
    for bad in ([(1, [1.0] * 12, 1, 1)], [(1, [1.0] * 8, 1, 1), (2, [1.0] * 16, 1, 1)], [(1, [1e30] * 8, 1, 1)]):
        with pytest.raises(Exception, match="equal parts|one length|must lie within"):
            compress(spark.createDataFrame(bad, SCHEMA))[0].count()
