import hashlib
import random
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from trailmark.llm.periodic_runs import find_runs, next_smaller, periodic_runs, repeated_from, suffix_order
from trailmark.llm.queries import runs_report


def brute_runs(w, least=12):
    """Every stretch with a period that can't be longer, smallest period each, by its definition."""
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(least, 2 * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(rows):
    out = []
    for i, text in rows:
        w = words_of(text)
        if i is not None and w and (h := zlib.crc32(str(i).encode())) % 10 == 0:
            g = h // 10
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(len(w))]
        runs = brute_runs(w)
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        best = min(((-n, s, q) for s, n, q in runs), default=None)
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        longest = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
        out.append((i, len(runs), *longest, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(x for k, x in enumerate(w) if k not in gone))))
    return sorted(out, key=str)


texts = st.lists(st.lists(st.integers(0, 2), max_size=60) | st.builds(lambda u, k, v: u * k + v, st.lists(st.integers(0, 3), max_size=8), st.integers(0, 9), st.lists(st.integers(0, 1), max_size=9)), max_size=6)


@settings(max_examples=400, deadline=None)
@given(texts, st.sampled_from([2, 3, 12]))
def test_runs_equal_their_definition(found, least):
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in found])]).astype(np.int64)
    symbols = np.array([x for t in found for x in t], np.int64)
    start, end, period = find_runs(symbols, bounds, least)
    want = [(bounds[k] + s, bounds[k] + s + n, q) for k, t in enumerate(found) for s, n, q in brute_runs(t, least)]
    assert list(zip(start.tolist(), end.tolist(), period.tolist(), strict=True)) == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=80))
def test_suffixes_and_next_smaller_values(values):
    symbols = np.array([*(x + 1 for x in values), 0])
    rank, lcp = suffix_order(symbols)
    order = sorted(range(symbols.size), key=lambda i: symbols[i:].tolist())
    assert [order[r] for r in rank] == list(range(symbols.size))
    for k in range(1, len(order)):
        a, b = symbols[order[k - 1] :].tolist(), symbols[order[k] :].tolist()
        assert lcp[k] == next(i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y)
    for v in (rank, -rank, np.array([*range(len(values), 0, -1)], np.int32), np.array([0, *range(len(values), 0, -1)], np.int32)):
        assert next_smaller(v).tolist() == [next((j for j in range(i + 1, v.size) if v[j] < v[i]), v.size) for i in range(v.size)]


def corpus():
    rng = random.Random(1)
    some = lambda n, k=40: " ".join(f"w{rng.randrange(k)}" for _ in range(n))
    line = some(9)
    rows = [None, "", " \n\t", "x", "é " * 12, "a b " * 6, "a b c " * 5 + "z", f"{line}\n" * 7 + some(30), some(300), some(12, 1), some(50, 2), "a\xa0b " * 13, "x " * 5000, some(3000, 900), (some(7) + " ") * 30 + some(200) + " " + (some(40) + "\n") * 4]
    return [(k, rng.choice(rows)) for k in range(260)] + [(k, t) for k, t in enumerate(rows)] + [(3, line * 3), (None, "a b " * 9)]


def test_query_equals_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, runs string, start int").repartition(4)
    got = runs_report(df).collect()
    want = brute(rows)
    assert sum(r[1] > 0 for r in want) > 100
    assert sorted(((r.doc_id, r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) for r in got), key=str) == want


def test_planting_keeps_other_texts(spark):
    df = spark.createDataFrame([(1, "a  b\tc"), (None, "x  y"), (29, None)], "doc_id long, text string")
    assert [r.t for r in df.select(repeated_from("doc_id", "text").alias("t")).collect()] == ["a  b\tc", "x  y", None]


def test_no_rows(spark):
    assert periodic_runs(spark.createDataFrame([], "doc_id long, text string")).count() == 0
