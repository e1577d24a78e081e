import itertools
import math
import re
import zlib

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from trailmark.llm.arrowtext import text_slices
from trailmark.llm.line_crf import KINDS, classify, features, fit, forward_backward, lines_of, stretch, training_set


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.floats(-3, 3), min_size=1, max_size=5), min_size=1, max_size=4), st.lists(st.floats(-2, 2), min_size=4, max_size=4))
def test_marginals_equal_summing_over_all_labellings(chains, moves):
    moves = np.array(moves).reshape(2, 2)
    bounds = np.concatenate([[0], np.cumsum([len(c) for c in chains])])
    good, expected = forward_backward(np.array([x for c in chains for x in c]), moves, bounds)
    want, want_moves = [], np.zeros((2, 2))
    for chain in chains:
        weights = {y: np.exp(sum(s * v for s, v in zip(chain, y, strict=True)) + sum(moves[a, b] for a, b in itertools.pairwise(y))) for y in itertools.product((0, 1), repeat=len(chain))}
        total = sum(weights.values())
        want += [sum(w for y, w in weights.items() if y[t]) / total for t in range(len(chain))]
        for y, w in weights.items():
            for a, b in itertools.pairwise(y):
                want_moves[a, b] += w / total
    assert np.allclose(good, want) and np.allclose(expected, want_moves)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab \n!é"), max_size=12), min_size=1, max_size=6))
def test_lines(texts):
    for _, _, data, offsets in text_slices(pa.array(texts)):
        starts, ends, bounds = lines_of(data, offsets)
        for k, text in enumerate(texts):
            assert [data[s:e].tobytes().decode() for s, e in zip(starts[bounds[k] : bounds[k + 1]], ends[bounds[k] : bounds[k + 1]], strict=True)] == text.split("\n")
        assert np.isfinite(features(data, offsets)[0]).all()


def documents(n=300):
    rng = np.random.default_rng(5)
    word = lambda: "".join(rng.choice(list("abcdefgh"), int(rng.integers(2, 8))))
    rows = []
    for i in range(n):
        bad = i % 3 == 0
        lines = [" ".join(word().upper() + "!!" if bad and 0 < k < 6 else word() for _ in range(12)) for k in range(7)]
        rows.append((i, "\n".join(lines), "clash", 0.5, int(not bad)))
    return rows


def test_held_out_accuracy_and_odd_rows(spark):
    rows = documents()
    odd = [(1000, None, "x", 0.0), (1001, "", "x", 0.0), (1002, "word\n" * 20000, "x", 0.0), (1002, "A!! B!!", "x", 0.0), (None, "plain words here", "x", 0.0)]
    docs = spark.createDataFrame([r[:4] for r in rows] + odd, "doc_id long, text string, source string, score double")
    labels = spark.createDataFrame([(r[0], r[4], 0) for r in rows] + [(1000, None, None), (1001, 1, 0), (1001, 0, 0)], "doc_id long, quality int, toxic int")
    got = classify(docs, labels).collect()
    assert len(got) == 305 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    held = [r for r in got if r.held_out and r.doc_id < 1000]
    assert len(held) > 30 and np.mean([r.predicted == rows[r.doc_id][4] for r in held]) > 0.97
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)


def test_nothing_to_learn_or_judge(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert classify(docs, labels).first().score == 0.5
    assert classify(docs.limit(0), labels).count() == 0


def brute_features(text):
    """Features of each line by plain loops."""
    kind_of = {b: i for i, kind in enumerate(KINDS) for b in kind}
    lines, had, seen, own = text.encode().split(b"\n"), set(), set(), []
    for line in lines:
        words = re.findall(rb"[^\x20\x09-\x0D]+", line)
        shares = [sum(kind_of.get(b) == i for b in line) / max(len(line), 1) for i in range(len(KINDS))]
        again = sum(a == b for a, b in itertools.pairwise(words)) / max(len(words), 1)
        old = 0
        for w in words:
            old += w in had and len(w) > 4
            had.add(w)
        own.append([*shares, again, old / max(len(words), 1), float(line in seen and len(line) > 20), math.log1p(len(line)) / 8, float(not words), sum(map(len, words)) / max(len(words), 1) / 16])
        seen.add(line)
    none = [0.0] * len(own[0])
    return [a + (own[i - 1] if i else none) + (own[i + 1] if i + 1 < len(own) else none) + [1.0, float(i == 0)] for i, a in enumerate(own)], [len(x) + 1 for x in lines]


def brute_score(chain, text):
    """The squared, weighted mean of the marginals, each as a sum over all labellings."""
    rows, weight = brute_features(text)
    score = [sum((v - m) / s * w for v, m, s, w in zip(row, chain.mean, chain.scale, chain.weights, strict=True)) for row in rows]
    good = [0.0] * len(rows)
    total = 0.0
    for y in itertools.product((0, 1), repeat=len(rows)):
        p = math.exp(sum(s * v for s, v in zip(score, y, strict=True)) + sum(chain.moves[a, b] for a, b in itertools.pairwise(y)))
        total += p
        good = [g + p * v for g, v in zip(good, y, strict=True)]
    return (sum(g / total * w for g, w in zip(good, weight, strict=True)) / sum(weight)) ** 2


def test_scores_equal_brute_force(spark):
    rows = documents(150) + [(900, "", "c", 0.0, 1), (901, "one\n\none ONE!! one\n" + "repeat this line please\n" * 2, "c", 0.0, 1), (902, "é日本語 | <b>1 2 3</b>", "c", 0.0, 0)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[4]) for r in rows if r[0] < 900], "doc_id long, quality int")
    chain = fit(*training_set(docs, labels, 3000, 200))
    for r in classify(docs, labels).collect():
        assert math.isclose(r.score, brute_score(chain, next(t for i, t, *_ in rows if i == r.doc_id)), rel_tol=1e-6, abs_tol=1e-9)


def test_long_texts_teach_from_anywhere():
    places = {stretch(i, 1000, 10) for i in range(200)}
    assert len(places) > 150 and max(b for _, b in places) > 900 and all(b - a == 10 for a, b in places) and stretch(5, 7, 10) == (0, 7)
