import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from trailmark.llm import ngram_join
from trailmark.llm.components import components
from trailmark.llm.ngram_join import PrefixTree, block_links, near_duplicates, needed, prefix_length


def shingles(text, k=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def brute(rows):
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus(seed, n=260):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(400)}"
    common = [" ".join(word() for _ in range(30)) for _ in range(3)]
    rows = []
    for i in range(n):
        kind = rng.random()
        if rows and kind < 0.55:
            words = (rng.choice(rows[-40:])[1] or "").split()
            for _ in range(rng.randrange(0, 1 + len(words) // 25)):
                words[rng.randrange(len(words))] = word()
            words = words[: len(words) - rng.randrange(0, 1 + len(words) // 4)] if rng.random() < 0.5 else words + [word() for _ in range(rng.randrange(9))]
        elif kind < 0.75:
            words = (" ".join(word() for _ in range(rng.randrange(40))) + " " + rng.choice(common)).split()
        else:
            words = [word() for _ in range(rng.choice([0, 1, 3, 5, 9, 60, 150]))]
        rows.append((i, " ".join(words)))
    return rows + [(n, None), (n + 1, "  \n"), (n + 2, "One two"), (n + 3, "one TWO"), (n + 4, "É"), (n + 5, "é")]


@pytest.mark.parametrize(("seed", "hashes"), [(1, 4), (2, 0)])
def test_components_equal_brute_force(spark, seed, hashes, monkeypatch):
    if not hashes:  # without first links, all of them come from the prefix join
        monkeypatch.setattr(ngram_join, "first_blocks", lambda heads: (heads.selectExpr("doc_id AS block", "doc_id"), heads.selectExpr("doc_id", *(f"0L AS met_{i}" for i in range(4)))))
    rows = corpus(seed)
    got = near_duplicates(spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, component string, n int")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows)
    assert len(got) == len(rows)


def test_small_blocks_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 3)
    rows = corpus(3)
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows)


def test_odd_rows(spark):
    schema = "doc_id long, text string"
    assert near_duplicates(spark.createDataFrame([], schema)).count() == 0
    got = near_duplicates(spark.createDataFrame([(3, "a b c"), (3, "a b c"), (None, "a b c"), (7, "a b c"), (None, "z"), (8, "q " * 30000)], schema)).collect()
    assert sorted((r.doc_id or -1, r.n_shingles, r.component_id or -1) for r in got) == [(-1, 1, -1), (-1, 1, 3), (3, 1, 3), (3, 1, 3), (7, 1, 3), (8, 1, 8)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sets(st.integers(0, 25), min_size=1, max_size=20), max_size=12))
def test_tree_leaves_out_no_similar_set(sets):
    arrays = [np.array(sorted(s), np.uint64) for s in sets]
    tree = PrefixTree()
    for i, own in enumerate(arrays):
        n = prefix_length(own.size)
        found = set(tree.search(own[:n], own.size, own.size - n))
        for j in range(i):
            if len(sets[i] & sets[j]) >= needed(len(sets[i]), len(sets[j])):
                assert j in found
        tree.insert(i, own[:n], own.size, own.size - n)
    parent = list(range(len(sets)))
    for i, j in block_links(arrays):
        parent = [parent[j] if p == parent[i] else p for p in parent]
    for i in range(len(sets)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= needed(len(sets[i]), len(sets[j])):
                assert parent[i] == parent[j]


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 60)] + [(100, k) for k in range(101, 140)] + [(5, 5), (200, 150)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 61)}, **{k: 100 for k in range(100, 140)}, 150: 150, 200: 150}
