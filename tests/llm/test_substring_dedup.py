import random
import tempfile
import time
from pathlib import Path

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from trailmark.llm.arrowtext import window_hashes
from trailmark.llm.shared import clear, stage
from trailmark.llm.substring_dedup import ReachTree, align, chains, common_words, in_stretches, loosened, matches, minimisers, narrow, repeated_passages, run_hashes, scales_of, seeds, squeezed, wide


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 9), max_size=12), min_size=1, max_size=4), st.integers(1, 6))
def test_minimisers_equal_a_plain_loop(documents, window):
    bounds = np.concatenate([[0], np.cumsum([len(d) for d in documents])])
    places, owners = minimisers(np.array([x for d in documents for x in d], np.uint64), bounds, window)
    want = set()
    for k, d in enumerate(documents):
        for s in range(max(1, len(d) - window + 1) if d else 0):
            own = d[s : s + window]
            want.add((bounds[k] + s + max(i for i, x in enumerate(own) if x == min(own)), k))
    assert set(zip(places.tolist(), owners.tolist(), strict=True)) == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 60), st.integers(1, 9)), min_size=1, max_size=9))
def test_best_chain_equals_all_pairs_dynamic_programming(rows):
    runs = np.array(sorted(set(rows), key=lambda r: (r[1], r[0])))
    best = []
    for q, (s1, s2, n) in enumerate(runs):
        options = [best[p] - (s1 - runs[p][0] - runs[p][2]) - (s2 - runs[p][1] - runs[p][2]) for p in range(q) if runs[p][0] + runs[p][2] <= s1 and runs[p][1] + runs[p][2] <= s2]
        best.append(10 * n + max([0, *options]))
    chain = chains(runs, most_gap=1 << 30)[0]
    score = 10 * runs[chain][:, 2].sum() - sum((runs[b][:2] - runs[a][:2] - runs[a][2]).sum() for a, b in zip(chain, chain[1:], strict=False))
    assert score == max(best)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 60), st.integers(1, 9)), min_size=1, max_size=12), st.integers(0, 20))
def test_best_chain_inside_a_gap(rows, gap):
    runs = np.array(sorted(set(rows), key=lambda r: (r[1], r[0])))
    best = []
    for q, (s1, s2, n) in enumerate(runs):
        near = [p for p in range(q) if 0 <= s1 - runs[p][0] - runs[p][2] <= gap and 0 <= s2 - runs[p][1] - runs[p][2] <= gap]
        best.append(10 * n + max([0, *(best[p] - (s1 - runs[p][0] - runs[p][2]) - (s2 - runs[p][1] - runs[p][2]) for p in near)]))
    got = chains(runs, most_gap=gap)
    score = 10 * runs[got[0]][:, 2].sum() - sum((runs[b][:2] - runs[a][:2] - runs[a][2]).sum() for a, b in zip(got[0], got[0][1:], strict=False))
    assert score == max(best) and sorted(q for c in got for q in c) == list(range(len(runs)))


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 20), st.lists(st.tuples(st.integers(0, 19), st.one_of(st.none(), st.integers(0, 50))), max_size=60), st.integers(0, 20), st.integers(0, 20))
def test_tree_of_maxima(n, changes, low, high):
    tree, plain = ReachTree(n), [ReachTree.NONE] * n
    for place, value in changes:
        entry = ReachTree.NONE if value is None else (value, place)
        tree.set(place % n, entry)
        plain[place % n] = entry
        assert tree.top(min(low, n), min(high, n)) == max([ReachTree.NONE, *plain[min(low, n) : min(high, n)]])


def test_a_text_that_many_ask_for(spark):
    rng = random.Random(9)
    source = [f"s{i}" for i in range(400)]
    rows = [(0, " ".join(source))]
    for i in range(1, 330):
        at = rng.randrange(330)
        rows.append((i, " ".join([f"d{i}a{j}" for j in range(20)] + source[at : at + 60 + i % 10] + [f"d{i}b{j}" for j in range(20)])))
    got = repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in got} == set(range(1, 330))


def test_alignment():
    a = np.arange(100, dtype=np.uint64)
    b = a.copy()
    b[40] = 999
    assert align(a, b, np.array([[10, 10, 8], [60, 60, 8]])) == (0, 100, 0, 100, 99)
    assert common_words(np.array([1, 2, 3, 4]), np.array([1, 9, 3, 4, 5])) == 3


def test_planted_passages_are_found_and_clean_texts_left(spark):
    rng = random.Random(8)
    word = lambda: f"w{rng.randrange(3000)}"
    passages = [[word() for _ in range(n)] for n in (55, 70, 120)]
    rows, planted = [], {}
    for i in range(120):
        words = [word() for _ in range(rng.randrange(300))]
        if i % 3 == 0:
            passage = list(passages[i // 3 % 3])
            for _ in range(rng.randrange(3)):
                passage[rng.randrange(20, len(passage) - 20)] = word()
            at = rng.randrange(len(words) + 1)
            planted[i] = (i // 3 % 3, at, at + len(passage))
            words[at:at] = passage
        rows.append((i, " ".join(words), "clash", 0))
    rows += [(500, None, "c", 0), (501, "", "c", 0), (502, "one two", "c", 0), (503, " ".join(passages[0]) + " " + " ".join(passages[0]), "c", 0)]
    got = repeated_passages(spark.createDataFrame(rows, "doc_id long, text string, seed string, src int")).collect()
    firsts = {min(i for i, p in planted.items() if p[0] == k) for k in range(3)}
    found = {}
    for r in got:
        assert r.doc_id in planted or r.doc_id == 503
        found.setdefault(r.doc_id, []).append(r)
    for i, (kind, low, high) in planted.items():
        if i not in firsts:
            assert any(abs(r.from_word - low) <= 2 and abs(r.to_word - high) <= 2 and planted[r.src_id][0] == kind for r in found[i]), (i, low, high, found.get(i))
    assert len(found[503]) >= 2
    assert all(r.n_words >= 50 and r.n_agree >= 0.8 * r.n_words for r in got)


def test_odd_rows(spark):
    text = " ".join(f"u{i}" for i in range(80))
    schema = "doc_id long, text string"
    assert repeated_passages(spark.createDataFrame([], schema)).count() == 0
    got = repeated_passages(spark.createDataFrame([(1, text), (2, text.upper()), (None, text), (3, "x " * 20000)], schema)).collect()
    assert [(r.doc_id, r.src_id, r.from_word, r.to_word, r.n_agree) for r in got if r.doc_id < 3] == [(2, 1, 0, 80, 80)]


def test_a_far_predecessor_does_not_hide_a_near_one():
    runs = np.array([[0, 0, 200], [500, 500, 30], [530, 533, 30]])
    assert chains(runs) == [[0], [1, 2]]


def test_second_passage_of_a_pair_and_adjacent_copies(spark):
    rng = random.Random(5)
    fresh = lambda n: [f"z{rng.randrange(10**9)}" for _ in range(n)]
    far, a, b, p = fresh(200), fresh(30), fresh(30), fresh(55)
    rows = [(1, far + fresh(300) + a + b), (2, far + fresh(300) + a + fresh(3) + b), (3, p * 3)]
    got = repeated_passages(spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")).collect()
    places = {(r.doc_id, r.src_id, r.from_word, r.to_word) for r in got}
    assert {(2, 1, 0, 200), (2, 1, 500, 563), (3, 3, 55, 110), (3, 3, 110, 165)} <= places
    assert all(r.src_to <= r.from_word for r in got if r.doc_id == 3)


def test_a_passage_whose_parts_occurred_before(spark):
    rng = random.Random(6)
    fresh = lambda n: [f"z{rng.randrange(10**9)}" for _ in range(n)]
    rows, want = [], set()
    for g, (size, cut) in enumerate([(60, 30), (60, 45), (50, 25), (50, 49), (80, 49)]):
        p = fresh(size)
        rows += [(10 * g, fresh(40) + p[:cut] + fresh(40)), (10 * g + 1, fresh(30) + p[-cut:] + fresh(30))]
        rows += [(10 * g + 2, fresh(25) + p + fresh(25)), (10 * g + 3, fresh(70) + p + fresh(70))]
        want.add((10 * g + 3, 10 * g + 2, 70, 70 + size))
    got = repeated_passages(spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")).collect()
    assert want <= {(r.doc_id, r.src_id, r.from_word, r.to_word) for r in got}


def test_evenly_spread_changes_down_to_least_alike(spark):
    rng = random.Random(7)
    fresh = lambda n: [f"z{rng.randrange(10**9)}" for _ in range(n)]
    rows, planted = [], []
    for size, changes in [(55, 2), (55, 5), (55, 8), (55, 10), (70, 13), (120, 22), (120, 24)] * 4:
        p, i = fresh(size), 2 * len(planted)
        edited = list(p)
        for c in range(changes):
            edited[(c + 1) * size // (changes + 1)] = fresh(1)[0]
        rows += [(i, fresh(60) + p + fresh(60)), (i + 1, fresh(90) + edited + fresh(50))]
        planted.append((i + 1, 90, 90 + size))
    got = {(r.doc_id, r.src_id): r for r in repeated_passages(spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")).collect()}
    for i, low, high in planted:
        r = got.get((i, i - 1))
        assert r and abs(r.from_word - low) <= 4 and abs(r.to_word - high) <= 4, (i, low, high, r)


def longest_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j], row[j + 1])
    return row[-1]


def test_changed_passages_whose_parts_occurred_before_are_recalled(spark):
    """Halves and thirds of a passage come first, each in a text of its own; then the whole, then the whole with changes."""
    rng = random.Random(16)
    fresh = lambda n: [f"z{rng.randrange(10**9)}" for _ in range(n)]
    rows, groups = [], []

    def add(words):
        before = rng.randrange(40)
        rows.append((len(rows), fresh(before) + words + fresh(rng.randrange(40))))
        return len(rows) - 1, before

    for g in range(60):
        size = rng.choice([60, 60, 75, 90])  # no half of it is a passage of its own
        p = fresh(size)
        parts = 2 if g < 40 else 3
        for k in range(parts):
            add(p[k * size // parts : (k + 1) * size // parts])
        whole, changed = add(p)[0], list(p)
        places = range(6, size, 7) if g < 10 else rng.sample(range(3, size - 3), int(size * rng.choice([0.03, 0.08, 0.13])))
        for i in places:
            changed[i] = fresh(1)[0]
        doc, at = add(changed)
        groups.append((doc, whole, at, size))
    texts = dict(rows)
    got = repeated_passages(spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")).collect()
    found = {(r.doc_id, r.src_id): r for r in got}
    hit = [(d, w) in found and abs(found[d, w].from_word - at) <= 4 and abs(found[d, w].to_word - at - size) <= 4 for d, w, at, size in groups]
    assert all(hit[:10]) and sum(hit) >= 0.9 * len(hit)
    for r in got:  # every row is a passage by a plain alignment, and of a planted pair
        agree = longest_common(texts[r.src_id][r.src_from : r.src_to], texts[r.doc_id][r.from_word : r.to_word])
        assert agree >= r.n_agree >= 0.8 * r.n_words >= 40 and (r.doc_id, r.src_id) in {g[:2] for g in groups}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), max_size=60), st.integers(1, 45))
def test_hashes_by_doubling_equal_the_plain_ones(own, k):
    own = np.array(own, np.uint64)
    want = window_hashes(own, np.array([0, own.size]), k)[0]
    assert run_hashes(own, k).tolist() == (want.tolist() if own.size >= k else [])


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(-(2**63), 2**63 - 1), min_size=1, max_size=50))
def test_packed_numbers_come_back(column):
    assert loosened(squeezed(np.array(column, np.int64)), len(column)).tolist() == column


def test_word_hashes_in_five_bytes():
    own = np.random.default_rng(1).integers(0, 2**64, 100, np.uint64)
    assert len(narrow(own[3:])) == 5 * 97 and (wide(narrow(own[3:])) == own[3:] % 2**40).all() and wide(b"").size == 0


def test_a_cleared_table_is_empty(spark):
    kept = stage(spark.range(1000).repartition(3), "kept", release=True)
    folder = kept.inputFiles()[0].rsplit("/", 1)[0]
    clear(kept)
    assert spark.read.parquet(folder).count() == 0


def test_words_in_stretches():
    lists = [[{"low": 10, "high": 20}, {"low": 2, "high": 5}], [], [{"low": 0, "high": 9}]]
    document, at = np.array([0, 0, 0, 0, 1, 2, 2]), np.array([1, 2, 10, 18, 2, 0, 7])
    assert in_stretches(document, at, 3, lists).tolist() == [False, True, True, False, False, True, False]
    assert not in_stretches(document, at, 3, [[], [], []]).any()


def test_matches_equal_a_plain_loop(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(-50, 50) << 40 if i % 9 else None, " ".join(f"w{rng.randrange(6)}" for _ in range(rng.randrange(90)))) for i in range(80)]
    rows = [r for r in rows if r[0] is not None] + [(7, None), (8, ""), (9, "w1 w2")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got, want = set(), set()
    for r in matches(docs, [(4, 1), (6, 1)]).collect():
        columns = [loosened(bytes(x), r.n).tolist() for x in (r.docs, r.places, r.srcs, r.src_places)]
        got |= {(r["size"], *x) for x in zip(*columns, strict=True)}
    for k in (4, 6):
        places = {}
        for i, text in rows:
            own = (text or "").split()
            for at in range(len(own) - k + 1):
                places.setdefault(tuple(own[at : at + k]), set()).add((i, at))
        want |= {(k, *x, *min(own)) for own in places.values() for x in own if x != min(own)}
    assert got == want and want


def test_packed_seeds_are_small(spark):
    """A seed takes under 10 bytes in the shuffle, where a row of its own took over 20."""
    rng = random.Random(4)
    docs = spark.createDataFrame([(i, " ".join(f"z{rng.randrange(10**6)}" for _ in range(500))) for i in range(2000)], "doc_id long, text string").coalesce(1)
    n, size = 0, 0
    for r in seeds(docs, scales_of(50, 0.8)[:1], 256).collect():
        n, size = n + r.n, size + len(r.hashes) + len(r.docs) + len(r.places)
    assert n == 2000 * 497 and size < 10 * n


def test_shuffle_files_go_with_their_table(spark):
    files = lambda: {p for p in Path(spark.conf.get("spark.local.dir", tempfile.gettempdir())).glob("blockmgr-*/*/shuffle_*.data")}
    before = files()
    kept = stage(spark.range(1000).repartition(3), "kept", release=True)
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.2)
    assert not files() - before and kept.count() == 1000
