import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from trailmark.llm.arrowtext import text_slices, words
from trailmark.llm.packing import Lengths, best_fit, dominating, pack, plan_slots, reduce_instance, split_points, word_ids
from trailmark.llm.shared import tokenizer_path


def fewest(items, capacity):
    """The optimum by trying all ways to place each item."""
    best = len(items)

    def go(k, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if k == len(items):
            best = len(bins)
            return
        for i in range(len(bins)):
            if bins[i] + items[k] <= capacity and bins[i] not in bins[:i]:
                go(k + 1, [*bins[:i], bins[i] + items[k], *bins[i + 1 :]])
        go(k + 1, [*bins, items[k]])

    go(0, [])
    return best


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=9))
def test_reduction_keeps_the_optimum(lengths):
    items = Lengths(Counter(lengths))
    fixed = reduce_instance(items, 20)
    left = sorted((x for x, n in items.count.items() for _ in range(n)), reverse=True)
    assert all(sum(x * n for x, n in p) <= 20 for _, p in fixed)
    assert sum(t for t, _ in fixed) + fewest(left, 20) == fewest(sorted(lengths, reverse=True), 20)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 30), min_size=1, max_size=60))
def test_best_fit_equals_placing_one_by_one(lengths):
    bins = []
    for x in sorted(lengths, reverse=True):
        fits = [i for i, r in enumerate(bins) if r >= x]
        if fits:
            bins[min(fits, key=lambda i: bins[i])] -= x
        else:
            bins.append(30 - x)
    groups = best_fit(Lengths(Counter(lengths)), 30)
    assert sorted(30 - sum(x * n for x, n in p) for t, p in groups for _ in range(t)) == sorted(bins)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=60))
def test_slots_hold_every_item_once_without_gaps(lengths):
    slots = plan_slots(Counter(lengths), 30)
    bins = defaultdict(list)
    for x, n in Counter(lengths).items():
        own = slots[slots[:, 0] == x]
        for rank in range(n):
            s = own[np.searchsorted(own[:, 1], rank, side="right") - 1]
            bins[s[3] + (rank - s[1]) // s[2]].append((s[4] + (rank - s[1]) % s[2] * x, x))
    for own in bins.values():
        at = 0
        for offset, x in sorted(own):
            assert offset == at
            at += x
        assert at <= 30


def test_dominating_sets():
    assert dominating(Lengths({9: 1, 2: 1}), 9, 10) == ((9, 1),)
    assert dominating(Lengths({6: 1, 4: 1, 1: 5}), 6, 10) == ((6, 1), (4, 1))
    assert dominating(Lengths({6: 1, 3: 2}), 6, 10) == ((6, 1), (3, 1))
    assert dominating(Lengths({2: 1, 1: 20}), 2, 10) is None


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from(" \n'stREve.,<|>endoftxé—Σ1\u0301"), st.characters(exclude_categories=["Cs"])), max_size=30), max_size=4))
def test_ids_equal_encoding_each_text(texts):
    texts = [*texts, "A.<|endoftext|>,b it's,x"] if len(texts) % 2 else texts
    cache = word_ids("word_bpe_49k.json")
    for low, high, data, offsets in text_slices(pa.array(texts, pa.string())):
        starts, ends, bounds = words(data, offsets, split_points(data))
        where, lengths = cache.lookup(data, starts, ends)
        for k in range(low, high):
            own = slice(bounds[k - low], bounds[k - low + 1])
            got = [x for s, n in zip(where[own], lengths[own], strict=True) for x in cache.ids[s : s + n].tolist()]
            assert got == cache.tokenizer.encode(texts[k], add_special_tokens=False).ids


def test_pack_round_trip(spark):
    tokenizer = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    texts = ["Hello, World's 12 x", None, "", " \n ", "ΣΑΣ é <|endoftext|>a", "w " * 9000, "Hello, World's 12 x"] + [f"text number {i} " * (i % 50) for i in range(60)]
    rows = [(i, t, "clash") for i, t in enumerate(texts)] + [(3, "again", "clash")]
    got = pack(spark.createDataFrame(rows, "doc_id long, text string, length string")).collect()
    ids = defaultdict(list)
    for i, t, _ in rows:
        ids[i].append(tokenizer.encode(t or "", add_special_tokens=False).ids + [1])
    for i, want in ids.items():
        crcs = Counter(zlib.crc32(np.array(w[s : s + 4096], "<u4").tobytes()) for w in want for s in range(0, len(w), 4096))
        assert Counter(r.ids_crc32 for r in got if r.doc_id == i) == crcs
    bins = defaultdict(list)
    for r in got:
        assert r.start == r.piece * 4096
        bins[r.sequence_id].append((r.offset, r.length))
    for own in bins.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= 4096
    assert len(bins) == -(-sum(r.length for r in got) // 4096)
    assert pack(spark.createDataFrame([], "doc_id long, text string")).count() == 0
