import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from trailmark.llm import simhash
from trailmark.llm.simhash import CODE, anchors, fingerprint, links, near_duplicates


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    """doc_id, fingerprint and component of each row, every pair compared."""
    prints = [brute_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                root[top(a)] = top(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[top(k)] = min([x for x in (least.get(top(k)), i) if x is not None], default=None)
    return sorted(((i, f"{p:016x}", least[top(k)]) for k, ((i, _), p) in enumerate(zip(rows, prints, strict=True))), key=str)


def words_near(rng, base, n):
    """Copies of a long text with a word changed, whose fingerprints lie near each other."""
    out = []
    for _ in range(n):
        w = base.split()
        w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def corpus():
    rng = random.Random(5)
    base = [" ".join(f"w{rng.randrange(500)}" for _ in range(n)) for n in (400, 900, 2500)]
    texts = [*base, *(t for b in base for t in words_near(rng, b, 25)), None, "", " \n", "one", "One", "one two", "a b c", "A  b\nC", "a\xa0b", "É b c d", base[0].upper(), "x " * 3000, *(" ".join(f"u{rng.randrange(10**6)}" for _ in range(9)) for _ in range(60))]
    rng.shuffle(texts)
    return [(1000 - k, t) for k, t in enumerate(texts)] + [(7, base[1]), (7, base[1]), (None, base[2]), (None, "alone here now")]


def test_components_equal_every_pair_compared(spark):
    rows = corpus()
    assert len({p for _, p, _ in brute(rows)}) > 100
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, fp int, anchor string").repartition(5)
    for options in ({}, {"crowd": 0}, {"crowd": 2}):
        assert sorted(map(tuple, near_duplicates(df, **options).collect()), key=str) == brute(rows)


def test_no_rows(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_fingerprint_is_that_of_the_platform_hash(spark):
    text = "Several WORDS of a text\tthat Repeats of a text"
    words = text.lower().split()
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    hashes = [r.h & (2**64 - 1) for r in spark.createDataFrame([(s,) for s in shingles], "s string").select(F.xxhash64("s").alias("h")).collect()]
    assert fingerprint(text) == brute_fingerprint(text) == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_counts_in_steps(monkeypatch):
    text = " ".join(f"w{i % 77}" for i in range(1000))
    monkeypatch.setattr(simhash, "STEP", 7)
    assert fingerprint(text) == brute_fingerprint(text)


@pytest.mark.parametrize("flips", [0, 1, 2])
def test_a_word_visits_the_anchors_of_all_words_near(flips):
    rng = np.random.default_rng(flips)
    assert sum(b.bits for b in CODE) == 64
    for word in rng.integers(0, 1 << 64, 150, dtype=np.uint64, endpoint=False):
        other = int(word)
        for b in rng.choice(64, flips, replace=False):
            other ^= 1 << int(b)
        home = anchors(np.array([other], np.uint64), 0)[1]
        assert home.size == 1 and (int(home[0]) ^ other).bit_count() <= sum(b.radius for b in CODE)
        visited = anchors(np.array([word]), 2)[1]
        assert home[0] in visited and np.unique(visited).size == visited.size < 400


def test_links_in_a_crowd(spark):
    rng = random.Random(3)
    fps = sorted({0, *(sum(1 << b for b in rng.sample(range(64), rng.randrange(4))) for _ in range(300)), *(rng.getrandbits(64) for _ in range(50))})
    want = {(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 2}
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(signed(x),) for x in fps], "fp long")
    for crowd in (0, 5, 4096):
        got = {tuple(sorted((r.a % (1 << 64), r.b % (1 << 64)))) for r in links(df, crowd=crowd).collect()}
        assert got == want
