import hashlib
import re

from pyspark.sql import functions as F

from trailmark.llm import exact_dedup
from trailmark.llm.exact_dedup import duplicate_groups


def brute(rows):
    groups = {}
    for i, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((-len(text or ""), float("inf") if i is None else i))
    return {k: (min(v)[1], len(v)) for k, v in groups.items()}


def check(spark, rows, **options):
    got = duplicate_groups(spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, hash string, row int"), **options).collect()
    want = brute(rows)
    by_sha = {hashlib.sha256(k.encode()).hexdigest(): v for k, v in want.items()}
    assert len(got) == len(rows)
    for r in got:
        assert (float("inf") if r.keep_id is None else r.keep_id, r.group_size) == by_sha[r.text_sha256]
    assert sum(r.kept for r in got) == len(want) and all(r.doc_id == r.keep_id for r in got if r.kept)


ROWS = [(1, "a b"), (2, "ab"), (3, "a  b"), (4, None), (5, ""), (6, " \n"), (7, "é" * 50), (8, "é" * 49 + " é"), (9, "xyz" * 40), (9, "xyz" * 40), (10, "xyz" * 41), (11, "xy zx yz" * 40), (None, "only"), (12, "a\xa0b"), (13, "日本" * 33 + "x")]


def test_groups(spark):
    check(spark, ROWS)
    check(spark, ROWS, block_chars=4)
    assert duplicate_groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_colliding_hashes_do_not_merge_texts(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "hash_of", lambda content: F.pmod(F.xxhash64(*content), F.lit(3)))
    check(spark, ROWS, block_chars=4)
