import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from trailmark.llm.mixing import mix, mixture, points_below, reversed_bits, targets


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 7), st.data())
def test_rank_of_a_point_counts_the_points_before_it(bits, data):
    low = data.draw(st.integers(0, 1 << bits))
    index = np.arange(1 << bits)
    value = reversed_bits(index, bits)
    want = [int((value[:i] < low).sum()) for i in index]
    assert points_below(index, np.full(index.size, low), bits).tolist() == want


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 1000), min_size=1, max_size=9))
def test_targets_share_everything_and_stop_at_the_cap(sizes):
    totals = [(f"s{i}", n) for i, n in enumerate(sizes)]
    goal = targets(totals, (5, 2, 1), 3)
    assert sum(goal.values()) == pytest.approx(sum(sizes))
    weight = {f"s{i}": (5, 2, 1)[i % 3] for i in range(len(sizes))}
    open_levels = {round(goal[s] / weight[s], 6) for s, n in totals if goal[s] < 3 * n - 1e-6}
    assert len(open_levels) <= 1
    assert all(goal[s] <= 3 * n + 1e-9 and (not open_levels or goal[s] / weight[s] <= max(open_levels) + 1e-6) for s, n in totals)


def test_schedule_is_even_and_takes_each_target(spark):
    rows = [(i, "w " * (i % 13 * 7), f"s{i % 3}" if i % 4 else None, "clash") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size string")
    got = mix(docs, block_words=16).collect()
    assert len(got) == 400
    for source in {r.source for r in got}:
        own = [r for r in got if r.source == source]
        assert sum(r.size for r in own) == own[0].source_size
        assert sum(r.taken for r in own) == int(own[0].target + 0.5)
        assert all(0 <= r.taken <= 3 * r.size for r in own)
    slots = mixture(docs, block_words=16)[2].select("slot", "source_key").distinct().orderBy("slot").toPandas()
    share = slots["source_key"].value_counts(normalize=True)
    half = slots["source_key"][: len(slots) // 2].value_counts(normalize=True)
    assert (share - half).abs().max() < 0.05


def test_odd_rows(spark):
    rows = [(1, None, "a"), (1, "x y", "a"), (1, "x y", "a"), (None, "p q r", None), (2, "", "b")]
    got = mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), block_words=4).collect()
    assert len(got) == 5 and sum(r.taken for r in got if r.source == "a") == 6 and sum(r.taken for r in got if r.source is None) == 1
    assert all(r.taken == 0 for r in got if r.size == 0)
    assert mix(spark.createDataFrame([], "doc_id long, text string, source string")).count() == 0
