"""The rules one by one, against plain Python."""

import math
import random
import subprocess
import sys
import zlib
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trailmark.functions import codes, geometry, timeutil
from trailmark.operators import actors, camera, ego, markers, navigation, recording, series, vectormap
from trailmark.sources import robot


def one(spark, expression):
    return spark.range(1).select(expression.alias("x")).first()["x"]


@pytest.mark.parametrize(("us", "want"), [(-500_000, (-1, 500_000_000)), (0, (0, 0)), (1_500_001, (1, 500_001_000)), (-1_000_000, (-1, 0)), (-1, (-1, 999_999_000))])
def test_durations_round_down(spark, us, want):
    assert tuple(one(spark, timeutil.time_struct(F.lit(us).cast("long")))) == want


def test_times_cut_and_seconds_round_to_even(spark):
    assert one(spark, timeutil.to_microseconds(F.lit(2), F.lit(1999))) == 2_000_001
    assert [one(spark, timeutil.from_seconds(F.lit(x))) for x in (0.5e-6, 1.5e-6, 2.5e-6)] == [round(x * 1e6) for x in (0.5e-6, 1.5e-6, 2.5e-6)]
    assert timeutil.history_capacity(2.0, 0.5, 64) == 5 and timeutil.history_capacity(0.0, 1.0, 64) == 1


def thin(times, period, most):
    if not times:
        return []
    kept = [times[0]]
    for t in times[1:]:
        if len(kept) >= most:
            break
        if t - kept[-1] >= period:
            kept.append(t)
    return kept + [times[-1]] if len(kept) < most and kept[-1] != times[-1] else kept


@settings(max_examples=20, deadline=None)
@given(lists=st.lists(st.lists(st.integers(0, 40), max_size=12).map(sorted), min_size=1, max_size=8), period=st.integers(1, 9), most=st.integers(1, 6))
def test_downsample(spark, lists, period, most):
    rows = spark.createDataFrame([(i, [(t,) for t in x]) for i, x in enumerate(lists)], "i int, p array<struct<t: long>>")
    got = {r.i: [x.t for x in r.q] for r in rows.select("i", series.downsample("p", "t", period, most).alias("q")).collect()}
    assert got == {i: thin(x, period, most) for i, x in enumerate(lists)}


def test_segments_across_chunks(spark):
    rng = random.Random(1)
    rows = [(i, rng.randrange(5)) for i in range(200)]
    want, segment = {}, 0
    for i, t in rows:
        segment += i > 0 and t < rows[i - 1][1]
        want[i] = segment
    df = spark.createDataFrame(rows, "ingest_seq long, stamp_us long")
    for chunk in (7, 1000):
        got = series.segment(df, "ingest_seq", ["stamp_us"], lambda a, b: b["stamp_us"] < a["stamp_us"], chunk=chunk)
        assert {r.ingest_seq: r.segment for r in got.collect()} == want


def test_revisions_count_returns(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, "a")], "ingest_seq long, k string")
    assert [r.revision for r in series.revisions(df, ["k"]).orderBy("ingest_seq").collect()] == [1, 1, 2, 3]


def test_executed_path_rules(spark):
    frames = ("map", "base_link", "base_link")
    rows = [(1, 0, *frames), (2, 50, *frames), (3, 100, *frames), (4, 30, *frames), (5, 40, "odom", "base_link", "base_link"), (6, 45, "", "base_link", "base_link"), (7, 150, "odom", "base_link", "base_link")]
    df = spark.createDataFrame(rows, "ingest_seq long, stamp_us long, pose_frame_id string, child_frame_id string, dynamics_frame_id string")
    got = ego.executed_path(df, ego.PathConfig(interval_us=100)).orderBy("ingest_seq").collect()
    assert [(r.ingest_seq, r.segment, r.offset_us) for r in got] == [(1, 0, 0), (3, 0, 100), (4, 1, 0), (5, 2, 0), (7, 2, 110)]
    assert ego.executed_path(df, ego.PathConfig(interval_us=0)).count() == 6
    assert ego.executed_path(df, ego.PathConfig(interval_us=0, max_points=1)).count() == 3
    with pytest.raises(ValueError):
        ego.PathConfig(interval_us=-1)


def test_history_keeps_absent_tracks_until_stale(spark):
    config = actors.ActorConfig(history_us=100, period_us=20, stale_us=50, max_points=64)
    assert config.capacity == 6
    rows = [(1, 1, "a", 0), (1, 2, "b", 0), (1, 3, "b", 40), (1, 4, "b", 50), (1, 5, "b", 60), (1, 6, "b", 60)]
    states = spark.createDataFrame([(g, i, t, s, s) for g, i, t, s in rows], "g int, ingest_seq long, track_id string, stamp_us long, ref_us long")
    out = actors.history(states, states.select("g", "ingest_seq", "ref_us").distinct(), config, by=["g"])
    got = {(r.ingest_seq, r.track_id): [p.t for p in r.points] for r in out.collect()}
    assert got[3, "a"] == [0] and got[4, "a"] == [0] and (5, "a") not in got
    assert got[5, "b"] == [0, 40, 60] and got[6, "b"] == [0, 40, 60]


def point(t, x, yaw=0.0, speed=9.0, q=(0.0, 0.0, 0.0, 1.0)):
    v = (float(x), 0.0, 0.0)
    return (t, v, q, (3.0, 4.0, 0.0), (0.0, 0.0, 0.0), yaw, 0.0, 0.0, speed)


POINT = "struct<timestamp_us: long, position: struct<x: double, y: double, z: double>, orientation: struct<x: double, y: double, z: double, w: double>, linear_velocity: struct<x: double, y: double, z: double>, linear_acceleration: struct<x: double, y: double, z: double>, yaw: double, yaw_rate: double, yaw_acceleration: double, speed: double>"


def test_recording_requests(spark):
    points = spark.createDataFrame([("s", t, point(t, x, yaw)) for t, x, yaw in ((0, 0, 3.0), (10, 10, -3.0), (20, 30, 0.0))], f"scene string, stamp_us long, point {POINT}")
    cached = spark.createDataFrame([("s", 4, 0, 20)], "scene string, revision long, start_us long, end_us long")
    asked = [("s", 1, 5, 100, 5, 0, 0), ("s", 2, 99, 1, 5, 0, 4), ("s", 3, 99, 1, 5, 0, 0), ("s", 4, 0, -5, 5, 0, 0), ("t", 5, 0, 1, 5, 0, 0), ("s", 6, 0, 20, 6, 1, 0), ("s", 7, 0, 20, 4, 3, 0), ("s", 8, 5, 10, 0, 0, 0), ("s", 9, 0, 20, 7, 3, 0)]
    df = recording.answer_status(spark.createDataFrame(asked, "scene string, request_id int, reference_us long, future_duration_us long, sampling_interval_us long, max_points int, known_revision long"), cached, on=["scene"])
    status = {r.request_id: r.status for r in df.collect()}
    assert status == {1: "ok", 2: "not_modified", 3: "out_of_range", 4: "ok", 5: "no_recording", 6: "ok", 7: "ok", 8: "ok", 9: "ok"}
    got = {}
    for r in recording.answers(df, points, on=["scene"]).orderBy("stamp_us").collect():
        got.setdefault(r.request_id, []).append((r.stamp_us, r.point.position.x, r.point.yaw, r.point.speed))
    assert got[1] == [(5, 5.0, 0.0, 5.0), (10, 10.0, -3.0, 9.0), (15, 20.0, -1.5, 5.0), (20, 30.0, 0.0, 9.0)]
    assert [t for t, *_ in got[4]] == [0] and [t for t, *_ in got[6]] == [0] and [t for t, *_ in got[8]] == [5, 10, 15]
    assert [t for t, *_ in got[7]] == [0, 8, 20] and [t for t, *_ in got[9]] == [0, 7, 14]


def test_quaternions_go_the_short_way(spark):
    q = lambda *v: F.struct(*(F.lit(float(x)).alias(c) for c, x in zip("xyzw", v, strict=True)))
    assert tuple(one(spark, geometry.nlerp(q(0, 0, 0, 1), q(0, 0, 0, -1), F.lit(0.5)))) == (0, 0, 0, 1)
    assert tuple(one(spark, geometry.nlerp(q(0, 0, 0, 0), q(0, 0, 0, 0), F.lit(0.5)))) == (0, 0, 0, 1)
    half = one(spark, geometry.nlerp(q(0, 0, 0, 1), q(0, 0, 1, 0), F.lit(0.5)))
    assert math.isclose(one(spark, geometry.yaw_of(F.lit(0.0), F.lit(0.0), F.lit(half.z), F.lit(half.w))), math.pi / 2)


def test_gate(spark):
    rows = [(5, 10, True), (5, 11, True), (6, 12, False), (6, 12, True), (1, 5, True), (0, 6, True), (1, 7, True), (3, 2, False), (1, 8, True)]
    df = spark.createDataFrame([(1, i, *r) for i, r in enumerate(rows)], "g int, ingest_seq long, sequence long, reference_us long, valid boolean")
    got = navigation.gate(df, ["g"]).orderBy("ingest_seq").collect()
    assert [r.accepted for r in got] == [True, False, True, True, True, False, False, True, True]
    assert [r.rollback for r in got] == [False, False, False, False, True, False, False, True, False]


def test_navigation_sections(spark):
    from trailmark.schemas import CHANNELS

    good = '{"frame_id": "map", "lookahead_distance": 1.0, "expected_point_count": 1, "points": [{"valid": true, "position": {"x": 1, "y": 2, "z": 3}, "longitudinal_distance": 4.0}]}'
    bad = good.replace('"x": 1', '"x": NaN')
    hidden = bad.replace("true", "false")
    texts = [f'{{"sequence": 1, "reference_timestamp_us": 5, "route_map": {a}, "route_model_input": {b}}}' for a, b in ((good, good.replace("map", "base_link")), (good, good), (bad, good), (hidden, "null"), (good.replace('count": 1', 'count": 2'), "null"))]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "ingest_seq long, t string").select("ingest_seq", F.from_json("t", CHANNELS["navigation"], {"allowNonNumericNumbers": "true"}).alias("r")).select("ingest_seq", "r.*")
    got = [(r.emit_map, r.emit_input, r.valid) for r in navigation.judge(df).orderBy("ingest_seq").collect()]
    assert got == [(True, True, True), (True, False, False), (False, False, False), (True, True, True), (False, False, False)]
    routes = navigation.routes(df, "route_map", "p").orderBy("ingest_seq").collect()
    assert routes[3].points[0].position.x == 0.0 and routes[0].points[0].longitudinal_distance == 4.0
    plan = '{"sequence": 1, "reference_timestamp_us": 5, "planned_trajectory": {"source": "model_planning", "start_timestamp_us": 7, "end_timestamp_us": 9, "points": []}}'
    p = navigation.plans(spark.range(1).select(F.lit(0).alias("ingest_seq"), F.from_json(F.lit(plan), CHANNELS["navigation"]).alias("r")).select("ingest_seq", "r.*")).first()
    assert (p.source, p.requested_us, p.actual_us, p.producer) == (2, 4, 2, "unknown")


def test_polylines_and_lines(spark):
    lines = spark.createDataFrame([("a", [(0.0, 0.0, 0.0), (1.0, 1.0, 1.0)], [0.1]), ("b", [(0.0, 0.0, 0.0)], [])], "id string, points array<struct<x: double, y: double, z: double>>, headings array<double>")
    assert [r.v for r in lines.orderBy("id").select(vectormap.polyline_valid(F.struct("points", "headings")).alias("v")).collect()] == [False, True]
    drawn = markers.line_strips(lines, "centerline").collect()
    assert [(r.id, r.line[1].z, r.marker_id) for r in drawn] == [("a", 1.04, zlib.crc32(b"map/lane_centerlines:a") & 0x7FFFFFFF)]
    walked = navigation_rows(spark)
    assert walked == [("ADD",), ("DELETE",)]


def navigation_rows(spark):
    df = spark.createDataFrame([(1, [(True, (0.0, 0.0, 0.0)), (True, (1.0, 0.0, 0.0))]), (2, [(True, (0.0, 0.0, 0.0)), (False, (1.0, 0.0, 0.0))])], "i int, points array<struct<valid: boolean, position: struct<x: double, y: double, z: double>>>").withColumn("frame_id", F.lit("odom"))
    assert markers.navigation_line(df.where("i = 2").withColumn("points", F.slice("points", 1, 1)), "executed_path").count() == 0
    out = markers.navigation_line(df, "route").orderBy("i").collect()
    assert [(r.marker_id, r.ns, r.frame, len(r.line)) for r in out] == [(1, "navigation/route", "odom", 2), (1, "navigation", "map", 0)]
    return [(r.action,) for r in out]


def test_camera(spark):
    kinds = [b"\xff\xd8\xff\x00", b"\x89PNG\r\n\x1a\n", b"RIFF0000WEBP", b"RIFF0000AVI ", b""]
    df = spark.createDataFrame([(i, bytearray(k)) for i, k in enumerate(kinds)], "i int, d binary")
    assert [r.f for r in df.orderBy("i").select(codes.image_format(F.col("d")).alias("f")).collect()] == ["jpeg", "png", "webp", "unknown", "unknown"]
    assert camera.camera_table(spark).count() == 5


def test_ids_are_crc(spark):
    assert one(spark, codes.stable_id(F.lit("t1"), F.lit("box"))) == zlib.crc32(b"t1:box") & 0x7FFFFFFF


def test_entry_module_without_text_operators():
    """In a process of its own, where the text operators and the pipeline can't be imported."""
    hide = """
import sys
class Hidden:
    def find_spec(self, name, path=None, target=None):
        if name == "corpus_pipeline" or name.startswith("trailmark.llm"):
            raise ModuleNotFoundError(name)
sys.meta_path.insert(0, Hidden())
import __spark_entry__ as entry
names = set(entry.queries())
assert names == set(entry.oracle_sql()) and "gt_future_grid" in names and "pipeline" not in names and not any(n.startswith("op") for n in names)
"""
    done = subprocess.run([sys.executable, "-c", hide], cwd=Path(__file__).resolve().parent.parent, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr


def test_admission_in_chunks_equals_one_walk(spark):
    rng = random.Random(3)
    rows, want = [], set()
    for g in range(3):
        t, last = 0, None
        for i in range(300):
            t += rng.choice([0, 1, 2, 7, 40])
            rows.append((g, i, t))
            if last is None or t - last >= 10:
                want.add((g, i))
                last = t
    df = spark.createDataFrame(rows, "g int, ingest_seq long, stamp_us long")
    for chunk in (10, 37, 500, None):
        assert {(r.g, r.ingest_seq) for r in series.admit(df, ["g"], "ingest_seq", "stamp_us", 10, chunk_us=chunk).collect()} == want
    assert series.admit(df.limit(0), ["g"], "ingest_seq", "stamp_us", 10).count() == 0


def test_brackets_across_chunks(spark):
    rng = random.Random(4)
    points = sorted(rng.sample(range(1000), 30))
    rows = spark.createDataFrame([(None, t, (t,)) for t in points], "g int, stamp_us long, point struct<t: long>")
    asked = [*range(-50, 1050, 13), *points[:5]]
    grid = spark.createDataFrame([(None, t, t) for t in asked], "g int, stamp_us long, q long")
    want = {(t, max((p for p in points if p <= t), default=None), min((p for p in points if p >= t), default=None)) for t in asked}
    for chunk in (7, 100, 10_000):
        got = series.bracket(grid, rows, ["g"], chunk_us=chunk).collect()
        assert {(r.q, r.before and r.before.t, r.after and r.after.t) for r in got} == want and len(got) == len(asked)


def test_plans_are_finite_in_every_field(spark):
    from trailmark.schemas import CHANNELS

    zero = '{"x": 0, "y": 0, "z": 0}'
    whole = '{"timestamp_us": 1, "position": P, "orientation": {"x": 0, "y": 0, "z": 0, "w": 1}, "linear_velocity": V, "linear_acceleration": A, "yaw": 0, "yaw_rate": 1, "yaw_acceleration": 2, "speed": 3}'
    whole = whole.replace("P", zero).replace("V", zero).replace("A", zero)
    nan = [whole.replace(a, b) for a, b in (('"w": 1', '"w": NaN'), ('"yaw_rate": 1', '"yaw_rate": NaN'), ('"yaw_acceleration": 2', '"yaw_acceleration": Infinity'), ('"linear_velocity": {"x": 0', '"linear_velocity": {"x": NaN'), ('"linear_acceleration": {"x": 0', '"linear_acceleration": {"x": NaN'))]
    df = spark.createDataFrame([(i, f'{{"reference_timestamp_us": 0, "planned_trajectory": {{"points": [{p}]}}}}') for i, p in enumerate([whole, *nan])], "i int, t string").select("i", F.from_json("t", CHANNELS["navigation"]).alias("r"))
    got = [r.v for r in df.orderBy("i").select(navigation.plan_valid(F.col("r.planned_trajectory"), F.col("r.reference_timestamp_us")).alias("v")).collect()]
    assert got == [True] + [False] * 5


def test_configurations_have_bounds():
    assert recording.FutureConfig().period_us == 500_000
    for bad in ({"future_us": -1}, {"interval_us": -1}, {"max_points": 0}, {"rate_hz": 0}):
        with pytest.raises(ValueError):
            recording.FutureConfig(**bad)


def test_native_times_equal_the_walk(spark):
    rng = random.Random(6)
    recorded = {g: sorted(rng.sample(range(500), 40)) for g in (1, 2)}
    asked, want = [], {}
    for n in range(120):
        g, most = rng.choice([1, 2]), rng.choice([0, 1, 2, 3, 7, 300])
        start = rng.choice([recorded[g][rng.randrange(40)], rng.randrange(recorded[g][0], recorded[g][-1])])
        until = min(recorded[g][-1], start + rng.choice([0, 3, 90, 400]))
        asked.append((g, n, start, until, most))
        grid = [t for t in recorded[g] if start <= t <= until]
        grid = grid if grid and grid[0] == start else [start, *grid]
        cap = max(most or 256, 1)
        grid = [*grid, until] if grid[-1] != until and len(grid) < cap else grid
        last = len(grid) - 1
        want[n] = grid if len(grid) <= cap else grid[:1] if cap == 1 else [grid[round(i * last / (cap - 1))] for i in range(cap)]
    requests = spark.createDataFrame(asked, "g int, request_id int, reference_us long, until_us long, max_points int")
    points = spark.createDataFrame([(g, t) for g, ts in recorded.items() for t in ts], "g int, stamp_us long")
    for chunk in (20, 10_000):
        got = {}
        for r in recording.native_times(requests, points, on=["g"], chunk_us=chunk).collect():
            got.setdefault(r.request_id, []).append(r.stamp_us)
        assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def test_robot_descriptions_are_files(spark, tmp_path):
    text = '''<?xml version="1.0"?>
<robot name="r">
  <link name="base_link"/>
  <joint name="base_to_wheel" type="fixed"><parent link="base_link"/><child link="wheel"/><origin xyz="2.8 -0.94  0.36" rpy="0 0 1.5"/></joint>
  <joint name="base_to_body" type="fixed"><parent link="base_link"/><child link="body"/></joint>
</robot>'''
    (tmp_path / "r.urdf").write_text(text)
    rows = robot.joints(robot.read_description(spark, str(tmp_path / "r.urdf"))).orderBy("child").collect()
    assert [(r.joint, r.kind, r.parent, r.child, r.xyz, r.rpy) for r in rows] == [("base_to_body", "fixed", "base_link", "body", [0.0] * 3, [0.0] * 3), ("base_to_wheel", "fixed", "base_link", "wheel", [2.8, -0.94, 0.36], [0.0, 0.0, 1.5])]
