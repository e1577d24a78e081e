"""Rules that carry state, each against the plain loop that says what it means."""

import json
import random

import numpy as np
import pytest


from trailmark.operators import actors, camera, ego, ingest, markers, navigation, series, ticks, vectormap
from trailmark.operators.navigation import gate_steps
from trailmark.schemas import CHANNELS


def updates(rng, n):
    """Navigation updates of a stream: numbers that rise, jump and repeat, times that fall now and then."""
    rows, ref = [], 0
    for i in range(n):
        ref = ref + rng.randrange(4) if rng.random() > 0.1 else rng.randrange(max(ref, 1) + 1)
        rows.append((i, rng.choice([i, rng.randrange(8), rng.randrange(60)]), ref, rng.random() < 0.7))
    return rows


def test_gate_in_chunks_equals_its_steps(spark):
    rng, rows, want = random.Random(8), [], {}
    for g in (0, 1, None):
        own = updates(rng, 150)
        _, back, passed = gate_steps(None, *([r[k] for r in own] for k in (1, 2, 3)))
        want |= {(g, r[0]): x for r, x in zip(own, zip(back, passed, strict=True), strict=True)}
        rows += [(g, *r) for r in own]
    df = spark.createDataFrame(rows, "g int, ingest_seq long, sequence long, reference_us long, valid boolean")
    for chunk in (1, 7, 40, 1000):
        got = navigation.gate(df, ["g"], chunk=chunk).collect()
        assert {(r.g, r.ingest_seq): (r.rollback, r.accepted) for r in got} == want and len(got) == len(rows)
    assert navigation.gate(df.limit(0), ["g"]).count() == 0


def test_gate_chunks_hand_on_what_the_steps_would():
    """A chunk's ladders and marks over many small streams."""
    pa = pytest.importorskip("pyarrow")
    rng = random.Random(9)
    for _ in range(300):
        rows = updates(rng, rng.randrange(1, 30))
        state, size = (0, None), rng.choice([1, 3, 8, 30])
        back, passed = [], []
        for low in range(0, len(rows), size):
            part = rows[low : low + size]
            own = navigation._Chunk(pa.table(dict(zip(("ingest_seq", "sequence", "reference_us", "valid"), map(list, zip(*part, strict=True)), strict=True))))
            marks = own.marks(*state)
            back, passed = back + marks[0].tolist(), passed + marks[1].tolist()
            state = navigation._enter(dict(zip(navigation._LADDERS, own.table_row(), strict=True)) | {"n": len(part)}, *state)
        want = gate_steps(None, *([r[k] for r in rows] for k in (1, 2, 3)))
        assert (tuple(state), back, passed) == want


def test_gate_works_on_many_streams_at_once(spark):
    """Streams of a batch lie one behind the other, and none is a group of its own."""
    pa = pytest.importorskip("pyarrow")
    rng, rows, first, want = random.Random(10), [], [], ([], [])
    for _ in range(400):
        own = updates(rng, rng.randrange(1, 12))
        first.append(len(rows))
        rows += own
        _, *marks = gate_steps(None, *([r[k] for r in own] for k in (1, 2, 3)))
        want = tuple(a + b for a, b in zip(want, marks, strict=True))
    table = pa.table(dict(zip(("ingest_seq", "sequence", "reference_us", "valid"), map(list, zip(*rows, strict=True)), strict=True)))
    none = np.zeros(len(first), np.int64)
    assert tuple(x.tolist() for x in navigation._Chunk(table, np.array(first)).marks(none, none, none > 0)) == want
    df = spark.range(3000).selectExpr("id % 1000 AS g", "id * 1000000 AS ingest_seq", "id % 7 AS sequence", "id AS reference_us", "true AS valid")
    got = navigation.gate(df, ["g"])
    assert "FlatMapGroups" not in got._jdf.queryExecution().toString()
    assert got.count() == 3000


def walk(packets, config):
    """Histories of a rollout as a process keeps them: buffers by track, and eviction by any packet's time."""
    buffers, seen, out = {}, {}, {}
    for seq, ref, states in packets:
        for track, t in states:
            ring = buffers.setdefault(track, [])
            if not ring or ring[-1][0] != t:
                ring.append((t, seq))
                del ring[: -config.capacity]
            seen[track] = ref
        for track in [k for k, last in seen.items() if ref - last > config.stale_us]:
            del seen[track], buffers[track]
        for track, ring in buffers.items():
            inside = [t for t, _ in ring if ref - config.history_us <= t <= ref]
            if inside:
                out[seq, track] = inside
    return out


def test_histories_with_evictions_equal_the_walk(spark):
    rng = random.Random(11)
    config = actors.ActorConfig(history_us=200, period_us=1, stale_us=50, max_points=7)
    rows, packets, want = [], [], {}
    for g in range(4):
        ref, own = 0, []
        for seq in range(60):
            ref += rng.choice([0, 3, 10, 30, 70])
            states = [(k, ref - rng.choice([0, 0, 1])) for k in ("a", "b", "c") if rng.random() < 0.35]
            own.append((seq, ref, states))
            packets.append((g, seq, ref))
            rows += [(g, seq, ref, k, t) for k, t in states]
        want |= {(g, *k): v for k, v in walk(own, config).items()}
    states = spark.createDataFrame(rows, "g int, ingest_seq long, ref_us long, track_id string, stamp_us long")
    out = actors.history(states, spark.createDataFrame(packets, "g int, ingest_seq long, ref_us long"), config, by=["g"])
    got = {(r.g, r.ingest_seq, r.track_id): sorted(p.t for p in r.valid) for r in out.collect()}
    assert got == {k: sorted(v) for k, v in want.items()}
    assert any(len(v) == 7 for v in want.values())


def test_another_tracks_packet_evicts(spark):
    config = actors.ActorConfig(history_us=20_000_000, stale_us=5_000_000, period_us=1_000_000)
    rows = [(0, "a", 0), (1, "b", 8_000_000), (2, "a", 10_000_000)]
    df = spark.createDataFrame([(1, i, r, k, r) for i, k, r in rows], "g int, ingest_seq long, ref_us long, track_id string, stamp_us long")
    packets = df.select("g", "ingest_seq", "ref_us")
    last = lambda p: {r.track_id: [x.t for x in r.points] for r in actors.history(df, p, config, by=["g"]).where("ingest_seq = 2").collect()}
    assert last(packets) == {"a": [10_000_000], "b": [8_000_000]}
    assert last(packets.where("ingest_seq <> 1"))["a"] == [0, 10_000_000]  # no packet came while it was stale


def test_histories_of_dense_packets_join_by_equality_alone(spark):
    """A packet meets the tracks of its slot, not all their rows; and lists are thinned together."""
    config = actors.ActorConfig(history_us=30, period_us=4, stale_us=1000, max_points=5)
    df = spark.range(900).selectExpr("1 AS g", "id AS ingest_seq", "id AS ref_us", "cast(id % 3 AS string) AS track_id", "id AS stamp_us")
    out = actors.history(df, df.select("g", "ingest_seq", "ref_us"), config, by=["g"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    joins = [x for x in plan.splitlines() if "Join" in x and "_slot" in x]
    assert joins and not [x for x in joins if ">=" in x] and "aggregate(" not in plan
    got = {(r.ingest_seq, r.track_id): [p.t for p in r.points] for r in out.collect()}
    assert len(got) == 900 * 3 - 3 and got[899, "2"][-1] == 899  # the first packet sees one track, the second two
    nothing = spark.createDataFrame([(None,), ([],), ([(1,), (2,), (9,)],)], "p array<struct<t: long>>")
    assert [r.q and [x.t for x in r.q] for r in nothing.select(series.downsample("p", "t", 4, 2).alias("q")).collect()] == [None, [], [1, 9]]


def test_records_tell_what_is_missing_at_any_depth(spark):
    zero, w = {"x": 0, "y": 0, "z": 0}, {"x": 0, "y": 0, "z": 0, "w": 1}
    vectors = ("linear_velocity", "angular_velocity", "linear_acceleration", "angular_acceleration")
    whole = {"timestamp_us": 1, "position": zero, "orientation": w, "speed": 1, **{c: zero for c in vectors}}
    cases = [(whole, None), ({**whole, "position": {"x": 1}}, "missing position.y"), ({**whole, "orientation": {}}, "missing orientation.x"), ({k: v for k, v in whole.items() if k != "angular_velocity"}, "missing angular_velocity"), ({**whole, "pose_frame_id": None}, None)]
    state = {"timestamp_us": 1, "position": zero, "orientation": w, "linear_velocity": zero, "linear_acceleration": zero, "yaw": 0, "yaw_rate": 0, "yaw_acceleration": 0, "speed": 0}
    actor = {"track_id": "t", "label_class": "c", "is_static": False, "dimensions": zero, "current_state": state}
    snapshot = lambda *a: {"message_type": "actor_snapshot", "timestamp_us": 1, "actors": list(a)}
    nested = [
        (snapshot(), None), (snapshot(actor), None), (snapshot(actor, {k: v for k, v in actor.items() if k not in ("track_id", "current_state")}), "missing actors[].track_id"),
        (snapshot(actor, {**actor, "current_state": {**state, "position": {"x": 0, "y": 0}}}), "missing actors[].current_state.position.z"), (snapshot(None), "missing actors[]"),
        (snapshot({**actor, "available_future_points": [state, {**state, "speed": None}]}), "missing actors[].available_future_points[].speed"), ({**snapshot(), "message_type": "x"}, "message_type"),
    ]
    for channel, own in (("ego", cases), ("actors", nested)):
        df = spark.createDataFrame([(i, json.dumps(x)) for i, (x, _) in enumerate(own)] + [(99, "{")], "ingest_seq long, payload string")
        got = {r.ingest_seq: r.reason for r in ingest.records(df, channel).collect()}
        assert got == {i: reason for i, (_, reason) in enumerate(own)} | {99: "malformed"}
        good, bad = ingest.parse(df, channel)
        assert good.count() + bad.count() == len(own) + 1 and bad.columns == ["ingest_seq", "payload", "reason"]
        assert ingest.records(df, channel)._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_calibrations_of_any_shape(spark):
    pose = {"vec": {"z": 3, "y": "2.5", "x": 1.0, "extra": [1]}, "quat": {"x": 0, "y": 0.0, "z": 0, "w": 1e-5}}
    metas = [
        {"z": None, "available_camera": {"rig_to_camera": pose, "é": "ü\n"}, "a": [1, 2.50, {"b": True, "a": []}, {}], "n": 12345678901234567890},
        {"available_camera": {"rig_to_camera": {"position": {"x": 1, "y": 2}, "rotation": pose["quat"]}}}, {"available_camera": []}, {"available_camera": {"rig_to_camera": {"vec": None, "translation": pose["vec"], "quat": pose["quat"]}}},
    ]
    names = camera.CAMERAS
    rows = [(10 * i + 5, json.dumps({"camera_logical_id": names[i], "end_timestamp_us": 1, "camera_metadata": m})) for i, m in enumerate(metas)]
    rows += [(0, json.dumps({"camera_logical_id": names[0], "end_timestamp_us": 0, "camera_metadata": None})), (6, json.dumps({"camera_logical_id": names[0], "end_timestamp_us": 2, "camera_metadata": {"late": 1}}))]
    once = camera.calibration_once(ingest.parse(spark.createDataFrame(rows, "ingest_seq long, payload string"), "camera")[0])
    texts = {r.camera_logical_id: r.json for r in camera.calibration_json(once).collect()}
    assert texts == {names[i]: json.dumps(m, indent=2, sort_keys=True) for i, m in enumerate(metas)}
    found = camera.static_transforms(once, camera.camera_table(spark)).collect()  # a pose that is null or lacks an axis gives none
    assert [(r.camera, tuple(r.translation), tuple(r.rotation)) for r in found] == [(names[0], (1.0, 2.5, 3.0), (0.0, 0.0, 0.0, 1e-5))]


def test_brackets_take_ties_in_order(spark):
    points = spark.createDataFrame([(1, 10, n, (n,)) for n in (5, 3, 9, 7)] + [(1, 40, n, (n,)) for n in (12, 11)], "g int, stamp_us long, n long, point struct<n: long>").repartition(3)
    grid = spark.createDataFrame([(1, t, t) for t in (5, 10, 25, 40, 50)], "g int, stamp_us long, q long")
    for chunk in (8, 1000):
        got = {r.q: (r.before and r.before.n, r.after and r.after.n) for r in series.bracket(grid, points, ["g"], seq="n", chunk_us=chunk).collect()}
        assert got == {5: (None, 3), 10: (9, 3), 25: (9, 11), 40: (12, 11), 50: (12, None)}


def test_layer_arrays_equal_a_dictionary_of_markers(spark):
    rng, rows, want = random.Random(12), [], set()
    for g in range(3):
        latest = {}
        for seq in range(80):
            layer, action = rng.randrange(1, 5), rng.choice(["ADD", "ADD", "DELETE"])
            rows.append((g, seq, layer, action, seq * 10))
            latest[layer] = (action, seq * 10)
            want |= {(g, seq, at, k, *m) for at, (k, m) in enumerate(latest.items())}
            if action == "DELETE":
                del latest[layer]
    df = spark.createDataFrame(rows, "g int, seq long, marker_id int, action string, n_points int")
    got = navigation.layer_arrays(df, [1, 2, 3, 4], by=["g"]).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_layer_snapshots_are_the_last_arrays(spark):
    """Runs of any length across chunks, removals and layers that come again; and messages are scanned once."""
    rng, rows, want = random.Random(14), [], {}
    for g in range(40):
        latest, n = {}, rng.randrange(1, 60)
        for seq in range(n):
            layer, action = rng.randrange(1, 4), "ADD" if rng.random() < rng.choice([0.4, 0.97]) else "DELETE"
            rows.append((g, seq, layer, action, seq * 10))
            latest[layer] = (action, seq * 10)
            want[g] = [(seq, at, k, *m) for at, (k, m) in enumerate(latest.items())]
            if action == "DELETE":
                del latest[layer]
    df = spark.createDataFrame(rows, "g int, seq long, marker_id int, action string, n_points int")
    for chunk in (1, 4, 17, 1000):
        out = navigation.layer_snapshot(df, by=["g"], chunk=chunk)
        got = {}
        for r in sorted(tuple(r) for r in out.collect()):
            got.setdefault(r[0], []).append(r[1:])
        assert got == want
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_last_values_across_chunks(spark):
    rng = random.Random(13)
    rows = [(i % 2, i, rng.choice("abc"), i * 10 if rng.random() < 0.9 else None) for i in range(120)]
    df = spark.createDataFrame(rows, "g int, n long, k string, v long")
    want, held = {}, {}
    for g, n, k, v in rows:
        held[g, k] = held.get((g, k)) if v is None else v
        want[n] = tuple(held.get((g, c)) for c in "abc")
    for chunk in (5, 1000):
        assert {r.n: (r.a, r.b, r.c) for r in series.last_values(df, ["g"], "n", "k", ["a", "b", "c"], "v", chunk=chunk).collect()} == want


FRAMES = ("map", "base_link", "base_link")


def path_at(rows, tick, config):
    """The executed path as a process would publish it behind the rows up to a tick."""
    samples, received, stored, frames = [], None, None, None
    for _, t, *own in rows:
        if t > tick:
            break
        if received is not None and (t < received or own != frames):
            samples, stored = [], None
        received, frames = t, own
        if stored is None or config.interval_us == 0 or t - stored >= config.interval_us:
            samples.append(t)
            stored = t
        if config.history_us:
            samples = [s for s in samples if s >= received - config.history_us]
        samples = samples[-config.max_points :]
    return samples


@pytest.mark.parametrize(("interval", "history", "most"), [(10, 0, 4), (10, 60, 512), (7, 45, 3), (0, 20, 2), (60, 30, 5)])
def test_paths_at_ticks_equal_the_walk(spark, interval, history, most):
    rng, rows, want, clock = random.Random(14), [], {}, []
    config = ego.PathConfig(interval_us=interval, history_us=history, max_points=most)
    for g in range(3):
        t, frame, own = 0, "map", []
        for seq in range(60):
            t += rng.choice([0, 1, 4, 9, 40])
            frame = rng.choice(["map", "odom"]) if rng.random() < 0.07 else frame
            own.append((seq, t, frame, "base_link", "base_link"))
        rows += [(g, *r) for r in own]
        for tick, at in enumerate(range(-20, t + 30, 13)):
            clock.append((g, tick, at))
            if path := path_at(own, at, config):
                want[g, tick] = (path[0], path[-1] - path[0], len(path))
    df = spark.createDataFrame(rows, "g int, ingest_seq long, stamp_us long, pose_frame_id string, child_frame_id string, dynamics_frame_id string")
    out = ticks.path_snapshots(df, spark.createDataFrame(clock, "g int, tick int, tick_us long"), config, ["g"])
    assert {(r.g, r.tick): (r.reference_us, r.duration_us, r.n_points) for r in out.collect()} == want


def test_retention_across_chunks(spark):
    rng = random.Random(15)
    rows, t = [], 0
    for i in range(100):
        t += rng.randrange(5)
        rows.append((i % 2, i, t))
    df = spark.createDataFrame(rows, "g int, n long, t long")
    latest = spark.createDataFrame([(0, t + 20), (1, t)], "g int, latest_us long")
    for history, most in ((0, 7), (40, 100), (40, 6), (10, 9)):
        want = set()
        for g, end in ((0, t + 20), (1, t)):
            own = [r for r in rows if r[0] == g and (not history or r[2] >= end - history)]
            want |= set(own[-most:])
        for chunk in (6, 1000):
            got = series.newest(df, ["g"], "t", "n", history_us=history, most=most, latest=latest, chunk=chunk).collect()
            assert {tuple(r) for r in got} == want


def test_labels_say_track_and_static(spark):
    row = ("car", "7", True, (1.0, 1.0, 2.0), (0.0, 0.0, 0.0), 1.25, (0.0, 0.0, 0.0))
    df = spark.createDataFrame([row, ("bus", "8", False, *row[3:])], "label_class string, track_id string, is_static boolean, dimensions struct<x: double, y: double, z: double>, position struct<x: double, y: double, z: double>, speed double, linear_velocity struct<x: double, y: double, z: double>")
    assert [r.text for r in markers.labels(df).orderBy("track_id").collect()] == ["car #7 static\n1.2 m/s", "bus #8\n1.2 m/s"]
    assert [markers.boxes(df, alpha).first().color.a for alpha in (-1, 0.5, 7)] == [0.0, 0.5, 1.0]
    packets = df.selectExpr("*", "1 AS ingest_seq", "0 AS ordinal", "'map' AS pose_frame_id", "'odom' AS dynamics_frame_id")
    assert {(r.kind, r.frame) for r in markers.actor_markers(packets).where("at >= 0").collect()} == {(0, "map"), (1, "map"), (2, "odom")}
    assert {r.kind for r in markers.actor_markers(packets, markers.ActorMarkerConfig(labels=False, arrows=False)).collect()} == {0}


def test_map_layers_are_shown_as_asked(spark):
    line = {"points": [{"x": i, "y": 0, "z": 1} for i in range(2)]}
    packet = {
        "message_type": "vector_map", "scene_id": "s", "map_id": "m", "frame_id": "odom", "extent": {"minimum": {"x": 0, "y": 0, "z": 0}, "maximum": {"x": 1, "y": 1, "z": 1}},
        "lanes": [{"id": "l", "centerline": line, "left_boundary": line, "right_boundary": {}}], "traffic_signs": [{"id": "t", "sign_type": "S", "position": {"x": 0, "y": 0, "z": 2}}],
    }
    maps = vectormap.valid_maps(ingest.parse(spark.createDataFrame([(1, json.dumps(packet))], "ingest_seq long, payload string"), "map")[0])
    rows = lambda config: [(r.layer, r.part, r.ns, r.frame, r.width, r.line[0].z if r.line else None, r.text) for r in markers.map_markers(maps, ["map_id"], config).orderBy("layer", "at", "part").collect()]
    assert rows(markers.MapMarkerConfig()) == [
        (0, 0, "", "odom", 0.0, None, None), (1, 0, "map/lane_centerlines", "odom", 0.02, 1.04, None), (2, 0, "map/lane_left_boundaries", "odom", 0.06, 1.05, None),
        (5, 0, "map/traffic_signs", "odom", 0.0, 2.04, None), (5, 1, "map/traffic_sign_labels", "odom", 0.0, 2.04 + 0.7, "S\n#t"),
    ]
    few = markers.MapMarkerConfig(centerlines=False, sign_labels=False, boundary_width=0.5, z_offset=1.0)
    assert [(r[0], r[4], r[5]) for r in rows(few)] == [(0, 0.0, None), (2, 0.5, 2.01), (5, 0.0, 3.0)]
    for make in (lambda: markers.MapMarkerConfig(road_edge_width=-1), lambda: markers.NavigationMarkerConfig(widths={"route": -1}), lambda: markers.NavigationMarkerConfig(offsets={"x": 1}), lambda: ticks.MapClientConfig(republish_us=0)):
        with pytest.raises(ValueError):
            make()
    assert ticks.MapClientConfig(request_us=5, republish_us=1).periods == (100_000, 100_000)


def test_answers_without_a_map_change_nothing(spark):
    cached = spark.createDataFrame([(1, 10, 1, 1, "s"), (1, 20, 2, 2, ""), (1, 20, 3, 3, "s"), (1, 30, 4, 4, "")], "g int, stamp_us long, ingest_seq long, revision long, scene_id string")
    clock = spark.createDataFrame([(1, n, t) for n, t in enumerate((5, 10, 15, 20, 25, 30, 40))], "g int, tick int, tick_us long")
    got = [(r.revision, r.action) for r in ticks.map_polls(clock, cached, ["g"]).orderBy("tick").collect()]
    assert got == [(None, "none"), (1, "publish"), (1, "republish"), (3, "publish"), (3, "republish"), (3, "none"), (3, "none")]


def test_every_channel_has_a_schema():
    assert set(CHANNELS) == {"ego", "actors", "map", "recording", "navigation", "camera"}
