"""Live ports and streams with state: bounds, restarts, clocks, and the rows of the batch twins."""

import json
import random
import socket
import time

import pytest
from test_streaming import drained, framed, stream_of

from trailmark.operators import actors, camera, ego, ingest, recording, ticks
from trailmark.sources.framed import Captures, FramedSource, PortsSource
from trailmark.sources.tables import retain
from trailmark.streaming import periodic, stateful


@pytest.fixture
def states(spark):
    """A session whose state store has maps and timers."""
    before = {k: spark.conf.get(k, None) for k in stateful.STATE_STORE}
    for k, v in stateful.STATE_STORE.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v) if v else spark.conf.unset(k)


def until(true, seconds=60):
    end = time.time() + seconds
    while not true() and time.time() < end:
        time.sleep(0.2)
    assert true()


def test_a_burst_keeps_the_newest_frames():
    reader = FramedSource({"port": "29881", "images": "true", "queueDepth": "32", "maxPacketsPerTrigger": "16"}).simpleStreamReader(None)
    try:
        reader.read({"n": 0})
        with socket.create_connection(("127.0.0.1", 29881)) as sender:
            for i in range(1000):
                sender.sendall(framed(json.dumps({"n": i}), b"\xff" * 20_000))
            until(lambda: reader.ring.next == 1000)
        rows, end = reader.read({"n": 0})
        rows = list(rows)
        assert [(n, json.loads(text)["n"], dropped, len(data)) for n, text, dropped, data in rows] == [(n, n, 968, 20_000) for n in range(968, 984)]
        again, same = reader.read({"n": 0})  # nothing more leaves the ring before the batch is over
        assert list(again) == rows and same == end == {"n": 984}
        reader.commit(end)
        more, end = reader.read(end)
        assert [r[0] for r in more] == list(range(984, 1000)) and reader.ring.dropped == 968 and len(reader.taken) == 16
    finally:
        reader.close()


def test_captures_outlive_their_reader(tmp_path):
    uri = f"file://{tmp_path}"
    options = {"ports": "29882,29883", "captures": uri, "queueDepth": "4"}
    reader = PortsSource(options).streamReader(None)
    try:
        assert reader.latestOffset() == reader.initialOffset() == {"29882": 0, "29883": 0}
        for port, n in ((29882, 3), (29883, 6)):
            with socket.create_connection(("127.0.0.1", port)) as sender:
                for i in range(n):
                    sender.sendall(framed(f"[{port}, {i}]"))
            until(lambda port=port, n=n: reader.ports[port].ring.next == n)
        end = reader.latestOffset()
        assert end == {"29882": 3, "29883": 6}
    finally:
        reader.stop()
    other = PortsSource(options).streamReader(None)  # after a restart
    try:
        parts = other.partitions({"29882": 1, "29883": 0}, end)
        rows = [row for part in parts for row in other.read(part)]
        assert rows == [(29882, 1, "[29882, 1]", 0), (29882, 2, "[29882, 2]", 0)] + [(29883, i, f"[29883, {i}]", 2) for i in range(2, 6)]
        assert other.latestOffset() == end
        other.commit(end)
        with socket.create_connection(("127.0.0.1", 29882)) as sender:
            sender.sendall(framed("[]"))
        until(lambda: other.ports[29882].ring.next == 4)
        assert other.latestOffset()["29882"] == 4 and [b for _, b, _ in Captures(uri).spans(29882)] == [3, 4]
        other.commit({"29882": 4, "29883": 6})
        assert [b for _, b, _ in Captures(uri).spans(29882)] == [4]
    finally:
        other.stop()


def test_ports_as_a_stream_with_a_restart(spark, tmp_path):
    spark.dataSource.register(PortsSource)

    def run():
        source = spark.readStream.format("framed_ports").option("ports", "29884,29885").option("captures", f"file://{tmp_path}/captures").option("queueDepth", "100").load()
        return source.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).start()

    def send(port, low, high):
        for _ in range(100):
            try:
                with socket.create_connection(("127.0.0.1", port)) as sender:
                    for i in range(low, high):
                        sender.sendall(framed(json.dumps([port, i])))
                return
            except ConnectionRefusedError:
                time.sleep(0.2)

    rows = lambda: [tuple(json.loads(r.payload)) for r in spark.read.schema("port int, ingest_seq long, payload string").parquet(str(tmp_path / "out")).collect()]
    for low, high in ((0, 5), (5, 9)):
        query = run()
        for port in (29884, 29885):
            send(port, low, high)
        until(lambda high=high: len(rows()) == 2 * high)
        query.stop()
    assert sorted(rows()) == [(p, i) for p in (29884, 29885) for i in range(9)]


def test_rings_of_stream_batch_and_loop_agree(states, tmp_path):
    rng = random.Random(21)
    config = actors.ActorConfig(history_us=200, period_us=1, stale_us=50, max_points=4)
    rows, want = [], {}
    for g in range(2):
        ref, buffers, seen = 0, {}, {}
        for seq in range(50):
            ref += rng.choice([0, 5, 20, 60])
            own = [(k, ref - rng.choice([0, 0, 3])) for k in "abc" if rng.random() < 0.4]
            for k, t in own:
                ring = buffers.setdefault(k, [])
                if not ring or ring[-1] != t:
                    ring.append(t)
                    del ring[:-4]
                seen[k] = ref
                want[g, seq, k] = list(ring)
            for k in [k for k, last in seen.items() if ref - last > config.stale_us]:
                del seen[k], buffers[k]
            rows += [(g, seq, ref, k, t) for k, t in own] or [(g, seq, ref, None, None)]
    rows.sort(key=lambda r: r[1])
    schema = "g int, ingest_seq long, ref_us long, track_id string, stamp_us long"
    got = drained(stateful.track_rings(stream_of(states, rows, schema, tmp_path / "in", parts=2), "g", config), "rings_stream")
    assert {(r.g, r.ingest_seq, r.track_id): r.ring for r in got} == want
    df = states.createDataFrame(rows, schema)
    packets = df.select("g", "ingest_seq", "ref_us").distinct()
    batch = actors.rings(df.where("track_id IS NOT NULL"), packets, config, by=["g"], time="stamp_us").collect()
    assert {(r.g, r.ingest_seq, r.track_id): [x.t for x in r.ring] for r in batch} == want


def test_calibration_once_over_batches_and_restarts(states, tmp_path):
    schema = "camera_logical_id string, ingest_seq long, camera_metadata string"
    first = [("a", 1, None), ("a", 3, "three"), ("a", 2, "two"), ("b", 4, None)]
    later = [("a", 5, "five"), ("b", 7, "seven"), ("b", 6, None), ("c", 8, "eight")]

    def run(rows):
        states.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        once = stateful.calibration_once(states.readStream.schema(schema).parquet(str(tmp_path / "in")))
        once.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination()

    run(first)
    run(later)
    got = {(r.camera_logical_id, r.ingest_seq, r.camera_metadata) for r in states.read.parquet(str(tmp_path / "out")).collect()}
    batch = camera.calibration_once(states.createDataFrame(first + later, schema)).collect()
    assert got == {(r.camera_logical_id, r.ingest_seq, r.camera_metadata) for r in batch} == {("a", 2, "two"), ("b", 7, "seven"), ("c", 8, "eight")}


def test_revisions_of_stream_and_batch_agree_over_a_restart(states, tmp_path):
    rng = random.Random(22)
    point = lambda *t: [(x,) for x in t]
    rows = [(i % 2, i, rng.choice(["s", "t", None]), rng.choice([1, 2]), rng.choice([point(1, 2), point(), point(2, 2)])) for i in range(40)]
    schema = "slot long, ingest_seq long, scene_id string, source_revision long, points array<struct<timestamp_us: long>>"
    for part in (rows[:25], rows[25:]):
        states.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        packets = states.readStream.schema(schema).parquet(str(tmp_path / "in")).withColumn("good", recording.increasing("points"))
        out = stateful.revisions(packets.drop("points"), "slot", ["scene_id", "source_revision"], good="good")
        out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination()
    got = {(r.slot, r.ingest_seq, r.scene_id, r.source_revision, r.status, r.revision) for r in states.read.parquet(str(tmp_path / "out")).collect()}
    batch = recording.cache(states.createDataFrame(rows, schema), by=["slot"]).collect()
    assert got == {(r.slot, r.ingest_seq, r.scene_id, r.source_revision, r.status, r.revision) for r in batch}


def test_paths_are_published_on_the_clock(states, tmp_path):
    rng, rows = random.Random(23), []
    for g in ("a", "b"):
        t = 0
        for seq in range(40):
            t = t + rng.randrange(30) if seq != 15 else 0
            rows.append((g, seq, t, "map", "base_link", "base_link"))
    schema = "g string, ingest_seq long, stamp_us long, pose_frame_id string, child_frame_id string, dynamics_frame_id string"
    config = ego.PathConfig(interval_us=20, history_us=300, max_points=9)
    stream = stateful.published_paths(stream_of(states, rows, schema, tmp_path / "in", parts=2), "g", config, 300)
    query = stream.writeStream.format("memory").queryName("paths_live").outputMode("append").start()
    df = states.createDataFrame(rows, schema)
    path = ego.executed_path(df, config, by=["g"])
    want = {(r.g, r.segment, r.ingest_seq, r.stamp_us, r.offset_us) for r in path.collect()}
    newest = {g: max(s for x, s, *_ in want if x == g) for g in ("a", "b")}
    want = {w for w in want if w[1] == newest[w[0]]}

    def shown():
        held = states.table("paths_live").collect()
        last = {g: max((r.published_ms for r in held if r.g == g), default=None) for g in ("a", "b")}
        return {(r.g, r.segment, r.ingest_seq, r.stamp_us, r.offset_us) for r in held if r.published_ms == last[r.g]}

    until(lambda: shown() == want, 90)
    before = states.table("paths_live").select("published_ms").distinct().count()
    until(lambda: states.table("paths_live").select("published_ms").distinct().count() > before, 30)  # again, without new rows
    query.stop()
    assert shown() == want


def test_map_client_ticks_equal_the_batch_rule(spark, tmp_path):
    upsert = retain(["slot"], str(tmp_path / "maps"))
    schema = "slot long, ingest_seq long, scene_id string, revision long"
    news = {1: [(1, 1, "s", 1)], 2: [(2, 2, "", 1)], 4: [(1, 3, "t", 2), (2, 4, "s", 2)], 5: [(1, 5, "", 3)], 6: [(1, 6, "t", 4)]}
    client = periodic.map_client(spark, str(tmp_path / "maps"), str(tmp_path / "client"))
    cached, clock = [], []
    for tick in range(8):
        if tick in news:
            upsert(spark.createDataFrame(news[tick], schema), tick)
            cached += [(s, n, 10 * tick, scene, rev) for s, n, scene, rev in news[tick]]
        client(tick)
        if tick == 4:
            client(tick)  # a tick that comes again says the same
        clock += [(s, tick, 10 * tick) for s in (1, 2)]
    sent = spark.read.parquet(str(tmp_path / "client" / "actions")).collect()
    batch = ticks.map_polls(spark.createDataFrame(clock, "slot long, tick int, tick_us long"), spark.createDataFrame(cached, "slot long, ingest_seq long, stamp_us long, scene_id string, revision long"), ["slot"]).collect()
    want = {(r.slot, r.tick): r.action for r in batch}
    got = {(r.slot, r.tick): r.action for r in sent}
    assert {k: v for k, v in want.items() if v != "none"} == {k: v for k, v in got.items() if v != "none"} and all(want[k] == v for k, v in got.items())


MOTION = "struct<timestamp_us: long, position: struct<x: double, y: double, z: double>, orientation: struct<x: double, y: double, z: double, w: double>, linear_velocity: struct<x: double, y: double, z: double>, linear_acceleration: struct<x: double, y: double, z: double>, yaw: double, yaw_rate: double, yaw_acceleration: double, speed: double>"


def test_futures_are_published_on_a_clock(spark, tmp_path):
    zero, points = (0.0, 0.0, 0.0), str(tmp_path / "points")
    rows = [(1, t, (t, (float(t), 0.0, 0.0), (0.0, 0.0, 0.0, 1.0), zero, zero, 0.0, 0.0, 0.0, 1.0)) for t in range(0, 101, 10)]
    recorded = spark.createDataFrame(rows, f"slot long, stamp_us long, point {MOTION}")
    recorded.write.parquet(points)
    retain(["slot"], str(tmp_path / "rec"))(spark.createDataFrame([(1, 1, 1, 0, 100)], "slot long, ingest_seq long, revision long, start_us long, end_us long"), 0)
    clock = retain(["slot"], str(tmp_path / "clock"))
    config = recording.FutureConfig(future_us=25, interval_us=7, max_points=9)
    client = periodic.future_client(spark, str(tmp_path / "rec"), points, str(tmp_path / "clock"), str(tmp_path / "out"), config)
    now = [5, 5, 42, 90, 400]
    done = []

    def publish(number):
        if number < len(now):
            clock(spark.createDataFrame([(1, number, now[number])], "slot long, ingest_seq long, stamp_us long"), number)
            client(number)
            done.append(number)

    query = periodic.every(spark, "200 milliseconds", publish, str(tmp_path / "ck"))
    until(lambda: len(done) >= len(now), 90)
    query.stop()
    got = sorted((r.tick, r.stamp_us, r.offset_us, r.point.position.x) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    asked = recording.tick_requests(spark.createDataFrame([(1, n, t) for n, t in enumerate(now)], "slot long, request_id int, tick_us long"), config)
    status = recording.answer_status(asked, spark.createDataFrame([(1, 1, 0, 100)], "slot long, revision long, start_us long, end_us long"), on=["slot"])
    batch = recording.answers(status, recorded, on=["slot"]).collect()
    assert got == sorted((r.request_id, r.stamp_us, r.offset_us, r.point.position.x) for r in batch) and {r[0] for r in got} == {0, 1, 2, 3}


def test_requests_are_answered_from_what_is_retained(spark, tmp_path):
    schema, maps = "slot long, requested_scene_id string, known_revision long", str(tmp_path / "maps")
    spark.createDataFrame([(1, "", 0), (1, "s", 3), (1, "t", 3), (2, "", 0)], schema).write.parquet(str(tmp_path / "in"))
    requests = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    retain(["slot"], maps)(spark.createDataFrame([(1, 9, "s", 3)], "slot long, ingest_seq long, scene_id string, revision long"), 0)
    periodic.answer_stream(requests, maps, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    assert sorted((r.slot, r.requested_scene_id, r.status) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [(1, "", "ok"), (1, "s", "not_modified"), (1, "t", "scene_mismatch"), (2, "", "no_map")]


def test_packets_are_counted_as_they_pass(spark, tmp_path):
    rows = [(i, c) for i, c in enumerate(["ego", "ego", "map", None, "x", "camera", "ego"])]
    counts = ingest.TopicCounts("packets")
    spark.streams.addListener(counts)
    try:
        stream = ingest.observed(stream_of(spark, rows, "ingest_seq long, channel string", tmp_path / "in", parts=2), "packets")
        query = stream.writeStream.format("noop").trigger(availableNow=True).start()
        query.awaitTermination()
        until(lambda: sum(counts.totals.values()) == len(rows), 30)
    finally:
        spark.streams.removeListener(counts)
    assert len(counts.batches) == 2 and {k: v for k, v in counts.totals.items() if v} == {"ego": 3, "map": 1, "camera": 1, "other": 2}
    assert sum(counts.batches[0].values()) == 4
