"""Streams give the rows of their batch twins, and framed packets arrive whole."""

import json
import random
import socket
import struct
import threading
import time

import pytest

from trailmark.operators import navigation
from trailmark.operators.series import segment
from trailmark.sources.framed import Closed, FramedSource, frames, packets, read_captures
from trailmark.sources.tables import append, retain, retained, topic, versions
from trailmark.streaming import stateful


def stream_of(spark, rows, schema, folder, parts=3):
    step = -(-len(rows) // parts)
    for i in range(parts):
        spark.createDataFrame(rows[i * step : (i + 1) * step], schema).coalesce(1).write.mode("append").parquet(str(folder))
        time.sleep(0.05)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder))


def drained(df, name):
    query = df.writeStream.format("memory").queryName(name).outputMode("append").start()
    query.processAllAvailable()
    query.stop()
    return df.sparkSession.table(name).collect()


def test_path_points_stream_equals_batch(spark, tmp_path):
    rng, rows, t = random.Random(2), [], 0
    for i in range(60):
        t = t + rng.randrange(40) if rng.random() < 0.93 else rng.randrange(50)
        rows.append((i % 2, i, t))
    schema = "g int, ingest_seq long, stamp_us long"
    got = drained(stateful.path_points(stream_of(spark, rows, schema, tmp_path / "in"), "g", 50), "path_stream")
    want = set()
    for g in (0, 1):
        received = stored = None
        for _, i, t in (r for r in rows if r[0] == g):
            if received is not None and t < received:
                stored = None
            received = t
            if stored is None or t - stored >= 50:
                stored = t
                want.add((g, i, t))
    assert {(r.g, r.ingest_seq, r.stamp_us) for r in got} == want
    batch = segment(spark.createDataFrame(rows, schema), "ingest_seq", ["stamp_us"], lambda a, b: b["stamp_us"] < a["stamp_us"], by=["g"])
    segments = {(r.g, r.ingest_seq): r.segment for r in batch.collect()}
    assert all(segments[r.g, r.ingest_seq] == r.segment for r in got)


def test_gate_stream_equals_batch(spark, tmp_path):
    rng = random.Random(4)
    rows = [(i % 2, i, rng.randrange(6), 10 * i - rng.choice([0, 0, 0, 400]), rng.random() < 0.8) for i in range(60)]
    schema = "g int, ingest_seq long, sequence long, reference_us long, valid boolean"
    got = drained(stateful.gate(stream_of(spark, rows, schema, tmp_path / "in"), "g"), "gate_stream")
    want = navigation.gate(spark.createDataFrame(rows, schema), ["g"]).where("accepted").collect()
    assert {(r.g, r.ingest_seq) for r in got} == {(r.g, r.ingest_seq) for r in want}


def framed(text, image=None):
    raw = text.encode()
    out = struct.pack("!I", len(raw)) + raw
    return out if image is None else out + struct.pack("!Q", len(image)) + image


def test_captures(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(framed('{"n": 1}') + framed('{"n": 2}') + b"\x00\x00")
    (tmp_path / "b.bin").write_bytes(framed("{}") + struct.pack("!I", 0) + framed("{}"))
    assert sorted((r.at, r.payload) for r in read_captures(spark, str(tmp_path)).collect()) == [(0, '{"n": 1}'), (0, "{}"), (1, '{"n": 2}')]
    assert list(frames(framed("{}", b"\xff\xd8") + framed("{}", b"")[:-1], images=True)) == [("{}", b"\xff\xd8")]


def test_sockets_deliver_every_packet(spark):
    spark.dataSource.register(FramedSource)
    for protocol, port in (("tcp", 29871), ("udp", 29872)):
        query = spark.readStream.format("framed").option("port", port).option("protocol", protocol).load().writeStream.format("memory").queryName(f"live_{protocol}").start()

        def send(protocol=protocol, port=port):
            kind = socket.SOCK_STREAM if protocol == "tcp" else socket.SOCK_DGRAM
            for _ in range(100):
                try:
                    with socket.socket(socket.AF_INET, kind) as s:
                        s.connect(("127.0.0.1", port))
                        for i in range(20):
                            text = json.dumps({"n": i})
                            s.sendall(framed(text) if protocol == "tcp" else text.encode())
                        return
                except ConnectionRefusedError:
                    time.sleep(0.2)

        time.sleep(3 if protocol == "udp" else 0)
        thread = threading.Thread(target=send)
        thread.start()
        until = time.time() + 40
        while time.time() < until and spark.table(f"live_{protocol}").count() < 20:
            time.sleep(0.5)
        query.stop()
        thread.join()
        assert [json.loads(r.payload)["n"] for r in spark.table(f"live_{protocol}").orderBy("ingest_seq").collect()] == list(range(20))


def test_sinks(spark, tmp_path):
    rows = [(1, "a", 10), (2, "b", 20), (3, "a", 30)]
    schema = "ingest_seq long, k string, v int"
    append(stream_of(spark, rows, schema, tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck"), partition_by=["k"]).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3
    table = str(tmp_path / "retained")
    assert retained(spark, table) is None
    upsert = retain(["k"], table)
    for i in range(3):
        upsert(spark.createDataFrame(rows[i : i + 1], schema), i)
    upsert(spark.createDataFrame(rows[2:], schema), 2)
    assert {r.k: r.v for r in retained(spark, table).collect()} == {"a": 30, "b": 20} and versions(spark, table) == [0, 1, 2]
    upsert(spark.createDataFrame([(9, "b", 1)], schema), 1)  # a batch that comes again starts from the version before it
    assert {r.k: r.v for r in retained(spark, table, before=2).collect()} == {"a": 10, "b": 1}


def test_topics_at_rest_and_as_streams(spark, tmp_path):
    schema = "ingest_seq long, payload string, channel string"
    spark.createDataFrame([(1, "x", "ego"), (2, "y", "map"), (3, "z", "ego")], schema).write.partitionBy("channel").parquet(str(tmp_path / "topic"))
    rest = topic(spark, str(tmp_path / "topic"), schema, channels=["ego"])
    assert {r.ingest_seq for r in rest.collect()} == {1, 3} and "PartitionFilters: [isnotnull(channel" in rest._jdf.queryExecution().toString()
    assert {r.ingest_seq for r in drained(topic(spark, str(tmp_path / "topic"), schema, channels=["map"], stream=True, most_files=1), "topic_stream")} == {2}


def test_path_points_break_on_frames(spark, tmp_path):
    rows = [("a", 1, 0, "map"), ("a", 2, 5, "map"), ("a", 3, 6, "odom"), ("a", 4, 7, ""), ("a", 5, 20, "odom"), ("a", 6, 40, "map")]
    got = drained(stateful.path_points(stream_of(spark, rows, "k string, ingest_seq long, stamp_us long, pose_frame_id string", tmp_path / "in"), "k", 10), "frame_stream")
    assert {(r.ingest_seq, r.segment) for r in got} == {(1, 0), (3, 1), (5, 1), (6, 2)}


def test_bad_bytes_keep_their_frame_and_no_length_ends_it():
    bad = struct.pack("!I", 4) + b"\xff\xfe{}" + framed("{}")
    assert [end for *_, end in packets(bad)] == [8, 14] and len(list(frames(bad))) == 2
    with pytest.raises(Closed):
        list(packets(framed("{}") + struct.pack("!I", 0)))


def test_camera_frames_and_broken_senders_on_a_port(spark):
    reader = FramedSource({"port": "29873", "images": "true", "maxPacketsPerTrigger": "100"}).simpleStreamReader(None)
    try:
        reader.read({"n": 0})
        with socket.create_connection(("127.0.0.1", 29873)) as bad, socket.create_connection(("127.0.0.1", 29873)) as good:
            bad.sendall(framed("[1]", b"a") + struct.pack("!I", 0) + framed("[2]", b"b"))
            good.sendall(framed("[3]", b"\x00\xff" * 50_000) + framed("[4]", b"")[:-3])
            end, until = {"n": 0}, time.time() + 20
            while end["n"] < 2 and time.time() < until:
                time.sleep(0.1)
                _, end = reader.read({"n": 0})
            good.sendall(framed("[4]", b"")[-3:])
            while end["n"] < 3 and time.time() < until:
                time.sleep(0.1)
                rows, end = reader.read({"n": 0})
        rows = list(reader.readBetweenOffsets({"n": 0}, end))
        assert {(text, len(data)) for _, text, _, data in rows} == {("[1]", 1), ("[3]", 100_000), ("[4]", 0)}
        reader.commit(end)
        with pytest.raises(RuntimeError):
            reader.readBetweenOffsets({"n": 0}, end)
    finally:
        reader.close()
