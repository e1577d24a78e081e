"""What is published on a clock from retained tables: each tick runs the batch operators on the tables as they are."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import recording, vectormap
from ..sources.tables import retain, retained


def every(spark: SparkSession, period: str, publish: Callable[[int], None], checkpoint: str) -> StreamingQuery:
    """Call ``publish`` with the number of the tick every ``period``; numbers go on after a restart. A tick that failed comes again with its number."""
    clock = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return clock.writeStream.foreachBatch(lambda _, number: publish(number)).option("checkpointLocation", checkpoint).trigger(processingTime=period).start()


def _sent(rows: DataFrame, path: str, tick: int) -> None:
    """The rows of a tick, in a folder of their own: one that comes again overwrites it."""
    rows.write.mode("overwrite").parquet(f"{path}/tick={tick}")


def map_client(spark: SparkSession, maps: str, out: str) -> Callable[[int], None]:
    """A client of retained maps (slot, ingest_seq, scene_id, revision; table ``maps``): at each tick slot, revision and ``action`` go to ``out``.

    As :func:`trailmark.operators.ticks.map_polls`: publish for a new revision, republish for the
    known one, none without a map. What the client knows is the table ``out``/known.
    """

    def tick(number: int) -> None:
        current = retained(spark, maps)
        if current is None:
            return
        known = retained(spark, f"{out}/known", before=number)
        known = spark.createDataFrame([], "slot long, known_revision long") if known is None else known.select("slot", F.col("revision").alias("known_revision"))
        asked = current.select("slot").join(known, "slot", "left").select("slot", F.lit("").alias("requested_scene_id"), F.coalesce("known_revision", F.lit(0)).alias("known_revision"))
        answered = vectormap.answer_status(asked, current)
        usable = F.length(F.coalesce("scene_id", F.lit(""))) > 0
        action = F.when(F.col("status") == "not_modified", "republish").when((F.col("status") == "ok") & usable, "publish").otherwise("none")
        rows = answered.select("slot", F.lit(number).cast("long").alias("ingest_seq"), "revision", action.alias("action"))
        _sent(rows, f"{out}/actions", number)
        written = spark.read.parquet(f"{out}/actions/tick={number}")
        retain(["slot"], f"{out}/known")(written.where("action <> 'none'").select("slot", "ingest_seq", "revision"), number)

    return tick


def future_client(spark: SparkSession, recordings: str, points: str, clock: str, out: str, config: recording.FutureConfig) -> Callable[[int], None]:
    """A client of recorded trajectories: at each tick the answer for the time that ``clock`` retains goes to ``out``.

    Tables: ``recordings`` (retained: slot, ingest_seq, revision, start_us, end_us), ``points`` (slot,
    stamp_us, point), ``clock`` (retained: slot, ingest_seq, stamp_us). Rows: slot, request_id,
    stamp_us, offset_us, point; none where the time lies outside the recording.
    """

    def tick(number: int) -> None:
        held, now = retained(spark, recordings), retained(spark, clock)
        if held is None or now is None:
            return
        asked = recording.tick_requests(now.select("slot", F.col("stamp_us").alias("tick_us")).withColumn("request_id", F.col("slot")), config)
        status = recording.answer_status(asked, held.drop("ingest_seq"), on=["slot"])
        _sent(recording.answers(status, spark.read.parquet(points), on=["slot"]).select("slot", "request_id", "stamp_us", "offset_us", "point"), out, number)

    return tick


def answer_stream(requests: DataFrame, maps: str, out: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Answers to a stream of map requests (slot, requested_scene_id, known_revision) from the maps that are retained when its batch runs; rows go to ``out``."""

    def batch(rows: DataFrame, number: int) -> None:
        current = retained(rows.sparkSession, maps)
        empty = rows.sparkSession.createDataFrame([], "slot long, scene_id string, revision long")
        answered = vectormap.answer_status(rows, empty if current is None else current.select("slot", "scene_id", "revision"))
        answered.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return requests.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
