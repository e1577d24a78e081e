"""Camera frames: image rows, calibration once a camera, static transforms."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codes import image_format

#: Cameras and the frames of their optics.
CAMERAS = ("camera_cross_left_120fov", "camera_front_wide_120fov", "camera_front_tele_30fov", "camera_cross_right_120fov", "camera_rear_left_70fov")


def camera_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(c, f"{c}_optical") for c in CAMERAS], "camera STRING, frame_id STRING")


def images(frames: DataFrame, cameras: DataFrame) -> DataFrame:
    """Image rows of known cameras. ``frames``: ingest_seq, camera_logical_id, end_timestamp_us, data."""
    named = frames.withColumnRenamed("camera_logical_id", "camera").join(F.broadcast(cameras), "camera")  # five cameras
    return named.select("ingest_seq", "camera", "frame_id", F.col("end_timestamp_us").alias("stamp_us"), image_format(F.col("data")).alias("format"), "data")


def calibration_once(frames: DataFrame, metadata: str = "camera_metadata") -> DataFrame:
    """The first metadata of each camera, of unknown ones too."""
    rest = [c for c in frames.columns if c != "camera_logical_id"]
    return frames.where(F.col(metadata).isNotNull()).groupBy("camera_logical_id").agg(F.min_by(F.struct(*rest), "ingest_seq").alias("_f")).select("camera_logical_id", "_f.*")


def _numbers(pose: Column, names: tuple[str, ...], axes: str) -> Column:
    """The first of the members ``names`` that is there, as a struct of numbers; null where an axis isn't a number."""
    member = F.coalesce(*(F.try_variant_get(pose, f"$.{n}", "variant") for n in names))
    values = {c: F.try_variant_get(member, f"$.{c}", "double") for c in axes}
    whole = F.lit(True)
    for v in values.values():
        whole &= v.isNotNull()
    return F.when(whole, F.struct(*(v.alias(c) for c, v in values.items())))


def static_transforms(calibrations: DataFrame, cameras: DataFrame) -> DataFrame:
    """base_link to camera, from metadata as JSON text of any shape; the pose may come under other names."""
    pose = F.try_variant_get(F.try_parse_json("camera_metadata"), "$.available_camera.rig_to_camera", "variant")
    named = calibrations.withColumnRenamed("camera_logical_id", "camera").join(F.broadcast(cameras), "camera").withColumn("pose", pose)
    shift, turn = _numbers(F.col("pose"), ("vec", "translation", "vec3", "position"), "xyz"), _numbers(F.col("pose"), ("quat", "rotation", "orientation"), "xyzw")
    return named.select("camera", F.lit("base_link").alias("parent"), F.col("frame_id").alias("child"), shift.alias("translation"), turn.alias("rotation")).where("translation IS NOT NULL AND rotation IS NOT NULL")


def calibration_json(calibrations: DataFrame) -> DataFrame:
    """The metadata, JSON of any shape, as text with sorted keys at every depth, indented by two.

    Numbers and escapes are spelled as Python's ``json`` does, which no SQL function follows; a row a camera comes here.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if x is None else json.dumps(json.loads(x), indent=2, sort_keys=True) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["camera_logical_id", "json"])

    return calibrations.select("camera_logical_id", "camera_metadata").mapInArrow(run, "camera_logical_id string, json string")
