"""Ego state, clock, transform and the executed path."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.geometry import yaw_of
from ..functions.timeutil import nanoseconds_part, seconds_part
from ..schemas import EGO_SOURCES
from .series import admit, newest, segment


def states(records: DataFrame) -> DataFrame:
    """EgoState rows with the defaults of the frames."""
    frames = {"pose_frame_id": "map", "child_frame_id": "base_link", "dynamics_frame_id": "base_link"}
    rest = ["position", "orientation", "linear_velocity", "angular_velocity", "linear_acceleration", "angular_acceleration", "speed"]
    return records.select("ingest_seq", F.col("timestamp_us").alias("stamp_us"), *(F.coalesce(c, F.lit(v)).alias(c) for c, v in frames.items()), *(c for c in rest if c in records.columns))


def clock(ego: DataFrame) -> DataFrame:
    return ego.select("ingest_seq", seconds_part("stamp_us").alias("sec"), nanoseconds_part("stamp_us").alias("nanosec"))


def transforms(ego: DataFrame) -> DataFrame:
    """A row of the frame tree for each state."""
    return ego.select("ingest_seq", "stamp_us", F.col("pose_frame_id").alias("parent"), F.col("child_frame_id").alias("child"), F.col("position").alias("translation"), F.col("orientation").alias("rotation"))


def trajectory_points(ego: DataFrame) -> DataFrame:
    """TrajectoryPoint fields of a state: yaw of the quaternion, its derivatives from the angular z."""
    q = F.col("orientation")
    out = ego.withColumn("yaw", yaw_of(q["x"], q["y"], q["z"], q["w"]))
    for name, source in (("yaw_rate", "angular_velocity"), ("yaw_acceleration", "angular_acceleration")):
        if source in ego.columns:
            out = out.withColumn(name, F.col(source)["z"])
    return out


@dataclass(frozen=True)
class PathConfig:
    interval_us: int = 100_000
    history_us: int = 0
    max_points: int = 512

    def __post_init__(self) -> None:
        if self.interval_us < 0 or self.history_us < 0 or self.max_points < 1:
            raise ValueError("interval and history must not be negative, and a path needs a point")


FRAMES = ["pose_frame_id", "child_frame_id", "dynamics_frame_id"]


def path_segments(ego: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Rows with frames, numbered by ``segment``: one begins when time goes back or a frame changes."""
    named = ego
    for c in FRAMES:
        named = named.where(F.length(c) > 0)

    def breaks(before, row):
        other = row["stamp_us"] < before["stamp_us"]
        for c in FRAMES:
            other |= row[c] != before[c]
        return other

    return segment(named, "ingest_seq", ["stamp_us", *FRAMES], breaks, by=by)


def executed_path(ego: DataFrame, config: PathConfig, by: list[str] | None = None) -> DataFrame:
    """The points of the path of each segment, with ``offset_us`` from its first one."""
    by = [*(by or []), "segment"]
    rows = ego if "segment" in ego.columns else path_segments(ego, by[:-1])
    latest = rows.groupBy(*by).agg(F.max("stamp_us").alias("latest_us"))  # it moves on with rows that aren't sampled too
    kept = newest(admit(rows, by, "ingest_seq", "stamp_us", config.interval_us), by, "stamp_us", "ingest_seq", history_us=config.history_us, most=config.max_points, latest=latest if config.history_us else None)
    first = F.min("stamp_us").over(Window.partitionBy(*by))  # of what is kept: max_points rows at most
    return kept.withColumn("offset_us", F.col("stamp_us") - first).withColumn("source", F.lit(EGO_SOURCES["EXECUTED"]))


def path_summary(path: DataFrame, by: list[str]) -> DataFrame:
    """reference_us, duration_us and n_points of each path."""
    return path.groupBy(*by).agg(F.min("stamp_us").alias("reference_us"), F.greatest(F.max("stamp_us") - F.min("stamp_us"), F.lit(0)).alias("duration_us"), F.count("*").alias("n_points"))
