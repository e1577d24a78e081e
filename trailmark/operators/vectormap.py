"""Vector maps: element and edge tables, the revision cache and requests to it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import LANE_IDS
from .series import revisions

KEY = ["scene_id", "map_id", "source_revision"]


def polyline_valid(line: Column) -> Column:
    """No headings, or one for each point."""
    headings = F.size(F.coalesce(line["headings"], F.array()))
    return (headings == 0) | (headings == F.size(F.coalesce(line["points"], F.array())))


def valid_maps(records: DataFrame) -> DataFrame:
    """Maps of which every polyline is valid; others leave the cache alone."""
    lanes, edges, waits = (F.coalesce(F.col(c), F.array()) for c in ("lanes", "road_edges", "wait_lines"))
    good = F.forall(lanes, lambda x: polyline_valid(x["centerline"]) & polyline_valid(x["left_boundary"]) & polyline_valid(x["right_boundary"]))
    good &= F.forall(edges, lambda x: polyline_valid(x["polyline"])) & F.forall(waits, lambda x: polyline_valid(x["polyline"]))
    return records.where(F.coalesce(good, F.lit(True))).withColumns({"source_revision": F.coalesce("source_revision", F.lit(1)), "frame_id": F.coalesce("frame_id", F.lit("map"))})


def cache(maps: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The revision that each map makes current; equal keys in a row are one."""
    return revisions(maps, KEY, by=by)


def elements(maps: DataFrame, kind: str, key: list[str] | None = None) -> DataFrame:
    """A row for each lane, road edge, traffic sign or wait line."""
    return maps.select(*(key or ["scene_id", "revision"]), F.posexplode(kind).alias("at", "e")).select(*(key or ["scene_id", "revision"]), "at", "e.*")


def lane_edges(lanes: DataFrame, key: list[str]) -> DataFrame:
    """Lane references as edges: key, lane_id, relation, other_id. The lists of a lane are exploded once, in one pass."""
    lists = F.map_from_arrays(F.array(*(F.lit(c) for c in LANE_IDS)), F.array(*(F.coalesce(F.col(c), F.array().cast("array<string>")) for c in LANE_IDS)))
    return lanes.select(*key, F.col("id").alias("lane_id"), F.explode(lists).alias("relation", "ids")).select(*key, "lane_id", "relation", F.explode("ids").alias("other_id"))


def element_counts(maps: DataFrame, key: list[str]) -> DataFrame:
    return maps.select(*key, *(F.size(F.coalesce(F.col(c), F.array())).alias(f"n_{c}") for c in ("lanes", "road_edges", "traffic_signs", "wait_lines")))


def answer_status(requests: DataFrame, current: DataFrame) -> DataFrame:
    """``status`` of requests to a cache: no_map, scene_mismatch, not_modified or ok, in this order.

    ``current``: one row (scene_id, revision) for each cache ``slot``; ``requests``: slot,
    requested_scene_id, known_revision.
    """
    both = requests.join(current, "slot", "left")
    other = (F.col("requested_scene_id") != "") & (F.col("requested_scene_id") != F.col("scene_id"))
    known = (F.col("known_revision") != 0) & (F.col("known_revision") == F.col("revision"))
    return both.withColumn("status", F.when(F.col("revision").isNull(), "no_map").when(other, "scene_mismatch").when(known, "not_modified").otherwise("ok")).withColumn("revision", F.coalesce("revision", F.lit(0)))
