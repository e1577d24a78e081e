"""Record types on the wire and after projection. Times are microseconds in BIGINT."""

from __future__ import annotations

VEC3 = "STRUCT<x: DOUBLE, y: DOUBLE, z: DOUBLE>"
QUAT = "STRUCT<x: DOUBLE, y: DOUBLE, z: DOUBLE, w: DOUBLE>"
MOTION = f"STRUCT<timestamp_us: BIGINT, position: {VEC3}, orientation: {QUAT}, linear_velocity: {VEC3}, linear_acceleration: {VEC3}, yaw: DOUBLE, yaw_rate: DOUBLE, yaw_acceleration: DOUBLE, speed: DOUBLE>"
#: What a recorded point says besides its time; only its answers need it.
MOTION_REST = ("position", "orientation", "linear_velocity", "linear_acceleration", "yaw", "yaw_rate", "yaw_acceleration", "speed")
POLYLINE = f"STRUCT<points: ARRAY<{VEC3}>, headings: ARRAY<DOUBLE>>"
LANE_IDS = ("successor_ids", "predecessor_ids", "left_adjacent_ids", "right_adjacent_ids", "traffic_sign_ids", "wait_line_ids", "road_area_ids")
LANE = f"STRUCT<id: STRING, centerline: {POLYLINE}, left_boundary: {POLYLINE}, right_boundary: {POLYLINE}, " + ", ".join(f"{c}: ARRAY<STRING>" for c in LANE_IDS) + ">"
ROUTE = f"STRUCT<frame_id: STRING, source_frame_id: STRING, lookahead_distance: DOUBLE, expected_point_count: BIGINT, points: ARRAY<STRUCT<valid: BOOLEAN, position: {VEC3}, longitudinal_distance: DOUBLE>>>"
PLAN = f"STRUCT<pose_frame_id: STRING, dynamics_frame_id: STRING, source: STRING, producer: STRING, is_model_generated: BOOLEAN, start_timestamp_us: BIGINT, end_timestamp_us: BIGINT, points: ARRAY<{MOTION}>>"

#: Schema of the JSON of each channel, as :func:`pyspark.sql.functions.from_json` takes it.
CHANNELS = {
    "ego": f"timestamp_us BIGINT, pose_frame_id STRING, child_frame_id STRING, dynamics_frame_id STRING, position {VEC3}, orientation {QUAT}, linear_velocity {VEC3}, angular_velocity {VEC3}, linear_acceleration {VEC3}, angular_acceleration {VEC3}, speed DOUBLE",
    "actors": f"message_type STRING, timestamp_us BIGINT, pose_frame_id STRING, dynamics_frame_id STRING, actors ARRAY<STRUCT<track_id: STRING, label_class: STRING, is_static: BOOLEAN, dimensions: {VEC3}, current_state: {MOTION}, available_future_points: ARRAY<{MOTION}>>>",
    "map": f"message_type STRING, scene_id STRING, map_id STRING, source_revision BIGINT, frame_id STRING, extent STRUCT<minimum: {VEC3}, maximum: {VEC3}>, lanes ARRAY<{LANE}>, road_edges ARRAY<STRUCT<id: STRING, polyline: {POLYLINE}>>, traffic_signs ARRAY<STRUCT<id: STRING, sign_type: STRING, position: {VEC3}>>, wait_lines ARRAY<STRUCT<id: STRING, wait_line_type: STRING, is_implicit: BOOLEAN, polyline: {POLYLINE}>>",
    "recording": f"message_type STRING, scene_id STRING, source_revision BIGINT, pose_frame_id STRING, dynamics_frame_id STRING, points ARRAY<{MOTION}>",
    "navigation": f"message_type STRING, sequence BIGINT, reference_timestamp_us BIGINT, route_generator_type STRING, force_gt_active BOOLEAN, route_map {ROUTE}, route_model_input {ROUTE}, planned_trajectory {PLAN}",
    "camera": "camera_logical_id STRING, end_timestamp_us BIGINT, camera_metadata STRING",
}

#: The message type that a channel accepts.
MESSAGE_TYPES = {"actors": "actor_snapshot", "map": "vector_map", "recording": "ground_truth_ego_trajectory", "navigation": "navigation_update"}

#: Fields that a record may lack, ``[]`` being the elements of an array; without any other one it is quarantined. What a section lacks that its own rules judge (routes, plans) costs the section.
OPTIONAL = {
    "ego": ["pose_frame_id", "child_frame_id", "dynamics_frame_id"],
    "actors": ["message_type", "pose_frame_id", "dynamics_frame_id", "actors", "actors[].available_future_points"],
    "map": ["message_type", "source_revision", "frame_id", "lanes", "road_edges", "traffic_signs", "wait_lines", *(f"lanes[].{c}" for c in LANE_IDS), *(f"{c}.{k}" for c in ("lanes[].centerline", "lanes[].left_boundary", "lanes[].right_boundary", "road_edges[].polyline", "wait_lines[].polyline") for k in ("points", "headings"))],
    "recording": ["message_type", "source_revision", "pose_frame_id", "dynamics_frame_id", *(f"points[].{c}" for c in MOTION_REST)],
    "navigation": ["message_type", "route_generator_type", "force_gt_active", "route_map", "route_model_input", "planned_trajectory"],
    "camera": ["camera_metadata"],
}
#: Fields whose own fields aren't looked into.
CLOSED = {"navigation": ["route_map", "route_model_input", "planned_trajectory"], "recording": [f"points[].{c}" for c in MOTION_REST]}

#: Numbers of trajectory kinds and route generators.
EGO_SOURCES = {"UNKNOWN": 0, "RECORDING": 1, "MODEL_PLANNING": 2, "EXECUTED": 3, "CONTROLLER_REFERENCE": 4}
ACTOR_SOURCES = {"UNKNOWN": 0, "HISTORY": 1, "FUTURE": 2, "MODEL_PREDICTION": 3, "PLACEHOLDER": 4}
ROUTE_GENERATORS = {"UNKNOWN": 0, "RECORDED": 1, "MAP": 2}
