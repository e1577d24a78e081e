"""Rows for a viewer: boxes, labels, arrows and lines."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codes import ACTOR_COLOURS, OTHER_ACTOR, colour_of, rgba, stable_id, wait_line_colour
from ..functions.geometry import raised

#: Line layers as marker id, namespace, width, z offset and colour.
NAVIGATION_LAYERS = {
    "route": (1, "navigation/route", 0.28, 0.16, (1.00, 0.10, 0.62, 1.00)),
    "ground_truth": (2, "navigation/ground_truth_future", 0.20, 0.20, (0.10, 1.00, 0.20, 1.00)),
    "model_plan": (3, "navigation/model_plan", 0.26, 0.24, (1.00, 0.80, 0.00, 1.00)),
    "executed_path": (4, "navigation/executed_path", 0.12, 0.12, (1.00, 1.00, 1.00, 0.95)),
}
#: Layers of a map as namespace, width, z offset over that of all, and colour.
MAP_LAYERS = {
    "centerline": ("map/lane_centerlines", 0.02, 0.00, (0.00, 0.85, 0.75, 0.85)),
    "left_boundary": ("map/lane_left_boundaries", 0.06, 0.01, (0.90, 0.90, 0.90, 0.55)),
    "right_boundary": ("map/lane_right_boundaries", 0.06, 0.01, (0.90, 0.90, 0.90, 0.55)),
    "road_edge": ("map/road_edges", 0.12, 0.02, (1.00, 0.12, 0.12, 0.85)),
    "wait_line": ("map/wait_lines/", 0.20, 0.05, None),
}
#: A removed navigation layer's namespace and frame.
REMOVED = ("navigation", "map")


def _not_negative(**values: float) -> None:
    for name, value in values.items():
        if value < 0:
            raise ValueError(f"{name} must not be negative")


@dataclass(frozen=True)
class ActorMarkerConfig:
    box_alpha: float = 0.65
    label_offset: float = 0.5
    arrow_scale: float = 0.5
    labels: bool = True
    arrows: bool = True


@dataclass(frozen=True)
class MapMarkerConfig:
    """Which layers of a map are shown, their widths (those of :data:`MAP_LAYERS` unless named) and the z offset of all."""

    centerlines: bool = True
    boundaries: bool = True
    road_edges: bool = True
    wait_lines: bool = True
    signs: bool = True
    sign_labels: bool = True
    centerline_width: float = MAP_LAYERS["centerline"][1]
    boundary_width: float = MAP_LAYERS["left_boundary"][1]
    road_edge_width: float = MAP_LAYERS["road_edge"][1]
    wait_line_width: float = MAP_LAYERS["wait_line"][1]
    z_offset: float = 0.04

    def __post_init__(self) -> None:
        _not_negative(centerline_width=self.centerline_width, boundary_width=self.boundary_width, road_edge_width=self.road_edge_width, wait_line_width=self.wait_line_width)


@dataclass(frozen=True)
class NavigationMarkerConfig:
    """Widths and z offsets by layer, where they aren't those of :data:`NAVIGATION_LAYERS`."""

    widths: dict[str, float] = field(default_factory=dict)
    offsets: dict[str, float] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if unknown := (set(self.widths) | set(self.offsets)) - set(NAVIGATION_LAYERS):
            raise ValueError(f"no such layers: {sorted(unknown)}")
        _not_negative(**self.widths)


def boxes(actors: DataFrame, alpha: float = 0.65) -> DataFrame:
    """A box for each actor. ``actors``: track_id, label_class, dimensions, position, orientation..."""
    size = F.struct(*(F.greatest(F.col("dimensions")[c], F.lit(0.05)).alias(c) for c in "xyz"))
    colour = colour_of(F.col("label_class"), ACTOR_COLOURS, OTHER_ACTOR)
    return actors.withColumns({"ns": F.concat(F.lit("actors/boxes/"), "label_class"), "id": stable_id(F.col("track_id"), F.lit("box")), "scale": size, "color": colour.withField("a", F.lit(min(max(float(alpha), 0.0), 1.0)))})


def labels(actors: DataFrame, offset: float = 0.5) -> DataFrame:
    """A text above each actor: class, track, whether it is static, and speed. ``actors``: as for boxes, and is_static, speed."""
    static = F.when(F.col("is_static"), " static").otherwise("")
    text = F.concat(F.col("label_class"), F.lit(" #"), "track_id", static, F.lit("\n"), F.expr("format_number(speed, '0.0')"), F.lit(" m/s"))
    up = raised(F.col("position"), F.col("dimensions")["z"] / 2 + offset)
    return actors.withColumns({"ns": F.lit("actors/labels"), "id": stable_id(F.col("track_id"), F.lit("label")), "text": text, "at": up})


def arrows(actors: DataFrame, scale: float = 0.5) -> DataFrame:
    """The velocity of each actor that moves faster than 0.05."""
    moving = actors.where((F.col("speed") > 0.05) & ~F.isnan("speed"))
    p, v = F.col("position"), F.col("linear_velocity")
    start = raised(p, F.col("dimensions")["z"] / 2)
    end = F.struct(*((start[c] + scale * v[c]).alias(c) for c in "xyz"))
    return moving.withColumns({"ns": F.lit("actors/velocity"), "id": stable_id(F.col("track_id"), F.lit("velocity")), "start": start, "end": end})


def actor_markers(actors: DataFrame, config: ActorMarkerConfig = ActorMarkerConfig()) -> DataFrame:
    """All markers of each packet in order: delete all, then box, label and arrow of every actor.

    ``actors``: what boxes, labels and arrows take, and ingest_seq, ordinal, pose_frame_id,
    dynamics_frame_id (the frame of arrows).
    """
    rows = lambda x, at, kind, frame, action: x.select("ingest_seq", at.alias("at"), F.lit(kind).alias("kind"), "ns", "id", F.col(frame).alias("frame"), F.lit(action).alias("action"))
    first = actors.groupBy("ingest_seq").agg(F.first("pose_frame_id").alias("pose_frame_id")).withColumns({"ns": F.lit(""), "id": F.lit(0).cast("long")})
    out = rows(first, F.lit(-1), 0, "pose_frame_id", "DELETEALL")
    parts = [(boxes(actors, config.box_alpha), 0, "pose_frame_id")]
    parts += [(labels(actors, config.label_offset), 1, "pose_frame_id")] if config.labels else []
    parts += [(arrows(actors, config.arrow_scale), 2, "dynamics_frame_id")] if config.arrows else []
    for part, kind, frame in parts:
        out = out.unionByName(rows(part, F.col("ordinal"), kind, frame, "ADD"))
    return out


def _strip(layer: str, id_: Column, points: Column, z_offset: float, width: float | None = None, kind: Column | None = None, implicit: Column | None = None) -> Column:
    """A line of a map layer as a struct: ns, id, marker_id, width, color, line, text."""
    ns, own, above, colour = MAP_LAYERS[layer]
    name = F.lit(ns) if colour else F.concat(F.lit(ns), F.lower(kind))
    return _marker(name, id_, rgba(colour) if colour else wait_line_colour(kind, implicit), F.transform(points, lambda p: raised(p, F.lit(z_offset + above))), own if width is None else width)


def _marker(ns: Column, id_: Column, color: Column, line: Column, width: float, text: Column | None = None) -> Column:
    text = F.lit(None).cast("string") if text is None else text
    return F.struct(ns.alias("ns"), id_.alias("id"), stable_id(ns, id_).alias("marker_id"), F.lit(float(width)).alias("width"), color.alias("color"), line.alias("line"), text.alias("text"))


def line_strips(lines: DataFrame, layer: str, *, points: str = "points", z_offset: float = 0.04) -> DataFrame:
    """A line for each row with two points or more. ``lines``: id, points, and for wait lines wait_line_type and is_implicit."""
    kind, implicit = (F.col("wait_line_type"), F.col("is_implicit")) if layer == "wait_line" else (None, None)
    return lines.where(F.size(points) >= 2).withColumn("_m", _strip(layer, F.col("id"), F.col(points), z_offset, kind=kind, implicit=implicit)).select(*lines.columns, *(F.col(f"_m.{c}").alias(c) for c in ("ns", "marker_id", "width", "color", "line")))


def signs(rows: DataFrame, offset: float = 0.04) -> DataFrame:
    """A sphere and a label of each traffic sign."""
    text = F.concat("sign_type", F.lit("\n#"), "id")
    return rows.withColumns({"sphere": raised(F.col("position"), offset), "label": raised(F.col("position"), offset + 0.7), "text": text})


def map_markers(maps: DataFrame, key: list[str], config: MapMarkerConfig = MapMarkerConfig()) -> DataFrame:
    """All markers of each map, in the order of layer, at, part: key, layer, at, part, frame, action, and ns, id, marker_id, width, color, line, text.

    Layer 0 deletes all that is there; then centerlines, boundaries (left and right of a lane side
    by side), road edges, wait lines, and signs with their labels. A map is read once: its layers
    are one array, which is exploded. Lines of under two points are left out.
    """
    z = config.z_offset
    white, place = rgba((1.0, 1.0, 1.0, 1.0)), lambda x, up: F.array(raised(x["position"], F.lit(z + up)))
    sign = lambda up, ns, text: lambda x: _marker(F.lit(ns), x["id"], white, place(x, up), 0.0, text(x))
    parts = []
    add = lambda layer, part, source, make: parts.append((layer, part, source, make))
    if config.centerlines:
        add(1, 0, "lanes", lambda x: _strip("centerline", x["id"], x["centerline"]["points"], z, config.centerline_width))
    if config.boundaries:
        add(2, 0, "lanes", lambda x: _strip("left_boundary", x["id"], x["left_boundary"]["points"], z, config.boundary_width))
        add(2, 1, "lanes", lambda x: _strip("right_boundary", x["id"], x["right_boundary"]["points"], z, config.boundary_width))
    if config.road_edges:
        add(3, 0, "road_edges", lambda x: _strip("road_edge", x["id"], x["polyline"]["points"], z, config.road_edge_width))
    if config.wait_lines:
        add(4, 0, "wait_lines", lambda x: _strip("wait_line", x["id"], x["polyline"]["points"], z, config.wait_line_width, x["wait_line_type"], x["is_implicit"]))
    if config.signs:
        add(5, 0, "traffic_signs", sign(0.0, "map/traffic_signs", lambda x: F.lit(None).cast("string")))
    if config.signs and config.sign_labels:
        add(5, 1, "traffic_signs", sign(0.7, "map/traffic_sign_labels", lambda x: F.concat(x["sign_type"], F.lit("\n#"), x["id"])))

    def layer_rows(layer: int, part: int, source: str, make) -> Column:
        own = F.transform(F.col(source), lambda x, i: F.struct(F.lit(layer).alias("layer"), i.alias("at"), F.lit(part).alias("part"), F.lit("ADD").alias("action"), make(x).alias("m")))
        return own if layer == 5 else F.filter(own, lambda r: F.size(r["m"]["line"]) >= 2)

    nothing = _marker(F.lit(""), F.lit(""), F.lit(None).cast("struct<r: double, g: double, b: double, a: double>"), F.array().cast("array<struct<x: double, y: double, z: double>>"), 0.0)
    clear = F.array(F.struct(F.lit(0).alias("layer"), F.lit(-1).alias("at"), F.lit(0).alias("part"), F.lit("DELETEALL").alias("action"), nothing.alias("m")))
    rows = F.concat(clear, *(F.coalesce(layer_rows(*p), F.slice(clear, 1, 0)) for p in parts))
    return maps.select(*key, F.coalesce("frame_id", F.lit("map")).alias("frame"), F.explode(rows).alias("r")).select(*key, "r.layer", "r.at", "r.part", "frame", "r.action", "r.m.*")


def navigation_lines(messages: DataFrame, config: NavigationMarkerConfig = NavigationMarkerConfig()) -> DataFrame:
    """The line of each message of a layer, with marker_id, ns, frame, action, width, color and line.

    ``messages``: kind (a key of :data:`NAVIGATION_LAYERS`), frame, positions. Under two points
    remove the layer: a DELETE of its id, without a line; but for the executed path, which is left standing.
    """
    layers = {k: (i, ns, float(config.widths.get(k, w)), float(config.offsets.get(k, z)), c) for k, (i, ns, w, z, c) in NAVIGATION_LAYERS.items()}

    def of(position: int, make=F.lit) -> Column:
        table = F.create_map(*(x for k, v in layers.items() for x in (F.lit(k), make(v[position]))))
        return table[F.col("kind")]

    line = F.transform("positions", lambda p: raised(p, of(3)))
    rows = messages.where((F.col("kind") != "executed_path") | (F.size("positions") >= 2)).withColumn("_stands", F.size("positions") >= 2)
    either = lambda there, gone: F.when(F.col("_stands"), there).otherwise(gone)
    return rows.withColumns({
        "marker_id": of(0), "ns": either(of(1), F.lit(REMOVED[0])), "frame": either(F.col("frame"), F.lit(REMOVED[1])), "action": either(F.lit("ADD"), F.lit("DELETE")),
        "width": either(of(2), None), "color": either(of(4, rgba), None), "line": either(line, F.slice("positions", 1, 0)),
    }).drop("_stands", "positions")


def navigation_line(messages: DataFrame, kind: str, config: NavigationMarkerConfig = NavigationMarkerConfig()) -> DataFrame:
    """The lines of one layer. ``messages``: points, and frame_id or pose_frame_id. Only valid points of a route count."""
    points = F.filter("points", lambda p: p["valid"]) if kind == "route" else F.col("points")
    frame = "frame_id" if "frame_id" in messages.columns else "pose_frame_id"
    return navigation_lines(messages.withColumns({"kind": F.lit(kind), "frame": F.col(frame), "positions": F.transform(points, lambda p: p["position"])}), config)
