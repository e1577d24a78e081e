"""Codes, names and styles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import EGO_SOURCES, ROUTE_GENERATORS


def route_generator(name: Column) -> Column:
    """Code by the end of the name; RECORDED goes before MAP."""
    upper = F.upper(name)
    return F.when(upper.endswith("RECORDED"), ROUTE_GENERATORS["RECORDED"]).when(upper.endswith("MAP"), ROUTE_GENERATORS["MAP"]).otherwise(0)


def plan_source(name: Column) -> Column:
    upper = F.upper(name)
    kinds = ("MODEL_PLANNING", "CONTROLLER_REFERENCE")
    return F.when(upper == kinds[0], EGO_SOURCES[kinds[0]]).when(upper == kinds[1], EGO_SOURCES[kinds[1]]).otherwise(0)


def image_format(data: Column) -> Column:
    """jpeg, png, webp or unknown, by the first bytes."""
    head = lambda n, at=1: F.hex(F.substring(data, at, n))
    return F.when(head(3) == "FFD8FF", "jpeg").when(head(8) == "89504E470D0A1A0A", "png").when((head(4) == "52494646") & (head(4, 9) == "57454250"), "webp").otherwise("unknown")


def stable_id(*parts: Column) -> Column:
    """A positive 31-bit id of ``a:b``; the same in every run."""
    return F.crc32(F.concat_ws(":", *parts).cast("binary")).bitwiseAND(F.lit(2147483647))


#: Red, green, blue by actor class.
ACTOR_COLOURS = {
    "automobile": (0.10, 0.45, 1.00),
    "heavy_truck": (1.00, 0.45, 0.05),
    "trailer": (0.65, 0.20, 0.90),
    "pedestrian": (0.95, 0.15, 0.15),
    "bicycle": (0.10, 0.85, 0.25),
    "motorcycle": (0.95, 0.85, 0.10),
}
OTHER_ACTOR = (0.55, 0.55, 0.55)
#: Red, green, blue, alpha by wait-line type.
WAIT_LINE_COLOURS = {"STOP": (1.00, 0.85, 0.00, 1.00), "YIELD": (1.00, 0.40, 0.00, 1.00)}
OTHER_WAIT_LINE = (0.65, 0.65, 0.65, 0.90)
IMPLICIT_ALPHA = 0.45


def rgba(values: tuple[float, ...]) -> Column:
    return F.struct(*(F.lit(v).alias(n) for n, v in zip("rgba", values, strict=False)))


def colour_of(label: Column, colours: dict[str, tuple[float, ...]], other: tuple[float, ...]) -> Column:
    """A colour from a small table, with one for all other names."""
    table = F.create_map(*(x for name, values in colours.items() for x in (F.lit(name), rgba(values))))
    return F.coalesce(table[label], rgba(other))


def wait_line_colour(kind: Column, implicit: Column) -> Column:
    colour = colour_of(F.upper(kind), WAIT_LINE_COLOURS, OTHER_WAIT_LINE)
    return F.struct(colour["r"].alias("r"), colour["g"].alias("g"), colour["b"].alias("b"), F.when(implicit, IMPLICIT_ALPHA).otherwise(colour["a"]).alias("a"))
