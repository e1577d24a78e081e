"""Vectors, quaternions and interpolation as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def yaw_of(x: Column, y: Column, z: Column, w: Column) -> Column:
    return F.atan2(2 * (w * z + x * y), 1 - 2 * (y * y + z * z))


def norm(v: Column) -> Column:
    return F.sqrt(v["x"] * v["x"] + v["y"] * v["y"] + v["z"] * v["z"])


def lerp(a: Column, b: Column, alpha: Column) -> Column:
    return a + alpha * (b - a)


def lerp_vector(a: Column, b: Column, alpha: Column) -> Column:
    return F.struct(*(lerp(a[c], b[c], alpha).alias(c) for c in "xyz"))


def nlerp(a: Column, b: Column, alpha: Column) -> Column:
    """Normalised linear interpolation over the shorter way; the identity where the length vanishes."""
    dot = sum((a[c] * b[c] for c in "yzw"), a["x"] * b["x"])
    sign = F.when(dot < 0, -1.0).otherwise(1.0)
    mixed = {c: (1 - alpha) * a[c] + alpha * (sign * b[c]) for c in "xyzw"}
    length = F.sqrt(sum((mixed[c] * mixed[c] for c in "yzw"), mixed["x"] * mixed["x"]))
    return F.struct(*(F.when(length <= 1e-12, float(c == "w")).otherwise(mixed[c] / length).alias(c) for c in "xyzw"))


def finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))


def raised(p: Column, offset: float | Column) -> Column:
    """A point with ``offset`` on z."""
    return F.struct(p["x"].alias("x"), p["y"].alias("y"), (p["z"] + offset).alias("z"))
