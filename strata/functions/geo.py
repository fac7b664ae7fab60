"""Points, boxes, hexagonal cells and Morton codes as plain expressions."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text forms of points and boxes.
POINT_LAT = r"\(([^,]+),"
POINT_LON = r",\s*([^)]+)\)"
BOX = r"\(\s*([-\d.]+)\s*,\s*([-\d.]+)\s*,\s*([-\d.]+)\s*,\s*([-\d.]+)\s*\)"

KM_PER_DEGREE = 111.1949
# Parallel at which the plane projection keeps east-west distances.
REFERENCE_PARALLEL = 6.0


def _finite(c: Column) -> Column:
    """Null for what reads as a number but is no place."""
    return F.when(F.abs(c) < F.lit(float("inf")), c)


def point_lat(c: Column) -> Column:
    return _finite(F.regexp_extract(c, POINT_LAT, 1).try_cast("double"))


def point_lon(c: Column) -> Column:
    return _finite(F.regexp_extract(c, POINT_LON, 1).try_cast("double"))


def box_midpoint(url: Column) -> Column:
    """Struct (lat, lon): middle of the ``(south, west, north, east)`` box in a text."""
    side = [F.regexp_extract(url, BOX, i).try_cast("double") for i in (1, 2, 3, 4)]
    return F.struct(
        ((side[0] + side[2]) / F.lit(2.0)).alias("lat"),
        ((side[1] + side[3]) / F.lit(2.0)).alias("lon"),
    )


def hex_axial(lat: Column, lon: Column, cell_km: float) -> tuple[Column, Column]:
    """Axial coordinates (q, r) of the pointy-top hexagon that holds a point."""
    x = lon * F.lit(KM_PER_DEGREE) * F.lit(math.cos(math.radians(REFERENCE_PARALLEL)))
    y = lat * F.lit(KM_PER_DEGREE)
    qf = (F.lit(math.sqrt(3.0) / 3.0) * x - y / F.lit(3.0)) / F.lit(float(cell_km))
    rf = (F.lit(2.0 / 3.0) * y) / F.lit(float(cell_km))
    sf = -qf - rf
    q, r, s = (F.floor(v + F.lit(0.5)) for v in (qf, rf, sf))
    off_q, off_r, off_s = F.abs(q - qf), F.abs(r - rf), F.abs(s - sf)
    q_worst = (off_q > off_r) & (off_q > off_s)
    return (
        F.when(q_worst, -r - s).otherwise(q),
        F.when(~q_worst & (off_r > off_s), -q - s).otherwise(r),
    )


def hex_cell(lat: Column, lon: Column, cell_km: float) -> Column:
    """Cell id ``q:r``; NULL when a coordinate is."""
    q, r = hex_axial(lat, lon, cell_km)
    return F.concat(q.cast("string"), F.lit(":"), r.cast("string"))


def morton(buckets: list[Column], bits: int) -> Column:
    """Interleave the low ``bits`` bits of non-negative integers, first column lowest."""
    if bits * len(buckets) > 62:
        raise ValueError("bits * columns must stay below 63")
    parts = [
        F.shiftleft(
            F.shiftright(c.cast("long"), b).bitwiseAND(F.lit(1).cast("long")),
            b * len(buckets) + i,
        )
        for i, c in enumerate(buckets)
        for b in range(bits)
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), parts)
