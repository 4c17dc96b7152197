"""Points within a distance of other points, and the hexagon that contains a point.

Both sides get Z-order codes of a global latitude/longitude grid whose cells are about
half the radius high. Each disc is covered by ranges of consecutive codes; ranges are cut
at block borders (a block is 4 x 4 cells), so that the range join is an equi-join on the
block with a BETWEEN on the sorted code, and the exact distance decides last. Neither side
is broadcast by hint. A block with very many points is split by adaptive execution,
since the join streams one side and keeps only the block's few disc ranges.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..functions import geo

_BLOCK_BITS = 4  # 4 x 4 cells


def grid_level(radius_m: float) -> int:
    """Bits a dimension such that a cell is between 1/2 and 1 radius high."""
    metres = math.pi * geo.EARTH_M
    return max(2, min(30, int(math.log2(metres / (radius_m / 2)))))


def _spread(v: np.ndarray) -> np.ndarray:
    x = v.astype(np.int64) & 0x7FFFFFFF
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << shift)) & mask
    return x


def disc_ranges(lat: np.ndarray, lon: np.ndarray, radius_m: float, level: int) -> tuple[np.ndarray, ...]:
    """Code ranges that cover each disc: (index of the disc, block, low, high)."""
    half = radius_m / geo.EARTH_M * (1 + 1e-9) + 1e-12
    n = 1 << level
    top = np.clip(np.radians(lat) + half, -math.pi / 2, math.pi / 2)
    low = np.clip(np.radians(lat) - half, -math.pi / 2, math.pi / 2)
    s = np.sin(half) / np.maximum(np.cos(np.radians(lat)), 1e-300)
    polar = (np.abs(np.radians(lat)) + half >= math.pi / 2) | (s >= 1)
    wide = np.where(polar, math.pi, np.arcsin(np.minimum(s, 1.0)) + 1e-12)
    v0 = np.clip(np.floor((np.degrees(low) + 90) / 180 * n), 0, n - 1).astype(np.int64)
    v1 = np.clip(np.floor((np.degrees(top) + 90) / 180 * n), 0, n - 1).astype(np.int64)
    u0 = np.floor((lon - np.degrees(wide) + 180) / 360 * n).astype(np.int64)
    u1 = np.floor((lon + np.degrees(wide) + 180) / 360 * n).astype(np.int64)
    u1 = np.where(u1 - u0 >= n, u0 + n - 1, u1)
    nu, nv = u1 - u0 + 1, v1 - v0 + 1
    owner = np.repeat(np.arange(len(lat)), nu * nv)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(nu * nv) - nu * nv, nu * nv)
    u = (u0[owner] + at % nu[owner]) % n
    v = v0[owner] + at // nu[owner]
    code = _spread(u) | (_spread(v) << 1)
    order = np.lexsort((code, owner))
    owner, code = owner[order], code[order]
    block = code >> _BLOCK_BITS
    new = np.ones(len(code), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (block[1:] != block[:-1]) | (code[1:] != code[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(code)) - 1 if len(first) else first
    return owner[first], block[first], code[first], code[last]


def with_code(points: DataFrame, lat: str, lon: str, level: int, code: str) -> DataFrame:
    """Add the Z-order code. Points without a valid latitude or longitude drop out."""
    n = F.lit(float(1 << level))
    top = F.lit((1 << level) - 1)
    ok = F.col(lat).between(-90, 90) & ~F.isnan(lon) & (F.abs(F.col(lon)) < 1e6)
    u = F.pmod(F.floor((F.col(lon) + 180) / 360 * n), F.lit(1 << level))
    v = F.least(F.floor((F.col(lat) + 90) / 180 * n), top)
    return geo.with_morton(points.where(ok), u, v, code)


def within_distance(centres: DataFrame, points: DataFrame, centre_id: str, point_id: str, radius_m: float, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Pairs (centre_id, point_id, dist_m) at most ``radius_m`` apart, each pair once.

    NULL, NaN or impossible coordinates match nothing; longitudes count modulo 360.
    Repeated rows of one id with the same values give one pair; an id delivered with
    different values gives the pair with the smallest distance. Empty sides give an empty
    result. Other columns, whatever their names, are ignored.
    """
    level = grid_level(radius_m)

    def cover(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            owner, block, lo, hi = disc_ranges(b.c_lat.to_numpy(float), b.c_lon.to_numpy(float), radius_m, level)
            rows = b.iloc[owner].reset_index(drop=True)
            yield rows.assign(block=block, code_lo=lo, code_hi=hi)

    c = centres.select(F.col(centre_id).alias("c_id"), F.col(lat).cast("double").alias("c_lat"), F.col(lon).cast("double").alias("c_lon"))
    c = c.where(F.col("c_lat").between(-90, 90) & ~F.isnan("c_lon") & (F.abs("c_lon") < 1e6))
    id_type = c.schema["c_id"].dataType.simpleString()
    ranges = c.mapInPandas(cover, f"c_id {id_type}, c_lat double, c_lon double, block long, code_lo long, code_hi long")
    p = points.select(F.col(point_id).alias("p_id"), F.col(lat).cast("double").alias("p_lat"), F.col(lon).cast("double").alias("p_lon"))
    p = with_code(p, "p_lat", "p_lon", level, "code").withColumn("block", F.shiftright("code", _BLOCK_BITS))
    dist = geo.haversine_m(F.col("c_lat"), F.col("c_lon"), F.col("p_lat"), F.col("p_lon"))
    return (
        p.join(ranges, "block")
        .where(F.col("code").between(F.col("code_lo"), F.col("code_hi")))
        .withColumn("dist_m", dist)
        .where(F.col("dist_m") <= radius_m)
        .groupBy(F.col("c_id").alias(centre_id), F.col("p_id").alias(point_id))
        .agg(F.min("dist_m").alias("dist_m"))
    )


def containing_cell(points: DataFrame, grid: DataFrame, edge: float, lat: str = "lat", lon: str = "lon", label: str = "h3") -> DataFrame:
    """Join each point with the label of the grid hexagon that contains it.

    Points in no hexagon of ``grid``, or without valid coordinates, drop out. ``grid``
    has the axial ``q`` and ``r``. The join has no hint: the grid is broadcast only where
    its size is below the session's threshold.
    """
    ok = F.col(lat).between(-80, 84) & F.col(lon).between(-80, 98)
    keyed = geo.with_axial(geo.with_utm32(points.where(ok), lat, lon, "_x", "_y"), "_x", "_y", edge, "_q", "_r").drop("_x", "_y")
    cells = grid.select(F.col("q").cast("long").alias("_q"), F.col("r").cast("long").alias("_r"), F.col(label))
    return keyed.join(cells, ["_q", "_r"]).drop("_q", "_r")
