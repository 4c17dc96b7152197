"""Projection, hex lattice and space-filling-curve expressions, all JVM-side.

The SQL twins of the projection and the hex rounding are in
:mod:`hexloom.plans.sql`; both follow the same closed forms.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

EARTH_M = 6371008.8

# WGS84 and UTM constants of the Krueger series to the third order.
_A, _FL = 6378137.0, 1 / 298.257223563
_N = _FL / (2 - _FL)
RECT = _A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
ALPHA = (_N / 2 - 2 / 3 * _N**2 + 5 / 16 * _N**3, 13 / 48 * _N**2 - 3 / 5 * _N**3, 61 / 240 * _N**3)
BETA = (_N / 2 - 2 / 3 * _N**2 + 37 / 96 * _N**3, 1 / 48 * _N**2 + 1 / 15 * _N**3, 17 / 480 * _N**3)
DELTA = (2 * _N - 2 / 3 * _N**2 - 2 * _N**3, 7 / 3 * _N**2 - 8 / 5 * _N**3, 56 / 15 * _N**3)
ECC = 2 * math.sqrt(_N) / (1 + _N)
K0, FALSE_E, LON0 = 0.9996, 500000.0, 9.0
SQRT3 = math.sqrt(3.0)
NOWHERE = -(1 << 20)


def _atanh(x: Column) -> Column:
    return F.lit(0.5) * F.log((1 + x) / (1 - x))


def with_utm32(df: DataFrame, lat: str, lon: str, x: str = "x", y: str = "y") -> DataFrame:
    """Add easting and northing in zone 32; NaN for NULL, so that joins on what follows
    from them add no filter (see :func:`with_morton`). Steps are columns of their own, so
    that no step is computed, or compiled, more than once."""
    s = F.sin(F.radians(F.col(lat)))
    df = df.withColumns({"_t": F.sinh(_atanh(s) - F.lit(ECC) * _atanh(F.lit(ECC) * s)), "_l": F.radians(F.col(lon) - F.lit(LON0))})
    df = df.withColumns({"_xi": F.atan2("_t", F.cos("_l")), "_eta": _atanh(F.sin("_l") / F.sqrt(1 + F.col("_t") * F.col("_t")))})
    xi, eta = F.col("_xi"), F.col("_eta")
    east, north = eta, xi
    for j, a in enumerate(ALPHA, 1):
        east = east + F.lit(a) * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        north = north + F.lit(a) * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    nan = F.lit(float("nan"))
    return df.withColumns({x: F.coalesce(F.lit(FALSE_E) + F.lit(K0 * RECT) * east, nan), y: F.coalesce(F.lit(K0 * RECT) * north, nan)}).drop("_t", "_l", "_xi", "_eta")


def utm32_inverse(x: Column, y: Column) -> tuple[Column, Column]:
    """Latitude and longitude of a point of zone 32."""
    xi, eta = y / F.lit(K0 * RECT), (x - F.lit(FALSE_E)) / F.lit(K0 * RECT)
    xi1, eta1 = xi, eta
    for j, b in enumerate(BETA, 1):
        xi1 = xi1 - F.lit(b) * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        eta1 = eta1 - F.lit(b) * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(xi1) / F.cosh(eta1))
    lat = chi
    for j, d in enumerate(DELTA, 1):
        lat = lat + F.lit(d) * F.sin(2 * j * chi)
    return F.degrees(lat), F.lit(LON0) + F.degrees(F.atan2(F.sinh(eta1), F.cos(xi1)))


# GRS80 and the European equal-area projection at 52 N, 10 E.
_F3 = 1 / 298.257222101
_E2 = _F3 * (2 - _F3)
LAEA_LAT, LAEA_LON, LAEA_X, LAEA_Y = 52.0, 10.0, 4_321_000.0, 3_210_000.0


def _authalic(s):
    """The authalic q of a sine, as a number or a column."""
    ec = math.sqrt(_E2)
    log = math.log if isinstance(s, float) else F.log
    return (1 - _E2) * (s / (1 - _E2 * s * s) - log((1 - ec * s) / (1 + ec * s)) / (2 * ec))


def with_laea(df: DataFrame, lat: str, lon: str, x: str = "x", y: str = "y") -> DataFrame:
    """Add easting and northing of the Lambert equal-area projection (52 N, 10 E)."""
    qp, s0 = _authalic(1.0), math.sin(math.radians(LAEA_LAT))
    rq = _A * math.sqrt(qp / 2)
    b0 = math.asin(_authalic(s0) / qp)
    d = _A * math.cos(math.radians(LAEA_LAT)) / math.sqrt(1 - _E2 * s0 * s0) / (rq * math.cos(b0))
    df = df.withColumns({"_s": F.sin(F.radians(F.col(lat))), "_l": F.radians(F.col(lon) - F.lit(LAEA_LON))})
    df = df.withColumn("_b", F.asin(_authalic(F.col("_s")) / qp))
    beta, lam = F.col("_b"), F.col("_l")
    df = df.withColumn("_k", F.lit(rq) * F.sqrt(2 / (1 + math.sin(b0) * F.sin(beta) + math.cos(b0) * F.cos(beta) * F.cos(lam))))
    east = F.lit(LAEA_X) + F.col("_k") * d * F.cos(beta) * F.sin(lam)
    north = F.lit(LAEA_Y) + F.col("_k") / d * (math.cos(b0) * F.sin(beta) - math.sin(b0) * F.cos(beta) * F.cos(lam))
    return df.withColumns({x: east, y: north}).drop("_s", "_l", "_b", "_k")


def with_axial(df: DataFrame, x: str, y: str, edge: float, q: str = "q", r: str = "r") -> DataFrame:
    """Add axial (q, r) of the pointy-top hexagon of that edge that contains (x, y);
    :data:`NOWHERE` for NULL. Never NULL, as in :func:`with_morton`."""
    df = df.withColumns({"_qf": (F.col(x) * F.lit(SQRT3 / 3) - F.col(y) / 3) / F.lit(edge), "_rf": F.col(y) * F.lit(2 / 3) / F.lit(edge)})
    df = df.withColumns({"_qi": F.rint("_qf"), "_ri": F.rint("_rf"), "_si": F.rint(-F.col("_qf") - F.col("_rf"))})
    df = df.withColumns({"_dq": F.abs(F.col("_qi") - F.col("_qf")), "_dr": F.abs(F.col("_ri") - F.col("_rf")), "_ds": F.abs(F.col("_si") + F.col("_qf") + F.col("_rf"))})
    q_off = (F.col("_dq") > F.col("_dr")) & (F.col("_dq") > F.col("_ds"))
    return df.withColumns(
        {
            q: F.coalesce(F.when(q_off, -F.col("_ri") - F.col("_si")).otherwise(F.col("_qi")).cast("long"), F.lit(NOWHERE)),
            r: F.coalesce(F.when(~q_off & (F.col("_dr") > F.col("_ds")), -F.col("_qi") - F.col("_si")).otherwise(F.col("_ri")).cast("long"), F.lit(NOWHERE)),
        }
    ).drop("_qf", "_rf", "_qi", "_ri", "_si", "_dq", "_dr", "_ds")


def hex_centre(q: Column, r: Column, edge: float) -> tuple[Column, Column]:
    return F.lit(edge * SQRT3) * (q + r / 2), F.lit(edge * 1.5) * r


def box_cells(boxes: DataFrame, edge: float) -> DataFrame:
    """Each box (x0, y0, x1, y1) with the ``cell`` of every hexagon whose centre lies in it."""
    rows = F.sequence(F.ceil(F.col("y0") / (edge * 1.5)), F.floor(F.col("y1") / (edge * 1.5)))
    wide = edge * SQRT3
    cols = F.sequence(F.ceil(F.col("x0") / wide - F.col("r") / 2), F.floor(F.col("x1") / wide - F.col("r") / 2))
    some = lambda lo, hi: F.col(lo) <= F.col(hi)
    b = boxes.where(some("x0", "x1") & some("y0", "y1")).withColumn("r", F.explode(rows)).withColumn("q", F.explode(cols))
    return b.withColumn("cell", cell_id(F.col("q"), F.col("r")))


def cell_id(q: Column, r: Column) -> Column:
    return (q + F.lit(1 << 20)) * F.lit(1 << 21) + (r + F.lit(1 << 20))


def cell_qr(cell: Column) -> tuple[Column, Column]:
    return F.shiftright(cell, 21) - F.lit(1 << 20), cell.bitwiseAND(F.lit((1 << 21) - 1)) - F.lit(1 << 20)


def with_cell(df: DataFrame, lat: str, lon: str, edge: float, cell: str = "cell") -> DataFrame:
    """Add the hex cell of WGS84 points; rows without valid coordinates drop out."""
    ok = df.where(F.col(lat).between(-80, 84) & F.col(lon).between(-80, 98))
    df = with_axial(with_utm32(ok, lat, lon, "_x", "_y"), "_x", "_y", edge, "_q", "_r")
    return df.withColumn(cell, cell_id(F.col("_q"), F.col("_r"))).drop("_x", "_y", "_q", "_r")


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.lit(2 * EARTH_M) * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def bearing(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Initial bearing in degrees from 0 to 360."""
    d = F.radians(lon2 - lon1)
    y = F.sin(d) * F.cos(F.radians(lat2))
    x = F.cos(F.radians(lat1)) * F.sin(F.radians(lat2)) - F.sin(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.cos(d)
    deg = F.degrees(F.atan2(y, x))
    return F.when(deg < 0, deg + 360.0).otherwise(deg)


def equirect_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    dx = F.radians(lon2 - lon1) * F.cos(F.radians((lat1 + lat2) / 2))
    return F.lit(EARTH_M) * F.sqrt(dx * dx + F.pow(F.radians(lat2 - lat1), 2))


def with_morton(df: DataFrame, u: Column, v: Column, code: str) -> DataFrame:
    """Add the Z-order code of two integers from 0 to 2**31 - 1; ``u`` takes the even places.

    Each doubling of the gaps is a column of its own, else the expression doubles too. The
    code is never NULL (-1 instead): a join on a nullable key adds a filter on it, which the
    optimizer would push below all these columns, written out in full.
    """
    low = F.lit(0x7FFFFFFF)
    df = df.withColumns({"_u": u.cast("long").bitwiseAND(low), "_v": v.cast("long").bitwiseAND(low)})
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        df = df.withColumns({c: F.col(c).bitwiseOR(F.shiftleft(c, shift)).bitwiseAND(F.lit(mask)) for c in ("_u", "_v")})
    return df.withColumn(code, F.coalesce(F.col("_u").bitwiseOR(F.shiftleft("_v", 1)), F.lit(-1))).drop("_u", "_v")
