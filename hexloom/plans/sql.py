"""SQL text shared by the checks of several queries (DuckDB dialect)."""

from __future__ import annotations

from ..functions import geo


def e(x: float) -> str:
    """A literal that is a double, not a decimal."""
    return f"{x!r}" if "e" in f"{x!r}" else f"{x!r}e0"


def strip(c: str) -> str:
    return f"regexp_replace({c}, '^[\\s\\x{{a0}}\\x{{2009}}\\x{{202f}}\\x{{feff}}]+|[\\s\\x{{a0}}\\x{{2009}}\\x{{202f}}\\x{{feff}}]+$', '', 'g')"


def number(c: str) -> str:
    s = strip(c)
    return f"CASE WHEN regexp_full_match({s}, '[+-]?[0-9]+([.,][0-9]+)?') THEN CAST(replace({s}, ',', '.') AS DOUBLE) END"


def usable(c: str, low: float, high: float) -> str:
    return f"CASE WHEN ({number(c)}) BETWEEN {e(low)} AND {e(high)} THEN ({number(c)}) END"


def zip5(c: str) -> str:
    d = f"regexp_replace({c}, '[^0-9]', '', 'g')"
    return f"CASE WHEN length({d}) >= 5 THEN left({d}, 5) END"


def utm32_cells(source: str, lat: str, lon: str, edge: float, keep: str) -> str:
    """SELECT of ``keep``, with x, y, q, r of each point of ``source``."""
    east = " + ".join(["eta"] + [f"{e(a)} * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, a in enumerate(geo.ALPHA, 1)])
    north = " + ".join(["xi"] + [f"{e(a)} * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, a in enumerate(geo.ALPHA, 1)])
    qr = "abs(qi - qf) > abs(ri - rf) AND abs(qi - qf) > abs(si - sf)"
    return f"""
      SELECT {keep}, x, y,
        TRY_CAST(CASE WHEN {qr} THEN -ri - si ELSE qi END AS BIGINT) AS q,
        TRY_CAST(CASE WHEN NOT ({qr}) AND abs(ri - rf) > abs(si - sf) THEN -qi - si ELSE ri END AS BIGINT) AS r
      FROM (SELECT *, round_even(qf, 0) AS qi, round_even(rf, 0) AS ri, round_even(sf, 0) AS si FROM (
        SELECT *, (x * {e(geo.SQRT3 / 3)} - y / 3) / {e(edge)} AS qf, y * {e(2 / 3)} / {e(edge)} AS rf,
          -((x * {e(geo.SQRT3 / 3)} - y / 3) / {e(edge)}) - y * {e(2 / 3)} / {e(edge)} AS sf FROM (
          SELECT *, {e(geo.FALSE_E)} + {e(geo.K0 * geo.RECT)} * ({east}) AS x, {e(geo.K0 * geo.RECT)} * ({north}) AS y FROM (
            SELECT *, atan2(tt, cos(lam)) AS xi, atanh(sin(lam) / sqrt(1 + tt * tt)) AS eta FROM (
              SELECT *, sinh(atanh(sin(phi)) - {e(geo.ECC)} * atanh({e(geo.ECC)} * sin(phi))) AS tt FROM (
                SELECT *, radians({lat}) AS phi, radians({lon} - {e(geo.LON0)}) AS lam FROM {source}))))))"""


def haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return f"({e(2 * geo.EARTH_M)} * asin(least(1e0, sqrt(pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2)))))"
