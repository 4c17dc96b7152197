"""Relations that the queries share, derived from the given tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import geo
from ..session import materialise, table
from . import sql

EDGE_M = 4000.0
E4 = sql.e(EDGE_M)
VALID = "NOT isnan(lat) AND NOT isnan(lon) AND lat BETWEEN -80 AND 84 AND lon BETWEEN -80 AND 98"


def grid(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "grid").select("cell", F.col("q").cast("long").alias("q"), F.col("r").cast("long").alias("r"), "lat", "lon")


def grid_xy(spark: SparkSession, sf: str) -> DataFrame:
    """Cells with the planar coordinates of their centres."""
    g = grid(spark, sf)
    x, y = geo.hex_centre(F.col("q"), F.col("r"), EDGE_M)
    return g.select("cell", x.alias("x"), y.alias("y"))


OBJECT = ("category", "subcategory", "name", "lat", "lon")


def pois(spark: SparkSession, sf: str, columns: tuple[str, ...] = OBJECT) -> DataFrame:
    """Objects once each, with their cell; invalid coordinates drop out."""
    return geo.with_cell(objects(spark, sf, columns), "lat", "lon", EDGE_M)


def objects(spark: SparkSession, sf: str, columns: tuple[str, ...] = OBJECT) -> DataFrame:
    """Each object as delivered last; only ``columns`` of it go through the shuffle."""
    last = F.max_by(F.struct(*columns), F.coalesce("loaded_at", F.lit("1970-01-01").cast("timestamp_ntz")))
    return table(spark, sf, "pois").groupBy("osm_id").agg(last.alias("o")).select("osm_id", *[F.col(f"o.{c}").alias(c) for c in columns])


def pois_xy(spark: SparkSession, sf: str, columns: tuple[str, ...] = OBJECT) -> DataFrame:
    return geo.with_utm32(objects(spark, sf, columns).where(VALID), "lat", "lon")


def cells(spark: SparkSession, sf: str) -> DataFrame:
    """One row a cell with means over the builds of scores; missing values left out."""
    s = table(spark, sf, "scores")
    ok = lambda c, cond: F.avg(F.when(~F.isnan(c) & cond, F.col(c))).alias(c)
    return s.groupBy("cell").agg(
        F.max("kreis").alias("kreis"),
        ok("population", F.col("population") >= 0),
        ok("rent_2022", (F.col("rent_2022") > 0) & (F.col("rent_2022") < 100)),
        ok("vacancy_pct", F.col("vacancy_pct").between(0, 100)),
        F.avg("s_green").alias("s_green"),
        F.avg("s_quiet").alias("s_quiet"),
        F.bool_or("inhabited").alias("inhabited"),
    )


def key_point(key: str) -> tuple:
    """Made-up coordinates of a key: lon, lat."""
    k = F.col(key)
    return F.lit(6.0) + (k * 7919 % 9000) / 1000.0, F.lit(47.3) + (k * 6007 % 7700) / 1000.0


def centres(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers as centres: center, name, weight, x, y, cell."""
    lon, lat = key_point("s_suppkey")
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("center"), F.concat(F.lit("n"), "s_nationkey").alias("name"), (F.greatest(F.col("s_acctbal"), F.lit(0.0)) + 1000.0).alias("weight"), lon.alias("lon"), lat.alias("lat"))
    s = geo.with_utm32(s, "lat", "lon")
    return geo.with_axial(s, "x", "y", EDGE_M, "q", "r").withColumn("cell", geo.cell_id(F.col("q"), F.col("r"))).drop("q", "r")


def regions(spark: SparkSession, sf: str) -> DataFrame:
    """Nations as hexagons of 70 km: ags, gen, ring."""
    lon, lat = key_point("n_nationkey")
    n = geo.with_utm32(table(spark, sf, "nation").select(F.col("n_nationkey").alias("ags"), F.col("n_name").alias("gen"), lon.alias("lon"), lat.alias("lat")), "lat", "lon")
    ring = F.array(*[F.struct((F.col("x") + dx).alias("x"), (F.col("y") + dy).alias("y")) for dx, dy in HEXAGON])
    # written out: a filter on the ring would drag the whole projection into it
    return materialise(n.select("ags", "gen", ring.alias("ring")))


HEXAGON = ((70000.0, 0.0), (35000.0, 60621.0), (-35000.0, 60621.0), (-70000.0, 0.0), (-35000.0, -60621.0), (35000.0, -60621.0))

# --- SQL ---------------------------------------------------------------------------------

ONCE = f"(SELECT DISTINCT ON (osm_id) osm_id, category, subcategory, name, lat, lon FROM pois WHERE {VALID} ORDER BY osm_id, loaded_at DESC NULLS LAST)"
POIS = f"p AS (SELECT *, (q + 1048576) * 2097152 + r + 1048576 AS cell FROM ({sql.utm32_cells(ONCE, 'lat', 'lon', EDGE_M, 'osm_id, category, subcategory, name')}))"
GRID_XY = f"g AS (SELECT cell, q, r, {sql.e(EDGE_M * geo.SQRT3)} * (q + r / 2e0) AS x, {sql.e(EDGE_M * 1.5)} * r AS y FROM grid)"
CELLS = """c AS (SELECT cell, max(kreis) AS kreis, avg(population) FILTER (NOT isnan(population) AND population >= 0) AS population,
    avg(rent_2022) FILTER (NOT isnan(rent_2022) AND rent_2022 > 0 AND rent_2022 < 100) AS rent_2022,
    avg(vacancy_pct) FILTER (NOT isnan(vacancy_pct) AND vacancy_pct BETWEEN 0 AND 100) AS vacancy_pct,
    avg(s_green) AS s_green, avg(s_quiet) AS s_quiet, bool_or(inhabited) AS inhabited FROM scores GROUP BY cell)"""


def key_source(source: str, key: str, columns: str) -> str:
    return f"(SELECT {columns}, 6e0 + ({key} * 7919 % 9000) / 1000e0 AS lon, 473e-1 + ({key} * 6007 % 7700) / 1000e0 AS lat FROM {source})"


CENTRES = f"z AS (SELECT *, (q + 1048576) * 2097152 + r + 1048576 AS cell FROM ({sql.utm32_cells(key_source('supplier', 's_suppkey', 's_suppkey AS center, concat(chr(110), s_nationkey) AS name, greatest(s_acctbal, 0e0) + 1000e0 AS weight'), 'lat', 'lon', EDGE_M, 'center, name, weight')}))"
REGIONS = f"""n0 AS ({sql.utm32_cells(key_source('nation', 'n_nationkey', 'n_nationkey AS ags, n_name AS gen'), 'lat', 'lon', EDGE_M, 'ags, gen')}),
  edges AS (SELECT ags, gen, x + ax AS x1, y + ay AS y1, x + bx AS x2, y + by_ AS y2 FROM n0, (VALUES {", ".join(f"({sql.e(a[0])}, {sql.e(a[1])}, {sql.e(b[0])}, {sql.e(b[1])})" for a, b in zip(HEXAGON, HEXAGON[1:] + HEXAGON[:1]))}) AS v(ax, ay, bx, by_))"""


def disk(source: str, k: int, columns: str) -> str:
    """The SQL twin of :func:`hexloom.operators.kernels.disk`."""
    return f"""(SELECT cell + dq * 2097152 + dr AS cell, (abs(dq) + abs(dr) + abs(dq + dr)) / 2e0 AS ring, cell AS src_cell, {columns}
    FROM {source}, (SELECT dq, dr FROM range({-k}, {k + 1}) AS a(dq), range({-k}, {k + 1}) AS b(dr) WHERE abs(dq + dr) <= {k}))"""
