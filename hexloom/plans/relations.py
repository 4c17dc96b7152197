"""Queries of single relational steps: ways, windows, groups of modes, chunks, manifests and
reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import geo, rules, text
from ..operators import reach as rc, spatial, ways
from ..session import table
from . import inputs as inp, scoring, sql

e = sql.e
BOX = (8.0, 49.0, 11.0, 52.0)


def _ways(spark: SparkSession, sf: str) -> DataFrame:
    lon, lat = inp.key_point("o_orderkey")
    return ways.vertices(table(spark, sf, "orders").select(F.col("o_custkey").alias("way"), F.col("o_orderkey").alias("seq"), lon.alias("lon"), lat.alias("lat")), "way", "seq")


def way_polygons(spark: SparkSession, sf: str) -> DataFrame:
    """Closed outlines of ways that meet a box."""
    return _ways(spark, sf).select("way", ways.outline(F.col("points"), BOX).alias("wkt")).where("wkt is not null")


def way_centroids(spark: SparkSession, sf: str) -> DataFrame:
    lon, lat = ways.centroid(F.col("points"))
    return _ways(spark, sf).select("way", F.round(lon, 6).alias("lon"), F.round(lat, 6).alias("lat"))


def way_dispatch(spark: SparkSession, sf: str) -> DataFrame:
    """How many objects go where, with tags made of their columns."""
    p = inp.objects(spark, sf)
    sub, k = F.coalesce("subcategory", F.lit("none")), F.col("osm_id") % 8
    key = F.when(k == 0, "highway").when(k == 1, "waterway").when(k == 2, "natural").when(k == 3, "landuse").when(k == 4, "military").otherwise("amenity")
    value = F.when(k == 0, F.when(F.col("osm_id") % 3 == 0, "primary").otherwise("footway")).when(k == 1, F.when(F.col("osm_id") % 3 == 0, "river").otherwise("stream")).when(k == 2, "tree_row").when(k == 3, "forest").when(k == 4, "base").otherwise(sub)
    tags = F.map_from_arrays(F.array(key), F.array(value))
    return p.select(tags.alias("tags")).select(F.coalesce(ways.route(), F.lit("none")).alias("route")).groupBy("route").agg(F.count(F.lit(1)).alias("n"))


def member_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Objects of some kinds of leisure, by a semi join on both columns, with the mass of each
    cell."""
    kinds = spark.createDataFrame([("entertainment", "cinema", 2.0), ("leisure", "climbing", 1.5), ("leisure", "swimming_pool", 1.0)], "category string, subcategory string, mass double")
    return inp.pois(spark, sf).join(kinds, ["category", "subcategory"]).groupBy("cell").agg(F.sum("mass").alias("mass"), F.count(F.lit(1)).alias("spots"))


def reliable_values(spark: SparkSession, sf: str) -> DataFrame:
    """Means by kreis of values whose footnote is blank."""
    s = table(spark, sf, "scores").where("kreis is not null and not isnan(s_green)")
    note = F.when(F.col("score_id") % 5 == 0, "()").when(F.col("score_id") % 7 == 0, " ")
    return s.where(F.trim(F.coalesce(note, F.lit(""))) == "").groupBy("kreis").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("s_green"), 6).alias("s_green"))


def mode_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Minutes by what a client calls a mode: the better of the columns it stands for."""
    groups = {"active": ["walk", "bike"], "car": ["car"]}
    wide = scoring._reach(spark, sf).groupBy("center", "cell").pivot("mode", ["walk", "bike", "car"]).agg(F.min("minutes"))
    best = lambda cols: F.least(*cols) if len(cols) > 1 else F.col(cols[0])
    return wide.select("center", "cell", *[F.round(best(cols), 4).alias(f"m_{name}") for name, cols in groups.items()])


def reach_floor(spark: SparkSession, sf: str) -> DataFrame:
    """The least minutes under the sentinel of each centre and mode, over all cells; infinite
    where there are none."""
    t = F.col("minutes")
    floor = F.coalesce(F.min(F.when(t < rc.HORIZON, t)), F.lit(float("inf")))
    return scoring._reach(spark, sf).groupBy("center", "mode").agg(F.round(floor, 4).alias("floor"))


def window_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Cells within 150 km of any centre of each batch of centres."""
    batch = F.shiftright("cell", 26).alias("batch")
    c = inp.centres(spark, sf).select("x", "y", batch)
    return spatial.radius_join(c, inp.grid_xy(spark, sf), 150_000.0).select("batch", "cell").distinct().groupBy("batch").agg(F.count(F.lit(1)).alias("cells"))


def boxed_grid(spark: SparkSession, sf: str) -> DataFrame:
    """Cells made for the bounding box of each region: those whose centre lies in it."""
    ring = F.col("ring")
    xs, ys = F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"])
    b = inp.regions(spark, sf).select("ags", F.array_min(xs).alias("x0"), F.array_max(xs).alias("x1"), F.array_min(ys).alias("y0"), F.array_max(ys).alias("y1"))
    return geo.box_cells(b, inp.EDGE_M).groupBy("ags").agg(F.count(F.lit(1)).alias("cells"), F.min("cell").alias("first"), F.max("cell").alias("last"))


def strongest_centres(spark: SparkSession, sf: str) -> DataFrame:
    """Centres with any pull, strongest first."""
    return inp.centres(spark, sf).where("weight > 2000").select("center", F.round("weight", 4).alias("weight")).orderBy(F.col("weight").desc(), "center")


def describe_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Count, mean, spread and range of the cell table's columns, a row each, from one pass."""
    cols = ["population", "rent_2022", "vacancy_pct", "s_green", "s_quiet"]
    fs = {"n": F.count, "mean": F.avg, "spread": F.stddev_samp, "least": F.min, "most": F.max}
    one = inp.cells(spark, sf).agg(*[f(c).cast("double").alias(f"{c}_{n}") for c in cols for n, f in fs.items()])
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("col"), *[F.col(f"{c}_{n}").alias(n) for n in fs]) for c in cols]))
    return one.select(each.alias("e")).select("e.col", F.col("e.n").cast("long").alias("n"), *[F.round(f"e.{n}", 5).alias(n) for n in ("mean", "spread", "least", "most")])


def prefix_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Schools by the district that their zip's first two digits name, with its weight."""
    j = table(spark, sf, "jedeschule").select(F.substring(text.zip5(F.col("zip")), 1, 2).alias("district")).where("district is not null")
    d = table(spark, sf, "nation").select(F.lpad((F.col("n_nationkey") * 3 + 10).cast("string"), 2, "0").alias("district"), "n_name")
    return j.join(d, "district").groupBy("district", "n_name").agg(F.count(F.lit(1)).alias("schools"))


def field_chunk(spark: SparkSession, sf: str) -> DataFrame:
    """Minutes, best and overall codes of each cell as one wide row by mode, 255 for nothing."""
    wide = scoring.mbo_field(spark, sf).groupBy("cell").pivot("mode", ["walk", "bike", "car"]).agg(F.max("m").alias("m"), F.max("b").alias("b"), F.max("o").alias("o"))
    cols = [f"{m}_{c}" for m in ("walk", "bike", "car") for c in "mbo"]
    return inp.grid(spark, sf).select("cell").join(wide, "cell", "left").select("cell", *[F.coalesce(c, F.lit(255)).alias(c) for c in cols])


def target_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Each centre as a target with its name, kind and number of targets of its name, as JSON."""
    c = inp.centres(spark, sf).select("center", "name")
    n = c.groupBy("name").agg(F.count(F.lit(1)).alias("of_name"))
    doc = F.to_json(F.struct(F.col("center").alias("id"), "name", F.lit("city").alias("kind"), "of_name"))
    return c.join(n, "name").select("center", doc.alias("target"))


def freshness(spark: SparkSession, sf: str) -> DataFrame:
    """When each table was last delivered, how many rows, and whether it lags the newest."""
    one = lambda t: table(spark, sf, t).agg(F.count(F.lit(1)).alias("n"), F.max("loaded_at").alias("last")).select(F.lit(t).alias("tab"), "n", "last")
    every = one("scores").unionByName(one("pois")).unionByName(one("jedeschule"))
    newest = every.agg(F.max("last")).scalar()
    return every.select("tab", "n", F.date_format("last", "yyyy-MM-dd").alias("last"), (F.col("last") < newest - F.expr("INTERVAL 30 DAYS")).alias("stale"))


FUNCTIONS = (
    way_polygons, way_centroids, way_dispatch, member_pairs, reliable_values, mode_groups, reach_floor, window_cells, boxed_grid, strongest_centres,
    describe_scores, prefix_lookup, field_chunk, target_manifest, freshness,
)


def queries() -> dict:
    return {f.__name__: f for f in FUNCTIONS}


def oracle_sql() -> dict[str, str]:
    from .scoring_sql import REACH, oracle_sql as scoring_sql

    points = inp.key_source("orders", "o_orderkey", "o_custkey AS way, o_orderkey AS seq")
    describe = " UNION ALL ".join(f"SELECT '{c}' AS col, count({c}) AS n, round(avg({c}), 5) AS mean, round(stddev_samp({c}), 5) AS spread, round(min({c}), 5) AS least, round(max({c}), 5) AS most FROM c" for c in ("population", "rent_2022", "vacancy_pct", "s_green", "s_quiet"))
    wide = ", ".join(f"CAST(coalesce(max({c}) FILTER (mode = '{m}'), 255) AS INT) AS {m}_{c}" for m in ("walk", "bike", "car") for c in "mbo")
    tables = " UNION ALL ".join(f"SELECT '{t}' AS tab, count(*) AS n, max(loaded_at) AS last FROM {t}" for t in ("scores", "pois", "jedeschule"))
    return {
        "way_polygons": f"""WITH v AS (SELECT way, seq, lon, lat, row_number() OVER (PARTITION BY way ORDER BY seq) AS k, count(*) OVER (PARTITION BY way) AS n FROM {points}),
          a AS (SELECT way, any_value(n) AS n, bool_or(lon BETWEEN 8 AND 11 AND lat BETWEEN 49 AND 52) AS meets, string_agg(printf('%.7f %.7f', lon, lat), ', ' ORDER BY seq) AS ring, max(printf('%.7f %.7f', lon, lat)) FILTER (k = 1) AS first, max(printf('%.7f %.7f', lon, lat)) FILTER (k = n) AS last FROM v GROUP BY way)
          SELECT way, 'POLYGON ((' || ring || CASE WHEN first <> last THEN ', ' || first ELSE '' END || '))' AS wkt FROM a WHERE n >= 3 AND meets""",
        "way_centroids": f"SELECT way, round(avg(lon), 6) AS lon, round(avg(lat), 6) AS lat FROM {points} GROUP BY way",
        "way_dispatch": f"""WITH o AS (SELECT DISTINCT ON (osm_id) * FROM pois ORDER BY osm_id, loaded_at DESC NULLS LAST), r AS (SELECT CASE WHEN osm_id % 8 = 0 AND osm_id % 3 = 0 THEN 'primary' WHEN osm_id % 8 = 0 THEN 'none' WHEN osm_id % 8 = 1 THEN CASE WHEN osm_id % 3 = 0 THEN 'river' ELSE 'stream' END
          WHEN osm_id % 8 = 2 THEN 'trees' WHEN osm_id % 8 = 3 THEN 'green:forest' WHEN osm_id % 8 = 4 THEN 'closed:military' WHEN subcategory IN ('bar', 'pub', 'cafe', 'restaurant', 'fast_food', 'cinema', 'theatre') THEN 'poi:entertainment/' || subcategory
          WHEN subcategory = 'pharmacy' THEN 'poi:family/pharmacy' WHEN subcategory = 'doctors' THEN 'poi:family/doctor' WHEN subcategory = 'dentist' THEN 'poi:family/dentist' WHEN subcategory = 'kindergarten' THEN 'poi:family/kita' ELSE 'none' END AS route FROM o)
          SELECT route, count(*) AS n FROM r GROUP BY route""",
        "member_pairs": f"WITH {inp.POIS}, k(category, subcategory, mass) AS (VALUES ('entertainment', 'cinema', 2e0), ('leisure', 'climbing', 15e-1), ('leisure', 'swimming_pool', 1e0)) SELECT cell, sum(mass) AS mass, count(*) AS spots FROM p JOIN k USING (category, subcategory) GROUP BY cell",
        "reliable_values": "SELECT kreis, count(*) AS n, round(avg(s_green), 6) AS s_green FROM scores WHERE kreis IS NOT NULL AND NOT isnan(s_green) AND score_id % 5 <> 0 GROUP BY kreis",
        "mode_groups": f"WITH {REACH} SELECT center, cell, round(min(minutes) FILTER (mode IN ('walk', 'bike')), 4) AS m_active, round(min(minutes) FILTER (mode = 'car'), 4) AS m_car FROM re GROUP BY center, cell",
        "reach_floor": f"WITH {REACH} SELECT center, mode, round(coalesce(min(minutes) FILTER (minutes < 120), 'inf'::DOUBLE), 4) AS floor FROM re GROUP BY center, mode",
        "window_cells": f"WITH {inp.CENTRES}, {inp.GRID_XY}, w AS (SELECT DISTINCT z.cell >> 26 AS batch, g.cell FROM z, g WHERE abs(z.x - g.x) <= 150000 AND abs(z.y - g.y) <= 150000 AND sqrt(pow(z.x - g.x, 2) + pow(z.y - g.y, 2)) <= 150000) SELECT batch, count(*) AS cells FROM w GROUP BY batch",
        "boxed_grid": f"""WITH {inp.REGIONS}, b AS (SELECT ags, min(x1) AS x0, max(x1) AS x1, min(y1) AS y0, max(y1) AS y1 FROM edges GROUP BY ags), r0 AS (SELECT *, unnest(range(CAST(ceil(y0 / 6000e0) AS BIGINT), CAST(floor(y1 / 6000e0) AS BIGINT) + 1)) AS r FROM b),
          q0 AS (SELECT ags, r, unnest(range(CAST(ceil(x0 / {e(4000 * geo.SQRT3)} - r / 2e0) AS BIGINT), CAST(floor(x1 / {e(4000 * geo.SQRT3)} - r / 2e0) AS BIGINT) + 1)) AS q FROM r0), k AS (SELECT ags, (q + 1048576) * 2097152 + r + 1048576 AS cell FROM q0)
          SELECT ags, count(*) AS cells, min(cell) AS first, max(cell) AS last FROM k GROUP BY ags""",
        "strongest_centres": f"WITH {inp.CENTRES} SELECT center, round(weight, 4) AS weight FROM z WHERE weight > 2000",
        "describe_scores": f"WITH {inp.CELLS} {describe}",
        "prefix_lookup": f"WITH j AS (SELECT left({sql.zip5('zip')}, 2) AS district FROM jedeschule), d AS (SELECT lpad(CAST(n_nationkey * 3 + 10 AS VARCHAR), 2, '0') AS district, n_name FROM nation) SELECT district, n_name, count(*) AS schools FROM j JOIN d USING (district) GROUP BY ALL",
        "field_chunk": f"WITH f AS ({scoring_sql()['mbo_field']}), w AS (SELECT cell, {wide} FROM f GROUP BY cell) SELECT grid.cell, {', '.join(f'coalesce({m}_{c}, 255) AS {m}_{c}' for m in ('walk', 'bike', 'car') for c in 'mbo')} FROM grid LEFT JOIN w USING (cell)",
        "target_manifest": f"""WITH {inp.CENTRES} SELECT center, '{{"id":' || center || ',"name":"' || name || '","kind":"city","of_name":' || count(*) OVER (PARTITION BY name) || '}}' AS target FROM z""",
        "freshness": f"WITH t AS ({tables}) SELECT tab, n, strftime(last, '%Y-%m-%d') AS last, last < (SELECT max(last) FROM t) - INTERVAL 30 DAY AS stale FROM t",
    }
