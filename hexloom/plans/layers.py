"""Queries over the hex grid: kernels, spatial joins and layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import geo, rules, shape
from ..operators import iterate, kernels as kn, ordering, spatial, stats, streets, timetable, validate
from ..session import table
from . import inputs as inp, sql

SC, STEP, SPREAD = kn.SCALE, kn.STEP_KM, kn.SPREAD_KM
e = sql.e


def _r(name: str, n: int = 6):
    return F.round(name, n).alias(name)


# --- kernels -------------------------------------------------------------------------------


def ent_density(spark: SparkSession, sf: str) -> DataFrame:
    """Weighted density of going out around each cell, in all and by group."""
    out = inp.pois(spark, sf, ("category", "subcategory", "lat", "lon")).where("category = 'entertainment'")
    weight = F.lit(1.0)
    for k, w in rules.ENT_WEIGHTS.items():
        weight = F.when(F.col("subcategory") == k, F.lit(w)).otherwise(weight)
    out = out.withColumn("w", weight)
    groups = [F.sum(F.when(F.col("subcategory").isin(*subs), F.col("w"))).alias(g) for g, subs in rules.ENT_GROUPS.items()]
    src = out.groupBy("cell").agg(F.sum("w").alias("ent_density"), *groups)
    cols = ["ent_density", *rules.ENT_GROUPS]
    return kn.disk_weighted_sum(src, inp.grid(spark, sf), cols, 6, 1.5 * SC).select("cell", *[_r(c) for c in cols])


def population_catchment(spark: SparkSession, sf: str) -> DataFrame:
    """Median density around each cell and three decayed catchments."""
    src, g = inp.cells(spark, sf).select("cell", "population"), inp.grid(spark, sf)
    sums = kn.disk_weighted_sums(src, g, "population", {"catchment_pop": (4, 3.0 * SC), "catchment_wide": (7, 4.0 * SC), "catchment_leisure": (6, 1.5 * SC)})
    out = sums.join(kn.disk_median(src, "population", 1, 3).withColumnRenamed("population", "density"), "cell", "left")
    return out.select("cell", *[_r(c, 4) for c in ("density", "catchment_pop", "catchment_wide", "catchment_leisure")])


def disk_max_reach(spark: SparkSession, sf: str) -> DataFrame:
    src = inp.cells(spark, sf).select("cell", "s_green", "s_quiet")
    return kn.disk_weighted_max(src, inp.grid(spark, sf), ["s_green", "s_quiet"], 12, 6.0 * SC).select("cell", _r("s_green"), _r("s_quiet"))


def gaussian_feather(spark: SparkSession, sf: str) -> DataFrame:
    """Several columns smoothed in one pass, each from the values before smoothing."""
    cols = ["rent_2022", "vacancy_pct", "s_green"]
    return kn.disk_gaussian_mean(inp.cells(spark, sf).select("cell", *cols), cols, 2, 1.0 * SC).select("cell", *[_r(c) for c in cols])


def kernel_shrink_rent(spark: SparkSession, sf: str) -> DataFrame:
    """Rents shrunk towards the kreis' weighted mean where few people live."""
    src = inp.cells(spark, sf).select("cell", "kreis", "rent_2022", "population")
    prior = src.groupBy("kreis").agg(stats.weighted_mean("rent_2022", "population").alias("prior"))
    joined = src.join(prior, "kreis", "left")
    return kn.kernel_shrink(joined, "rent_2022", "population", "prior").select("cell", _r("rent_2022"))


def disk_mean_spread(spark: SparkSession, sf: str) -> DataFrame:
    """Flat mean over grid neighbours, and how far a cell stands out of its ring."""
    src, g = inp.cells(spark, sf).select("cell", "s_quiet"), inp.grid(spark, sf)
    mean = kn.disk_mean(src, g, "s_quiet", 1)
    return mean.join(kn.disk_spread(src, "s_quiet"), "cell", "left").select("cell", _r("s_quiet"), _r("spread"), _r("deviation"))


def dilated_water(spark: SparkSession, sf: str) -> DataFrame:
    """Cells within one ring of a swimming place."""
    return kn.dilate(inp.pois(spark, sf).where("subcategory = 'swimming_pool'").select("cell").distinct(), 1)


def repair_rounds(spark: SparkSession, sf: str) -> DataFrame:
    """Gaps in s_quiet (set where vacancy is unknown) filled from neighbours."""
    src = inp.cells(spark, sf).select("cell", F.when(F.col("vacancy_pct").isNotNull(), F.col("s_quiet")).alias("v"), "inhabited")
    return kn.repair(src, "v", F.col("inhabited")).select("cell", _r("v"))


# --- timetable -----------------------------------------------------------------------------


def service_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Service around each cell from a timetable made of events: the user is the stop, the
    type the route, the event the trip and its day the service."""
    import datetime as dt

    ev = table(spark, sf, "events").select("event_id", "user_id", "event_type", F.date_format("ts", "yyyyMMdd").alias("day"))
    day = dt.date(2024, 1, 3)
    trips = ev.select(F.col("event_id").alias("trip_id"), F.col("event_type").alias("route_id"), F.pmod("event_id", F.lit(7)).alias("service_id"))
    routes = trips.select("route_id", F.when(F.length("route_id") % 2 == 0, "2").otherwise("3").alias("route_type")).distinct()
    ids = spark.range(7).toDF("service_id")
    flag = lambda cond: F.when(cond, "1").otherwise("0")
    calendar = ids.select("service_id", *[flag((F.col("service_id") + i) % 3 > 0).alias(d) for i, d in enumerate(timetable.DAYS)], F.lit("20230101").alias("start_date"), F.lit("20251231").alias("end_date"))
    dates = ids.where("service_id in (0, 4)").select("service_id", F.lit("20240103").alias("date"), F.when(F.col("service_id") == 0, "1").otherwise("2").alias("exception_type"))
    stop_times = ev.select(F.col("event_id").alias("trip_id"), F.col("user_id").alias("stop_id"))
    deps = timetable.departures(stop_times, trips, routes, timetable.active_services(calendar, dates, day))
    lon, lat = inp.key_point("stop_id")
    stops = geo.with_cell(ev.select(F.col("user_id").alias("stop_id")).distinct().select("stop_id", lon.alias("lon"), lat.alias("lat")), "lat", "lon", inp.EDGE_M)
    weight = F.when(F.col("route_type") == "2", F.lit(2.0)).otherwise(F.lit(1.0))
    return timetable.service_quality(deps, stops, inp.grid(spark, sf), weight).select("cell", _r("departures"), _r("routes"), _r("quality"))


# --- spatial joins --------------------------------------------------------------------------


def point_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Objects a cell and category."""
    return inp.pois(spark, sf).groupBy("cell", "category").agg(F.count(F.lit(1)).alias("n"))


def nearest_facility(spark: SparkSession, sf: str) -> DataFrame:
    """Minutes on foot and by bike to three kinds of place, averaged over a cell's rim."""
    kinds = ["pharmacy", "kindergarten", "supermarket"]
    places = inp.pois_xy(spark, sf, ("subcategory", "lat", "lon")).select("x", "y", F.col("subcategory").alias("kind"))
    mean = spatial.nearest_around(inp.grid_xy(spark, sf), places, "cell", kn.rim_offsets(), 12_000.0, "kind", kinds).withColumnRenamed("dist", "m")
    per = lambda kmh: F.col("m") * F.lit(60 * 1.3 / (kmh * 1000))
    return mean.select("cell", "kind", F.round(per(4.5), 4).alias("walk_min"), F.round(per(15.0), 4).alias("bike_min"))


def nearest_label(spark: SparkSession, sf: str) -> DataFrame:
    """The nearest named place of each school point: a viewpoint within 1,500 m, else the
    nearest cinema."""
    pts = geo.with_utm32(table(spark, sf, "schools_points").where(inp.VALID), "lat", "lon").select("point_id", "x", "y")
    named = inp.pois_xy(spark, sf).where("name is not null")
    fine = spatial.nearest(pts, named.where("category = 'nature'"), "point_id", ["name"], 1500.0, 1500.0, "osm_id")
    coarse = spatial.nearest(pts, named.where("subcategory = 'cinema'"), "point_id", ["name"], 8000.0, None, "osm_id")
    both = coarse.select("point_id", F.col("name").alias("far")).join(fine.select("point_id", F.col("name").alias("near")), "point_id", "full")
    return both.select("point_id", F.coalesce("near", "far").alias("label"))


def poly_assign(spark: SparkSession, sf: str) -> DataFrame:
    """The region of each object; where regions overlap, the smallest ags."""
    pts = inp.pois_xy(spark, sf).select("osm_id", "x", "y")
    hit = spatial.polygon_join(pts, inp.regions(spark, sf), 50_000.0)
    return hit.groupBy("osm_id").agg(F.min(F.struct("ags", "gen")).alias("r"), F.count(F.lit(1)).alias("regions")).select("osm_id", "r.ags", "r.gen", "regions")


def noise_energy(spark: SparkSession, sf: str) -> DataFrame:
    """Levels of centres at cells within 30 km added as energies, and decayed proximity."""
    src = inp.centres(spark, sf).select("center", "x", "y", (F.lit(60.0) + F.col("weight") / 500).alias("level"))
    pairs = spatial.radius_join(src, inp.grid_xy(spark, sf), 30_000.0)
    at = F.col("level") - 20 * F.log10(F.greatest(F.col("dist"), F.lit(100.0)) / 100)
    out = pairs.groupBy("cell").agg(stats.energy_sum(at).alias("db"), F.sum(F.exp(-F.col("dist") / 10_000)).alias("near"))
    return out.select("cell", _r("db", 4), _r("near"), F.round(shape.noise_anchor(F.col("db")), 6).alias("annoyance"))


def anti_gapfill(spark: SparkSession, sf: str) -> DataFrame:
    """Primary schools of the register's points, and those of the map that have none near."""
    own = geo.with_utm32(table(spark, sf, "schools_points").where(inp.VALID), "lat", "lon").where("is_grund")
    osm = inp.pois_xy(spark, sf).where("category = 'school' and subcategory = 'grundschule'")
    extra = spatial.anti_within(osm.select("osm_id", "x", "y"), own.select("x", "y"), "osm_id", 150.0)
    return own.select(F.lit("register").alias("origin"), F.col("point_id").alias("id")).unionByName(extra.select(F.lit("map").alias("origin"), F.col("osm_id").alias("id")))


def line_densify(spark: SparkSession, sf: str) -> DataFrame:
    """Samples every 25 km along the polyline of each customer's orders."""
    lon, lat = inp.key_point("o_orderkey")
    pts = geo.with_utm32(table(spark, sf, "orders").select(F.col("o_custkey").alias("way"), F.col("o_orderkey").alias("seq"), lon.alias("lon"), lat.alias("lat")), "lat", "lon")
    return spatial.densify(pts, "way", "seq", 25_000.0).groupBy("way").agg(F.count(F.lit(1)).alias("samples"), F.round(F.sum("x"), 1).alias("x"), F.round(F.sum("y"), 1).alias("y"))


def street_grain(spark: SparkSession, sf: str) -> DataFrame:
    """Disorder, turning and grain of ways made of each customer's orders."""
    lon, lat = inp.key_point("o_orderkey")
    pts = table(spark, sf, "orders").select(F.col("o_custkey").alias("way"), F.col("o_orderkey").alias("seq"), lon.alias("lon"), lat.alias("lat"))
    seg = streets.way_segments(pts)
    middles = geo.with_cell(seg.select("mid_lat", "mid_lon", "metres", "bearing"), "mid_lat", "mid_lon", inp.EDGE_M)
    vertices = geo.with_cell(seg.where("turn is not null").select("lat", "lon", "turn"), "lat", "lon", inp.EDGE_M)
    return streets.grain(middles, vertices, inp.grid(spark, sf)).select("cell", _r("disorder"), _r("turn", 4), _r("grain"))


def centers_nms(spark: SparkSession, sf: str) -> DataFrame:
    """Centres by population, none within 45 km of a stronger one."""
    pts = inp.cells(spark, sf).select("cell", F.col("population").alias("pop")).join(inp.grid_xy(spark, sf), "cell").where("pop > 0")
    return iterate.non_max_suppression(pts, "cell", 12_000.0, 45_000.0, 3500.0).select("cell", F.round("pop_s", 3).alias("pop_s"))


def city_clusters(spark: SparkSession, sf: str) -> DataFrame:
    """Centres of one name within 150 km of each other as one city, with its label."""
    return iterate.city_groups(inp.centres(spark, sf), "center", "name", "weight", 150_000.0)


def center_regions(spark: SparkSession, sf: str) -> DataFrame:
    """The region of each centre, the nearest one where none contains it."""
    near = spatial.nearest_polygon(inp.centres(spark, sf), inp.regions(spark, sf), "center", "gen", 10_000.0, 50_000.0)
    return near.select("center", "gen", F.round("dist", 3).alias("dist"))


def remapped_stops(spark: SparkSession, sf: str) -> DataFrame:
    """Departures by stop under the stops' numbers in another network."""
    ev = table(spark, sf, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    other = ev.select("user_id", (F.col("user_id") * 7 + 3).alias("number"))
    return ordering.remapped(ev, other, "user_id", "user_id", "number").select(F.col("user_id").alias("stop"), "n")


def validate_rules(spark: SparkSession, sf: str) -> DataFrame:
    c = inp.cells(spark, sf)
    rules_ = [
        validate.Rule("cells", F.count(F.lit(1)), 10_000, 20_000),
        validate.Rule("green range", F.max("s_green"), 0, 1),
        validate.Rule("rent median", F.percentile("rent_2022", 0.5), 3, 15),
        validate.Rule("inhabited share", validate.share(F.col("inhabited")), 0.5, 1),
        validate.Rule("quiet p95", F.percentile("s_quiet", 0.95), 0.4, 0.99),
    ]
    return validate.check(c, rules_).withColumn("value", F.round("value", 6))


def kreis_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Whether any object of two kinds lies in each kreis."""
    place = inp.cells(spark, sf).select("cell", "kreis").where("kreis is not null")
    at = inp.pois(spark, sf).join(place, "cell").select("kreis", (F.col("category") == "school").alias("school"), (F.col("subcategory") == "cinema").alias("cinema"))
    return validate.coverage(at, place, "kreis", ["school", "cinema"])


FUNCTIONS = (
    ent_density, population_catchment, disk_max_reach, gaussian_feather, kernel_shrink_rent, disk_mean_spread, dilated_water, repair_rounds, service_quality, point_cells,
    nearest_facility, nearest_label, poly_assign, noise_energy, anti_gapfill, line_densify, street_grain, centers_nms, city_clusters, center_regions, remapped_stops, validate_rules, kreis_coverage,
)


def queries() -> dict:
    return {f.__name__: f for f in FUNCTIONS}


# --- SQL -----------------------------------------------------------------------------------

_W = lambda scale: f"exp(-sqrt(pow(ring * {e(STEP)}, 2) + {e(SPREAD**2)}) / {e(scale)})"
_W0 = lambda scale: f"exp(-(ring * {e(STEP)}) / {e(scale)})"
_G = lambda sigma, spread=True: f"exp(-(pow(ring * {e(STEP)}, 2) + {e(SPREAD**2 if spread else 0.0)}) / {e(2 * sigma**2)})"


def _ent() -> str:
    case = " ".join(f"WHEN subcategory = '{k}' THEN {e(w)}" for k, w in rules.ENT_WEIGHTS.items())
    groups = ", ".join("sum(w) FILTER (subcategory IN ({})) AS {}".format(", ".join(f"'{s}'" for s in subs), g) for g, subs in rules.ENT_GROUPS.items())
    cols = ["ent_density", *rules.ENT_GROUPS]
    sums = ", ".join(f"sum({c} * {_W(1.5 * SC)}) AS {c}" for c in cols)
    final = ", ".join(f"round(coalesce(d.{c}, 0e0), 6) AS {c}" for c in cols)
    return f"""WITH {inp.POIS}, w AS (SELECT *, CASE {case} ELSE 1e0 END AS w FROM p WHERE category = 'entertainment'),
      s AS (SELECT cell, sum(w) AS ent_density, {groups} FROM w GROUP BY cell),
      d AS (SELECT cell, {sums} FROM {inp.disk("s", 6, ", ".join(cols))} GROUP BY cell)
      SELECT grid.cell, {final} FROM grid LEFT JOIN d USING (cell)"""


def _catchment() -> str:
    parts = "".join(
        f", {n} AS (SELECT cell, sum(population * {_W(s * SC)}) FILTER (population > 0) AS v FROM {inp.disk('c', k, 'population')} GROUP BY cell)"
        for n, k, s in (("c1", 4, 3.0), ("c2", 7, 4.0), ("c3", 6, 1.5))
    )
    return f"""WITH {inp.CELLS}, m AS (SELECT cell, CASE WHEN count(population) >= 3 THEN quantile_cont(population, 0.5) END AS v FROM {inp.disk("c", 1, "population")} GROUP BY cell){parts}
      SELECT grid.cell, round(CASE WHEN c.cell IS NOT NULL THEN m.v END, 4) AS density, round(coalesce(c1.v, 0e0), 4) AS catchment_pop, round(coalesce(c2.v, 0e0), 4) AS catchment_wide, round(coalesce(c3.v, 0e0), 4) AS catchment_leisure
      FROM grid LEFT JOIN c USING (cell) LEFT JOIN m USING (cell) LEFT JOIN c1 USING (cell) LEFT JOIN c2 USING (cell) LEFT JOIN c3 USING (cell)"""


def _max() -> str:
    cols = ("s_green", "s_quiet")
    return f"""WITH {inp.CELLS}, d AS (SELECT cell, {", ".join(f"max({c} * {_W0(6.0 * SC)}) FILTER ({c} > 0) AS {c}" for c in cols)} FROM {inp.disk("c", 12, "s_green, s_quiet")} GROUP BY cell)
      SELECT grid.cell, {", ".join(f"round(coalesce(d.{c}, 0e0), 6) AS {c}" for c in cols)} FROM grid LEFT JOIN d USING (cell)"""


def _feather() -> str:
    cols, w = ("rent_2022", "vacancy_pct", "s_green"), _G(1.0 * SC)
    return f"""WITH {inp.CELLS}, d AS (SELECT cell, {", ".join(f"sum({c} * {w}) / nullif(sum({w}) FILTER ({c} IS NOT NULL), 0e0) AS {c}" for c in cols)} FROM {inp.disk("c", 2, ", ".join(cols))} GROUP BY cell)
      SELECT c.cell, {", ".join(f"round(d.{c}, 6) AS {c}" for c in cols)} FROM c LEFT JOIN d USING (cell)"""


def _shrink() -> str:
    w = f"population * {_G(1.5 * SC, False)}"
    return f"""WITH {inp.CELLS}, pr AS (SELECT kreis, sum(rent_2022 * population) / nullif(sum(population) FILTER (rent_2022 IS NOT NULL), 0e0) AS prior FROM c GROUP BY kreis),
      j AS (SELECT c.*, prior FROM c LEFT JOIN pr ON c.kreis = pr.kreis),
      d AS (SELECT cell, sum({w} * rent_2022) AS a, sum({w}) AS b FROM {inp.disk("(SELECT * FROM c WHERE population > 0 AND rent_2022 IS NOT NULL)", 4, "rent_2022, population")} GROUP BY cell)
      SELECT j.cell, round((coalesce(a, 0e0) + 300e0 * coalesce(prior, (SELECT quantile_cont(prior, 0.5) FROM j))) / (coalesce(b, 0e0) + 300e0), 6) AS rent_2022 FROM j LEFT JOIN d USING (cell)"""


def _spread() -> str:
    return f"""WITH {inp.CELLS}, f AS (SELECT grid.cell, coalesce(s_quiet, 0e0) AS v FROM grid LEFT JOIN c USING (cell)),
      m AS (SELECT cell, avg(v) AS v FROM {inp.disk("f", 1, "v")} GROUP BY cell),
      s AS (SELECT cell, max(s_quiet) - min(s_quiet) AS spread, abs(max(s_quiet) FILTER (ring = 0) - avg(s_quiet) FILTER (ring > 0)) AS deviation FROM {inp.disk("c", 1, "s_quiet")} GROUP BY cell)
      SELECT grid.cell, round(m.v, 6) AS s_quiet, round(CASE WHEN c.cell IS NOT NULL THEN spread END, 6) AS spread, round(CASE WHEN c.cell IS NOT NULL THEN deviation END, 6) AS deviation
      FROM grid LEFT JOIN m USING (cell) LEFT JOIN c USING (cell) LEFT JOIN s USING (cell)"""


def _repair() -> str:
    steps = []
    for i in range(3):
        steps.append(f"n{i} AS (SELECT cell, count(v) AS n, avg(v) AS mean, quantile_cont(v, 0.5) AS mid FROM {inp.disk(f'(SELECT * FROM s{i} WHERE v IS NOT NULL)', 1, 'v')} WHERE ring = 1 GROUP BY cell)")
        odd = "v <= 1e-1 AND n >= 4 AND mid >= 5e-1 AND mid - v >= 4e-1"
        steps.append(f"s{i + 1} AS (SELECT s{i}.cell, may, CASE WHEN may AND v IS NULL AND n >= 2 THEN mean WHEN may AND {odd} THEN mid ELSE v END AS v FROM s{i} LEFT JOIN n{i} USING (cell))")
    return f"""WITH {inp.CELLS}, s0 AS (SELECT cell, coalesce(inhabited, false) AS may, CASE WHEN vacancy_pct IS NOT NULL THEN s_quiet END AS v FROM c), {", ".join(steps)} SELECT cell, round(v, 6) AS v FROM s3"""


def _service() -> str:
    stops = inp.key_source("(SELECT DISTINCT user_id AS stop_id FROM events)", "stop_id", "stop_id")
    return f"""WITH st AS (SELECT stop_id, (q + 1048576) * 2097152 + r + 1048576 AS cell FROM ({sql.utm32_cells(stops, "lat", "lon", inp.EDGE_M, "stop_id")})),
      sv AS (SELECT i AS service_id FROM range(7) AS t(i) WHERE ((i + 2) % 3 > 0 OR i = 0) AND i <> 4),
      dp AS (SELECT cell, event_type AS route_id, CASE WHEN length(event_type) % 2 = 0 THEN 2e0 ELSE 1e0 END AS w FROM events JOIN st ON user_id = stop_id WHERE event_id % 7 IN (SELECT service_id FROM sv)),
      n AS (SELECT cell, count(*) AS n FROM dp GROUP BY cell),
      a AS (SELECT cell, CAST(sum(n) AS DOUBLE) AS departures FROM {inp.disk("n", 1, "n")} GROUP BY cell),
      r0 AS (SELECT DISTINCT cell, route_id, w FROM dp), r1 AS (SELECT DISTINCT cell, route_id, w FROM {inp.disk("r0", 1, "route_id, w")}),
      b AS (SELECT cell, sum(w) AS routes FROM r1 GROUP BY cell),
      o AS (SELECT grid.cell, coalesce(departures, 0e0) AS departures, coalesce(routes, 0e0) AS routes FROM grid LEFT JOIN a USING (cell) LEFT JOIN b USING (cell))
      SELECT cell, round(departures, 6) AS departures, round(routes, 6) AS routes, round(sqrt(departures / (departures + 3000e0) * (routes / (routes + 15e0))), 6) AS quality FROM o"""


def _facility() -> str:
    import math

    far = 0.338 / 0.93 * geo.SQRT3 * inp.EDGE_M
    rim = ", ".join(f"({e(far * math.cos(math.radians(60 * i)))}, {e(far * math.sin(math.radians(60 * i)))})" for i in range(6))
    return f"""WITH {inp.POIS}, {inp.GRID_XY}, k AS (SELECT subcategory AS kind, x, y FROM p WHERE subcategory IN ('pharmacy', 'kindergarten', 'supermarket')),
      d AS (SELECT cell, i, kind, sqrt(min(pow(g.x + dx - k.x, 2) + pow(g.y + dy - k.y, 2))) AS m FROM g, (SELECT row_number() OVER () AS i, dx, dy FROM (VALUES {rim}) AS v(dx, dy)) AS rim, k GROUP BY cell, i, kind),
      a AS (SELECT cell, kind, avg(m) AS m FROM d GROUP BY cell, kind)
      SELECT cell, kind, round(m * {e(60 * 1.3 / 4500)}, 4) AS walk_min, round(m * {e(60 * 1.3 / 15000)}, 4) AS bike_min FROM a"""


_SCHOOLS_XY = sql.utm32_cells(f"(SELECT * FROM schools_points WHERE {inp.VALID})", "lat", "lon", inp.EDGE_M, "point_id, is_grund")
_LABEL = f"""WITH {inp.POIS}, s AS ({_SCHOOLS_XY}),
  d AS (SELECT point_id, p.name, osm_id, category, subcategory, sqrt(pow(s.x - p.x, 2) + pow(s.y - p.y, 2)) AS d FROM s, p WHERE p.name IS NOT NULL AND (category = 'nature' OR subcategory = 'cinema')),
  f AS (SELECT point_id, arg_min(name, (d, osm_id)) AS near FROM d WHERE category = 'nature' AND d <= 1500 GROUP BY point_id),
  c AS (SELECT point_id, arg_min(name, (d, osm_id)) AS far FROM d WHERE subcategory = 'cinema' GROUP BY point_id)
  SELECT point_id, coalesce(near, far) AS label FROM c FULL JOIN f USING (point_id)"""
_POLY = f"""WITH {inp.POIS}, {inp.REGIONS},
  h AS (SELECT osm_id, ags, gen FROM p, edges WHERE (y1 > y) <> (y2 > y) AND x < (x2 - x1) * (y - y1) / (y2 - y1) + x1 GROUP BY osm_id, ags, gen HAVING count(*) % 2 = 1)
  SELECT osm_id, min(ags) AS ags, arg_min(gen, ags) AS gen, count(*) AS regions FROM h GROUP BY osm_id"""
_NOISE = f"""WITH {inp.CENTRES}, {inp.GRID_XY}, d AS (SELECT g.cell, 60e0 + weight / 500 AS level, sqrt(pow(z.x - g.x, 2) + pow(z.y - g.y, 2)) AS d FROM z, g WHERE abs(z.x - g.x) <= 30000 AND abs(z.y - g.y) <= 30000),
  o AS (SELECT cell, 10 * log10(sum(pow(10e0, (level - 20 * log10(greatest(d, 100e0) / 100)) / 10))) AS db, sum(exp(-d / 10000e0)) AS near FROM d WHERE d <= 30000 GROUP BY cell)
  SELECT cell, round(db, 4) AS db, round(near, 6) AS near, round(greatest(0e0, least(1e0, (db - 55e0) / 15e0)), 6) AS annoyance FROM o"""
_GAPFILL = f"""WITH {inp.POIS}, s AS (SELECT * FROM ({_SCHOOLS_XY}) WHERE is_grund), m AS (SELECT * FROM p WHERE category = 'school' AND subcategory = 'grundschule')
  SELECT 'register' AS origin, point_id AS id FROM s
  UNION ALL SELECT 'map', osm_id FROM m WHERE NOT EXISTS (SELECT 1 FROM s WHERE abs(s.x - m.x) < 150 AND abs(s.y - m.y) < 150 AND sqrt(pow(s.x - m.x, 2) + pow(s.y - m.y, 2)) < 150)"""
_ORDERS = sql.utm32_cells(inp.key_source("orders", "o_orderkey", "o_custkey AS way, o_orderkey AS seq"), "lat", "lon", inp.EDGE_M, "way, seq, lat, lon")
_DENSIFY = f"""WITH o AS ({_ORDERS}), s0 AS (SELECT way, seq, x, y, lead(x) OVER w AS x2, lead(y) OVER w AS y2 FROM o WINDOW w AS (PARTITION BY way ORDER BY seq)),
  s1 AS (SELECT *, sqrt(pow(x - x2, 2) + pow(y - y2, 2)) AS len FROM s0 WHERE x2 IS NOT NULL),
  s2 AS (SELECT *, coalesce(sum(len) OVER (PARTITION BY way ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0e0) AS before FROM s1),
  s3 AS (SELECT *, unnest(range(CAST(ceil(before / 25000e0) AS BIGINT), CAST(ceil((before + len) / 25000e0) AS BIGINT))) AS n FROM s2 WHERE len > 0)
  SELECT way, count(*) AS samples, round(sum(x + (n * 25000e0 - before) / len * (x2 - x)), 1) AS x, round(sum(y + (n * 25000e0 - before) / len * (y2 - y)), 1) AS y FROM s3 GROUP BY way"""


def _grain() -> str:
    hav = sql.haversine("lat", "lon", "lat2", "lon2")
    brg = "degrees(atan2(sin(radians(lon2 - lon)) * cos(radians(lat2)), cos(radians(lat)) * sin(radians(lat2)) - sin(radians(lat)) * cos(radians(lat2)) * cos(radians(lon2 - lon))))"
    mids = sql.utm32_cells("m0", "lat", "lon", inp.EDGE_M, "metres, bearing")
    return f"""WITH o AS (SELECT *, (q + 1048576) * 2097152 + r + 1048576 AS cell FROM ({_ORDERS})),
      s0 AS (SELECT *, lead(lat) OVER w AS lat2, lead(lon) OVER w AS lon2 FROM o WINDOW w AS (PARTITION BY way ORDER BY seq)),
      s1 AS (SELECT cell, way, seq, lat, lon, lat2, lon2, {hav} AS metres, {brg} AS b0 FROM s0 WHERE lat2 IS NOT NULL),
      s2 AS (SELECT *, CASE WHEN metres > 0 THEN CASE WHEN b0 < 0 THEN b0 + 360 ELSE b0 END END AS bearing FROM s1),
      s3 AS (SELECT *, bearing - lag(bearing) OVER (PARTITION BY way ORDER BY seq) + 180 AS t FROM s2),
      s AS (SELECT *, abs(t - 360 * floor(t / 360) - 180) AS turn FROM s3),
      m0 AS (SELECT (lat + lat2) / 2 AS lat, (lon + lon2) / 2 AS lon, metres, bearing FROM s), m1 AS (SELECT *, (q + 1048576) * 2097152 + r + 1048576 AS cell FROM ({mids})),
      b AS (SELECT cell, CAST(floor(v / 10) AS BIGINT) % 36 AS bin, sum(metres) AS m FROM (SELECT cell, metres, unnest([bearing, bearing + 180]) AS v FROM m1 WHERE metres > 0) GROUP BY ALL),
      d AS (SELECT cell, bin, sum(m) AS m FROM {inp.disk("b", 1, "bin, m")} GROUP BY cell, bin),
      h AS (SELECT cell, total, -sum(m / total * ln(m / total)) / ln(36e0) AS disorder FROM (SELECT *, sum(m) OVER (PARTITION BY cell) AS total FROM d) GROUP BY cell, total),
      t0 AS (SELECT cell, sum(turn) AS a, count(turn) AS b FROM s WHERE turn IS NOT NULL GROUP BY cell),
      t1 AS (SELECT cell, sum(a) / sum(b) AS turn FROM {inp.disk("t0", 1, "a, b")} GROUP BY cell)
      SELECT grid.cell, round(disorder, 6) AS disorder, round(coalesce(turn, 0e0), 4) AS turn, round(CASE WHEN total >= 4000 THEN greatest(0e0, least(1e0, (disorder - 88e-2) / 10e-2)) * (25e-2 + 75e-2 * greatest(0e0, least(1e0, (coalesce(turn, 0e0) - 5) / 3))) ELSE 0e0 END, 6) AS grain
      FROM grid LEFT JOIN h USING (cell) LEFT JOIN t1 USING (cell)"""


_NEAREST_REGION = f"""WITH {inp.CENTRES}, {inp.REGIONS},
  h AS (SELECT center, min(gen) AS gen FROM (SELECT center, ags, gen FROM z, edges WHERE (y1 > y) <> (y2 > y) AND x < (x2 - x1) * (y - y1) / (y2 - y1) + x1 GROUP BY ALL HAVING count(*) % 2 = 1) GROUP BY center),
  t AS (SELECT center, gen, x, y, x1, y1, x2 - x1 AS ux, y2 - y1 AS uy, greatest(0e0, least(1e0, ((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / (pow(x2 - x1, 2) + pow(y2 - y1, 2)))) AS s FROM z, edges),
  d AS (SELECT center, arg_min(gen, (sqrt(pow(x - x1 - s * ux, 2) + pow(y - y1 - s * uy, 2)), gen)) AS gen, min(sqrt(pow(x - x1 - s * ux, 2) + pow(y - y1 - s * uy, 2))) AS d FROM t GROUP BY center)
  SELECT center, coalesce(h.gen, d.gen) AS gen, CASE WHEN h.gen IS NULL THEN round(d, 3) ELSE 0e0 END AS dist FROM d LEFT JOIN h USING (center)"""
_CLUSTERS = f"""WITH RECURSIVE {inp.CENTRES}, l AS (SELECT a.center AS a, b.center AS b FROM z a JOIN z b ON a.name = b.name AND sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2)) <= 150000),
  w(a, b) AS (SELECT center, center FROM z UNION SELECT w.a, l.b FROM w JOIN l ON w.b = l.a),
  k AS (SELECT a AS center, min(b) AS city FROM w GROUP BY a),
  t AS (SELECT city, name, row_number() OVER (PARTITION BY name ORDER BY sum(weight) DESC, city) AS n FROM k JOIN z USING (center) GROUP BY city, name)
  SELECT center, city, CASE WHEN n = 1 THEN name ELSE name || '-' || n END AS label FROM k JOIN t USING (city)"""
_RULES = f"""WITH {inp.CELLS}, m AS (SELECT count(*) AS a, max(s_green) AS b, quantile_cont(rent_2022, 0.5) AS c_, avg(CASE WHEN inhabited THEN 1e0 ELSE 0e0 END) AS d, quantile_cont(s_quiet, 0.95) AS q FROM c),
  v AS (SELECT 'cells' AS rule, CAST(a AS DOUBLE) AS value, 10000e0 AS low, 20000e0 AS high FROM m UNION ALL SELECT 'green range', b, 0e0, 1e0 FROM m UNION ALL SELECT 'rent median', c_, 3e0, 15e0 FROM m
    UNION ALL SELECT 'inhabited share', d, 5e-1, 1e0 FROM m UNION ALL SELECT 'quiet p95', q, 4e-1, 99e-2 FROM m)
  SELECT rule, round(value, 6) AS value, low, high, coalesce(value BETWEEN low AND high, false) AS ok FROM v"""
_COVER = f"""WITH {inp.CELLS}, {inp.POIS}, k AS (SELECT cell, kreis FROM c WHERE kreis IS NOT NULL), a AS (SELECT kreis, bool_or(category = 'school') AS school, bool_or(subcategory = 'cinema') AS cinema FROM p JOIN k USING (cell) GROUP BY kreis)
  SELECT kreis, coalesce(school, false) AS school, coalesce(cinema, false) AS cinema FROM (SELECT DISTINCT kreis FROM k) LEFT JOIN a USING (kreis)"""


def oracle_sql() -> dict[str, str]:
    return {
        "ent_density": _ent(),
        "population_catchment": _catchment(),
        "disk_max_reach": _max(),
        "gaussian_feather": _feather(),
        "kernel_shrink_rent": _shrink(),
        "disk_mean_spread": _spread(),
        "dilated_water": f"WITH {inp.POIS}, w AS (SELECT DISTINCT cell FROM p WHERE subcategory = 'swimming_pool') SELECT DISTINCT cell FROM {inp.disk('w', 1, 'src')}".replace("src_cell, src", "src_cell"),
        "repair_rounds": _repair(),
        "service_quality": _service(),
        "point_cells": f"WITH {inp.POIS} SELECT cell, category, count(*) AS n FROM p GROUP BY cell, category",
        "nearest_facility": _facility(),
        "nearest_label": _LABEL,
        "poly_assign": _POLY,
        "noise_energy": _NOISE,
        "anti_gapfill": _GAPFILL,
        "line_densify": _DENSIFY,
        "street_grain": _grain(),
        "city_clusters": _CLUSTERS,
        "center_regions": _NEAREST_REGION,
        "remapped_stops": "SELECT user_id * 7 + 3 AS stop, count(*) AS n FROM events GROUP BY user_id",
        "validate_rules": _RULES,
        "kreis_coverage": _COVER,
    }
