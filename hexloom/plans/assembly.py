"""The composite layers in full, and their assembly into one table of scores.

Land cover, noise and pay stand in the given tables only in part; :func:`land` makes what
is missing from what is there, the same way here and in the SQL. The SQL states all
constants by itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import composites as comp, geo, shape
from ..operators import kernels as kn, layers as ly, raster, spatial, stats, validate
from ..session import materialise, settle, table
from . import inputs as inp, layers as grid_layers, scoring, sql, surfaces

e = sql.e
SC = kn.SCALE


def _r(name: str, n: int = 6) -> Column:
    return F.round(name, n).alias(name)


# --- made-up inputs ------------------------------------------------------------------------

#: Columns of the land cover that the tables lack: expressions that read alike in both
#: dialects, over a (greenness), b (quiet) and cell.
LAND = {
    "tree_share": "a * 6e-1",
    "grass_share": "a * 3e-1",
    "crop_share": "1e-1 + (cell % 7) / 70e0",
    "park_share": "b * 5e-2",
    "tree_canopy": "b * 1e-1",
    "water_raw": "CASE WHEN cell % 13 = 0 THEN (cell % 5) / 10e0 ELSE 0e0 END",
    "water_share": "CASE WHEN cell % 13 = 0 THEN (cell % 5) / 125e-1 ELSE 0e0 END",
    "waterway_share": "(cell % 3) / 3e0",
    "builtup_share": "(1e0 - a) * 5e-1",
    "wetland_share": "CASE WHEN cell % 17 = 0 THEN 1e-1 ELSE 0e0 END",
    "heath_share": "CASE WHEN cell % 11 = 0 THEN b * 4e-1 ELSE 0e0 END",
    "beach_share": "CASE WHEN cell % 29 = 0 THEN 5e-2 ELSE 0e0 END",
    "no_access_share": "CASE WHEN cell % 19 = 0 THEN 5e-1 ELSE 0e0 END",
    "water_recr_q": "CASE WHEN cell % 26 = 0 THEN 45e-2 ELSE 1e0 END",
    "road_db": "50e0 + (1e0 - b) * 25e0",
    "rail_db": "50e0 + (cell % 6) * 4e0",
    "airport_db": "CASE WHEN cell % 31 = 0 THEN 6e1 ELSE 0e0 END",
    "height_m": "(cell % 40) * 1e0",
}


def land(spark: SparkSession, sf: str) -> DataFrame:
    """One row a cell of the grid, with people and the columns of :data:`LAND`."""
    c = inp.cells(spark, sf).select("cell", "population", F.col("s_green").alias("a0"), F.col("s_quiet").alias("b0"))
    g = inp.grid(spark, sf).select("cell").join(c, "cell", "left")
    g = g.select("cell", "population", F.coalesce("a0", F.lit(0.0)).alias("a"), F.coalesce("b0", F.lit(0.0)).alias("b"))
    return g.select("cell", "population", *[F.expr(x).alias(name) for name, x in LAND.items()])


def waterways(spark: SparkSession, sf: str) -> DataFrame:
    """Points on rivers and streams: pools by their number."""
    p = inp.pois_xy(spark, sf, ("subcategory", "lat", "lon")).where("subcategory = 'swimming_pool'")
    kind = F.when(F.col("osm_id") % 2 == 0, "river").otherwise("stream")
    return geo.with_axial(p.select("x", "y", kind.alias("cls")), "x", "y", inp.EDGE_M).select("x", "y", "cls", geo.cell_id(F.col("q"), F.col("r")).alias("cell"))


# --- layers --------------------------------------------------------------------------------


def green_layer(spark: SparkSession, sf: str) -> DataFrame:
    """Greenness of each cell from its land cover."""
    return _green(land(spark, sf)).select("cell", _r("s_green"))


def _green(lc: DataFrame) -> DataFrame:
    cols = [F.col(c) for c in ("tree_share", "grass_share", "crop_share", "park_share", "tree_canopy", "water_share", "waterway_share", "builtup_share")]
    return lc.withColumn("s_green", comp.greenness(*cols))


def noise_layer(spark: SparkSession, sf: str) -> DataFrame:
    """Penalties of road, rail and air from their levels, and of all of them as energies
    with what a dense place makes by itself."""
    return _noisy(spark, sf).select("cell", *[_r(c) for c in ("road_penalty", "rail_penalty", "airport_penalty", "urban_penalty", "noise_penalty")])


def _noisy(spark: SparkSession, sf: str) -> DataFrame:
    lc = land(spark, sf)
    smooth = kn.disk_mean(lc.select("cell", F.col("population").alias("smooth")), inp.grid(spark, sf), "smooth", 1)
    return ly.noise(lc.join(smooth, "cell"), "smooth")


def nature_layer(spark: SparkSession, sf: str) -> DataFrame:
    """Nature within reach: eight types by quality and decayed maximum, rivers and streams as
    a bonus, minutes to the nearest lake and forest."""
    lc = _noisy(spark, sf).withColumns({"transport": F.greatest("road_penalty", "rail_penalty", "airport_penalty")})
    ways = waterways(spark, sf)
    near = kn.disk(ways.select("cell", "cls").distinct(), 1).groupBy("cell").agg(F.bool_or(F.col("cls") == "river").alias("by_river"), F.bool_or(F.col("cls") == "stream").alias("by_stream"))
    sights = inp.pois(spark, sf, ("category", "subcategory", "lat", "lon")).where("category = 'nature'").groupBy("cell").agg(F.count_if(F.col("subcategory") == "viewpoint").alias("views"), F.count_if(~F.col("subcategory").eqNullSafe("viewpoint")).alias("marks"))
    grid = inp.grid(spark, sf)
    load = kn.disk_weighted_sum(lc.select("cell", "population"), grid, ["population"], 12, 6.0 * SC).withColumnRenamed("population", "load")
    relief = kn.disk_mean(lc.select("cell", F.col("height_m").alias("relief_m")), grid, "relief_m", 1)
    a = lc.join(near, "cell", "left").join(sights, "cell", "left").join(load, "cell").join(relief, "cell")
    false = F.lit(False)
    a = a.withColumns({"by_river": F.coalesce("by_river", false), "by_stream": F.coalesce("by_stream", false)})
    a = materialise(ly.nature_sources(a))
    reach = kn.disk_weighted_max(a, grid, [f"q_{t}" for t in ly.NATURE_SOURCES], 12, 6.0 * SC)
    scored = reach.select("cell", ly.nature_score({t: F.col(f"q_{t}") for t in ly.NATURE_SOURCES}).alias("nature_score"), F.col("q_sights").alias("sight_score"))
    places = a.where("lake or tree_share >= 0.55").select("cell", F.explode(F.array_compact(F.array(F.when(F.col("lake"), "lake"), F.when(F.col("tree_share") >= 0.55, "forest")))).alias("kind"))
    xy = inp.grid_xy(spark, sf)
    mins = spatial.nearest_around(xy, places.join(xy, "cell").select("x", "y", "kind"), "cell", [(0.0, 0.0)], 20_000.0, "kind", ["lake", "forest"])
    mins = mins.groupBy("cell").pivot("kind", ["lake", "forest"]).agg(F.max(ly.minutes_within(F.col("dist"), 338.0 * SC, 15.0)))
    out = scored.join(relief, "cell").join(mins, "cell", "left")
    far = F.lit(120.0)
    return out.select("cell", _r("relief_m"), _r("sight_score"), F.round(F.coalesce("lake", far), 4).alias("t_lake_min"), F.round(F.coalesce("forest", far), 4).alias("t_forest_min"), _r("nature_score"))


#: (column, places, speed): the times to the nearest place of each kind.
NEAREST = {
    "t_grund_min": ("grund", 15.0),
    "t_gym_min": ("gym", 15.0),
    "t_real_min": ("real", 15.0),
    "t_mittel_min": ("mittel", 15.0),
    "t_food_min": ("food", 4.5),
    "t_fresh_min": ("fresh", 4.5),
    "t_pharmacy_min": ("pharmacy", 4.5),
    "t_doctor_min": ("doctor", 15.0),
    "t_kita_min": ("kita", 4.5),
    "t_dentist_min": ("dentist", 15.0),
}
_KINDS = {"supermarket": "food", "bakery": "fresh", "butcher": "fresh", "pharmacy": "pharmacy", "doctors": "doctor", "kindergarten": "kita", "dentist": "dentist"}


def _school_points(spark: SparkSession, sf: str) -> DataFrame:
    s = geo.with_utm32(table(spark, sf, "schools_points").where(inp.VALID), "lat", "lon")
    tracks = F.array_compact(F.array(*[F.when(F.col(f"is_{t}"), F.lit(t)) for t in ("grund", "gym", "real", "mittel")]))
    return s.select("x", "y", F.explode(tracks).alias("kind"))


def schools_family(spark: SparkSession, sf: str) -> DataFrame:
    """Minutes to the nearest of ten kinds of place, averaged over a cell's rim, in one pass,
    and the supply of kindergartens and primary schools around."""
    kind = F.lit(None).cast("string")
    for sub, k in _KINDS.items():
        kind = F.when(F.col("subcategory") == sub, F.lit(k)).otherwise(kind)
    family = inp.pois_xy(spark, sf, ("subcategory", "lat", "lon")).select("x", "y", kind.alias("kind")).where("kind is not null")
    schools = _school_points(spark, sf)
    places = materialise(schools.unionByName(family))
    grid = inp.grid(spark, sf)
    kinds = [k for k, _ in NEAREST.values()]
    near = spatial.nearest_around(inp.grid_xy(spark, sf), places, "cell", kn.rim_offsets(), 12_000.0, "kind", kinds)
    mean = near.groupBy("cell").pivot("kind", kinds).agg(F.max("dist"))
    at = geo.with_axial(places.where("kind in ('kita', 'grund')"), "x", "y", inp.EDGE_M)
    count = at.groupBy(geo.cell_id(F.col("q"), F.col("r")).alias("cell")).agg(F.count(F.lit(1)).cast("double").alias("kita_supply"))
    supply = kn.disk_weighted_sum(count, grid, ["kita_supply"], 4, 3.0 * SC)
    out = supply.join(mean, "cell", "left")
    return out.select("cell", *[F.round(F.col(k) * F.lit(60 * 1.3 / (v * 1000)), 4).alias(c) for c, (k, v) in NEAREST.items()], _r("kita_supply"))


def demographics(spark: SparkSession, sf: str) -> DataFrame:
    """People, people per populated area smoothed over the ring, three catchments from one
    scatter, and age columns without lone outliers."""
    s = table(spark, sf, "scores")
    pop = F.when(~F.isnan("population") & (F.col("population") > 0), F.col("population"))
    # each build stands for one populated part of the cell, of one square kilometre
    cells = s.groupBy("cell").agg(F.sum(pop).alias("people"), F.count(pop).alias("parts"), F.avg("s_green").alias("age"), F.avg("s_quiet").alias("young"))
    src = materialise(cells.withColumn("dens", F.col("people") / F.nullif("parts", F.lit(0))))
    grid = inp.grid(spark, sf)
    sums = kn.disk_weighted_sums(src.select("cell", "people"), grid, "people", {"catchment_pop": (4, 3.0 * SC), "catchment_wide": (7, 4.0 * SC), "catchment_leisure": (6, 1.5 * SC)})
    out = sums.join(src.select("cell", F.col("people").alias("population")), "cell", "left").na.fill(0.0, ["population"])
    out = out.join(kn.disk_median(src.where("dens is not null"), "dens", 1), "cell", "left")
    for c in ("age", "young"):
        out = out.join(kn.disk_median(src, c, 1), "cell", "left")
    return out.select("cell", *[_r(c, 4) for c in ("population", "dens", "catchment_pop", "catchment_wide", "catchment_leisure")], _r("age"), _r("young"))


def character_inputs(spark: SparkSession, sf: str) -> DataFrame:
    """Kernel densities of old structures and of art by their weights: restaurants, cafes and
    theatres stand for structures, museums and cinemas for art."""
    sub = F.col("subcategory")
    p = inp.pois(spark, sf, ("subcategory", "lat", "lon")).select("cell", F.when(sub == "restaurant", 1.0).when(sub == "cafe", 0.7).when(sub == "theatre", 0.9).alias("hist_density"), F.when(sub == "museum", 1.0).when(sub == "cinema", 0.5).alias("art_density"))
    src = p.groupBy("cell").agg(F.sum("hist_density").alias("hist_density"), F.sum("art_density").alias("art_density"))
    return kn.disk_weighted_sum(src, inp.grid(spark, sf), ["hist_density", "art_density"], 2, 1.5 * SC).select("cell", _r("hist_density"), _r("art_density"))


def _places(spark: SparkSession, sf: str) -> DataFrame:
    """Each cell's municipality: the kreis and the ninth of it that its number names."""
    k = table(spark, sf, "scores").where("kreis is not null").groupBy("cell").agg(F.max("kreis").alias("kreis"))
    return k.withColumn("gem", F.concat("kreis", F.lit("-"), (F.col("cell") % 9).cast("string")))


def rent_layer(spark: SparkSession, sf: str) -> DataFrame:
    """Rents lifted to asking level by kreis, shrunk towards municipality, kreis or overall
    prior, and the local pay as a smooth surface."""
    c = inp.cells(spark, sf).select("cell", "rent_2022", "population")
    grid = inp.grid(spark, sf).select("cell")
    base = grid.join(c, "cell", "left").join(_places(spark, sf), "cell", "left")
    asking = table(spark, sf, "scores").where("kreis is not null").groupBy("kreis").agg((F.lit(8.0) + F.pmod(F.max("cell"), F.lit(70)) / 10.0).alias("asking"), (F.lit(2500.0) + F.pmod(F.max("cell"), F.lit(900))).alias("pay"))
    return ly.rent(materialise(base), asking, SC).select("cell", _r("rent_cal"), _r("kreis_pay", 4))


def vacancy_layer(spark: SparkSession, sf: str) -> DataFrame:
    """Vacancy of the square kilometre that each cell's centre lies in, on the equal-area grid,
    and its score."""
    s = table(spark, sf, "scores").select("lat", "lon", "vacancy_pct").where("not isnan(vacancy_pct) and vacancy_pct between 0 and 100")
    return ly.vacancy(s, inp.grid(spark, sf), "vacancy_pct").select("cell", _r("vacancy_pct"), _r("vacancy_score"))


#: Layer, and its columns in the assembled table.
LAYERS = {
    "freizeit": ("gravity_reach", {"score": "reach_activity"}),
    "oepnv": ("service_quality", {"quality": "oepnv_score"}),
    "entertainment": ("ent_density", {"ent_density": "ent_density"}),
    "rent": ("rent_layer", {"rent_cal": "rent_cal", "kreis_pay": "kreis_pay"}),
    "noise": ("noise_layer", {"noise_penalty": "noise_penalty"}),
    "nature": ("nature_layer", {"nature_score": "nature_score"}),
    "character": ("character_inputs", {"hist_density": "hist_density", "art_density": "art_density"}),
    "streets": ("street_grain", {"grain": "street_grain"}),
    "schools": ("schools_family", {c: c for c in ("t_grund_min", "t_gym_min", "t_real_min", "t_mittel_min")}),
    "family": ("schools_family", {c: c for c in ("t_food_min", "t_fresh_min", "t_pharmacy_min", "t_doctor_min", "t_kita_min", "t_dentist_min", "kita_supply")}),
    "demographics": ("demographics", {"population": "population", "catchment_pop": "catchment_pop", "catchment_leisure": "catchment_leisure", "age": "avg_age"}),
    "broadband": ("broadband_layer", {"score": "bb_score"}),
    "climate": ("climate_score", {"score": "climate_score"}),
    "flood": ("flood_eas", {"score": "flood_score"}),
    "vacancy": ("vacancy_layer", {"vacancy_score": "vacancy_score"}),
}


def assemble_layers(spark: SparkSession, sf: str) -> DataFrame:
    """Sixteen layers on the grid, each joined where it exists, with all composite scores.

    Each layer is written out and its shuffles let go before the next is planned: driver and
    disks hold one layer at a time, and the last join has tables of one row a cell.
    """
    known = {f.__name__: f for f in (*grid_layers.FUNCTIONS, *scoring.FUNCTIONS, *surfaces.FUNCTIONS, *FUNCTIONS)}
    lc = land(spark, sf).select("cell", "builtup_share", *[c for c in LAND if c in ("tree_share", "grass_share", "crop_share", "park_share", "tree_canopy", "water_share", "waterway_share")])
    found: dict[str, DataFrame | None] = {"greenness": materialise(lc)}
    made = {}
    for q in dict.fromkeys(q for q, _ in LAYERS.values()):
        made[q] = materialise(known[q](spark, sf))
        settle(spark)
    for name, (query, cols) in LAYERS.items():
        found[name] = made[query].select("cell", *[F.col(a).alias(b) for a, b in cols.items()])
    whole = ly.scored(ly.assemble(inp.grid(spark, sf).select("cell"), found))
    return whole.select("cell", *[_r(c) for c in ly.SCORES if c in whole.columns], _r("kita_crowd"), "inhabited")


def validate_layers(spark: SparkSession, sf: str) -> DataFrame:
    """Range checks of the assembled table: medians, ranges, shares and counts, by layer."""
    t = assemble_layers(spark, sf)
    rules_ = [validate.Rule("cells", F.count(F.lit(1)), 10_000, 20_000), validate.Rule("inhabited share", validate.share(F.col("inhabited")), 0.3, 1)]
    for c in ly.SCORES:
        rules_ += [
            validate.Rule(f"{c} least", F.min(c), 0, 1),
            validate.Rule(f"{c} most", F.max(c), 0, 1),
            validate.Rule(f"{c} known", validate.share(F.col(c).isNotNull()), 1, 1),
            validate.Rule(f"{c} median", F.percentile(c, 0.5), 0.01, 1),
            validate.Rule(f"{c} p95", F.percentile(c, 0.95), 0.05, 1),
            validate.Rule(f"{c} over half", validate.share(F.col(c) > 0.5), 0, 1),
            validate.Rule(f"{c} at floor", validate.share(F.col(c) <= 0), 0, 0.9),
            validate.Rule(f"{c} at top", validate.share(F.col(c) >= 1), 0, 0.9),
        ]
    return validate.check(t, rules_).withColumn("value", F.round("value", 5))


FUNCTIONS = (green_layer, noise_layer, nature_layer, schools_family, demographics, character_inputs, rent_layer, vacancy_layer)


def queries() -> dict:
    return {f.__name__: f for f in (*FUNCTIONS, assemble_layers, validate_layers)}


# --- SQL -----------------------------------------------------------------------------------


def _clip(x: str) -> str:
    return f"greatest(0e0, least(1e0, {x}))"


_LAND = f"""{inp.CELLS}, la0 AS (SELECT grid.cell, population, coalesce(s_green, 0e0) AS a, coalesce(s_quiet, 0e0) AS b FROM grid LEFT JOIN c USING (cell)),
  la AS (SELECT cell, population, {", ".join(f"{x} AS {n}" for n, x in LAND.items())} FROM la0)"""
_W = lambda km: f"exp(-sqrt(pow(ring * {e(kn.STEP_KM)}, 2) + {e(kn.SPREAD_KM**2)}) / {e(km * SC)})"
_W0 = lambda km: f"exp(-(ring * {e(kn.STEP_KM)}) / {e(km * SC)})"
_NOISY = f"""sm AS (SELECT cell, avg(coalesce(population, 0e0)) AS smooth FROM {inp.disk("(SELECT * FROM la)", 1, "population")} GROUP BY cell),
  no0 AS (SELECT la.*, {_clip("pow(smooth / 10000, 7e-1)")} AS urban_penalty, {_clip("(road_db - 55) / 15")} AS road_penalty, {_clip("(rail_db - 55) / 15")} AS rail_penalty, {_clip("(airport_db - 55) / 15")} AS airport_penalty FROM la JOIN sm USING (cell)),
  no1 AS (SELECT *, 10 * log10(pow(10e0, road_db / 10) + pow(10e0, rail_db / 10) + pow(10e0, airport_db / 10)) AS all_db FROM no0),
  no AS (SELECT *, greatest(urban_penalty, {_clip("(all_db - 55) / 15")}) AS noise_penalty FROM no1)"""


def _nature() -> str:
    ways = sql.utm32_cells(f"(SELECT * FROM {inp.ONCE} WHERE subcategory = 'swimming_pool')", "lat", "lon", inp.EDGE_M, "osm_id")
    sat = lambda share, k, p: f"(pow(greatest(0e0, ({share}) * mask), {p}) / (pow(greatest(0e0, ({share}) * mask), {p}) + pow({k}, {p})))"
    amp = f"(1 + 55e-2 * {_clip('pow(relief_m / 50, 7e-1)')})"
    q = {
        "forest": f"{sat('tree_share', '57e-2', '25e-1')} * {amp}",
        "grass": f"{sat(_clip('grass_share - heath_share'), '45e-2', '25e-1')} * {amp}",
        "crop": f"{sat('crop_share', '5e-1', '25e-1')} * {amp}",
        "lake": f"{sat('CASE WHEN lake THEN water_share ELSE 0e0 END', '45e-3', '1')} * water_recr_q",
        "wetland": f"{sat('wetland_share', '4e-2', '1')} * {amp}",
        "heath": f"{sat('heath_share', '3e-1', '25e-1')} * {amp}",
        "beach": f"{sat('beach_share', '4e-2', '1')}",
        "sights": "(n_sights / (n_sights + 1e0))",
        "river": "CASE WHEN by_river THEN bank * mask ELSE 0e0 END",
        "stream": "CASE WHEN by_stream THEN bank * mask ELSE 0e0 END",
    }
    weights = {"lake": "9e-1", "beach": "85e-2", "forest": "82e-2", "heath": "8e-1", "wetland": "65e-2", "sights": "55e-2", "grass": "48e-2", "crop": "15e-2"}
    c = [f"{w} * coalesce(n.q_{t}, 0e0)" for t, w in weights.items()]
    mins = lambda d: f"round(coalesce(sqrt(pow({d}, 2) + {e((338.0 * SC) ** 2)}) * 13e-1 / 1000 / 15 * 60, 120e0), 4)"
    return f"""WITH {_LAND}, {_NOISY}, {inp.POIS}, {inp.GRID_XY}, wy0 AS ({ways}), wy AS (SELECT DISTINCT (q + 1048576) * 2097152 + r + 1048576 AS cell, osm_id % 2 = 0 AS river FROM wy0),
      nr AS (SELECT cell, bool_or(river) AS by_river, bool_or(NOT river) AS by_stream FROM {inp.disk("wy", 1, "river")} GROUP BY cell),
      si AS (SELECT cell, count(*) FILTER (subcategory = 'viewpoint') AS views, count(*) FILTER (subcategory IS DISTINCT FROM 'viewpoint') AS marks FROM p WHERE category = 'nature' GROUP BY cell),
      lo AS (SELECT cell, sum(population * {_W(6.0)}) FILTER (population > 0) AS load FROM {inp.disk("la", 12, "population")} GROUP BY cell),
      re AS (SELECT cell, avg(height_m) AS relief_m FROM {inp.disk("la", 1, "height_m")} GROUP BY cell),
      s0 AS (SELECT no.*, coalesce(by_river, false) AS by_river, coalesce(by_stream, false) AS by_stream, coalesce(load, 0e0) AS load, relief_m, coalesce(marks, 0) + CASE WHEN builtup_share < 2e-1 THEN coalesce(views, 0) ELSE 0 END AS n_sights,
        water_raw >= 4e-2 AND NOT coalesce(by_river, false) AS lake, (1 - no_access_share) * (1 - 38e-2 * greatest(road_penalty, rail_penalty, airport_penalty)) AS mask,
        {_clip("(tree_share + grass_share + park_share + wetland_share) / 5e-1 - builtup_share")} AS bank FROM no LEFT JOIN nr USING (cell) LEFT JOIN si USING (cell) LEFT JOIN lo USING (cell) JOIN re USING (cell)),
      s1 AS (SELECT cell, lake, tree_share, relief_m, {", ".join(_clip(f"({x}) * (1 - 58e-2 * load / (load + 540000e0))") + f" AS q_{t}" for t, x in q.items())} FROM s0),
      n AS (SELECT cell, {", ".join(f"max(q_{t} * {_W0(6.0)}) FILTER (q_{t} > 0) AS q_{t}" for t in q)} FROM {inp.disk("s1", 12, ", ".join(f"q_{t}" for t in q))} GROUP BY cell),
      b AS (SELECT s1.cell, relief_m, coalesce(n.q_sights, 0e0) AS sights, {_clip("3e-1 * coalesce(n.q_river, 0e0) + 12e-2 * coalesce(n.q_stream, 0e0)")} AS bonus, greatest({", ".join(c)}) AS best, {" * ".join(f"(1 - 35e-2 * ({x}))" for x in c)} AS prod FROM s1 LEFT JOIN n USING (cell)),
      d AS (SELECT *, 1 - (1 - best) * (prod / (1 - 35e-2 * best)) AS base FROM b),
      lk AS (SELECT g.cell, x, y, lake, tree_share >= 55e-2 AS forest FROM s1 JOIN g USING (cell) WHERE lake OR tree_share >= 55e-2),
      ne AS (SELECT g.cell, min(sqrt(pow(g.x - lk.x, 2) + pow(g.y - lk.y, 2))) FILTER (lake) AS dl, min(sqrt(pow(g.x - lk.x, 2) + pow(g.y - lk.y, 2))) FILTER (forest) AS df FROM g, lk GROUP BY g.cell)
      SELECT cell, round(relief_m, 6) AS relief_m, round(sights, 6) AS sight_score, {mins("dl")} AS t_lake_min, {mins("df")} AS t_forest_min, round(pow({_clip("(1 - (1 - base) * (1 - bonus) - 36e-2) / 54e-2")}, 14e-1), 6) AS nature_score FROM d LEFT JOIN ne USING (cell)"""


def _family() -> str:
    import math

    far = 0.338 / 0.93 * geo.SQRT3 * inp.EDGE_M
    rim = ", ".join(f"({i}, {e(far * math.cos(math.radians(60 * i)))}, {e(far * math.sin(math.radians(60 * i)))})" for i in range(6))
    kind = " ".join(f"WHEN '{s}' THEN '{k}'" for s, k in (("supermarket", "food"), ("bakery", "fresh"), ("butcher", "fresh"), ("pharmacy", "pharmacy"), ("doctors", "doctor"), ("kindergarten", "kita"), ("dentist", "dentist")))
    times = (("t_grund_min", "grund", 15), ("t_gym_min", "gym", 15), ("t_real_min", "real", 15), ("t_mittel_min", "mittel", 15), ("t_food_min", "food", 4.5), ("t_fresh_min", "fresh", 4.5), ("t_pharmacy_min", "pharmacy", 4.5), ("t_doctor_min", "doctor", 15), ("t_kita_min", "kita", 4.5), ("t_dentist_min", "dentist", 15))
    sp = sql.utm32_cells(f"(SELECT * FROM schools_points WHERE {inp.VALID})", "lat", "lon", inp.EDGE_M, "is_grund, is_gym, is_real, is_mittel")
    tracks = " UNION ALL ".join(f"SELECT x, y, q, r, '{t}' AS kind FROM sp WHERE is_{t}" for t in ("grund", "gym", "real", "mittel"))
    # squares of 40 km first; what has none within is measured against all
    return f"""WITH {inp.POIS}, {inp.GRID_XY}, sp AS ({sp}), k AS ({tracks} UNION ALL SELECT * FROM (SELECT x, y, q, r, CASE subcategory {kind} END AS kind FROM p) WHERE kind IS NOT NULL),
      m AS (SELECT cell, i, x + dx AS x, y + dy AS y FROM g, (VALUES {rim}) AS v(i, dx, dy)),
      d AS (SELECT cell, i, kind, min(sqrt(pow(m.x - k.x, 2) + pow(m.y - k.y, 2))) AS d FROM m, k GROUP BY cell, i, kind),
      a AS (SELECT cell, kind, avg(d) AS d FROM d GROUP BY cell, kind),
      t AS (SELECT cell, {", ".join(f"round(max(d) FILTER (kind = '{kd}') * {e(60 * 1.3 / (v * 1000))}, 4) AS {c}" for c, kd, v in times)} FROM a GROUP BY cell),
      n AS (SELECT (q + 1048576) * 2097152 + r + 1048576 AS cell, CAST(count(*) AS DOUBLE) AS n FROM k WHERE kind IN ('kita', 'grund') GROUP BY 1), s AS (SELECT cell, sum(n * {_W(3.0)}) AS n FROM {inp.disk("n", 4, "n")} GROUP BY cell)
      SELECT grid.cell, t.* EXCLUDE (cell), round(coalesce(s.n, 0e0), 6) AS kita_supply FROM grid LEFT JOIN t USING (cell) LEFT JOIN s USING (cell)"""


_DEMO = f"""WITH b AS (SELECT cell, sum(population) FILTER (NOT isnan(population) AND population > 0) AS people, count(*) FILTER (NOT isnan(population) AND population > 0) AS parts, avg(s_green) AS age, avg(s_quiet) AS young FROM scores GROUP BY cell),
  d AS (SELECT *, people / nullif(parts, 0) AS dens FROM b), m AS (SELECT cell, quantile_cont(dens, 0.5) AS dens FROM {inp.disk("(SELECT * FROM d WHERE dens IS NOT NULL)", 1, "dens")} GROUP BY cell),
  n AS (SELECT cell, quantile_cont(age, 0.5) AS age, quantile_cont(young, 0.5) AS young FROM {inp.disk("d", 1, "age, young")} GROUP BY cell),
  s AS (SELECT cell, sum(people * {_W(3.0)}) FILTER (ring <= 4) AS c1, sum(people * {_W(4.0)}) AS c2, sum(people * {_W(1.5)}) FILTER (ring <= 6) AS c3 FROM {inp.disk("d", 7, "people")} GROUP BY cell)
  SELECT grid.cell, round(coalesce(people, 0e0), 4) AS population, round(CASE WHEN d.dens IS NOT NULL THEN m.dens END, 4) AS dens, round(coalesce(c1, 0e0), 4) AS catchment_pop, round(coalesce(c2, 0e0), 4) AS catchment_wide, round(coalesce(c3, 0e0), 4) AS catchment_leisure,
    round(CASE WHEN d.cell IS NOT NULL THEN n.age END, 6) AS age, round(CASE WHEN d.cell IS NOT NULL THEN n.young END, 6) AS young
  FROM grid LEFT JOIN d USING (cell) LEFT JOIN m USING (cell) LEFT JOIN n USING (cell) LEFT JOIN s USING (cell)"""
_CHARACTER = f"""WITH {inp.POIS}, w AS (SELECT cell, CASE subcategory WHEN 'restaurant' THEN 1e0 WHEN 'cafe' THEN 7e-1 WHEN 'theatre' THEN 9e-1 END AS h, CASE subcategory WHEN 'museum' THEN 1e0 WHEN 'cinema' THEN 5e-1 END AS a FROM p),
  s AS (SELECT cell, sum(h) AS h, sum(a) AS a FROM w GROUP BY cell), d AS (SELECT cell, sum(h * {_W(1.5)}) AS h, sum(a * {_W(1.5)}) AS a FROM {inp.disk("s", 2, "h, a")} GROUP BY cell)
  SELECT grid.cell, round(coalesce(h, 0e0), 6) AS hist_density, round(coalesce(a, 0e0), 6) AS art_density FROM grid LEFT JOIN d USING (cell)"""


def _rent() -> str:
    w = f"population * exp(-pow(ring * {e(kn.STEP_KM)}, 2) / {e(2 * (1.5 * SC) ** 2)})"
    blend = f"exp(-(pow(ring * {e(kn.STEP_KM)}, 2) + {e(kn.SPREAD_KM**2)}) / {e(2 * (6.0 * SC) ** 2)})"
    return f"""WITH {inp.CELLS}, pl AS (SELECT cell, max(kreis) AS kreis FROM scores WHERE kreis IS NOT NULL GROUP BY cell), ak AS (SELECT kreis, 8e0 + max(cell) % 70 / 10e0 AS asking, 2500e0 + max(cell) % 900 AS pay FROM scores WHERE kreis IS NOT NULL GROUP BY kreis),
      b AS (SELECT grid.cell, rent_2022, population, pl.kreis, pl.kreis || '-' || (grid.cell % 9) AS gem FROM grid LEFT JOIN c USING (cell) LEFT JOIN pl ON grid.cell = pl.cell),
      st AS (SELECT kreis, sum(rent_2022 * population) / sum(population) AS stock FROM b WHERE rent_2022 IS NOT NULL AND population > 0 AND kreis IS NOT NULL GROUP BY kreis),
      f AS (SELECT kreis, greatest(1e0, least(22e-1, asking / stock)) AS f FROM ak JOIN st USING (kreis)),
      u AS (SELECT b.*, CASE WHEN (SELECT count(DISTINCT gem) FROM b JOIN f ON b.kreis = f.kreis) < 50 THEN 132e-2 ELSE coalesce(f, (SELECT quantile_cont(f.f, 0.5) FROM b JOIN f ON b.kreis = f.kreis)) END AS uplift FROM b LEFT JOIN f ON b.kreis = f.kreis),
      r AS (SELECT *, rent_2022 * uplift AS cal FROM u), gp AS (SELECT kreis, gem, sum(cal * population) / sum(population) AS g FROM r WHERE cal IS NOT NULL AND population > 0 AND gem IS NOT NULL GROUP BY kreis, gem), kp AS (SELECT kreis, quantile_cont(g, 0.5) AS k FROM gp GROUP BY kreis),
      pr AS (SELECT r.*, coalesce(g, k) AS prior FROM r LEFT JOIN gp ON r.gem = gp.gem LEFT JOIN kp ON r.kreis = kp.kreis),
      d AS (SELECT cell, sum({w} * cal) AS x, sum({w}) AS y FROM {inp.disk("(SELECT * FROM r WHERE population > 0 AND cal IS NOT NULL)", 4, "cal, population")} GROUP BY cell),
      py AS (SELECT b.cell, pay FROM b LEFT JOIN ak ON b.kreis = ak.kreis), bl AS (SELECT cell, sum(pay * {blend}) / nullif(sum({blend}) FILTER (pay IS NOT NULL), 0e0) AS pay FROM {inp.disk("py", 13, "pay")} GROUP BY cell), bg AS (SELECT py.cell, bl.pay FROM py LEFT JOIN bl USING (cell))
      SELECT pr.cell, round((coalesce(x, 0e0) + 300e0 * coalesce(prior, (SELECT quantile_cont(prior, 0.5) FROM pr))) / (coalesce(y, 0e0) + 300e0), 6) AS rent_cal, round(coalesce(bg.pay, (SELECT quantile_cont(pay, 0.5) FROM bg)), 4) AS kreis_pay
      FROM pr LEFT JOIN d USING (cell) LEFT JOIN bg USING (cell)"""


def _laea(source: str, keep: str) -> str:
    """Kilometre bins of the equal-area projection at 52 N, 10 E on GRS80."""
    f = 1 / 298.257222101
    ee = f * (2 - f)
    ec = ee**0.5
    q = lambda s: f"({e(1 - ee)} * ({s} / (1 - {e(ee)} * {s} * {s}) - ln((1 - {e(ec)} * {s}) / (1 + {e(ec)} * {s})) / {e(2 * ec)}))"
    return f"""(SELECT {keep}, CAST(floor((4321000e0 + bb * dd * cos(beta) * sin(lam)) / 1000) AS BIGINT) AS cx, CAST(floor((3210000e0 + bb / dd * (cos(b0) * sin(beta) - sin(b0) * cos(beta) * cos(lam))) / 1000) AS BIGINT) AS cy
      FROM (SELECT *, rq * sqrt(2 / (1 + sin(b0) * sin(beta) + cos(b0) * cos(beta) * cos(lam))) AS bb, 6378137e0 * m0 / (rq * cos(b0)) AS dd FROM (SELECT *, asin(q1 / qp) AS beta, asin(q0 / qp) AS b0, 6378137e0 * sqrt(qp / 2) AS rq, cos(radians(52e0)) / sqrt(1 - {e(ee)} * pow(sin(radians(52e0)), 2)) AS m0
        FROM (SELECT *, radians(lon - 10e0) AS lam, {q("sin(radians(lat))")} AS q1, {q("sin(radians(52e0))")} AS q0, {q("1e0")} AS qp FROM {source}))))"""


_VACANCY = f"""WITH v AS (SELECT cx, cy, avg(vacancy_pct) AS v FROM {_laea("(SELECT * FROM scores WHERE NOT isnan(vacancy_pct) AND vacancy_pct BETWEEN 0 AND 100)", "vacancy_pct")} GROUP BY cx, cy), h AS (SELECT * FROM {_laea("grid", "cell")})
  SELECT cell, round(v, 6) AS vacancy_pct, round(1 - {_clip("(v - 5) / 13e0")} + 0 * v, 6) AS vacancy_score FROM h LEFT JOIN v USING (cx, cy)"""
_GREEN = f"""round({_clip(
    "(1 - (1 - CASE WHEN greatest(0e0, 1 - water_share) > 2e-2 THEN " + _clip("(tree_share + 5e-1 * grass_share + 25e-2 * crop_share + park_share + least(4e-2, 5e-1 * tree_canopy)) / (greatest(0e0, 1 - water_share) * 85e-2)")
    + " ELSE 0e0 END) * (1 - 2e-1 * " + _clip("(water_share + 15e-2 * waterway_share) / 3e-1") + ")) * (1 - 135e-2 * pow(builtup_share, 3))"
)}, 6)"""
_SCORES = ("s_oepnv", "s_green", "s_quiet", "s_nature", "s_character", "s_broadband", "s_climate", "s_flood", "s_vacancy")


def _assemble(all_sql: dict[str, str]) -> str:
    parts = {name: (all_sql[q], cols) for name, (q, cols) in LAYERS.items()}
    ctes = ", ".join(f"l_{n} AS (SELECT cell, {', '.join(f'{a} AS {b}' for a, b in cols.items())} FROM ({text}))" for n, (text, cols) in parts.items())
    joins = " ".join(f"LEFT JOIN l_{n} USING (cell)" for n in parts)
    people = "greatest(catchment_leisure, 1000e0)"
    hist = f"sqrt(hist_density * hist_density / (hist_density * hist_density + 484e0) * {_clip(f'1000 * hist_density / {people} / 4')})"
    return f"""WITH {_LAND}, {ctes}, j AS (SELECT * FROM la0 JOIN (SELECT * EXCLUDE (population) FROM la) la USING (cell) {joins}),
      g AS (SELECT *, coalesce(street_grain, 0e0) * {_clip("(builtup_share - 4e-2) / 16e-2")} AS gg FROM (SELECT * EXCLUDE (population), population AS pop0, coalesce(l_demographics_population, 0e0) AS pop FROM (SELECT j.*, dm.population AS l_demographics_population FROM (SELECT * EXCLUDE (population_1) FROM j) j LEFT JOIN l_demographics dm USING (cell))))
      SELECT cell, round(coalesce(oepnv_score, 0e0), 6) AS s_oepnv, {_GREEN} AS s_green, round(1 - coalesce(noise_penalty, 0e0), 6) AS s_quiet, round(coalesce(nature_score, 0e0), 6) AS s_nature,
        round(1 - (1 - {hist}) * (1 - 35e-2 * (art_density * art_density / (art_density * art_density + 784e0))) * (1 - 6e-1 * gg), 6) AS s_character, round(coalesce(bb_score, 0e0), 6) AS s_broadband, round(coalesce(climate_score, 5e-1), 6) AS s_climate,
        round(coalesce(flood_score, 1e0), 6) AS s_flood, round(coalesce(vacancy_score, 1e0), 6) AS s_vacancy,
        round(1 - 2e-1 * CASE WHEN catchment_pop <> 0 THEN {_clip("1 - 1000 * kita_supply / catchment_pop / 75e-2")} ELSE 0e0 END, 6) AS kita_crowd, pop >= 15 AS inhabited FROM g"""


def _checks(assembled: str) -> str:
    each = ["SELECT 'cells' AS rule, CAST(count(*) AS DOUBLE) AS value, 10000e0 AS low, 20000e0 AS high FROM t", "SELECT 'inhabited share', avg(CASE WHEN inhabited THEN 1e0 ELSE 0e0 END), 3e-1, 1e0 FROM t"]
    share = lambda cond: f"avg(CASE WHEN {cond} THEN 1e0 ELSE 0e0 END)"
    for c in _SCORES:
        for name, x, low, high in (
            ("least", f"min({c})", "0e0", "1e0"), ("most", f"max({c})", "0e0", "1e0"), ("known", share(f"{c} IS NOT NULL"), "1e0", "1e0"), ("median", f"quantile_cont({c}, 0.5)", "1e-2", "1e0"),
            ("p95", f"quantile_cont({c}, 0.95)", "5e-2", "1e0"), ("over half", share(f"{c} > 5e-1"), "0e0", "1e0"), ("at floor", share(f"{c} <= 0"), "0e0", "9e-1"), ("at top", share(f"{c} >= 1"), "0e0", "9e-1"),
        ):
            each.append(f"SELECT '{c} {name}', {x}, {low}, {high} FROM t")
    return f"WITH t AS ({assembled}), v AS ({' UNION ALL '.join(each)}) SELECT rule, round(value, 5) AS value, low, high, coalesce(value BETWEEN low AND high, false) AS ok FROM v"


def oracle_sql() -> dict[str, str]:
    pens = ", ".join(f"round({c}, 6) AS {c}" for c in ("road_penalty", "rail_penalty", "airport_penalty", "urban_penalty", "noise_penalty"))
    own = {
        "green_layer": f"WITH {_LAND} SELECT cell, {_GREEN} AS s_green FROM la",
        "noise_layer": f"WITH {_LAND}, {_NOISY} SELECT cell, {pens} FROM no",
        "nature_layer": _nature(),
        "schools_family": _family(),
        "demographics": _DEMO,
        "character_inputs": _CHARACTER,
        "rent_layer": _rent(),
        "vacancy_layer": _VACANCY,
    }
    everything = {**grid_layers.oracle_sql(), **scoring.oracle_sql(), **surfaces.oracle_sql(), **own}
    own["assemble_layers"] = _assemble(everything)
    own["validate_layers"] = _checks(own["assemble_layers"])
    return own
