"""Queries of the general data-preparation problems: p2, p3 and p6."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import text
from ..operators import impute, nearby, rejects
from ..session import table
from . import sql

EDGE_M = 4000.0
RADIUS_M = 100.0
RENT = impute.Numeric("rent_2022", 0.0, 100.0, open_low=True, open_high=True)
VACANCY = impute.Numeric("vacancy_pct", 0.0, 100.0)
LATITUDE = impute.Numeric("latitude", *text.LAT_RANGE)
LONGITUDE = impute.Numeric("longitude", *text.LON_RANGE)
PREDICTORS = ["population", "s_green", "s_quiet"]


def p2_near(spark: SparkSession, sf: str) -> DataFrame:
    """Each pair with its distance, and the hexagon of the school point."""
    schools = table(spark, sf, "schools_points")
    pairs = nearby.within_distance(schools, table(spark, sf, "pois"), "point_id", "osm_id", RADIUS_M)
    homes = nearby.containing_cell(schools.select("point_id", "lat", "lon"), table(spark, sf, "grid").select("q", "r", "h3"), EDGE_M)
    return pairs.join(homes.select("point_id", "h3"), "point_id").select("point_id", "osm_id", "h3", F.round("dist_m", 3).alias("dist_m"))


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return p2_near(spark, sf).select("point_id", "osm_id", "h3")


def p3_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Every row of scores with both fields filled and marked."""
    return impute.impute_numeric(table(spark, sf, "scores"), "score_id", ["kreis", "run_no"], [RENT, VACANCY], PREDICTORS)


def p3_schools(spark: SparkSession, sf: str) -> DataFrame:
    """Every row of jedeschule with latitude and longitude filled and marked."""
    rows = table(spark, sf, "jedeschule").select("row_id", text.zip5(F.col("zip")).alias("zip5"), text.usable_lat(F.col("latitude")).alias("latitude"), text.usable_lon(F.col("longitude")).alias("longitude"))
    return impute.impute_numeric(rows, "row_id", ["zip5"], [LATITUDE, LONGITUDE])


def p3_school_type(spark: SparkSession, sf: str) -> DataFrame:
    """Every row of jedeschule with its school type, drawn within the zip where missing."""
    rows = table(spark, sf, "jedeschule").withColumns({"la": text.usable_lat(F.col("latitude")), "lo": text.usable_lon(F.col("longitude"))})
    return impute.impute_category(rows, "row_id", text.zip5(F.col("zip")), text.strip(text.known(F.col("school_type"))), ["la", "lo"])


def p3_heldout(spark: SparkSession, sf: str) -> DataFrame:
    """A tenth of the present values, fixed by the row's key, hidden and filled again: how far
    the group's mean is off, whether the equations are at least as near, and whether filled
    values spread like the true ones."""
    s = table(spark, sf, "scores")
    hide = F.pmod(F.col("score_id"), F.lit(10)) == 3
    fields = [RENT, VACANCY]
    hidden = s.select("score_id", "kreis", "run_no", *PREDICTORS, *[F.when(~hide, f.present()).alias(f.name) for f in fields])
    true = s.where(hide & F.col("kreis").isNotNull()).select("score_id", "kreis", "run_no", *[f.present().alias(f"t{i}") for i, f in enumerate(fields)])
    filled = [impute.impute_numeric(hidden, "score_id", ["kreis", "run_no"], fields, PREDICTORS, residual=r).select("score_id", *[F.col(f.name).alias(f"{n}{i}") for i, f in enumerate(fields)]) for r, n in ((True, "drawn"), (False, "plain"))]
    means = hidden.groupBy("kreis", "run_no").agg(*[F.avg(f.name).alias(f"m{i}") for i, f in enumerate(fields)])
    both = true.join(means, ["kreis", "run_no"]).join(filled[0], "score_id").join(filled[1], "score_id")
    each = F.explode(F.array(*[F.struct(F.lit(f.name).alias("fld"), *[F.col(f"{c}{i}").alias(n) for c, n in (("t", "actual"), ("m", "mean"), ("drawn", "drawn"), ("plain", "plain"))]) for i, f in enumerate(fields)]))
    rows = both.select(each.alias("e")).select("e.*").where("actual is not null and mean is not null")
    rmse = lambda c: F.sqrt(F.avg(F.pow(F.col(c) - F.col("actual"), 2)))
    spread = F.stddev_samp("drawn") / F.stddev_samp("actual")
    return rows.groupBy("fld").agg(F.count(F.lit(1)).alias("hidden"), F.round(rmse("mean"), 4).alias("rmse_mean"), (rmse("plain") <= rmse("mean") * 1.01).alias("near"), spread.between(0.85, 1.15).alias("spreads"))


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    scores = p3_scores(spark, sf).select(
        "score_id",
        F.explode(F.array(*[F.when(F.col(f"{f}_filled"), F.lit(f)) for f in ("rent_2022", "vacancy_pct")])).alias("fld"),
    )
    schools = p3_schools(spark, sf).where("latitude_filled")
    return (
        scores.where(F.col("fld").isNotNull())
        .select(F.lit("scores").alias("tab"), F.col("score_id").alias("row_key"), "fld")
        .unionByName(schools.select(F.lit("jedeschule").alias("tab"), F.col("row_id").alias("row_key"), F.lit("latitude").alias("fld")))
    )


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    return rejects.rejected(table(spark, sf, "jedeschule_raw"))


def p6_rows(spark: SparkSession, sf: str) -> DataFrame:
    return rejects.accepted(table(spark, sf, "jedeschule_raw"))


def queries() -> dict:
    return {f.__name__: f for f in (p2_found, p2_near, p3_found, p3_scores, p3_schools, p3_school_type, p3_heldout, p6_found, p6_rows)}


_P2 = f"""
WITH home AS ({sql.utm32_cells("(SELECT * FROM schools_points WHERE lat BETWEEN -80 AND 84 AND lon BETWEEN -80 AND 98)", "lat", "lon", EDGE_M, "point_id, lat, lon")}),
  p AS (SELECT DISTINCT osm_id, lat, lon FROM pois WHERE lat BETWEEN -90 AND 90 AND NOT isnan(lon)),
  pairs AS (SELECT point_id, osm_id, q, r, {sql.haversine("home.lat", "home.lon", "p.lat", "p.lon")} AS d
    FROM home JOIN p ON p.lat BETWEEN home.lat - 0.001e0 AND home.lat + 0.001e0)
SELECT point_id, osm_id, h3{{dist}} FROM pairs JOIN grid ON pairs.q = grid.q AND pairs.r = grid.r WHERE d <= {sql.e(RADIUS_M)} GROUP BY point_id, osm_id, h3"""

_FIELD = '(?:"(?:[^"]|"")*"|[^",]*)'


def _p6(select: str, where: str) -> str:
    lat, lon = (f"""(CASE WHEN f[{i}] LIKE '"%' THEN replace(substr(f[{i}], 2, length(f[{i}]) - 2), '""', '"') ELSE f[{i}] END)""" for i in (7, 8))
    bad = " OR ".join(f"({sql.strip(c)} <> '' AND ({sql.usable(c, *r)}) IS NULL)" for c, r in ((lat, text.LAT_RANGE), (lon, text.LON_RANGE)))
    return f"""
WITH a AS (SELECT line_id, raw_line, regexp_full_match(raw_line, '(?s){_FIELD}(?:,{_FIELD})*') AS ok FROM jedeschule_raw),
  b AS (SELECT *, CASE WHEN ok THEN string_split(regexp_replace(regexp_replace(raw_line, '("(?:[^"]|"")*"|[^",]+)', '\\1', 'g'), ',', ',', 'g'), ',') END AS naive,
    CASE WHEN ok THEN regexp_extract_all(',' || raw_line, '(?s),({_FIELD})', 1) END AS f FROM a),
  c AS (SELECT *, CASE WHEN NOT ok THEN 'quoting' WHEN len(f) <> 8 THEN 'column_count' WHEN {bad} THEN 'invalid_value' END AS reason,
    {sql.number(lat)} AS lat, {sql.number(lon)} AS lon FROM b)
SELECT {select} FROM c WHERE {where}"""


def oracle_sql() -> dict[str, str]:
    zip5 = sql.zip5("zip")
    lat = sql.usable("latitude", *text.LAT_RANGE)
    unquote = lambda i: f"""CASE WHEN f[{i}] LIKE '"%' THEN replace(substr(f[{i}], 2, length(f[{i}]) - 2), '""', '"') ELSE f[{i}] END"""
    texts = ", ".join(f"{unquote(i)} AS {c}" for i, c in enumerate(rejects.COLUMNS[:6], 1))
    return {
        "p2_found": _P2.format(dist=""),
        "p2_near": _P2.format(dist=", round(min(d), 3) AS dist_m"),
        "p3_found": f"""
WITH s AS (SELECT score_id, kreis, run_no, CASE WHEN NOT isnan(rent_2022) AND rent_2022 > 0 AND rent_2022 < 100 THEN rent_2022 END AS rent,
    CASE WHEN NOT isnan(vacancy_pct) AND vacancy_pct BETWEEN 0 AND 100 THEN vacancy_pct END AS vac FROM scores WHERE kreis IS NOT NULL),
  w AS (SELECT *, count(rent) OVER (PARTITION BY kreis, run_no) AS nr, count(vac) OVER (PARTITION BY kreis, run_no) AS nv FROM s),
  j AS (SELECT row_id, {zip5} AS z, {lat} AS la FROM jedeschule),
  k AS (SELECT *, count(la) OVER (PARTITION BY z) AS n FROM j WHERE z IS NOT NULL)
SELECT 'scores' AS tab, score_id AS row_key, 'rent_2022' AS fld FROM w WHERE rent IS NULL AND nr > 0
UNION ALL SELECT 'scores', score_id, 'vacancy_pct' FROM w WHERE vac IS NULL AND nv > 0
UNION ALL SELECT 'jedeschule', row_id, 'latitude' FROM k WHERE la IS NULL AND n > 0""",
        "p3_heldout": f"""
WITH s AS (SELECT score_id, kreis, run_no, score_id % 10 = 3 AS hide, CASE WHEN NOT isnan(rent_2022) AND rent_2022 > 0 AND rent_2022 < 100 THEN rent_2022 END AS rent,
    CASE WHEN NOT isnan(vacancy_pct) AND vacancy_pct BETWEEN 0 AND 100 THEN vacancy_pct END AS vac FROM scores WHERE kreis IS NOT NULL),
  m AS (SELECT kreis, run_no, avg(rent) FILTER (NOT hide) AS mr, avg(vac) FILTER (NOT hide) AS mv FROM s GROUP BY kreis, run_no),
  e AS (SELECT 'rent_2022' AS fld, rent AS t, mr AS m FROM s JOIN m USING (kreis, run_no) WHERE hide UNION ALL SELECT 'vacancy_pct', vac, mv FROM s JOIN m USING (kreis, run_no) WHERE hide)
SELECT fld, count(*) AS hidden, round(sqrt(avg(pow(m - t, 2))), 4) AS rmse_mean, true AS near, true AS spreads FROM e WHERE t IS NOT NULL AND m IS NOT NULL GROUP BY fld""",
        "p6_found": _p6("line_id, reason", "reason IS NOT NULL"),
        "p6_rows": _p6(f"line_id, {texts}, lat AS latitude, lon AS longitude", "reason IS NULL"),
    }
