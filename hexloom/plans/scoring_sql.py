"""The SQL of :mod:`hexloom.plans.scoring`."""

from __future__ import annotations

from ..functions import composites as comp, geo, rules, shape, text
from ..operators import kernels as kn
from . import inputs as inp, sql
from .layers import _W, _W0
from .scoring import CELL_AREA, PALETTE, SPEEDS

e = sql.e


def clip(x: str) -> str:
    return f"greatest(0e0, least(1e0, {x}))"


_MODES = ", ".join(f"('{m}', {e(60 * 1.3 / (v * 1000))})" for m, v in SPEEDS.items())
REACH = f"""{inp.CENTRES}, {inp.GRID_XY},
  r0 AS (SELECT center, g.cell, sqrt(pow(z.x - g.x, 2) + pow(z.y - g.y, 2)) AS d FROM z, g WHERE abs(z.x - g.x) <= 92310 AND abs(z.y - g.y) <= 92310),
  re AS (SELECT center, cell, mode, d * per AS minutes FROM r0, (VALUES {_MODES}) AS v(mode, per) WHERE d * per <= 120)"""
_CAR = "least(minutes * 13e-1 + 6e0, 120e0)"
_POINT_DECAY = f"exp(-pow(greatest(0e0, minutes - {e(shape.POINT_T0)}) / {e(shape.POINT_SIGMA)}, {e(shape.POINT_POWER)}))"


def _door() -> str:
    stops = sql.utm32_cells(inp.key_source("customer", "c_custkey", "c_custkey AS stop"), "lat", "lon", inp.EDGE_M, "stop")
    return f"""WITH {REACH}, s AS ({stops}),
      a AS (SELECT center, stop, iter, d / 1000 + (center * 7 + stop * 13 + iter * 29) % 17 AS m FROM
        (SELECT center, stop, sqrt(pow(z.x - s.x, 2) + pow(z.y - s.y, 2)) AS d FROM z, s WHERE abs(z.x - s.x) <= 120000 AND abs(z.y - s.y) <= 120000), range(5) AS t(iter) WHERE d <= 120000 AND (center + stop + iter) % 11 > 0),
      w AS (SELECT stop, cell, d * 60 * 13e-1 / 18000e0 AS eg FROM (SELECT stop, g.cell, sqrt(pow(s.x - g.x, 2) + pow(s.y - g.y, 2)) AS d FROM s, g WHERE abs(s.x - g.x) <= 8000 AND abs(s.y - g.y) <= 8000) WHERE d <= 8000 AND d * 60 * 13e-1 / 18000e0 <= 30),
      i AS (SELECT center, cell, iter, min(m + eg) AS t FROM a JOIN w USING (stop) GROUP BY ALL),
      t AS (SELECT center, cell, list_sort(list(t))[3] AS minutes FROM i GROUP BY ALL),
      b AS (SELECT center, cell, minutes AS bm FROM re WHERE mode = 'bike')
      SELECT center, cell, round(least(t.minutes, b.bm), 4) AS minutes FROM (SELECT * FROM t WHERE minutes <= 120) t FULL JOIN b USING (center, cell)"""


_MBO = f"""WITH {REACH}, te AS (SELECT re.cell, mode, center, minutes AS t, {clip("least(1e0, weight / 12000) * " + clip("(120e0 - minutes) / 120e0"))} AS term FROM re JOIN z USING (center)),
  ag AS (SELECT cell, mode, CASE WHEN max(term) >= 1 THEN 0e0 ELSE exp(sum(ln(1 - term))) END AS rest, max((term, -t)) FILTER (term > 0 AND t <= 25) AS w, min((t, -term)) FILTER (term > 0) AS n FROM te GROUP BY cell, mode),
  na AS (SELECT z.cell, mode, max({clip("weight / 20000")}) AS own FROM z JOIN grid ON z.cell = grid.cell, (VALUES ('walk'), ('bike'), ('car')) AS v(mode) GROUP BY z.cell, mode),
  b AS (SELECT cell, mode, coalesce(rest, 1e0) AS rest, coalesce(own, 0e0) AS own, CASE WHEN w IS NOT NULL THEN w[1] WHEN n IS NOT NULL AND n[1] < 120 THEN -n[2] ELSE 0e0 END AS b, CASE WHEN w IS NOT NULL THEN -w[2] WHEN n IS NOT NULL AND n[1] < 120 THEN n[1] ELSE 120e0 END AS m0 FROM ag FULL JOIN na USING (cell, mode)),
  m AS (SELECT *, CASE WHEN own >= b AND own > 0 THEN 0e0 ELSE m0 END AS m FROM b)
  SELECT cell, mode, CAST(least(254, round_even(round(m, 6), 0)) AS INT) AS m, CAST(least(254, round_even(round(254 * greatest(b, own), 6), 0)) AS INT) AS b, CAST(least(254, round_even(round(254 * (1 - (1 - own) * rest), 6), 0)) AS INT) AS o FROM m WHERE m < 120 OR own > 0"""
_LINKS = """l AS (SELECT a.center AS a, b.center AS b FROM z a JOIN z b ON a.name = b.name AND sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2)) <= 50000),
  w(a, b) AS (SELECT center, center FROM z UNION SELECT w.a, l.b FROM w JOIN l ON w.b = l.a), ci AS (SELECT a AS center, min(b) AS city FROM w GROUP BY a)"""
_CITY = f"""WITH RECURSIVE {REACH}, {_LINKS}, met AS (SELECT DISTINCT city, re.cell, mode FROM re JOIN ci USING (center)),
  f AS (SELECT met.city, met.cell, met.mode, z.weight, z.center, coalesce(re.minutes, 120e0) AS minutes FROM met JOIN ci ON met.city = ci.city JOIN z ON z.center = ci.center LEFT JOIN re ON re.center = z.center AND re.cell = met.cell AND re.mode = met.mode),
  c AS (SELECT *, sum(weight) OVER (PARTITION BY city, cell, mode ORDER BY minutes, center ROWS UNBOUNDED PRECEDING) AS run, sum(weight) OVER (PARTITION BY city, cell, mode) AS total FROM f)
  SELECT city, cell, mode, CAST(least(254, round_even(round(min(minutes), 6), 0)) AS INT) AS code FROM c WHERE run >= 5e-1 * total - 1e-9 GROUP BY ALL"""
_PARTS = f"""WITH RECURSIVE {inp.CENTRES}, {_LINKS}, t AS (SELECT city, name, row_number() OVER (PARTITION BY name ORDER BY sum(weight) DESC, city) AS n FROM ci JOIN z USING (center) GROUP BY city, name),
  m AS (SELECT city FROM ci GROUP BY city HAVING count(*) > 1), p AS (SELECT center, city, CASE WHEN n = 1 THEN lower(z.name) ELSE lower(z.name) || '-' || n END AS slug, weight FROM ci JOIN z USING (center) JOIN t USING (city) JOIN m USING (city)),
  k AS (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY center) AS k FROM p) SELECT center, city, CASE WHEN k = 1 THEN slug ELSE slug || '-' || k END AS part, round(weight, 4) AS weight FROM k"""


def _flood() -> str:
    src = sql.utm32_cells(inp.key_source("part", "p_partkey", "p_partkey, p_size"), "lat", "lon", inp.EDGE_M, "p_partkey, p_size, lat")
    rps = comp.RETURN_PERIODS
    d = [f"greatest(0e0, p_size / 10 + {e(0.4 * i)} - p_partkey % 7)" for i in range(len(rps))]
    sums = ", ".join(f"coalesce(sum(4e6 * cos(radians(lat))) FILTER ({x} > 0), 0e0) AS a{rp}, coalesce(sum(4e6 * cos(radians(lat)) * {x}) FILTER ({x} > 0), 0e0) AS d{rp}" for x, rp in zip(d, rps))
    sev = [f"coalesce({clip(f'a{rp} / {e(CELL_AREA)}')} * (d{rp} / nullif(a{rp}, 0e0)) / (d{rp} / nullif(a{rp}, 0e0) + 1), 0e0)" for rp in rps]
    eas = " + ".join(f"5e-1 * ({a} + {b}) * {e(1 / p - 1 / q)}" for a, b, p, q in zip(sev, sev[1:], rps, rps[1:]))
    first = "CASE " + " ".join(f"WHEN a{rp} / {e(CELL_AREA)} >= 1e-1 THEN {rp}" for rp in rps) + " ELSE 0 END"
    return f"""WITH s AS (SELECT (q + 1048576) * 2097152 + r + 1048576 AS cell, p_partkey, p_size, lat FROM ({src})), g AS (SELECT cell, {sums} FROM s GROUP BY cell), x AS (SELECT *, {eas} AS eas FROM g)
      SELECT cell, round(eas, 8) AS eas, round(1 - {clip("eas / 5e-2")}, 6) AS score, {first} AS first_rp FROM x"""


def _climate() -> str:
    return f"""WITH {inp.GRID_XY}, px AS (SELECT p_partkey % 8 AS row_, p_partkey % 5 AS col_, avg(p_retailprice) + 300 AS sun, avg(p_size) * 45 AS rain, avg(p_size) AS dry FROM part GROUP BY ALL),
      a AS (SELECT cell, greatest(0, least(4, CAST(floor((x - 280000) / 120000e0) AS BIGINT))) AS col_, greatest(0, least(7, CAST(floor((6100000 - y) / 120000e0) AS BIGINT))) AS row_ FROM g)
      SELECT cell, round(6e-1 * {clip("(sun - 1400) / 500e0")} + 4e-1 * least({clip("(rain - 1800) / -1200e0")}, {clip("(dry - 15) / 15e0")}), 6) AS score FROM a LEFT JOIN px USING (row_, col_)"""


def _quantise() -> str:
    return f"""WITH {inp.CELLS}, l AS (SELECT ln(1 + min(population)) AS pl, ln(1 + max(population)) AS ph, min(rent_2022) AS rl, max(rent_2022) AS rh FROM c),
      q AS (SELECT c.*, round_even((ln(1 + population) - pl) / ((ph - pl) / 254), 0) * ((ph - pl) / 254) + pl AS p2, round_even((rent_2022 - rl) / ((rh - rl) / 254), 0) AS rc, rl, rh, round_even(s_green * 100, 0) / 100 AS g2 FROM c, l)
      SELECT round(max(abs(p2 - ln(1 + population))), 6) AS population, round(max(abs(rc * ((rh - rl) / 254) + rl - rent_2022)), 6) AS rent_2022, round(max(abs(g2 - s_green)), 6) AS s_green, count(rent_2022) AS n, CAST(sum(rc) AS BIGINT) AS codes FROM q"""


def _plain(c: str) -> str:
    return f"replace(replace(replace(replace(lower({c}), 'ä', 'ae'), 'ö', 'oe'), 'ü', 'ue'), 'ß', 'ss')"


def _geocode() -> str:
    pat = "^(.*?)[\\s,]+(\\d+\\s*[a-zA-Z]?(?:\\s*[-/]\\s*\\d+\\s*[a-zA-Z]?)?)\\s*$"
    street = f"nullif(regexp_extract(trim(address), '{pat}', 1), '')"
    number = f"nullif(regexp_extract(trim(address), '{pat}', 2), '')"
    key = f"regexp_replace(regexp_replace(regexp_replace(replace({_plain(street)}, 'strasse', 'str'), 'str\\.', 'str', 'g'), '\\bst\\b', 'str', 'g'), '[^a-z0-9]', '', 'g')"
    city = f"coalesce(regexp_replace({_plain('city')}, '[^a-z0-9]', '', 'g'), '')"
    lat, lon = sql.usable("latitude", *text.LAT_RANGE), sql.usable("longitude", *text.LON_RANGE)
    tier = lambda n, cond: f"avg(p.lat) FILTER ({cond}) AS {n}_lat, avg(p.lon) FILTER ({cond}) AS {n}_lon"
    return f"""WITH a AS (SELECT row_id, {key} AS sk, TRY_CAST(nullif(regexp_extract({number}, '^\\s*(\\d+)', 1), '') AS INT) AS hn, {sql.zip5("zip")} AS plz, {city} AS ck, {lat} AS lat, {lon} AS lon FROM jedeschule),
      p AS (SELECT * FROM a WHERE lat IS NOT NULL AND lon IS NOT NULL AND sk <> ''), t AS (SELECT * FROM a WHERE lat IS NULL OR lon IS NULL),
      g AS (SELECT t.row_id, any_value(t.sk) AS sk, any_value(t.hn) AS hn, count(p.lat) AS n, max(p.lat) - min(p.lat) AS dlat, max(p.lon) - min(p.lon) AS dlon,
        {tier("z", "p.plz = t.plz")}, {tier("c", "p.ck = t.ck AND t.ck <> ''")}, {tier("f", "p.ck <> '' AND t.ck <> '' AND (contains(p.ck, t.ck) OR contains(t.ck, p.ck))")}, avg(p.lat) AS o_lat, avg(p.lon) AS o_lon
        FROM t LEFT JOIN p ON t.sk = p.sk AND t.hn = p.hn GROUP BY t.row_id),
      m AS (SELECT *, CASE WHEN sk IS NULL OR sk = '' OR hn IS NULL THEN 'no_addr' WHEN n = 0 THEN 'miss' WHEN z_lat IS NOT NULL THEN 'plz_match' WHEN c_lat IS NOT NULL THEN 'city_match' WHEN f_lat IS NOT NULL THEN 'city_fuzzy'
        WHEN n = 1 THEN 'unique' WHEN dlat < 1e-2 AND dlon < 15e-3 THEN 'clustered' ELSE 'ambig' END AS match FROM g)
      SELECT row_id, {", ".join(f"round(CASE match WHEN 'plz_match' THEN z_{v} WHEN 'city_match' THEN c_{v} WHEN 'city_fuzzy' THEN f_{v} WHEN 'unique' THEN o_{v} WHEN 'clustered' THEN o_{v} END, 6) AS {v}" for v in ("lat", "lon"))}, match FROM m"""


def condition(c) -> str:
    """A rule's condition over columns named like the tags."""
    q = lambda k: f'"{k}"'
    if isinstance(c, rules.Has):
        return f"coalesce({q(c.key)} IN ({', '.join(repr(v) for v in c.values)}), false)" if c.values else f"{q(c.key)} IS NOT NULL"
    if isinstance(c, rules.Like):
        return f"coalesce(regexp_matches(lower({q(c.key)}), '{c.pattern}'), false)"
    return "(" + (" OR " if isinstance(c, rules.Any) else " AND ").join(condition(p) for p in c.parts) + ")"


def case(table: list[tuple], otherwise: str) -> str:
    value = lambda r: f'"{r[5:]}"' if r.startswith("SAME:") else f"'{r}'"
    return "CASE " + " ".join(f"WHEN {condition(c)} THEN {value(r)}" for r, c in table) + f" ELSE {otherwise} END"


def _classify() -> str:
    used: set[str] = set()

    def collect(c):
        if hasattr(c, "parts"):
            for p in c.parts:
                collect(p)
        else:
            used.add(c.key)

    for t in (rules.POI_RULES, rules.GREEN_RULES, rules.WATER_RULES):
        for _, c in t:
            collect(c)
    own = {"shop": "category = 'grocery'", "leisure": "category = 'leisure'", "tourism": "category = 'nature'", "amenity": "category NOT IN ('grocery', 'leisure', 'nature')"}
    sub = "CASE WHEN category = 'school' THEN 'school' ELSE coalesce(subcategory, 'none') END"
    cols = [f'CASE WHEN {own[k]} THEN {sub} END AS "{k}"' if k in own else "coalesce(name, '') AS \"name\"" if k == "name" else f'CAST(NULL AS VARCHAR) AS "{k}"' for k in sorted(used)]
    return f"""WITH o AS (SELECT DISTINCT ON (osm_id) * FROM pois), t AS (SELECT {", ".join(cols)} FROM o)
      SELECT {case(rules.POI_RULES, "'none'")} AS class, {case(rules.GREEN_RULES, "'none'")} AS green, CAST({case(rules.WATER_RULES, "'1.0'")} AS DOUBLE) AS water, count(*) AS n FROM t GROUP BY ALL"""


def _track(t: str) -> str:
    s = "lower(coalesce(school_type, ''))"
    return f"(regexp_matches({s}, '{rules.REGISTER_TRACKS[t]}') AND NOT regexp_matches({s}, '{rules.REGISTER_SKIP}'))"


def _composite() -> str:
    return f"""{inp.CELLS}, {inp.POIS}, ki AS (SELECT cell, CAST(count(*) FILTER (subcategory = 'kindergarten') AS DOUBLE) AS kita, CAST(count(*) AS DOUBLE) AS places FROM p GROUP BY cell),
      a AS (SELECT grid.cell, c.population, c.vacancy_pct, c.inhabited, coalesce(c.s_green, 0e0) AS sg, coalesce(c.s_quiet, 0e0) AS sq, kita, places, coalesce(1 - c.s_green, 0e0) AS built FROM grid LEFT JOIN c USING (cell) LEFT JOIN ki USING (cell))"""


def _assemble() -> str:
    water, way = "(cell % 10 / 2003e-2)", "(cell % 3 / 3e0)"
    veg = f"(sg * 61371307e-8 + 5e-1 * (sg * 29317741e-8) + 25e-2 * 103717e-6 + sq * 5e-2 + least(4e-2, 5e-1 * (sq * 1e-1)))"
    gl = clip(f"{veg} / ((1 - {water}) * 85e-2)")
    wa = clip(f"({water} + 15e-2 * {way}) / 3e-1")
    d = "coalesce(places * 50371e-5, 0e0)"
    people = "greatest(coalesce(population * 2, 0e0), 1000e0)"
    hist = f"sqrt(pow({d}, 2) / (pow({d}, 2) + 484e0) * {clip(f'1000 * {d} / {people} / 4')})"
    art = "(pow(coalesce(places * 20317e-5, 0e0), 2) / (pow(coalesce(places * 20317e-5, 0e0), 2) + 784e0))"
    return f"""WITH {_composite()} SELECT cell, round({clip(f"(1 - (1 - {gl}) * (1 - 2e-1 * {wa})) * (1 - 135e-2 * pow(built * 5e-1, 3))")}, 6) AS green,
      round(1 - 2e-1 * coalesce({clip("1 - 1000 * kita / nullif(population, 0e0) / 75e-2")} * CASE WHEN kita / nullif(population, 0e0) IS NOT NULL THEN 1 END, 0e0), 6) AS kita_crowd,
      round(1 - (1 - {hist}) * (1 - 35e-2 * {art}) * (1 - 6e-1 * (sq * 99713e-5 * {clip("(built - 4e-2) / 16e-2")})), 6) AS character,
      round(CASE WHEN vacancy_pct IS NULL THEN 1e0 ELSE {clip("1 - (vacancy_pct - 5) / 13")} END, 6) AS vacancy, coalesce(population >= 15, inhabited, false) AS inhabited FROM a"""


_SUB = lambda m, pen: f"(CASE WHEN {m} IS NULL OR {m} >= 120 THEN 0e0 ELSE pow({clip(f'(60 - {m} * {pen}) / 55e0')}, 15e-1) END)"
_RANK = f"""WITH {REACH}, {inp.CELLS}, b AS (SELECT cell, min(minutes) FILTER (mode = 'bike') AS bike, least(min(minutes) FILTER (mode = 'car') * 13e-1 + 6, 120e0) AS car0, min(minutes) FILTER (mode = 'car') AS car1 FROM re GROUP BY cell),
  s AS (SELECT cell, s_green, s_quiet, {_SUB("bike", "1e0")} AS a, CASE WHEN car1 IS NULL THEN 0e0 ELSE {_SUB("car0", "11e-1")} END AS c_ FROM c JOIN b USING (cell) WHERE inhabited),
  t AS (SELECT *, 1 - (1 - greatest(a, c_)) * (1 - 4e-1 * a) * (1 - 4e-1 * c_) / (1 - 4e-1 * greatest(a, c_)) AS commute FROM s)
  SELECT cell, round(exp((2 * ln(greatest(s_green, 1e-2)) + ln(greatest(s_quiet, 1e-2)) + 3 * ln(greatest(commute, 1e-2))) / 6), 9) AS score FROM t ORDER BY score DESC, cell LIMIT 100"""
_ACCESS = f"""WITH {REACH}, f AS (SELECT cell, min(minutes) AS foot FROM re WHERE mode = 'walk' GROUP BY cell), o AS (SELECT *, foot * {e(4.5 / 15)} + 25e-1 AS bike, foot * {e(4.5 / 30)} + 6 AS car FROM f),
  b AS (SELECT cell, foot, least(bike, car) AS best, CASE WHEN bike <= car THEN 'bike' ELSE 'car' END AS mode FROM o), m AS (SELECT cell, CASE WHEN foot - best >= 3 THEN best ELSE foot END AS minutes, CASE WHEN foot - best >= 3 THEN mode ELSE 'foot' END AS mode FROM b)
  SELECT cell, round(minutes, 4) AS minutes, mode, round(pow({clip("(15 - minutes) / 12e0")}, 2), 6) AS near FROM m"""


def oracle_sql() -> dict[str, str]:
    tracks = ("grund", "gym", "real", "mittel")
    listed = ", ".join(f"CASE WHEN {_track(t)} THEN '{t}' END" for t in tracks)
    return {
        "direct_reach": f"WITH {REACH} SELECT center, cell, mode, CAST(round_even(CASE WHEN mode = 'car' THEN {_CAR} ELSE minutes END, 0) AS INT) AS minutes FROM re",
        "door_to_door": _door(),
        "gravity_reach": f"""WITH {REACH}, g2 AS (SELECT re.cell, sum(weight / 100 * exp(-minutes / 15e0)) AS raw FROM re JOIN z USING (center) WHERE mode = 'car' AND minutes < 60 GROUP BY re.cell),
          o AS (SELECT cell, sum(weight) / 500 AS own FROM z GROUP BY cell), b AS (SELECT cell, greatest(raw, coalesce(own, 0e0)) AS raw FROM g2 LEFT JOIN o USING (cell)), k AS (SELECT greatest(quantile_cont(raw, 0.999), 1e-9) AS cap FROM b WHERE raw > 0)
          SELECT cell, round(raw, 6) AS raw, round({clip("raw / cap")}, 6) AS score FROM b, k""",
        "point_reach": f"""WITH {REACH}, a AS (SELECT cell, mode, sum({_POINT_DECAY}) AS raw, min(minutes) AS minutes FROM re GROUP BY cell, mode), d AS (SELECT *, {_POINT_DECAY} AS dm FROM a)
          SELECT cell, mode, round(raw, 6) AS raw, round(minutes, 4) AS tmin, round(dm * (6e-1 + 4e-1 * (1 - exp(-greatest(0e0, raw - dm) / 15e-1))), 6) AS reach FROM d""",
        "mbo_field": _MBO,
        "city_weighted_percentile": _CITY,
        "city_parts": _PARTS,
        "weighted_median_rent": f"""WITH {inp.CELLS}, k AS (SELECT kreis, cell, round(rent_2022, 9) AS v, CASE WHEN bool_or(population IS NULL) OVER (PARTITION BY kreis) OR sum(population) OVER (PARTITION BY kreis) <= 0 THEN 1e0 ELSE population END AS w FROM c WHERE kreis IS NOT NULL AND rent_2022 IS NOT NULL),
          u AS (SELECT *, sum(w) OVER (PARTITION BY kreis ORDER BY v, cell ROWS UNBOUNDED PRECEDING) AS run, sum(w) OVER (PARTITION BY kreis) AS total FROM k),
          m AS (SELECT kreis, min(v) AS rent_2022 FROM u WHERE run >= 5e-1 * total - 1e-9 GROUP BY kreis), n AS (SELECT kreis, quantile_cont(v, 0.5) AS plain, stddev_samp(v) AS spread FROM k GROUP BY kreis)
          SELECT kreis, round(rent_2022, 6) AS rent_2022, round(plain, 6) AS plain, round(spread, 6) AS spread FROM m JOIN n USING (kreis)""",
        "kreis_noisy_or": f"WITH {inp.CELLS} SELECT kreis, round(1 - exp(sum(ln(1 - s_green * 2e-2))), 6) AS green, round(1 - exp(sum(ln(1 - s_quiet * 2e-2))), 6) AS quiet FROM c WHERE kreis IS NOT NULL GROUP BY kreis",
        "sector_lq": """WITH a AS (SELECT s_nationkey AS place, p_brand AS sector, sum(l_quantity) AS amount FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey GROUP BY ALL),
          q AS (SELECT *, (amount / sum(amount) OVER (PARTITION BY place)) / (sum(amount) OVER (PARTITION BY sector) / sum(amount) OVER ()) AS lq FROM a), h AS (SELECT sector, quantile_cont(amount, 0.7) AS half FROM a GROUP BY sector)
          SELECT place, sector, round(amount, 2) AS amount, round(lq, 6) AS lq, round(sqrt(amount / (amount + half) * (lq / (lq + 1))), 6) AS o FROM q JOIN h USING (sector)""",
        "allocated_mass": """WITH v AS (SELECT o_custkey, sum(o_totalprice) AS v FROM orders GROUP BY o_custkey), c AS (SELECT c_custkey, c_nationkey, greatest(c_acctbal, 0e0) AS share, sum(v) OVER (PARTITION BY c_nationkey) AS total FROM customer LEFT JOIN v ON c_custkey = o_custkey)
          SELECT c_custkey, round(total * share / nullif(sum(share) OVER (PARTITION BY c_nationkey), 0e0), 3) AS mass FROM c""",
        "flood_eas": _flood(),
        "vacancy_score": f"WITH {inp.CELLS} SELECT cell, round({clip('1 - (vacancy_pct - 5) / 13')}, 6) AS score FROM c WHERE vacancy_pct IS NOT NULL",
        "climate_score": _climate(),
        "quantise_roundtrip": _quantise(),
        "geocode_cascade": _geocode(),
        "classify_rules": _classify(),
        "school_tracks": "SELECT 'register' AS origin, " + ", ".join(f"count(*) FILTER {_track(t)} AS {t}" for t in tracks) + " FROM jedeschule UNION ALL SELECT 'map', " + ", ".join("count(*) FILTER (subcategory IN ({}))".format(", ".join(f"'{s}'" for s in rules.MAP_TRACKS[t])) for t in tracks) + " FROM (SELECT DISTINCT ON (osm_id) * FROM pois WHERE category = 'school')",
        "twin_recovery": f"""WITH j AS (SELECT lower(trim(name)) AS name, {sql.zip5("zip")} AS zip5, [x FOR x IN [{listed}] IF x IS NOT NULL] AS t FROM jedeschule WHERE name IS NOT NULL)
          SELECT name, zip5, coalesce(array_to_string(list_sort(list_distinct(flatten(list(t)))), ','), '') AS tracks, count(*) AS n FROM j WHERE zip5 IS NOT NULL GROUP BY name, zip5 HAVING count(*) > 1""",
        "assemble_scores": _assemble(),
        "composite_rank": _RANK,
        "score_cdf": f"WITH {inp.CELLS}, b AS (SELECT CAST(round_even(round(s_green * 254, 6), 0) AS INT) AS code, sum(population) AS p FROM c WHERE population > 0 GROUP BY 1) SELECT code, round(sum(p) OVER (ORDER BY code) / sum(p) OVER (), 6) AS cdf FROM b",
        "access_modes": _ACCESS,
        "content_changed": """WITH s AS (SELECT run_no, cell, inhabited FROM scores), b AS (SELECT run_no + 1 AS run_no, cell, inhabited FROM s WHERE run_no + 1 IN (SELECT run_no FROM s)), a AS (SELECT * FROM s WHERE run_no - 1 IN (SELECT run_no FROM s))
          SELECT run_no, 'gone' AS side, inhabited, count(*) AS n FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a) GROUP BY ALL UNION ALL SELECT run_no, 'new', inhabited, count(*) FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) GROUP BY ALL""",
        "tau_sweep": f"""WITH {REACH}, n AS (SELECT re.cell, minutes, weight / 100 AS mass, unnest([10e0, 15e0, 20e0, 30e0]) AS tau FROM re JOIN z USING (center) WHERE mode = 'car' AND minutes < 60), b AS (SELECT tau, cell, sum(mass * exp(-minutes / tau)) AS raw FROM n GROUP BY tau, cell)
          SELECT tau, count(*) AS cells, round(avg(raw), 6) AS mean, round(quantile_cont(raw, 0.95), 6) AS p95 FROM b GROUP BY tau""",
        "palette_levels": f"""WITH p AS ({sql.utm32_cells(inp.key_source("part", "p_partkey", "p_partkey AS k"), "lat", "lon", inp.EDGE_M, "k")}),
          d AS (SELECT k, q, r, (pow(k * 37 % 256 - pr, 2) + pow(k * 91 % 256 - pg, 2) + pow(k * 53 % 256 - pb, 2)) AS d, db FROM p, (VALUES {", ".join(f"({a}, {b}, {c}, {e(db)})" for a, b, c, db in PALETTE)}) AS v(pr, pg, pb, db)),
          m AS (SELECT k, any_value(q) AS q, any_value(r) AS r, arg_min(db, (d, db)) AS db FROM d GROUP BY k) SELECT (q + 1048576) * 2097152 + r + 1048576 AS cell, max(db) AS db FROM m GROUP BY 1""",
        "mode_pivot": f"WITH {REACH} SELECT center, " + ", ".join(f"count(*) FILTER (mode = '{m}') AS {m}" for m in SPEEDS) + " FROM re GROUP BY center",
    }
