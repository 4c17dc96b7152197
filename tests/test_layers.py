"""Composite layers, assembly, nearest polygons, remapping, and the shared folder."""

import math
import random

import pytest
from pyspark.sql import functions as F

from hexloom.functions import geo
from hexloom.operators import impute, layers as ly, ordering, reach, spatial, stats
from hexloom import session


def test_assembly_without_layers(spark):
    base = spark.createDataFrame([(1,), (2,)], "cell long")
    noise = spark.createDataFrame([(1, 0.25)], "cell long, noise_penalty double")
    flood = spark.createDataFrame([(2, 0.5)], "cell long, flood_score double")
    out = ly.scored(ly.assemble(base, {"noise": noise, "nature": None, "flood": flood}))
    got = {r.cell: r for r in out.collect()}
    assert "s_nature" not in out.columns and (got[1].s_quiet, got[2].s_quiet) == (0.75, 1.0)
    assert (got[1].s_flood, got[2].s_flood) == (1.0, 0.5) and not got[1].inhabited
    with pytest.raises(ValueError):
        ly.assemble(base, {"a": noise, "b": noise})


def test_nature_score_of_one_type(spark):
    names = [*ly.NATURE_WEIGHTS, "river", "stream"]
    one = {n: F.lit(1.0 if n == "lake" else 0.0) for n in names}
    none = {n: F.lit(0.0) for n in names}
    r = spark.range(1).select(ly.nature_score(one).alias("a"), ly.nature_score(none).alias("b")).first()
    assert r.a == pytest.approx(1.0) and r.b == 0.0


def test_equal_area_projection(spark):
    rows = [(52.0, 10.0), (48.137, 11.575), (53.55, 9.99)]
    got = geo.with_laea(spark.createDataFrame(rows, "lat double, lon double"), "lat", "lon").collect()
    assert (got[0].x, got[0].y) == (pytest.approx(4321000.0, abs=1e-3), pytest.approx(3210000.0, abs=1e-3))
    # areas keep: a small square of both has the area it has on the ellipsoid
    d = 1e-3
    for lat, lon in rows[1:]:
        corners = geo.with_laea(spark.createDataFrame([(lat, lon), (lat, lon + d), (lat + d, lon)], "lat double, lon double"), "lat", "lon").collect()
        (ax, ay), (bx, by), (cx, cy) = [(c.x, c.y) for c in corners]
        area = abs((bx - ax) * (cy - ay) - (cx - ax) * (by - ay))
        e2, s = 0.00669438002290, math.sin(math.radians(lat + d / 2))
        true = 6378137.0**2 * (1 - e2) / (1 - e2 * s * s) ** 2 * math.cos(math.radians(lat + d / 2)) * math.radians(d) ** 2
        assert area == pytest.approx(true, rel=1e-4)


def test_nearest_polygon_is_exact(spark):
    rnd = random.Random(4)
    rings = {f"p{i}": [(x + dx, y + dy) for dx, dy in ((0, 0), (900, 100), (700, 800))] for i, (x, y) in enumerate([(0, 0), (5000, 0), (0, 40_000)])}
    pts = [(i, rnd.uniform(-3000, 9000), rnd.uniform(-3000, 60_000)) for i in range(60)] + [(99, None, 0.0)]

    def dist(px, py, ring):
        inside, best = False, 1e18
        for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]):
            if (ay > py) != (by > py) and px < (bx - ax) * (py - ay) / (by - ay) + ax:
                inside = not inside
            t = max(0, min(1, ((px - ax) * (bx - ax) + (py - ay) * (by - ay)) / ((bx - ax) ** 2 + (by - ay) ** 2)))
            best = min(best, math.hypot(px - ax - t * (bx - ax), py - ay - t * (by - ay)))
        return 0.0 if inside else best

    want = {i: min((dist(x, y, r), n) for n, r in rings.items()) for i, x, y in pts if x is not None}
    P = spark.createDataFrame(pts, "id long, x double, y double")
    G = spark.createDataFrame([(n, [{"x": float(a), "y": float(b)} for a, b in r]) for n, r in rings.items()], "gen string, ring array<struct<x double, y double>>")
    got = {r.id: (r.dist, r.gen) for r in spatial.nearest_polygon(P, G, "id", "gen", 200.0, 500.0).collect()}
    assert {i: g for i, (_, g) in got.items()} == {i: g for i, (_, g) in want.items()}
    assert all(got[i][0] == pytest.approx(d, abs=1e-6) for i, (d, _) in want.items())
    assert spatial.nearest_polygon(P, G.limit(0), "id", "gen", 200.0, 500.0).count() == 0


def test_remap_is_complete(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    m = spark.createDataFrame([(1, 10), (2, 20)], "old long, new long")
    assert sorted((r.k, r.v) for r in ordering.remapped(df, m, "k", "old", "new").collect()) == [(10, "a"), (20, "b")]
    with pytest.raises(ValueError, match="1 rows"):
        ordering.remapped(df, m.where("old = 1"), "k", "old", "new")


def test_one_bad_weight_levels_all(spark):
    rows = [("a", 1.0, 1.0, 1), ("a", 2.0, 50.0, 2), ("a", 3.0, float("nan"), 3), ("b", 1.0, 1.0, 4), ("b", 2.0, 50.0, 5), ("c", 7.0, 0.0, 6), ("c", 9.0, 0.0, 7)]
    df = spark.createDataFrame(rows, "g string, v double, w double, id long")
    got = {r.g: r.v for r in stats.weighted_percentile(df, ["g"], "v", "w", 0.5, "id").collect()}
    assert got == {"a": 2.0, "b": 2.0, "c": 7.0}


def test_city_minutes_equal_filling_in(spark):
    rnd = random.Random(5)
    centres = [(i, f"n{i % 3}", rnd.choice([1.0, 2.0, 10.0])) for i in range(12)]
    links = [(c, x, "car", float(rnd.randrange(0, 110))) for c, _, _ in centres for x in range(15) if rnd.random() < 0.5]
    C = spark.createDataFrame(centres, "center long, name string, weight double")
    got = {(r.name, r.cell): r.minutes for r in reach.city_minutes(spark.createDataFrame(links, "center long, cell long, mode string, minutes double"), C, "name", "weight").collect()}
    at, want = {(c, x): m for c, x, _, m in links}, {}
    for name in {n for _, n, _ in centres}:
        for x in range(15):
            mins = sorted((at.get((c, x), 120.0), w) for c, n, w in centres if n == name)
            if all((c, x) not in at for c, n, _ in centres if n == name):
                continue
            run, total = 0.0, sum(w for _, w in mins)
            for m, w in mins:
                run += w
                if run >= 0.5 * total - 1e-9:
                    want[name, x] = m
                    break
    assert got == want


def test_native_opportunity_needs_no_reach(spark):
    r = spark.createDataFrame([], "center long, cell long, mode string, minutes double")
    opp = spark.createDataFrame([(1, 0.5)], "center long, opp double")
    native = spark.createDataFrame([(3, 0.5)], "cell long, native double")
    got = sorted(tuple(x) for x in reach.mbo(r, opp, native, ["car", "walk"]).collect())
    assert got == [(3, "car", 0, 127, 127), (3, "walk", 0, 127, 127)]


def test_chain_equals_filling_round_by_round(spark):
    rnd = random.Random(6)
    rows = []
    for i in range(600):
        x = rnd.gauss(0, 1)
        y = 10 + 2 * x + rnd.gauss(0, 0.5)
        z = 20 + y - x + rnd.gauss(0, 0.5)
        rows.append((i, "g", x, None if rnd.random() < 0.3 else y, None if rnd.random() < 0.3 else z))
    df = spark.createDataFrame(rows, "id long, g string, x double, y double, z double")
    fields = [impute.Numeric("y", -100.0, 100.0), impute.Numeric("z", -100.0, 100.0)]
    got = {r.id: r for r in impute.impute_numeric(df, "id", ["g"], fields, ["x"], residual=False).collect()}
    import numpy as np

    a = np.array([[r[2], np.nan if r[3] is None else r[3], np.nan if r[4] is None else r[4]] for r in rows])
    means = np.array([a[:, 0].mean(), np.nanmean(a[:, 1]), np.nanmean(a[:, 2])])
    d = a - means
    now = np.nan_to_num(d)
    for _ in range(200):
        for j in (1, 2):
            rest = [k for k in range(3) if k != j]
            ok = ~np.isnan(d[:, j])
            beta = np.linalg.lstsq(now[ok][:, rest], d[ok, j], rcond=None)[0]
            now[~ok, j] = now[~ok][:, rest] @ beta
    for i in range(600):
        assert got[i].y == pytest.approx(now[i, 1] + means[1], abs=1e-3) and got[i].z == pytest.approx(now[i, 2] + means[2], abs=1e-3)
        assert got[i].y_filled == (rows[i][3] is None) and got[i].z_filled == (rows[i][4] is None)
    with pytest.raises(ValueError):
        impute.impute_numeric(df, "id", ["g"], fields * 3)


def test_cluster_needs_a_shared_folder(spark):
    class Conf:
        def __init__(self, **values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key, default)

    class Session:
        def __init__(self, **values):
            self.conf = Conf(**values)

    with pytest.raises(RuntimeError):
        session.shared_dir(Session(**{"spark.master": "spark://host:7077"}))
    assert session.shared_dir(Session(**{"spark.master": "yarn", "spark.checkpoint.dir": "hdfs://x/y/"})) == "hdfs://x/y"
    assert session.shared_dir(Session(**{"spark.master": "local[4]"})).startswith("file://")


def test_scratch_deletes_its_tables(spark):
    from pathlib import Path

    with session.scratch(spark):
        t = session.materialise(spark.range(3))
        path = Path(t.inputFiles()[0].removeprefix("file://")).parent
        assert t.count() == 3 and path.exists()
    assert not path.exists()


@pytest.mark.parametrize(
    "address, street, number, key, first",
    [
        ("Königsberger Straße 12a", "Königsberger Straße", "12a", "koenigsbergerstr", 12),
        ("Am Ring  7 - 9", "Am Ring", "7 - 9", "amring", 7),
        ("Lange Str., 3/5", "Lange Str.", "3/5", "langestr", 3),
        ("Haupt St 4 b", "Haupt St", "4 b", "hauptstr", 4),
        ("Platz des 17. Juni", None, None, None, None),
        ("12", None, None, None, None),
        (None, None, None, None, None),
    ],
)
def test_addresses(spark, address, street, number, key, first):
    from hexloom.operators import geocode as gc

    a, b = gc.street_and_number(F.col("a"))
    r = spark.createDataFrame([(address,)], "a string").select(a.alias("s"), b.alias("n"), gc.norm_street(a).alias("k"), gc.house_number(b).alias("f")).first()
    assert tuple(r) == (street, number, key, first)


def test_way_shapes(spark):
    from hexloom.operators import ways

    rows = [
        (1, [(9.0, 50.0), (9.5, 50.0), (9.5, 50.5)]),
        (2, [(9.0, 50.0), (9.5, 50.0), (9.5, 50.5), (9.0, 50.0)]),
        (3, [(9.0, 50.0), (9.5, 50.0)]),
        (4, [(1.0, 50.0), (1.5, 50.0), (1.5, 50.5)]),
        (5, [(9.0, 95.0), (9.5, 50.0)]),
        (6, []),
        (7, None),
    ]
    df = spark.createDataFrame([(i, None if p is None else [{"lon": a, "lat": b} for a, b in p]) for i, p in rows], "id long, points array<struct<lon double, lat double>>")
    lon, lat = ways.centroid(F.col("points"))
    got = {r.id: r for r in df.select("id", ways.outline(F.col("points"), (8.0, 49.0, 11.0, 52.0)).alias("w"), lon.alias("lon"), lat.alias("lat")).collect()}
    ring = "POLYGON ((9.0000000 50.0000000, 9.5000000 50.0000000, 9.5000000 50.5000000, 9.0000000 50.0000000))"
    assert [got[i].w for i in range(1, 8)] == [ring, ring, None, None, None, None, None]
    assert (got[3].lon, got[3].lat) == (9.25, 50.0) and (got[5].lon, got[5].lat) == (9.5, 50.0)
    assert got[6].lon is None and got[7].lat is None


@pytest.mark.parametrize(
    "tags, want",
    [
        ({"highway": "primary", "waterway": "river"}, "primary"),
        ({"highway": "footway", "railway": "rail", "usage": "main"}, "rail"),
        ({"railway": "rail", "usage": "siding"}, None),
        ({"waterway": "stream", "natural": "tree_row"}, "stream"),
        ({"natural": "tree_row", "landuse": "forest"}, "trees"),
        ({"landuse": "forest", "access": "private"}, "green:forest"),
        ({"landuse": "military", "amenity": "pharmacy"}, "closed:military"),
        ({"amenity": "pharmacy"}, "poi:family/pharmacy"),
        ({}, None),
    ],
)
def test_way_dispatch(spark, tags, want):
    from hexloom.operators import ways

    assert spark.createDataFrame([(tags,)], "tags map<string,string>").select(ways.route().alias("r")).first().r == want


def test_records_of_files(spark, tmp_path):
    from hexloom.operators import rejects

    good = 'a,"One\ntwo",12345,x,y,z,50.0,10.0'
    (tmp_path / "a.csv").write_bytes(f"{good}\r\nb,c\n\nd,e,f,g,h,i,99,10\n".encode())
    (tmp_path / "b.csv").write_bytes(b'q,"never closed\nx,y\n')
    (tmp_path / "c.csv").write_bytes(b"")
    raw = rejects.records_of_files(spark, f"file://{tmp_path}/*.csv").withColumn("line_id", F.concat(F.element_at(F.split("file_name", "/"), -1), F.lit(":"), "line_no"))
    got = {r.line_id: (r.reason, r.latitude, r.name) for r in rejects.read_records(raw).collect()}
    assert got == {"a.csv:1": (None, 50.0, "One\ntwo"), "a.csv:3": ("column_count", None, None), "a.csv:5": ("invalid_value", None, None), "b.csv:1": ("quoting", None, None)}


def test_tagged_elements(spark, tmp_path):
    from hexloom.sources import readers

    rows = [(1, "way", {"highway": "primary"}, [(9.0, 50.0)]), (2, "way", {}, [(9.0, 50.0)]), (3, "node", {"amenity": "bar"}, [(1.0, 50.0)]), (4, "node", {"amenity": "bar"}, [(9.0, 50.0)])]
    spark.createDataFrame([(i, k, t, [{"lon": a, "lat": b} for a, b in n]) for i, k, t, n in rows], readers.SCHEMAS["elements"]).write.parquet(f"{tmp_path}/e")
    ids = lambda **kw: sorted(r.osm_id for r in readers.elements(spark, f"{tmp_path}/e", **kw).collect())
    assert ids() == [1, 3, 4] and ids(keys=("amenity",)) == [3, 4] and ids(box=(8.0, 49.0, 10.0, 51.0)) == [1, 4]
    assert readers.exists(spark, f"file://{tmp_path}/e") and not readers.exists(spark, f"file://{tmp_path}/no")


@pytest.mark.parametrize("name", ["assemble_layers", "validate_layers"])
def test_layers_are_written_out_before_they_are_joined(spark, sf, name):
    """What joins the layers reads one row a cell, never the objects or the builds again."""
    from hexloom.plans import assembly

    read = {f.split("/")[-2] if "part-" in f else f.split("/")[-1] for f in getattr(assembly, name)(spark, sf).inputFiles()}
    assert read and not read & {"pois.parquet", "scores.parquet", "events.parquet", "orders.parquet", "schools_points.parquet"}
