"""Spatial joins, reachability and loops against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from hexloom.operators import geocode, iterate, reach, spatial, stats


@pytest.fixture(scope="module")
def pts(spark):
    rnd = random.Random(5)
    a = [(i, rnd.uniform(-5e3, 5e3), rnd.uniform(-5e3, 5e3)) for i in range(60)]
    b = [(i, rnd.uniform(-5e3, 5e3), rnd.uniform(-5e3, 5e3), rnd.choice("uv")) for i in range(50)]
    return a, b, spark.createDataFrame(a, "k long, x double, y double"), spark.createDataFrame(b, "id long, x double, y double, kind string")


def d(p, q):
    return math.hypot(p[1] - q[1], p[2] - q[2])


def test_radius_join(spark, pts):
    a, b, left, right = pts
    got = {(r.k, r.id) for r in spatial.radius_join(left, right, 900.0).collect()}
    assert got == {(p[0], q[0]) for p in a for q in b if d(p, q) <= 900}
    nulls = spark.createDataFrame([(1, None, None)], "k long, x double, y double")
    assert spatial.radius_join(nulls, right, 900.0).count() == 0


def test_nearest(pts):
    a, b, left, right = pts
    got = {r.k: (r.id, round(r.dist, 6)) for r in spatial.nearest(left, right, "k", ["kind"], 50.0, 100_000.0, "id").collect()}
    assert got == {p[0]: min((round(d(p, q), 6), q[0]) for q in b)[::-1] for p in a}
    kinds = {(r.k, r.kind): r.id for r in spatial.nearest(left, right, "k", [], 50.0, 100_000.0, "id", kind="kind", kinds=["u", "v"]).collect()}
    assert kinds == {(p[0], k): min((d(p, q), q[0]) for q in b if q[3] == k)[1] for p in a for k in "uv"}
    near = spatial.nearest(left, right, "k", [], 100.0, 400.0, "id").collect()
    assert {r.k for r in near} == {p[0] for p in a if min(d(p, q) for q in b) <= 400}


def test_nearest_around(spark, pts):
    a, b, left, right = pts
    offsets = [(300.0, 0.0), (-150.0, 260.0), (0.0, -280.0)]
    mean = lambda p, k: sum(min(math.hypot(p[1] + dx - q[1], p[2] + dy - q[2]) for q in b if q[3] == k) for dx, dy in offsets) / 3
    for start in (1.0, 700.0, 50_000.0):
        got = {(r.k, r.kind): round(r.dist, 6) for r in spatial.nearest_around(left, right, "k", offsets, start, "kind", ["u", "v", "none"]).collect()}
        assert got == {(p[0], k): round(mean(p, k), 6) for p in a for k in "uv"}
    assert spatial.nearest_around(left, right, "k", offsets, 1.0, "kind", ["none"]).count() == 0
    far = spark.createDataFrame([(1, 4e5, 4e5), (2, None, None)], "k long, x double, y double")
    assert [round(r.dist, 3) for r in spatial.nearest_around(far, right.where("id = 0"), "k", [(0.0, 0.0)], 100.0, "kind", ["u", "v"]).collect()] == [round(math.hypot(4e5 - b[0][1], 4e5 - b[0][2]), 3)]


def _shuffled(spark, run):
    """Bytes that ``run`` writes to shuffles."""
    store = spark.sparkContext._jsc.sc().statusStore()
    total = lambda: sum(e.totalShuffleWrite() for e in [store.executorList(False).apply(i) for i in range(store.executorList(False).size())])
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    before = total()
    run()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    return total() - before


def test_nearest_facility_reads_its_places_once(spark, sf):
    """The objects are brought to their last version in one shuffle, and no pair is shuffled."""
    from hexloom.plans import inputs, layers

    one = _shuffled(spark, lambda: inputs.objects(spark, sf).write.format("noop").mode("overwrite").save())
    assert _shuffled(spark, lambda: layers.nearest_facility(spark, sf).count()) < 3 * one + 8e6


def test_schools_family_shuffles_no_pairs(spark, sf):
    from hexloom.plans import assembly, inputs

    one = _shuffled(spark, lambda: inputs.objects(spark, sf).write.format("noop").mode("overwrite").save())
    assert _shuffled(spark, lambda: assembly.schools_family(spark, sf).count()) < 3 * one + 60e6


def test_anti_within(pts):
    a, b, left, right = pts
    assert {r.k for r in spatial.anti_within(left, right, "k", 600.0).collect()} == {p[0] for p in a if all(d(p, q) >= 600 for q in b)}


def test_polygons(spark, pts):
    a, _, left, _ = pts
    ring = [(-2000.0, -2000.0), (3000.0, -1500.0), (1000.0, 500.0), (2500.0, 3000.0), (-1500.0, 2500.0)]

    def inside(x, y):
        hit = False
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                hit = not hit
        return hit

    poly = spark.createDataFrame([("p", [dict(x=x, y=y) for x, y in ring])], "name string, ring array<struct<x:double,y:double>>")
    want = {p[0] for p in a if inside(p[1], p[2])}
    assert {r.k for r in spatial.polygon_join(left, poly, 1000.0).collect()} == want
    both = spatial.polygon_join(left, poly, 1000.0, how="left").collect()
    assert len(both) == len(a) and {r.k for r in both if r.name} == want
    lattice = spatial.area_samples(poly, 250.0).collect()
    assert len(lattice) == sum(inside(250.0 * i, 250.0 * j) for i in range(-9, 13) for j in range(-9, 13))
    sliver = spark.createDataFrame([("s", [dict(x=1.0, y=1.0), dict(x=2.0, y=1.0), dict(x=2.0, y=2.0)])], "name string, ring array<struct<x:double,y:double>>")
    assert [(r.x, r.y) for r in spatial.area_samples(sliver, 250.0).collect()] == [(1.0, 1.0)]


def test_densify(spark):
    line = spark.createDataFrame([("w", 0, 0.0, 0.0), ("w", 1, 150.0, 0.0), ("w", 2, 150.0, 170.0)], "way string, seq int, x double, y double")
    got = [(r.x, r.y) for r in spatial.densify(line, "way", "seq", 100.0).orderBy("n").collect()]
    assert got == [(0.0, 0.0), (100.0, 0.0), (150.0, 50.0), (150.0, 150.0)]


def test_weighted_percentile(spark):
    rows = [("a", 1.0, 1.0), ("a", 2.0, 1.0), ("a", 9.0, 5.0), ("b", 4.0, None), ("b", 6.0, None), ("c", None, 1.0)]
    df = spark.createDataFrame(rows, "g string, v double, w double").withColumn("id", F.monotonically_increasing_id())
    assert {r.g: r.v for r in stats.weighted_percentile(df, ["g"], "v", "w", 0.5, "id").collect()} == {"a": 9.0, "b": 4.0}


def test_aggregates(spark):
    df = spark.createDataFrame([(0.5, 60.0), (0.5, 60.0), (None, None)], "x double, db double")
    r = df.agg(stats.noisy_or(F.col("x")).alias("o"), stats.energy_sum(F.col("db")).alias("s"), stats.energy_mean(F.col("db"), 4).alias("m")).first()
    assert r.o == pytest.approx(0.75) and r.s == pytest.approx(63.0103, abs=1e-4) and r.m == pytest.approx(56.9897, abs=1e-4)
    assert df.agg(stats.noisy_or(F.lit(1.0)).alias("o")).first().o == 1
    flat = spark.range(1).select(stats.entropy(F.array(*[F.lit(2.0)] * 36), 36).alias("e"), stats.entropy(F.array(F.lit(1.0), F.lit(0.0)), 36).alias("z")).first()
    assert flat.e == pytest.approx(1) and flat.z == pytest.approx(0)


def test_door_to_door(spark):
    arrivals = spark.createDataFrame([(1, s, i, float(t)) for s, i, t in [("a", 0, 10), ("a", 1, 12), ("b", 0, 8), ("b", 2, 30)]], "center long, stop string, iter int, minutes double")
    egress = spark.createDataFrame([("a", 7, "walk", 2.0), ("b", 7, "walk", 5.0)], "stop string, cell long, mode string, egress double")
    got = reach.door_to_door(arrivals, egress, 3).collect()
    assert [(r.cell, r.minutes) for r in got] == [(7, 14.0)]
    assert reach.door_to_door(arrivals, egress, 7).count() == 0  # 4 of 7 would be needed
    assert reach.percentile_index(5) == 2


def test_door_to_door_wide(spark):
    legs = spark.createDataFrame([(1, 7, "walk", 12.0, 14.0, None), (1, 7, "walk", 13.0, None, 35.0), (2, 7, "walk", 130.0, 5.0, None)], "center long, cell long, mode string, a double, b double, c double")
    got = reach.door_to_door_wide(legs, [F.col("a"), F.col("b"), F.col("c")]).collect()
    assert [(r.center, r.cell, r.minutes) for r in got] == [(1, 7, 14.0)]  # 130 is beyond the horizon


def test_door_to_door_copies_no_leg(spark, sf):
    """Iterations are columns of a leg, not rows."""
    from hexloom.plans import scoring

    plan = scoring.door_to_door(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence(0, 4" not in plan and "[0,1,2,3,4]" not in plan.replace(" ", "") and "collect_list" not in plan


def test_mbo_bounds(spark):
    rnd = random.Random(2)
    r = spark.createDataFrame([(c, x, "car", rnd.uniform(0, 119)) for c in range(6) for x in range(20)], "center long, cell long, mode string, minutes double")
    opp = spark.createDataFrame([(c, rnd.random()) for c in range(6)], "center long, opp double")
    native = spark.createDataFrame([(3, 0.9), (4, 0.1)], "cell long, native double")
    got = {x.cell: x for x in reach.mbo(r, opp, native, ["car"]).collect()}
    assert all(x.b <= x.o and 0 <= x.m <= 119 for x in got.values())
    assert got[3].m == 0 and got[3].b >= round(254 * 0.9)


def test_nms_equals_greedy(spark):
    rnd = random.Random(9)
    pts_ = [(i, rnd.uniform(0, 60e3), rnd.uniform(0, 60e3), rnd.uniform(100, 5000)) for i in range(150)]
    df = spark.createDataFrame(pts_, "k long, x double, y double, pop double")
    strength = {p[0]: sum(q[3] for q in pts_ if d(p, q) <= 3000) for p in pts_}
    left, want = {p[0]: p for p in pts_ if strength[p[0]] >= 3500}, set()
    while left:
        seed = min(left.values(), key=lambda p: (-strength[p[0]], p[0]))
        snap = min((q for q in pts_ if d(seed, q) <= 3000), key=lambda q: (-q[3], q[0]))
        want.add(snap[0])
        left = {k: p for k, p in left.items() if d(p, snap) > 9000 and k != seed[0]}
    got = {r.k for r in iterate.non_max_suppression(df, "k", 3000.0, 9000.0, 3500.0).collect()}
    assert got == want


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101)]
    nodes = spark.createDataFrame([(i,) for i in [*range(41), 100, 101, 200]], "node long")
    got = {r.node: r.component for r in iterate.components(spark.createDataFrame(chain, "a long, b long"), nodes).collect()}
    assert {got[i] for i in range(41)} == {0} and got[101] == 100 and got[200] == 200


def test_geocode_tiers(spark):
    P = "street_key string, number int, plz string, city_key string, lat double, lon double"
    points = spark.createDataFrame([("a", 1, "1", "x", 1.0, 1.0), ("a", 1, "2", "yz", 2.0, 2.0), ("b", 2, "1", "x", 5.0, 5.0), ("c", 3, "1", "u", 1.0, 1.0), ("c", 3, "2", "v", 1.004, 1.004)], P)
    targets = [(1, "a", 1, "2", "q"), (2, "a", 1, None, "x"), (3, "a", 1, None, "yzq"), (4, "b", 2, "9", "q"), (5, "c", 3, None, "q"), (6, "a", 1, None, "q"), (7, "zz", 1, None, "x"), (8, None, 1, "1", "x")]
    got = {r.id: (r.match, r.lat) for r in geocode.geocode(spark.createDataFrame(targets, "id int, street_key string, number int, plz string, city_key string"), points, "id").collect()}
    assert got == {1: ("plz_match", 2.0), 2: ("city_match", 1.0), 3: ("city_fuzzy", 2.0), 4: ("unique", 5.0), 5: ("clustered", pytest.approx(1.002)), 6: ("ambig", None), 7: ("miss", None), 8: ("no_addr", None)}
    row = spark.createDataFrame([("Königsberger Straße 12a", "91-93")], "a string, h string").select(geocode.norm_street(geocode.street_and_number(F.col("a"))[0]), geocode.house_number(F.col("h"))).first()
    assert tuple(row) == ("koenigsbergerstr", 91)
