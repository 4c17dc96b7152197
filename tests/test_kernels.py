"""Ring kernels against plain loops over small grids."""

import math
import random

import pytest
from pyspark.sql import functions as F

from hexloom.operators import kernels as kn


def cell(q, r):
    return (q + (1 << 20)) * (1 << 21) + r + (1 << 20)


def ring(a, b):
    dq, dr = a[0] - b[0], a[1] - b[1]
    return (abs(dq) + abs(dr) + abs(dq + dr)) // 2


@pytest.fixture(scope="module")
def world(spark):
    rnd = random.Random(3)
    at = {(q, r): (rnd.choice([None, 0.0, rnd.random()]) if rnd.random() < 0.6 else rnd.random()) for q in range(-3, 4) for r in range(-3, 4)}
    src = spark.createDataFrame([(cell(*k), v) for k, v in at.items()], "cell long, v double")
    return at, src, src.select("cell")


def test_offsets(spark):
    one = spark.createDataFrame([(cell(5, 7),)], "cell long")
    for k in (0, 1, 4):
        got = kn.disk(one, k).select("cell", "ring").collect()
        assert len(got) == len({g.cell for g in got}) == 3 * k * (k + 1) + 1
        assert max(g.ring for g in got) == k


def test_weighted_sum_and_max(world):
    at, src, grid = world
    s = {r.cell: r.v for r in kn.disk_weighted_sum(src, grid, ["v"], 2, 9.0).collect()}
    m = {r.cell: r.v for r in kn.disk_weighted_max(src, grid, ["v"], 2, 9.0).collect()}
    for k in at:
        near = [(ring(k, o), v) for o, v in at.items() if ring(k, o) <= 2 and v and v > 0]
        assert s[cell(*k)] == pytest.approx(sum(v * math.exp(-math.hypot(d * kn.STEP_KM, kn.SPREAD_KM) / 9.0) for d, v in near))
        assert m[cell(*k)] == pytest.approx(max((v * math.exp(-d * kn.STEP_KM / 9.0) for d, v in near), default=0.0))


def test_median_mean_gauss(world):
    at, src, grid = world
    med = {r.cell: r.v for r in kn.disk_median(src, "v", 1, 4).collect()}
    gauss = {r.cell: r.v for r in kn.disk_gaussian_mean(src, ["v"], 2, 7.0).collect()}
    for k in at:
        near = sorted(v for o, v in at.items() if ring(k, o) <= 1 and v is not None)
        want = None if len(near) < 4 else (near[(len(near) - 1) // 2] + near[len(near) // 2]) / 2
        assert med[cell(*k)] == (None if want is None else pytest.approx(want))
        w = [(math.exp(-((ring(k, o) * kn.STEP_KM) ** 2 + kn.SPREAD_KM**2) / 98.0), v) for o, v in at.items() if ring(k, o) <= 2 and v is not None]
        assert gauss[cell(*k)] == pytest.approx(sum(a * v for a, v in w) / sum(a for a, _ in w))


def test_constant_stays_constant(world):
    _, src, grid = world
    flat = src.withColumn("v", F.lit(0.7))
    assert {round(r.v, 9) for r in kn.disk_gaussian_mean(flat, ["v"], 3, 5.0).collect()} == {0.7}
    assert {round(r.v, 9) for r in kn.disk_mean(flat, grid, "v", 1).collect()} == {0.7}


def test_shrink(world):
    at, src, _ = world
    joined = src.withColumns({"pop": F.lit(100.0), "prior": F.when(F.col("cell") % 2 == 0, F.lit(0.5))})
    got = {r.cell: r.v for r in kn.kernel_shrink(joined, "v", "pop", "prior", 2, 4.0, 300.0).collect()}
    for k in at:
        w = [(100 * math.exp(-((ring(k, o) * kn.STEP_KM) ** 2) / 32), v) for o, v in at.items() if ring(k, o) <= 2 and v is not None]
        assert got[cell(*k)] == pytest.approx((sum(a * v for a, v in w) + 150) / (sum(a for a, _ in w) + 300))


def test_distinct_members_and_dilate(spark):
    src = spark.createDataFrame([(cell(0, 0), "a", 2.0), (cell(0, 0), "a", 2.0), (cell(0, 1), "a", 2.0), (cell(2, 0), "b", 1.0)], "cell long, m string, w double")
    got = {r.cell: r.w for r in kn.disk_distinct_weight(src, "m", "w", 1).collect()}
    assert got[cell(0, 0)] == 2 and got[cell(1, 0)] == 3
    assert kn.dilate(src.where("m = 'b'").select("cell"), 1).count() == 7


def test_children_and_rim(spark):
    one = spark.createDataFrame([(cell(3, -2),)], "cell long")
    assert kn.children(one).count() == 7
    x, y = 4000 * math.sqrt(3) * (3 - 1), -12000
    for r in kn.rim_points(one).collect():
        assert math.hypot(r.x - x, r.y - y) == pytest.approx(0.338 / 0.93 * math.sqrt(3) * 4000)


def test_repair(spark):
    ring1 = [(1, 0), (0, 1), (-1, 1), (-1, 0), (0, -1), (1, -1)]
    rows = [(cell(0, 0), None, True)] + [(cell(*c), v, False) for c, v in zip(ring1[:2], (0.4, 0.8))] + [(cell(10, 10), 0.05, True)] + [(cell(10 + q, 10 + r), 0.9, False) for q, r in ring1[:4]] + [(cell(30, 30), None, True)]
    src = spark.createDataFrame(rows, "cell long, v double, may boolean")
    got = {r.cell: r.v for r in kn.repair(src, "v", F.col("may")).collect()}
    assert got[cell(0, 0)] == pytest.approx(0.6) and got[cell(10, 10)] == pytest.approx(0.9) and got[cell(30, 30)] is None
