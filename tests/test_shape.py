"""Pinned values of the shaping functions, and properties of theirs."""

import itertools
import math

import pytest
from pyspark.sql import functions as F

from hexloom.functions import composites as comp, geo, shape


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("t, floor, target, want", [(15, 15, 80, 1), (80, 15, 80, 0), (10, 15, 80, 1), (None, 15, 80, 0), (120, 15, 80, 0), (150, 15, 80, 0), (47.5, 15, 80, 0.5**1.5)])
def test_commute_sub(spark, t, floor, target, want):
    got = one(spark, shape.commute_sub(F.lit(t).cast("double"), F.lit(float(floor)), F.lit(float(target))))
    assert got == pytest.approx(want)


def test_commute_total(spark):
    assert one(spark, shape.commute_total([])) == 0
    assert one(spark, shape.commute_total([F.lit(0.3)])) == pytest.approx(0.3)
    assert one(spark, shape.commute_total([F.lit(0.6), F.lit(0.6)])) == pytest.approx(1 - 0.4 * (1 - 0.24))
    values = [0.0, 0.2, 0.5, 0.9, 1.0]
    cols = [shape.commute_total([F.lit(a), F.lit(b)]).alias(f"c{i}") for i, (a, b) in enumerate(itertools.product(values, values))]
    row = spark.range(1).select(*cols).first()
    grid = {p: row[i] for i, p in enumerate(itertools.product(values, values))}
    for (a, b), v in grid.items():
        assert v >= max(a, b) - 1e-12
        assert all(grid[(a2, b)] >= v - 1e-12 for a2 in values if a2 >= a)


@pytest.mark.parametrize("comfort, floor, target, want", [(20, 3, 80, 20), (20, 22, 80, 22), (20, 100, 50, 49), (15, math.inf, 80, 15)])
def test_comfort_floor(spark, comfort, floor, target, want):
    assert one(spark, shape.comfort_floor(F.lit(float(comfort)), F.lit(float(floor)), F.lit(float(target)))) == want


def test_budgets():
    assert [shape.budget_for(*x) for x in ((0, 60), (22, 60), (11, 60), (0, 10), (200, 60))] == [60, 80, 70, 25, 180]
    assert [shape.slack_for(*x) for x in ((22, 80), (22, 20), (0, 500))] == [58, 10, 150]
    for floor, slack in itertools.product(range(0, 90, 7), range(15, 90, 5)):
        budget = shape.budget_for(floor, slack)
        assert shape.budget_for(floor, shape.slack_for(floor, budget)) == budget


@pytest.mark.parametrize("field, score, t, budget, want", [(True, 0.46, None, 60, False), (True, 0.07, None, 60, False), (True, 0.02, None, 60, True), (True, 0.0, None, 60, True), (False, None, 80, 60, True), (False, None, 50, 60, False)])
def test_over_budget(spark, field, score, t, budget, want):
    got = one(spark, shape.over_budget(F.lit(field), F.lit(score).cast("double"), F.lit(t).cast("double"), F.lit(float(budget))))
    assert got is want


@pytest.mark.parametrize("t, ref, modes, can, minutes, mode", [(3.6, "foot", ["bike"], [], 3.6, "foot"), (12.0, "foot", ["bike"], [], 6.1, "bike"), (20.0, "bike", ["bike"], [], 22.5, "bike"), (20.0, "bike", ["car"], [], 16.0, "car"), (9.0, "foot", ["bike"], ["bike"], 9.0, "foot")])
def test_best_mode(spark, t, ref, modes, can, minutes, mode):
    b = one(spark, shape.best_mode(F.lit(t), ref, modes, frozenset(can)))
    assert (b["minutes"], b["mode"]) == (pytest.approx(minutes), mode)


def test_proximity(spark):
    assert [one(spark, shape.proximity(F.lit(float(t)), F.lit(15.0), g)) for t, g in ((3, 1), (15, 1), (12, 1), (12, 2))] == pytest.approx([1, 0, 0.25, 0.0625])


def test_nulls_and_curves(spark):
    assert one(spark, shape.clip01(F.lit(None).cast("double"))) is None
    assert one(spark, shape.decay(F.lit(None).cast("double"))) == 0
    assert one(spark, shape.smoothstep(F.lit(37_500.0), 20_000, 55_000)) == pytest.approx(0.5)
    assert one(spark, shape.cityness(F.lit(25_000.0))) == 0.5
    assert one(spark, shape.point_reach(F.lit(0.0), F.lit(1.0))) == pytest.approx(0.6)
    assert one(spark, shape.weighted_geometric([(F.lit(0.25), 1), (F.lit(1.0), 1)])) == pytest.approx(0.5)
    assert one(spark, shape.budget_opportunity(F.lit(60.0), F.lit(30.0), F.lit(0.2), F.lit(0.8))) == pytest.approx(0.2 + 30 / 90 * 0.6)
    assert one(spark, comp.climate(F.lit(1900.0), F.lit(600.0), F.lit(30.0))) == pytest.approx(1)
    assert one(spark, comp.vacancy(F.lit(18.0))) == 0
    assert one(spark, comp.care_crowding(F.lit(None).cast("double"), F.lit(10.0))) == 1


def test_projection_round_trip(spark):
    pts = spark.createDataFrame([(48.137, 11.575), (54.9, 8.3), (47.3, 15.0), (51.0, 9.0)], "lat double, lon double")
    xy = geo.with_utm32(pts, "lat", "lon")
    back = xy.select("lat", "lon", "x", "y", geo.utm32_inverse(F.col("x"), F.col("y"))[0].alias("a"), geo.utm32_inverse(F.col("x"), F.col("y"))[1].alias("b")).collect()
    for r in back:
        assert r.a == pytest.approx(r.lat, abs=1e-8) and r.b == pytest.approx(r.lon, abs=1e-8)
    assert back[0].x == pytest.approx(691_607, abs=60) and back[0].y == pytest.approx(5_334_760, abs=60)


def test_grid_cells_are_ours(spark, sf):
    grid = spark.read.parquet(f"{sf}/grid.parquet").limit(500)
    got = geo.with_cell(grid.withColumnRenamed("cell", "want"), "lat", "lon", 4000.0)
    assert got.where("cell <> want").count() == 0
    q, r = geo.cell_qr(F.col("cell"))
    assert grid.where((q != F.col("q")) | (r != F.col("r"))).count() == 0
