"""Relative-error sketches: bounds, merging and groups."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from hexloom.llm import quantiles as q, queries

PS = [0.01, 0.1, 0.5, 0.9, 0.99, 0.999]


def worst(sketch, values, high=True):
    v = np.sort(values)
    out = 0.0
    for p, x in zip(PS, sketch.quantiles(PS)):
        lo, hi = np.searchsorted(v, x, "left") / len(v), np.searchsorted(v, x, "right") / len(v)
        out = max(out, max(0.0, lo - p, p - hi) / ((1 - p) if high else p))
    return out


@pytest.mark.parametrize("kind", ["lognormal", "sorted", "reversed", "ties"])
@pytest.mark.parametrize("high", [True, False])
def test_error_bound(kind, high):
    x = np.random.default_rng(0).lognormal(size=200_000)
    x = {"lognormal": x, "sorted": np.sort(x), "reversed": np.sort(x)[::-1], "ties": np.floor(x)}[kind]
    s = q.RelativeSketch(high=high)
    for part in np.array_split(x, 50):
        s.update(part)
    assert s.n == len(x) and worst(s, x, high) < 0.08
    assert sum(level.size << h for h, level in enumerate(s.levels)) == s.n
    assert sum(level.size for level in s.levels) < 8000


def test_merged_days_keep_the_bound():
    rng = np.random.default_rng(1)
    days = [rng.pareto(1.5, size=rng.integers(1, 9000)) for _ in range(60)]
    total = q.RelativeSketch()
    for d in days:
        s = q.RelativeSketch()
        s.update(d)
        total.merge(q.RelativeSketch.from_bytes(s.to_bytes()))
    assert total.n == sum(map(len, days)) and worst(total, np.concatenate(days)) < 0.08
    with pytest.raises(ValueError):
        total.merge(q.RelativeSketch(k=16))


def test_small_ones_are_exact():
    s = q.RelativeSketch()
    assert s.quantiles([0.5]) == [None]
    s.update(np.array([3.0, 1.0, 2.0, 2.0]))
    assert s.quantiles([0.0, 0.25, 0.5, 0.75, 1.0]) == [1.0, 1.0, 2.0, 2.0, 3.0]
    again = q.RelativeSketch.from_bytes(s.to_bytes())
    assert again.to_bytes() == s.to_bytes()


def test_groups(spark):
    nan = float("nan")
    rows = [("a", 1, 1.0, nan), ("a", 2, 3.0, None), ("a", 1, 2.0, None), (None, 1, 5.0, 7.0), ("b", 1, None, nan)] + [("hot", i % 5, float(i), None) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, day int, x double, y double").withColumns({"fld": F.lit(1), "sketch": F.lit(2)}).repartition(4)
    daily = q.sketches(df, ["g", "day"], ["x", "y"], held=3)
    got = {(r.g, r.fld, r.p): (r.n, r.value) for r in q.percentiles(q.combined(daily, ["g"]), ["g"], [0.5, 0.99]).collect()}
    assert got[("a", "x", 0.5)] == (3, 2.0) and got[(None, "y", 0.5)] == (1, 7.0) and not any(k[0] == "b" for k in got)
    n, v = got[("hot", "x", 0.99)]
    assert n == 3000 and abs(v - 2970) < 3
    assert q.percentiles(q.sketches(df.limit(0), ["g"], ["x"]), ["g"], [0.5]).count() == 0


def test_percentiles_keep_both_tails(spark, tmp_path):
    n, kreise = 60_000, 6
    rng = np.random.default_rng(5)
    v = np.concatenate([rng.permutation(np.linspace(1, 99, n)) for _ in range(kreise)])
    rows = spark.range(n * kreise).toPandas().assign(kreis=np.repeat(list("abcdef"), n), run_no=np.arange(n * kreise) % 4, rent_2022=v, population=v, vacancy_pct=v)
    rows.drop(columns="id").to_parquet(tmp_path / "scores.parquet")
    got = queries.p7_percentiles(spark, str(tmp_path)).collect()
    assert len(got) == kreise * len(queries.PERCENTILES) * len(queries.NUMBERS)
    for r in got:
        assert r.n == n and r.rank_bound == pytest.approx(0.08 * min(r.p, 1 - r.p))
        assert abs((r.value - 1) / 98 - r.p) <= r.rank_bound


def test_no_bound_while_all_is_kept():
    s = q.RelativeSketch()
    s.update(np.arange(191.0))
    assert q.rank_bound(s.n, 0.5, s.k, s.high) == 0.0 and s.quantiles([0.5]) == [95.0]
    assert q.rank_bound(10**6, 0.99, 32, True) == pytest.approx(0.0008)
    assert q.rank_bound(10**6, 0.01, 32, False) == pytest.approx(0.0008)
