"""Missing values filled from rows of the same group by chained equations.

Values are taken as deviations from their group's mean. Each incomplete field is then
regressed on the other fields and predictors over the rows where it is present, and the
missing deviations are set to the prediction plus a residual drawn at the group's own
spread; this goes round all fields until they stand still. All of it is linear in
what is observed and drawn, so one pass suffices: Spark adds up the cross products of
observed values and draws for each pattern of missing fields (a handful of numbers reach
the driver, whatever the table's size), the driver goes through the rounds on these sums
alone, and a second pass writes the values that the last round gives. Categories are drawn
from a naive Bayes posterior over the group's shares and the numeric predictors, from
counts and sums that Spark adds up likewise.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialise


@dataclass(frozen=True)
class Numeric:
    """A field to fill; values outside ``low`` to ``high`` count as missing."""

    name: str
    low: float
    high: float
    open_low: bool = False
    open_high: bool = False

    def present(self) -> Column:
        c = F.col(self.name).try_cast("double")
        low = c > self.low if self.open_low else c >= self.low
        high = c < self.high if self.open_high else c <= self.high
        return F.when(~F.isnan(c) & low & high, c)

    def clip(self, c: Column) -> Column:
        span = (self.high - self.low) * 1e-6
        low = self.low + (span if self.open_low else 0)
        high = self.high - (span if self.open_high else 0)
        return F.greatest(F.lit(low), F.least(F.lit(high), c))


def _normal_draw(key: Column, seed: int) -> Column:
    """A standard normal value fixed by the row's key and the seed."""
    unit = lambda k: (F.pmod(F.xxhash64(key, F.lit(seed), F.lit(k)), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)
    return F.sqrt(-2 * F.log(unit(1))) * F.cos(2 * math.pi * unit(2))


MOST_FIELDS = 5


class _Chain:
    """The rounds of chained equations on moments.

    A row's base vector is (predictors, observed deviations or 0, draws). A pattern has one
    digit a field: 0 present, 1 to be filled, 2 not to be filled (taken as 0). ``maps`` has
    for each pattern the rows' present values as linear forms of the base vector.
    """

    def __init__(self, moments: dict[tuple[int, ...], tuple[int, np.ndarray]], n_x: int, n_y: int, residual: bool):
        self.moments, self.n_x, self.n_y, self.residual = moments, n_x, n_y, residual
        self.maps = {p: np.vstack([np.eye(n_x + n_y, n_x + 2 * n_y)]) for p in moments}
        self.rounds = 0

    def run(self, tolerance: float = 1e-9, most: int = 1000) -> None:
        """Rounds over all fields until no row's values can change any more."""
        for self.rounds in range(1, most + 1):  # noqa: B007
            before = {p: form.copy() for p, form in self.maps.items()}
            for i in range(self.n_y):
                self._step(i)
            moved = max((np.abs(form - before[p]).max(initial=0.0) for p, form in self.maps.items()), default=0.0)
            largest = max((np.abs(form).max(initial=0.0) for form in self.maps.values()), default=0.0)
            if moved <= tolerance * max(1.0, largest):
                return
        raise RuntimeError(f"values still move after {most} rounds")

    def _step(self, i: int) -> None:
        """Regress field ``i`` and set its missing values."""
        at = self.n_x + i
        rest = [j for j in range(self.n_x + self.n_y) if j != at]
        total = np.zeros((self.n_x + self.n_y,) * 2)
        for p, (_, m) in self.moments.items():
            if p[i] == 0:
                total += self.maps[p] @ m @ self.maps[p].T
        beta, left = _regress(total, at, rest)
        for p, form in self.maps.items():
            if p[i] == 1:
                form[at] = beta @ form[rest]
                form[at, self.n_x + self.n_y + i] += math.sqrt(left) if self.residual else 0.0


def _regress(moments: np.ndarray, at: int, rest: list[int]) -> tuple[np.ndarray, float]:
    """Least squares without intercept: coefficients and the share left unexplained."""
    yy = moments[at, at]
    if yy <= 0:
        return np.zeros(len(rest)), 1.0
    if not rest:
        return np.zeros(0), 1.0
    a, b = moments[np.ix_(rest, rest)], moments[rest, at]
    scale = np.sqrt(np.maximum(np.diag(a), 1e-300))
    beta = np.linalg.solve(a / np.outer(scale, scale) + 1e-6 * np.eye(len(rest)), b / scale) / scale
    beta[np.diag(a) <= 0] = 0.0
    left = (yy - 2 * beta @ b + beta @ a @ beta) / yy
    return beta, float(min(1.0, max(0.0, left)))


def impute_numeric(df: DataFrame, key: str, groups: list[str | Column], fields: list[Numeric], predictors: list[str] = (), residual: bool = True) -> DataFrame:
    """``key`` with, for each field, ``<name>`` (filled where possible), and ``<name>_filled``.

    A value is filled when it is missing (NULL, NaN, out of range), every group column is
    known, and some row of the group has the field; otherwise it stays NULL and unmarked.
    The mark is set where a finite value came out of the equations. A group with one
    present value gives that value. Predictors that are missing count as their group's mean.
    Without ``residual`` the prediction alone is filled in. Rows with one key are filled
    alike; empty tables give none. Extra columns are ignored. Groups of any size are only
    ever aggregated, and joined back through a join that adaptive execution may split. More
    than ``MOST_FIELDS`` fields raise ``ValueError``, as there are three patterns a field.
    """
    if len(fields) > MOST_FIELDS:
        raise ValueError(f"more than {MOST_FIELDS} fields at once")
    gcols = [(F.col(g) if isinstance(g, str) else g).alias(f"g{i}") for i, g in enumerate(groups)]
    gs = [f"g{i}" for i in range(len(gcols))]
    n_x, n_y = len(predictors), len(fields)
    base = df.select(
        F.col(key).alias("k"),
        *gcols,
        *[f.present().alias(f"y{i}") for i, f in enumerate(fields)],
        *[F.when(~F.isnan(F.col(p).try_cast("double")), F.col(p).try_cast("double")).alias(f"x{i}") for i, p in enumerate(predictors)],
    )
    known = F.lit(True)
    for g in gs:
        known = known & F.col(g).isNotNull()
    means = [F.avg(f"y{i}").alias(f"m{i}") for i in range(n_y)] + [F.stddev_samp(f"y{i}").alias(f"d{i}") for i in range(n_y)] + [F.avg(f"x{i}").alias(f"mx{i}") for i in range(n_x)]
    stats = base.where(known).groupBy(*gs).agg(*means)
    zero = F.lit(0.0)
    pattern = F.concat(*[F.when(F.col(f"y{i}").isNotNull(), F.lit("0")).when(F.col(f"m{i}").isNotNull(), F.lit("1")).otherwise(F.lit("2")) for i in range(n_y)])
    flat = materialise(
        base.join(stats, gs, "left").select(
            "k",
            pattern.alias("pattern"),
            *[f"y{i}" for i in range(n_y)],
            *[f"m{i}" for i in range(n_y)],
            *[F.coalesce(F.col(f"x{i}") - F.col(f"mx{i}"), zero).alias(f"v{i}") for i in range(n_x)],
            *[F.coalesce(F.col(f"y{i}") - F.col(f"m{i}"), zero).alias(f"v{n_x + i}") for i in range(n_y)],
            *[F.coalesce(F.when(F.col(f"y{i}").isNull(), F.col(f"d{i}")), zero).alias(f"d{i}") for i in range(n_y)],
        )
    )
    draws = [F.when(F.col(f"d{i}") != 0, F.col(f"d{i}") * _normal_draw(F.col("k"), i)).otherwise(zero).alias(f"v{n_x + n_y + i}") for i in range(n_y)]
    flat = flat.select("*", *draws)
    size = n_x + 2 * n_y
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    # at most three patterns a field reach the driver
    got = flat.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col(f"v{i}") * F.col(f"v{j}")).alias(f"s{i}_{j}") for i, j in pairs]).collect()
    moments = {}
    for r in got:
        m = np.zeros((size, size))
        for i, j in pairs:
            m[i, j] = m[j, i] = r[f"s{i}_{j}"] or 0.0
        moments[tuple(map(int, r["pattern"]))] = (r["n"], m)
    chain = _Chain(moments, n_x, n_y, residual)
    chain.run()
    out = [F.col("k").alias(key)]
    for i, f in enumerate(fields):
        value = F.lit(None).cast("double")
        for p, form in sorted(chain.maps.items()):
            if p[i] == 1:
                terms = [F.lit(float(c)) * F.col(f"v{j}") for j, c in enumerate(form[n_x + i]) if c]
                total = zero
                for t in terms:
                    total = total + t
                value = F.when(F.col("pattern") == "".join(map(str, p)), F.col(f"m{i}") + total).otherwise(value)
        done = F.coalesce(F.abs(value) < F.lit(float("inf")), F.lit(False))
        out += [F.when(F.col(f"y{i}").isNotNull(), F.col(f"y{i}")).when(done, f.clip(value)).alias(f.name), done.alias(f"{f.name}_filled")]
    return flat.select(*out)


def impute_category(df: DataFrame, key: str, group: str | Column, field: Column, predictors: list[str] = (), max_classes: int = 64) -> DataFrame:
    """``key``, ``value`` and ``filled``: a missing category drawn from the group's posterior.

    The posterior is the group's share of each class, smoothed by one pseudo-row spread
    as the class's share of all rows, times Gaussian densities of the predictors' values
    in the class. Missing predictors are left out of the product. Groups without a
    present value, or a NULL group, stay NULL and unmarked. More than ``max_classes``
    classes raise ``ValueError``, as the model's size is bounded by their number.
    """
    g = F.col(group) if isinstance(group, str) else group
    xs = [F.when(~F.isnan(F.col(p).try_cast("double")), F.col(p).try_cast("double")).alias(f"x{i}") for i, p in enumerate(predictors)]
    base = df.select(F.col(key).alias("k"), g.alias("g"), field.alias("c"), *xs)
    model = base.where(F.col("c").isNotNull()).groupBy("c").agg(F.count(F.lit(1)).alias("n"), *[F.avg(f"x{i}").alias(f"m{i}") for i in range(len(predictors))], *[F.stddev_pop(f"x{i}").alias(f"d{i}") for i in range(len(predictors))])
    classes = model.orderBy("c").limit(max_classes + 1).collect()
    if len(classes) > max_classes:
        raise ValueError(f"more than {max_classes} classes")
    if not classes:
        return base.select(F.col("k").alias(key), F.col("c").alias("value"), F.lit(False).alias("filled"))
    total = sum(r["n"] for r in classes)
    shares = base.where(F.col("g").isNotNull()).groupBy("g").agg(F.count("c").alias("gn"), *[F.count_if(F.col("c") == r["c"]).alias(f"n{i}") for i, r in enumerate(classes)])
    scores = []
    for i, r in enumerate(classes):
        s = F.log((F.col(f"n{i}") + F.lit(r["n"] / total)) / (F.col("gn") + 1))
        for j in range(len(predictors)):
            if r[f"d{j}"]:
                z = (F.col(f"x{j}") - F.lit(r[f"m{j}"])) / F.lit(r[f"d{j}"])
                s = s + F.coalesce(-z * z / 2 - F.lit(math.log(r[f"d{j}"])), F.lit(0.0))
        unit = (F.pmod(F.xxhash64("k", F.lit(i)), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)
        scores.append(F.struct((s - F.log(-F.log(unit))).alias("s"), F.lit(r["c"]).alias("c")))
    best = F.greatest(*scores)["c"] if len(scores) > 1 else scores[0]["c"]
    fill = F.col("c").isNull() & (F.coalesce(F.col("gn"), F.lit(0)) > 0)
    return base.join(shares, "g", "left").select(F.col("k").alias(key), F.when(fill, best).otherwise(F.col("c")).alias("value"), fill.alias("filled"))
