"""Aggregations over rings of neighbouring hexagons.

Sources are brought to one row a cell first, then every source row is copied to the cells
of its disk (3k(k+1)+1 of them, generated inside the row, so no join) and the copies are
aggregated by cell in one shuffle. Sources may lie off the output grid.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import geo
from ..session import materialise

EDGE_M = 4000.0
#: Distances scale with the lattice: the reference step is 0.93 km, and two points within
#: one cell are on average 0.338 * sqrt(2) km apart at that step.
STEP_KM = geo.SQRT3 * EDGE_M / 1000
SCALE = STEP_KM / 0.93
SPREAD_KM = 0.338 * math.sqrt(2) * SCALE


def disk(src: DataFrame, k: int, cell: str = "cell") -> DataFrame:
    """Each row once for every cell within ``k`` rings: ``cell`` is the neighbour, ``ring``
    its distance, ``src_cell`` the row's own cell."""
    dq = F.explode(F.sequence(F.lit(-k), F.lit(k)))
    d = F.col("_dq")
    dr = F.explode(F.sequence(F.greatest(F.lit(-k), -d - k), F.least(F.lit(k), -d + k)))
    out = src.withColumnRenamed(cell, "src_cell").withColumn("_dq", dq).withColumn("_dr", dr)
    ring = ((F.abs("_dq") + F.abs("_dr") + F.abs(F.col("_dq") + F.col("_dr"))) / 2).cast("int")
    moved = F.col("src_cell") + F.col("_dq").cast("long") * F.lit(1 << 21) + F.col("_dr").cast("long")
    return out.withColumns({cell: moved, "ring": ring}).drop("_dq", "_dr")


def ring_weight(scale_km: float, spread: bool = True) -> Column:
    """exp(-d / scale) by ring, with the spread inside cells folded in."""
    d = F.col("ring") * F.lit(STEP_KM)
    if spread:
        d = F.sqrt(d * d + F.lit(SPREAD_KM**2))
    return F.exp(-d / F.lit(scale_km))


def gauss_weight(sigma_km: float, spread: bool = True) -> Column:
    d2 = F.pow(F.col("ring") * F.lit(STEP_KM), 2) + F.lit(SPREAD_KM**2 if spread else 0.0)
    return F.exp(-d2 / F.lit(2 * sigma_km**2))


def on_grid(grid: DataFrame, values: DataFrame, fill: float | None = 0.0) -> DataFrame:
    """All cells of the grid with the values, missing ones filled."""
    out = grid.select("cell").join(values, "cell", "left")
    return out if fill is None else out.na.fill(fill)


def disk_weighted_sum(src: DataFrame, grid: DataFrame, columns: list[str], k: int, scale_km: float) -> DataFrame:
    """Sum of positive values times the ring's weight; 0 where nothing is near."""
    w = ring_weight(scale_km)
    aggs = [F.sum(F.when(F.col(c) > 0, F.col(c) * w)).alias(c) for c in columns]
    return on_grid(grid, disk(src.select("cell", *columns), k).groupBy("cell").agg(*aggs))


def disk_weighted_sums(src: DataFrame, grid: DataFrame, column: str, sums: dict[str, tuple[int, float]]) -> DataFrame:
    """Several sums of one column, each with its own rings and scale, from one scatter over the
    widest disk; 0 where nothing is near."""
    part = lambda k, km: F.when((F.col(column) > 0) & (F.col("ring") <= k), F.col(column) * ring_weight(km))
    aggs = [F.sum(part(k, km)).alias(name) for name, (k, km) in sums.items()]
    return on_grid(grid, disk(src.select("cell", column), max(k for k, _ in sums.values())).groupBy("cell").agg(*aggs))


def disk_weighted_max(src: DataFrame, grid: DataFrame, columns: list[str], k: int, scale_km: float) -> DataFrame:
    """Largest positive value times the ring's weight, which is 1 in the cell itself."""
    w = ring_weight(scale_km, spread=False)
    aggs = [F.max(F.when(F.col(c) > 0, F.col(c) * w)).alias(c) for c in columns]
    return on_grid(grid, disk(src.select("cell", *columns), k).groupBy("cell").agg(*aggs))


def disk_gaussian_mean(src: DataFrame, columns: list[str], k: int, sigma_km: float) -> DataFrame:
    """Gaussian mean over the disk; missing sources count in neither sum. Cells of ``src``."""
    w = gauss_weight(sigma_km)
    aggs = [(F.sum(F.col(c) * w) / F.nullif(F.sum(F.when(F.col(c).isNotNull(), w)), F.lit(0.0))).alias(c) for c in columns]
    return src.select("cell").join(disk(src.select("cell", *columns), k).groupBy("cell").agg(*aggs), "cell", "left")


def disk_median(src: DataFrame, column: str, k: int, min_count: int = 1) -> DataFrame:
    """Median over the disk, NULL under ``min_count`` values. Cells of ``src``."""
    agg = F.when(F.count(column) >= min_count, F.percentile(column, 0.5)).alias(column)
    return src.select("cell").join(disk(src.select("cell", column), k).groupBy("cell").agg(agg), "cell", "left")


def disk_mean(src: DataFrame, grid: DataFrame, column: str, k: int) -> DataFrame:
    """Flat mean over the grid's own cells of the disk."""
    filled = on_grid(grid, src.select("cell", column))
    return grid.select("cell").join(disk(filled, k).groupBy("cell").agg(F.avg(column).alias(column)), "cell", "left")


def disk_spread(src: DataFrame, column: str, k: int = 1) -> DataFrame:
    """Largest minus smallest value over the disk, and the deviation from the ring's mean."""
    other = F.when(F.col("ring") > 0, F.col(column))
    own = F.max(F.when(F.col("ring") == 0, F.col(column)))
    aggs = [(F.max(column) - F.min(column)).alias("spread"), F.abs(own - F.avg(other)).alias("deviation")]
    return src.select("cell").join(disk(src.select("cell", column), k).groupBy("cell").agg(*aggs), "cell", "left")


def kernel_shrink(src: DataFrame, value: str, weight: str, prior: str, k: int = 4, sigma_km: float = 1.5 * SCALE, strength: float = 300.0) -> DataFrame:
    """(sum of weight * K * value + strength * prior) / (sum of weight * K + strength).

    K is Gaussian without the spread inside cells; weights of 0 or less don't count, and a
    missing prior is the median of the priors.
    """
    w = F.when((F.col(weight) > 0) & F.col(value).isNotNull(), F.col(weight) * gauss_weight(sigma_km, spread=False))
    sums = disk(src.select("cell", value, weight), k).groupBy("cell").agg(F.sum(w * F.col(value)).alias("_a"), F.sum(w).alias("_b"))
    middle = src.agg(F.percentile(prior, 0.5)).scalar()
    out = src.select("cell", prior).join(sums, "cell", "left")
    p = F.lit(strength) * F.coalesce(F.col(prior), middle)
    return out.select("cell", ((F.coalesce("_a", F.lit(0.0)) + p) / (F.coalesce("_b", F.lit(0.0)) + F.lit(strength))).alias(value))


def disk_distinct_weight(src: DataFrame, member: str, weight: str, k: int) -> DataFrame:
    """Weight of the distinct members met within the disk, each counted once a cell."""
    pairs = disk(src.select("cell", member, weight).distinct(), k).groupBy("cell", member).agg(F.max(weight).alias(weight))
    return pairs.groupBy("cell").agg(F.sum(weight).alias(weight))


def dilate(cells: DataFrame, k: int = 1) -> DataFrame:
    """The set of cells grown by ``k`` rings."""
    return disk(cells.select("cell"), k).select("cell").distinct()


def children(cells: DataFrame, edge_m: float = EDGE_M) -> DataFrame:
    """Seven points a cell: its centre and six around it, as planar x, y."""
    q, r = geo.cell_qr(F.col("cell"))
    x, y = geo.hex_centre(q, r, edge_m)
    step = edge_m * geo.SQRT3 / math.sqrt(7)
    turns = [math.radians(19.1066 + 60 * i) for i in range(6)]
    moves = [(0.0, 0.0), *[(step * math.cos(t), step * math.sin(t)) for t in turns]]
    places = F.array(*[F.struct(F.lit(i).alias("child"), (x + dx).alias("x"), (y + dy).alias("y")) for i, (dx, dy) in enumerate(moves)])
    return cells.select("cell", F.inline(places))


def rim_offsets(edge_m: float = EDGE_M) -> list[tuple[float, float]]:
    """Where the six points of :func:`rim_points` lie from a cell's centre."""
    far = 0.338 / 0.93 * geo.SQRT3 * edge_m
    return [(far * math.cos(math.radians(60 * i)), far * math.sin(math.radians(60 * i))) for i in range(6)]


def rim_points(cells: DataFrame, edge_m: float = EDGE_M) -> DataFrame:
    """Six points a cell, as far from the centre as the cell's points are on average."""
    q, r = geo.cell_qr(F.col("cell"))
    x, y = geo.hex_centre(q, r, edge_m)
    places = F.array(*[F.struct(F.lit(i).alias("rim"), (x + dx).alias("x"), (y + dy).alias("y")) for i, (dx, dy) in enumerate(rim_offsets(edge_m))])
    return cells.select("cell", F.inline(places))


def repair(src: DataFrame, value: str, candidate: Column, rounds: int = 3) -> DataFrame:
    """Fill gaps and single outliers from the ring of direct neighbours, round by round.

    ``candidate`` says which cells may change. A missing value takes the mean of two or
    more neighbours; a value of at most 0.1 takes their median if there are four or more,
    the median is at least 0.5 and 0.4 above it. All changes of a round apply together;
    rounds stop early without a change. Every round is written out.
    """
    now = materialise(src.select("cell", F.col(value).alias("v"), F.coalesce(candidate, F.lit(False)).alias("may")))
    for _ in range(rounds):
        near = disk(now.where(F.col("v").isNotNull()).select("cell", "v"), 1).where("ring = 1")
        stats = near.groupBy("cell").agg(F.count("v").alias("n"), F.avg("v").alias("mean"), F.percentile("v", 0.5).alias("mid"))
        gap = F.col("may") & F.col("v").isNull() & (F.col("n") >= 2)
        odd = F.col("may") & (F.col("v") <= 0.1) & (F.col("n") >= 4) & (F.col("mid") >= 0.5) & (F.col("mid") - F.col("v") >= 0.4)
        new = F.when(gap, F.col("mean")).when(odd, F.col("mid")).otherwise(F.col("v"))
        step = materialise(now.join(stats, "cell", "left").select("cell", new.alias("v"), "may", (~new.eqNullSafe(F.col("v"))).alias("changed")))
        now = step.drop("changed")
        if step.where("changed").isEmpty():
            break
    return now.select("cell", F.col("v").alias(value))
