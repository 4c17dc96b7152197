"""Joins by planar distance and containment, all through equi-joins on square buckets.

Planar columns are metres (see :func:`hexloom.functions.geo.with_utm32`). A radius join puts
both sides in buckets one radius wide and copies the left rows to the nine buckets around;
rows of one pair meet exactly once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window

from ..session import materialise


def _dist(ax: str, ay: str, bx: str, by: str) -> Column:
    dx, dy = F.col(ax) - F.col(bx), F.col(ay) - F.col(by)
    return F.sqrt(dx * dx + dy * dy)


def radius_join(left: DataFrame, right: DataFrame, radius_m: float, strict: bool = False, on: tuple[str, ...] = ()) -> DataFrame:
    """Pairs of left and right rows at most ``radius_m`` apart, with ``dist``, and equal in the
    columns ``on``.

    Both sides have planar ``x`` and ``y``; the right's come out as ``rx`` and ``ry``.
    Rows without coordinates drop out.
    """
    step = F.lit(float(radius_m))
    near = F.array(F.lit(-1), F.lit(0), F.lit(1))
    a = left.where(F.col("x").isNotNull() & F.col("y").isNotNull())
    a = a.withColumn("_bx", F.explode(F.transform(near, lambda i: F.floor(F.col("x") / step) + i)))
    a = a.withColumn("_by", F.explode(F.transform(near, lambda i: F.floor(F.col("y") / step) + i)))
    b = right.where(F.col("x").isNotNull() & F.col("y").isNotNull()).withColumnsRenamed({"x": "rx", "y": "ry"})
    b = b.withColumns({"_bx": F.floor(F.col("rx") / step), "_by": F.floor(F.col("ry") / step)})
    pairs = a.join(b, ["_bx", "_by", *on]).drop("_bx", "_by").withColumn("dist", _dist("x", "y", "rx", "ry"))
    return pairs.where(F.col("dist") < radius_m if strict else F.col("dist") <= radius_m)


def nearest(left: DataFrame, right: DataFrame, key: str, payload: list[str], start_m: float, most_m: float | None, tie: str, kind: str | None = None, kinds: list[str] = ()) -> DataFrame:
    """The nearest right row of each left row: key, [kind], ``dist`` and the payload.

    The radius grows fourfold from ``start_m`` until every left row (of every kind) has a match
    or ``most_m`` is reached (None: until the radius spans both sides); a match at distance d is final once d is within the radius,
    so each round only joins those that have none yet. Ties go to the smallest ``tie``.
    Left rows with nothing within ``most_m`` are not in the result. With ``kind``, a column
    of the right side, the nearest of each of ``kinds`` is found in the same passes.
    """
    by = [key, "_kind"]
    k = F.col(kind).cast("string") if kind else F.lit("")
    names = list(dict.fromkeys([tie, *payload]))
    right = right.select("x", "y", k.alias("_kind"), *[F.col(n).alias(f"p_{n}") for n in names])
    wanted = F.explode(F.array(*[F.lit(x) for x in (kinds if kind else [""])]))
    todo = left.select(key, "x", "y", wanted.alias("_kind"))
    if most_m is None:
        # as far as any two points can be apart
        box = [f(c) for c in ("x", "y") for f in (F.min, F.max)]
        spans = left.select("x", "y").unionByName(right.select("x", "y")).agg(*box).first()
        most_m = start_m if spans[0] is None else max(start_m, 1.0 + ((spans[1] - spans[0]) ** 2 + (spans[3] - spans[2]) ** 2) ** 0.5)
    done, radius = None, start_m
    while True:
        # tiles of the right side first: only those that may hold the nearest row are opened
        tile = radius / 5
        half = tile * 0.7072
        tiled = right.withColumns({"_tx": F.floor(F.col("x") / tile), "_ty": F.floor(F.col("y") / tile)})
        tiles = tiled.select("_kind", "_tx", "_ty").distinct().withColumns({"x": (F.col("_tx") + 0.5) * tile, "y": (F.col("_ty") + 0.5) * tile})
        near = radius_join(tiles, todo, radius + half, on=("_kind",))
        near = near.withColumn("_least", F.min("dist").over(Window.partitionBy(*by))).where(F.col("dist") <= F.col("_least") + 2 * half)
        pairs = near.select(*by, F.col("rx").alias("lx"), F.col("ry").alias("ly"), "_tx", "_ty").join(tiled, ["_kind", "_tx", "_ty"])
        pairs = pairs.withColumn("dist", _dist("lx", "ly", "x", "y")).where(F.col("dist") <= radius)
        best = pairs.groupBy(*by).agg(F.min(F.struct("dist", *[f"p_{n}" for n in names])).alias("b"))
        found = materialise(best.select(*by, "b.*"))
        done = found if done is None else done.unionByName(found)
        if radius >= most_m:
            break
        todo = materialise(todo.join(found, by, "left_anti"))
        if todo.isEmpty():
            break
        radius = min(radius * 4, most_m)
    return done.select(key, *([F.col("_kind").alias(kind)] if kind else []), "dist", *[F.col(f"p_{n}").alias(n) for n in names])


def nearest_around(left: DataFrame, right: DataFrame, key: str, offsets: list[tuple[float, float]], start_m: float, kind: str, kinds: list[str]) -> DataFrame:
    """key, kind and ``dist``: the mean, over the points at ``offsets`` from each left row, of
    the distance to the nearest right row of each kind.

    Both sides meet in squares two radii wide, with the right rows within one radius copied
    in. A left row lies in one square, so its pairs are added up where they arise and only
    the minima are shuffled. With the nearest right row at distance d of the left row
    itself, all that are nearest to a point are within d plus twice the longest offset; left
    rows for which that exceeds the radius go on to a round of twice the radius, until it
    spans both sides. A kind without rows, and rows without coordinates, are not in the result.
    """
    far = max((dx * dx + dy * dy) ** 0.5 for dx, dy in offsets)
    known = F.col("x").isNotNull() & F.col("y").isNotNull()
    right = materialise(right.where(known & F.col(kind).isin(*kinds)).select("x", "y", F.col(kind).alias("_kind")))
    left = left.where(known).select(key, F.col("x").alias("lx"), F.col("y").alias("ly"))
    box = [f(c) for c in ("x", "y") for f in (F.min, F.max)]
    there = right.groupBy("_kind").agg(*box).collect()
    ends = left.select(F.min("lx"), F.max("lx"), F.min("ly"), F.max("ly")).first()
    if not there or ends[0] is None:
        return left.select(key, F.lit("").alias(kind), F.lit(0.0).alias("dist")).limit(0)
    spans = [*[r[1:] for r in there], ends]
    width = [max(r[i + 1] for r in spans) - min(r[i] for r in spans) for i in (0, 2)]
    most = 1.0 + 2 * far + (width[0] ** 2 + width[1] ** 2) ** 0.5
    todo = left.withColumn("_kind", F.explode(F.array(*[F.lit(r[0]) for r in there])))
    done, radius = None, max(start_m, 2 * far)
    while True:
        step = F.lit(2 * radius)
        halo = lambda c: F.explode(F.sequence(F.floor((F.col(c) - radius) / step), F.floor((F.col(c) + radius) / step)))
        copies = right.withColumn("_bx", halo("x")).withColumn("_by", halo("y"))
        at = todo.withColumns({"_bx": F.floor(F.col("lx") / step), "_by": F.floor(F.col("ly") / step)})
        square = lambda c: c * c
        gap = lambda dx, dy: square(F.col("lx") + F.lit(dx) - F.col("x")) + square(F.col("ly") + F.lit(dy) - F.col("y"))
        least = [F.min(gap(*o)).alias(f"_d{i}") for i, o in enumerate([(0.0, 0.0), *offsets])]
        met = at.join(copies, ["_kind", "_bx", "_by"]).groupBy(key, "_kind").agg(*least)
        mean = sum((F.sqrt(f"_d{i + 1}") for i in range(len(offsets))), F.lit(0.0)) / len(offsets)
        sure = F.sqrt("_d0") <= radius - 2 * far if radius < most else F.lit(True)
        found = materialise(met.where(sure).select(key, "_kind", mean.alias("dist")))
        done = found if done is None else done.unionByName(found)
        if radius >= most:
            break
        todo = materialise(todo.join(found, [key, "_kind"], "left_anti"))
        if todo.isEmpty():
            break
        radius = min(radius * 2, most)
    return done.select(key, F.col("_kind").alias(kind), "dist")


def anti_within(left: DataFrame, right: DataFrame, key: str, radius_m: float) -> DataFrame:
    """Left rows with no right row closer than ``radius_m``. Rows without coordinates stay."""
    near = radius_join(left.select(key, "x", "y"), right.select("x", "y"), radius_m, strict=True)
    return left.join(near.select(key).distinct(), key, "left_anti")


def ray_cast(ring: Column, x: Column, y: Column) -> Column:
    """Whether (x, y) lies in the closed ring of structs (x, y)."""
    n = F.size(ring)

    def crosses(i: Column) -> Column:
        a, b = F.get(ring, i), F.get(ring, (i + 1) % n)
        ya, yb = a["y"], b["y"]
        straddles = (ya > y) != (yb > y)
        at = (b["x"] - a["x"]) * (y - ya) / F.nullif(yb - ya, F.lit(0.0)) + a["x"]
        return F.when(straddles & (x < at), F.lit(1)).otherwise(F.lit(0))

    total = F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda acc, i: acc + crosses(i))
    return (n >= 3) & (total % 2 == 1)


def polygon_join(points: DataFrame, polygons: DataFrame, bucket_m: float, how: str = "inner") -> DataFrame:
    """Points joined with the polygons (column ``ring``) that contain them.

    Polygons are listed under every bucket that their bounding box meets; ``bucket_m``
    should be of the order of a polygon's width. ``how`` may be ``left``.
    """
    step = F.lit(float(bucket_m))
    xs, ys = F.transform("ring", lambda p: p["x"]), F.transform("ring", lambda p: p["y"])
    span = lambda v: F.explode(F.sequence(F.floor(F.array_min(v) / step), F.floor(F.array_max(v) / step)))
    cover = polygons.where(F.size("ring") >= 3).withColumn("_bx", span(xs)).withColumn("_by", span(ys))
    p = points.withColumns({"_bx": F.floor(F.col("x") / step), "_by": F.floor(F.col("y") / step)})
    inside = p.join(cover, ["_bx", "_by"]).where(ray_cast(F.col("ring"), F.col("x"), F.col("y"))).drop("_bx", "_by", "ring")
    if how == "inner":
        return inside
    extra = [c for c in polygons.columns if c != "ring"]
    return points.join(inside.select(*[c for c in points.columns], *extra), points.columns, "left")


def area_samples(polygons: DataFrame, step_m: float) -> DataFrame:
    """Points on a square lattice inside each polygon; a sliver keeps its first vertex."""
    step = F.lit(float(step_m))
    xs, ys = F.transform("ring", lambda p: p["x"]), F.transform("ring", lambda p: p["y"])
    line = lambda v: F.explode(F.sequence(F.ceil(F.array_min(v) / step), F.greatest(F.floor(F.array_max(v) / step), F.ceil(F.array_min(v) / step))))
    lattice = polygons.withColumn("_i", line(xs)).withColumn("_j", line(ys)).withColumns({"x": F.col("_i") * step, "y": F.col("_j") * step})
    inside = lattice.where(ray_cast(F.col("ring"), F.col("x"), F.col("y"))).drop("_i", "_j", "ring")
    keys = [c for c in polygons.columns if c != "ring"]
    slivers = polygons.join(inside.select(*keys).distinct(), keys, "left_anti")
    return inside.unionByName(slivers.select(*keys, F.get("ring", F.lit(0))["x"].alias("x"), F.get("ring", F.lit(0))["y"].alias("y")))


def segments(points: DataFrame, line: str, seq: str) -> DataFrame:
    """Consecutive pairs of a line's points, with length and the arc length before."""
    w = Window.partitionBy(line).orderBy(seq)
    nxt = points.withColumns({"x2": F.lead("x").over(w), "y2": F.lead("y").over(w)})
    seg = nxt.where(F.col("x2").isNotNull()).withColumn("length", _dist("x", "y", "x2", "y2"))
    before = F.coalesce(F.sum("length").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    return seg.withColumn("before", before)


def densify(points: DataFrame, line: str, seq: str, step_m: float) -> DataFrame:
    """Samples every ``step_m`` along each line, the remainder carried across vertices."""
    seg = segments(points, line, seq)
    step = F.lit(float(step_m))
    first, last = F.ceil(F.col("before") / step), F.ceil((F.col("before") + F.col("length")) / step) - 1
    n = F.explode(F.sequence(first, last))
    s = seg.where((F.col("length") > 0) & (last >= first)).withColumn("n", n)
    part = (F.col("n") * step - F.col("before")) / F.col("length")
    return s.select(line, "n", (F.col("x") + part * (F.col("x2") - F.col("x"))).alias("x"), (F.col("y") + part * (F.col("y2") - F.col("y"))).alias("y"))


def feather(points: DataFrame, columns: list[str], sigma_m: float, radius_m: float, key: str) -> DataFrame:
    """Gaussian mean by true distance over all points within the radius, of many columns at
    once; a point's own weight is 1. Missing values count in neither sum."""
    own = points.select(F.col(key), "x", "y")
    other = points.select("x", "y", *columns)
    w = F.exp(-F.col("dist") * F.col("dist") / F.lit(2 * sigma_m**2))
    aggs = [(F.sum(F.col(c) * w) / F.nullif(F.sum(F.when(F.col(c).isNotNull(), w)), F.lit(0.0))).alias(c) for c in columns]
    return radius_join(own, other, radius_m).groupBy(key).agg(*aggs)


def nearest_polygon(points: DataFrame, polygons: DataFrame, key: str, name: str, step_m: float, start_m: float) -> DataFrame:
    """The polygon (column ``ring``) that contains each point, else the one whose edge is nearest:
    key, ``name`` and ``dist`` (0 inside). Ties go to the smallest name.

    Edges are looked up by samples at most ``step_m`` apart and measured exactly; the radius
    grows as in :func:`nearest`, until every point has a polygon. Points without coordinates
    drop out; without polygons the result is empty.
    """
    own = points.where(F.col("x").isNotNull() & F.col("y").isNotNull()).select(key, "x", "y")
    shapes = polygons.select(F.col(name).alias("_name"), "ring").where(F.size("ring") >= 3)
    inside = polygon_join(own, shapes, max(step_m, start_m)).groupBy(key).agg(F.min("_name").alias(name)).withColumn("dist", F.lit(0.0))
    corner = F.posexplode("ring").alias("_i", "_a")
    edges = shapes.select("_name", "ring", corner).select("_name", F.col("_a.x").alias("ax"), F.col("_a.y").alias("ay"), F.get("ring", (F.col("_i") + 1) % F.size("ring")).alias("_b")).select("_name", "ax", "ay", F.col("_b.x").alias("bx"), F.col("_b.y").alias("by"))
    n = F.greatest(F.lit(1), F.ceil(_dist("ax", "ay", "bx", "by") / F.lit(step_m)).cast("int"))
    cut = edges.withColumn("_n", n).withColumn("_k", F.explode(F.sequence(F.lit(0), F.col("_n"))))
    at = F.col("_k") / F.col("_n")
    samples = materialise(cut.select("_name", "ax", "ay", "bx", "by", (F.col("ax") + at * (F.col("bx") - F.col("ax"))).alias("x"), (F.col("ay") + at * (F.col("by") - F.col("ay"))).alias("y")))
    done = materialise(inside)
    todo = materialise(own.join(done, key, "left_anti"))
    radius = start_m
    while not todo.isEmpty() and not samples.isEmpty():
        near = radius_join(samples, todo, radius + step_m / 2)
        ux, uy = F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")
        t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((F.col("rx") - F.col("ax")) * ux + (F.col("ry") - F.col("ay")) * uy) / F.nullif(ux * ux + uy * uy, F.lit(0.0))))
        t = F.coalesce(t, F.lit(0.0))
        dx, dy = F.col("rx") - F.col("ax") - t * ux, F.col("ry") - F.col("ay") - t * uy
        exact = near.withColumn("_d", F.sqrt(dx * dx + dy * dy)).where(F.col("_d") <= radius)
        found = materialise(exact.groupBy(key).agg(F.min(F.struct("_d", "_name")).alias("b")).select(key, F.col("b._name").alias(name), F.col("b._d").alias("dist")))
        done = done.unionByName(found)
        todo = materialise(todo.join(found, key, "left_anti"))
        radius *= 4
    return done
