"""Ways of a map: what each is for, and its shape from its vertices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import rules

#: The classes of road that are sampled.
ROADS = ("motorway", "trunk", "primary", "secondary", "tertiary")


def route() -> Column:
    """Where a row with ``tags`` goes: a road's class, rail, river, stream, trees, green:kind,
    closed:kind, poi:class or NULL; the first that holds decides."""
    tag = rules.tag
    return F.coalesce(
        F.when(tag("highway").isin(*ROADS), tag("highway")),
        F.when((tag("railway") == "rail") & tag("usage").isin("main", "branch"), "rail"),
        F.when(tag("waterway").isin("river", "stream"), tag("waterway")),
        F.when(tag("natural") == "tree_row", "trees"),
        F.concat(F.lit("green:"), rules.green_kind()),
        F.concat(F.lit("closed:"), rules.no_access_kind()),
        F.concat(F.lit("poi:"), rules.poi_class()),
    )


def _valid(points: Column) -> Column:
    return F.filter(points, lambda p: p["lon"].between(-180, 180) & p["lat"].between(-90, 90))


def centroid(points: Column) -> tuple[Column, Column]:
    """Mean longitude and latitude of the valid vertices of an array of structs; NULL without one."""
    ok = _valid(points)
    n = F.nullif(F.size(ok), F.lit(0))
    total = lambda c: F.aggregate(F.transform(ok, lambda p: p[c]), F.lit(0.0), lambda a, x: a + x)
    return total("lon") / n, total("lat") / n


def outline(points: Column, box: tuple[float, float, float, float]) -> Column:
    """The way as a closed polygon in text form, seven decimals; NULL under three valid vertices
    or without one in the box (west, south, east, north)."""
    ok = _valid(points)
    inside = F.exists(ok, lambda p: p["lon"].between(box[0], box[2]) & p["lat"].between(box[1], box[3]))
    first, last = F.get(ok, F.lit(0)), F.get(ok, F.size(ok) - 1)
    ring = F.when(first == last, ok).otherwise(F.array_append(ok, first))
    text = F.array_join(F.transform(ring, lambda p: F.format_string("%.7f %.7f", p["lon"], p["lat"])), ", ")
    return F.when((F.size(ok) >= 3) & inside, F.concat(F.lit("POLYGON (("), text, F.lit("))")))


def vertices(points: DataFrame, way: str, seq: str) -> DataFrame:
    """Each way with its vertices in order as ``points``; bounded by what one way has."""
    p = F.struct(F.col(seq).alias("seq"), F.col("lon").alias("lon"), F.col("lat").alias("lat"))
    return points.groupBy(way).agg(F.transform(F.array_sort(F.collect_list(p)), lambda v: F.struct(v["lon"].alias("lon"), v["lat"].alias("lat"))).alias("points"))
