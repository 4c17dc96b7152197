"""The best representative of each duplicate group, chosen field by field."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

LOWEST = -(2**31)


def with_trust(rows: DataFrame, sources: DataFrame, source: str = "source", trust: str = "trust") -> DataFrame:
    """Add ``_trust``; sources that are NULL or not listed rank lowest.

    A source listed more than once has its highest trust.
    """
    best = sources.groupBy(F.col(source).alias("_source")).agg(F.max(trust).cast("long").alias("_trust"))
    joined = rows.join(best, rows[source] == best["_source"], "left").drop("_source")
    return joined.withColumn("_trust", F.coalesce("_trust", F.lit(LOWEST).cast("long")))


def survivors(rows: DataFrame, group: str, key: str, updated: str, attributes: dict[str, tuple[Column, Column]]) -> DataFrame:
    """For each group its first key, its size, and for each attribute the winner.

    ``attributes`` maps a name to (usable, value). The winner is, among rows where it is
    usable, the one with the highest ``_trust``, then the latest ``updated`` (NULL last),
    then the smallest key; without a usable row it is NULL. All attributes come from one
    aggregation of composite maxima, so that groups of any size combine map-side and ties
    are decided by the key; repeated rows count in the size and change nothing else. An
    empty table has no groups. Result: group, ``first``, ``size`` and, for each attribute, a
    struct ``<name>`` of (source_key, value).
    """
    aggs = []
    for name, (usable, value) in attributes.items():
        rank = F.struct(
            F.coalesce(usable, F.lit(False)).alias("u"),
            F.col("_trust").alias("t"),
            F.col(updated).isNotNull().alias("known"),
            F.col(updated).alias("at"),
            (-F.col(key)).alias("k"),
            value.alias("v"),
        )
        best = F.max(rank)
        aggs.append(F.when(best["u"], F.struct((-best["k"]).alias("source_key"), best["v"].alias("value"))).alias(name))
    return rows.groupBy(group).agg(F.min(key).alias("first"), F.count(F.lit(1)).alias("size"), *aggs)


def provenance(best: DataFrame, attributes: list[str]) -> DataFrame:
    """``first``, ``fld`` and ``source_key`` of each attribute that has a winner."""
    each = F.explode(F.array(*[F.struct(F.lit(a).alias("fld"), F.col(a)["source_key"].alias("source_key")) for a in attributes]))
    return best.select("first", each.alias("e")).select("first", "e.fld", "e.source_key").where(F.col("source_key").isNotNull())
