"""Incremental counts of objects by cell, and of events by window, on streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import geo


def cell_counts(stream: DataFrame, edge_m: float, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Objects of each category by cell; for ``update`` or ``complete`` output."""
    return geo.with_cell(stream, lat, lon, edge_m).groupBy("cell", "category").agg(F.count(F.lit(1)).alias("n"))


def windowed_counts(stream: DataFrame, ts: str, key: str, width: str = "1 day", late: str = "2 days") -> DataFrame:
    """Events by tumbling window and key; rows later than ``late`` are left out. Timestamps
    without a zone are taken as the session's."""
    zoned = stream.withColumn("_ts", F.col(ts).cast("timestamp"))
    return zoned.withWatermark("_ts", late).groupBy(F.window("_ts", width).alias("w"), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), key, "n")
