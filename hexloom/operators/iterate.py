"""Bounded driver loops: each round is one distributed plan, written out."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, Window

from ..session import materialise
from .spatial import radius_join


def non_max_suppression(points: DataFrame, key: str, smooth_m: float, suppress_m: float, least: float) -> DataFrame:
    """Greedy centres: key, x, y, ``pop_s``, by rounds instead of one by one.

    ``points`` has key, x, y and pop. The seed with the largest smoothed population snaps to
    the densest point within ``smooth_m``, and everything within ``suppress_m`` of that is
    done with; seeds under ``least`` don't count. Seeds that are the strongest within the
    sum of both distances can't affect each other, so a round takes all of them at once.
    Ties go to the smaller key. The result has the snapped point and its seed's strength.
    """
    self_ = points.select(F.col(key).alias("k"), "x", "y", "pop")
    pairs = radius_join(self_.select("k", "x", "y"), self_.select(F.col("k").alias("k2"), "x", "y", "pop"), smooth_m)
    info = pairs.groupBy("k").agg(F.sum("pop").alias("pop_s"), F.min(F.struct((-F.col("pop")).alias("d"), "k2", F.col("rx").alias("sx"), F.col("ry").alias("sy"))).alias("s"))
    alive = self_.join(info, "k").select("k", "x", "y", "pop_s", F.col("s.k2").alias("snap"), F.col("s.sx").alias("sx"), F.col("s.sy").alias("sy"))
    alive = materialise(alive.where(F.col("pop_s") >= least))
    chosen = None
    while not alive.isEmpty():
        # the strongest seed within reach of each seed, itself included
        rival = radius_join(alive.select("k", "x", "y"), alive.select(F.col("k").alias("k2"), "x", "y", "pop_s"), suppress_m + smooth_m)
        top = rival.groupBy("k").agg(F.min(F.struct((-F.col("pop_s")).alias("d"), "k2")).alias("t")).where("t.k2 = k").select("k")
        found = materialise(alive.join(top, "k", "left_semi"))
        chosen = found if chosen is None else chosen.unionByName(found)
        hit = radius_join(alive.select("k", "x", "y"), found.select(F.col("sx").alias("x"), F.col("sy").alias("y")), suppress_m)
        gone = hit.select("k").union(found.select("k")).distinct()
        alive = materialise(alive.join(gone, "k", "left_anti"))
    out = (chosen if chosen is not None else alive).groupBy("snap").agg(F.max(F.struct("pop_s", "sx", "sy")).alias("c"))
    return out.select(F.col("snap").alias(key), F.col("c.sx").alias("x"), F.col("c.sy").alias("y"), F.col("c.pop_s").alias("pop_s"))


def components(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Connected components: ``node`` and ``component``, its smallest member.

    Labels fall to the smallest label around, and then to the label's own label, so the
    rounds grow with the logarithm of a chain's length. Labels stay in tables.
    """
    both = edges.select("a", "b").union(edges.select("b", "a"))
    both = materialise(both.toDF("a", "b").where("a <> b").distinct())
    labels = materialise(nodes.select("node", F.col("node").alias("component")))
    while True:
        around = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("component").alias("near"))
        step = labels.join(around, labels["node"] == around["a"], "left").select("node", F.least("component", F.coalesce("near", "component")).alias("c1"), F.col("component").alias("was"))
        jump = step.select(F.col("node").alias("c1"), F.col("c1").alias("c2"))
        new = materialise(step.join(jump, "c1", "left").select("node", F.least("c1", F.coalesce("c2", "c1")).alias("component"), "was"))
        labels = new.drop("was")
        if new.where("component <> was").isEmpty():
            return labels


def city_groups(centres: DataFrame, key: str, name: str, weight: str, link_m: float) -> DataFrame:
    """Centres of one name linked within ``link_m``, each group with its own label.

    Columns: key, ``city`` (smallest key) and ``label``: the name, with -2, -3 and so on
    for further groups of the same name by falling weight.
    """
    c = centres.select(F.col(key).alias("node"), F.col(name).alias("name"), "x", "y", F.col(weight).alias("w"))
    pairs = radius_join(c.select("node", "name", "x", "y"), c.select(F.col("node").alias("n2"), F.col("name").alias("name2"), "x", "y"), link_m)
    comp = components(pairs.where("name = name2").select(F.col("node").alias("a"), F.col("n2").alias("b")), c)
    sized = comp.join(c, "node").groupBy("component", "name").agg(F.sum("w").alias("w"))
    rank = F.row_number().over(Window.partitionBy("name").orderBy(F.col("w").desc(), "component"))
    labels = sized.withColumn("r", rank).select("component", F.when(F.col("r") == 1, F.col("name")).otherwise(F.concat("name", F.lit("-"), "r")).alias("label"))
    return comp.join(labels, "component").select(F.col("node").alias(key), F.col("component").alias("city"), "label")
