"""Records that differ only in formatting, collapsed into one each with a count.

Each distinct raw value of a column is canonicalised once and gets an integer; records are
rewritten as the sorted array of (field, value) integers and those are grouped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialise

Canon = Callable[[Column], Column]


def value_ids(df: DataFrame, column: str, canon: Canon) -> DataFrame:
    """The dictionary of one column: each distinct raw value with its canonical value's id.

    Raw values without a canonical one (NULL) have no entry. Ids are unique but not dense;
    they are written out before use, so that a rerun task can't number anew.
    """
    raw = df.select(F.col(column).alias("raw")).where(F.col("raw").isNotNull()).distinct()
    known = materialise(raw.select("raw", canon(F.col("raw")).alias("canon")).where(F.col("canon").isNotNull()))
    ids = materialise(known.select("canon").distinct().withColumn("id", F.monotonically_increasing_id()))
    return known.join(ids, "canon").select("raw", "id")


def encode_records(df: DataFrame, fields: dict[str, Canon]) -> DataFrame:
    """``df`` with ``code``, the record as a sorted array of integers, written out.

    Rows in which a field has no canonical value drop out. The order in which the fields
    are given makes no difference. A raw value that many rows share is one hot join key,
    which adaptive execution splits, as the dictionary has it once. An existing column
    called ``code`` is replaced.
    """
    coded = df.drop("code")
    parts = []
    for i, name in enumerate(sorted(fields)):
        ids = value_ids(df, name, fields[name]).select(F.col("raw").alias(name), F.col("id").alias(f"_id{i}"))
        coded = coded.join(ids, name)
        parts.append(F.shiftleft(f"_id{i}", 8).bitwiseOR(F.lit(i)))
    return materialise(coded.withColumn("code", F.array_sort(F.array(*parts))).drop(*[f"_id{i}" for i in range(len(parts))]))


def groups(coded: DataFrame, key: str) -> DataFrame:
    """One row per group: ``code``, the smallest key as ``keep``, and ``copies``.

    Counts are added up before the shuffle, so that a group of any size costs one row a
    task. Repeated rows of one key count each.
    """
    return coded.groupBy("code").agg(F.min(key).alias("keep"), F.count(F.lit(1)).alias("copies"))


def duplicates(coded: DataFrame, key: str) -> DataFrame:
    """``keep`` and each other key of the groups of two rows or more."""
    multi = groups(coded, key).where("copies > 1")
    return coded.join(multi, "code").where(F.col(key) != F.col("keep")).select("keep", F.col(key).alias("dup"))


def collapse(coded: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """One record per group: the ``columns`` of its first row, ``keep`` and ``copies``."""
    first = F.min_by(F.struct(*columns), key)
    out = coded.groupBy("code").agg(F.min(key).alias("keep"), F.count(F.lit(1)).alias("copies"), first.alias("r"))
    return out.select("keep", "copies", "r.*")
