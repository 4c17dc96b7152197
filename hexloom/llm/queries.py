"""Queries of the llm problems and the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import text
from ..plans import sql
from ..session import table
from . import leakage, linkage, packing, quantiles, residue, survivorship, variants

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
CAPACITY = 2048
CHARS = 8192
PERCENTILES = [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99, 0.999]
NUMBERS = ["rent_2022", "population", "vacancy_pct"]


def school_codes(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of jedeschule with the code of their school group."""
    return variants.encode_records(table(spark, sf, "jedeschule"), {"name": text.word_bag, "zip": text.zip5})


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return variants.duplicates(school_codes(spark, sf), "row_id").select(F.col("keep").alias("keep_row"), F.col("dup").alias("dup_row"))


def p1_records(spark: SparkSession, sf: str) -> DataFrame:
    """Each school once, with the number of its rows."""
    return variants.collapse(school_codes(spark, sf), "row_id", ["name", "zip"]).withColumnRenamed("keep", "keep_row")


def _survivors(spark: SparkSession, sf: str) -> DataFrame:
    rows = survivorship.with_trust(school_codes(spark, sf), table(spark, sf, "register_sources"))
    lat, lon = text.usable_lat(F.col("latitude")), text.usable_lon(F.col("longitude"))
    attributes = {
        "name": (F.lit(True), F.col("name")),
        "school_type": (text.known(F.col("school_type")).isNotNull(), F.col("school_type")),
        "location": (lat.isNotNull() & lon.isNotNull(), F.struct(lat.alias("lat"), lon.alias("lon"))),
    }
    return survivorship.survivors(rows, "code", "row_id", "updated_at", attributes).where("size > 1")


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    best = survivorship.provenance(_survivors(spark, sf), ["name", "school_type", "location"])
    return best.select(F.col("first").alias("group_row"), "fld", F.col("source_key").alias("source_row"))


def p4_records(spark: SparkSession, sf: str) -> DataFrame:
    """The record built for each group."""
    return _survivors(spark, sf).select(
        F.col("first").alias("group_row"),
        F.col("size").alias("copies"),
        F.col("name.value").alias("name"),
        F.col("school_type.value").alias("school_type"),
        F.col("location.value.lat").alias("latitude"),
        F.col("location.value.lon").alias("longitude"),
    )


def p5_matches(spark: SparkSession, sf: str) -> DataFrame:
    """Each row of the register with its object on the map and the confidence."""
    return linkage.match(table(spark, sf, "jedeschule"), table(spark, sf, "pois").where("category = 'school'"))


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return p5_matches(spark, sf).select("row_id", "osm_id")


def _present(spark: SparkSession, sf: str) -> DataFrame:
    """scores with values that can't be as NULL."""
    ok = {
        "rent_2022": (F.col("rent_2022") > 0) & (F.col("rent_2022") < 100),
        "population": F.col("population") >= 0,
        "vacancy_pct": F.col("vacancy_pct").between(0, 100),
    }
    return table(spark, sf, "scores").withColumns({c: F.when(~F.isnan(c) & ok[c], F.col(c)) for c in ok})


def p7_builds(spark: SparkSession, sf: str) -> DataFrame:
    """The two sketches of each kreis, build and field, to be kept and combined: ``high`` tells
    which tail one protects."""
    rows = _present(spark, sf)
    upper, lower = [quantiles.sketches(rows, ["kreis", "run_no"], NUMBERS, high=h).withColumn("high", F.lit(h)) for h in (True, False)]
    return upper.unionByName(lower)


def p7_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    """Percentiles per kreis from the sketches of single builds, those under the median from
    the sketch that protects the lower tail."""
    found = quantiles.percentiles(quantiles.combined(p7_builds(spark, sf), ["kreis", "high"]), ["kreis", "high"], PERCENTILES)
    return found.where((F.col("p") >= 0.5) == F.col("high")).drop("high")


def p8_packed(spark: SparkSession, sf: str) -> DataFrame:
    """Every text, or part of a text over the capacity, with its container."""
    lengths = packing.token_lengths(table(spark, sf, "documents"), TOKENIZER)
    return packing.pack(lengths, CAPACITY, "doc_id", "n_tokens")


def p8_fill(spark: SparkSession, sf: str) -> DataFrame:
    """How many containers the texts take, and how full they are."""
    return packing.filled(p8_packed(spark, sf), CAPACITY).withColumn("fill", F.round("fill", 6))


def p8_chars(spark: SparkSession, sf: str) -> DataFrame:
    """The texts by their length in characters: their pieces, and that no container is too
    full or emptier on average than one in fifty."""
    packed = packing.pack(table(spark, sf, "documents"), CHARS, "doc_id", "n_chars")
    whole = packing.filled(packed, CHARS)
    docs = packed.groupBy("doc_id").agg(F.count(F.lit(1)).alias("pieces"), F.sum("size").alias("chars"), F.max("size").alias("largest"))
    good = whole.select((F.col("overfull") == 0).alias("fits"), (F.col("fill") > 0.98).alias("full"))
    return docs.withColumns({c: good.select(c).scalar() for c in ("fits", "full")})


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    return leakage.leaked_passages(table(spark, sf, "documents"), table(spark, sf, "eval_items")).select("doc_id", "item_id")


def p9_items(spark: SparkSession, sf: str) -> DataFrame:
    """Every item with the number of documents it leaked into."""
    hits = p9_found(spark, sf).groupBy("item_id").agg(F.count(F.lit(1)).alias("documents"))
    return table(spark, sf, "eval_items").select("item_id", "task").join(hits, "item_id", "left").na.fill({"documents": 0})


def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    return residue.residue(table(spark, sf, "documents")).select("doc_id")


def p10_templates(spark: SparkSession, sf: str) -> DataFrame:
    """The mined templates with their verdicts and how often they occur."""
    _, known = residue.mine(table(spark, sf, "documents"))
    found = residue.judged(residue.placed(known)[1], residue.fit(residue.sampled(known)))
    return found.groupBy("template", "verdict").agg(F.sum("count").alias("occurrences"), F.min("example").alias("example"))


def p10_heldout(spark: SparkSession, sf: str) -> DataFrame:
    """How the classifier does on labelled messages in wordings that it was not fitted to."""
    return residue.held_out(residue.mine(table(spark, sf, "documents"))[1])


def queries() -> dict:
    return {f.__name__: f for f in (p1_found, p1_records, p4_found, p4_records, p5_found, p5_matches, p7_percentiles, p7_builds, p8_packed, p8_fill, p8_chars, p9_found, p9_items, p10_found, p10_templates, p10_heldout)}


_LEAKS = """
WITH w AS (SELECT {key}, regexp_extract_all(replace(lower({text}), 'ß', 'ss'), '[\\p{{L}}\\p{{N}}]+') AS w FROM {source})
SELECT DISTINCT {key}, array_to_string(w[i : i + 19], ' ') AS s FROM w, unnest(range(1, len(w) - 18)) AS u(i)"""
_P9 = f"""
  d AS ({_LEAKS.format(key="doc_id", text="text", source="documents")}),
  i AS ({_LEAKS.format(key="item_id", text="text", source="eval_items")}),
  f AS (SELECT DISTINCT doc_id, item_id FROM d JOIN i ON d.s = i.s)"""

_BAG = "nullif(array_to_string(list_sort(regexp_extract_all(replace(lower(nfc_normalize(name)), 'ß', 'ss'), '[\\p{L}\\p{N}]+')), ' '), '')"
_GROUPED = f"""
  g AS (SELECT *, {sql.zip5("zip")} AS z, {_BAG} AS bag FROM jedeschule),
  h AS (SELECT *, min(row_id) OVER (PARTITION BY z, bag) AS first, count(*) OVER (PARTITION BY z, bag) AS n FROM g WHERE z IS NOT NULL AND bag IS NOT NULL)"""


def oracle_sql() -> dict[str, str]:
    lat, lon = sql.usable("latitude", *text.LAT_RANGE), sql.usable("longitude", *text.LON_RANGE)
    stand_ins = ", ".join(f"'{s}'" for s in text.STAND_INS)
    known = f"school_type IS NOT NULL AND lower({sql.strip('school_type')}) NOT IN ({stand_ins})"
    order = "coalesce(trust, -2147483648) DESC, updated_at DESC NULLS LAST, row_id"
    ranked = f"""
WITH {_GROUPED},
  t AS (SELECT h.*, trust, {lat} AS la, {lon} AS lo FROM h LEFT JOIN register_sources s ON h.source = s.source WHERE n > 1),
  u AS (SELECT first, n, row_id, name, school_type, la, lo, 'name' AS fld, row_number() OVER (PARTITION BY first ORDER BY {order}) AS k FROM t
    UNION ALL SELECT first, n, row_id, name, school_type, la, lo, 'school_type', row_number() OVER (PARTITION BY first ORDER BY {order}) FROM t WHERE {known}
    UNION ALL SELECT first, n, row_id, name, school_type, la, lo, 'location', row_number() OVER (PARTITION BY first ORDER BY {order}) FROM t WHERE la IS NOT NULL AND lo IS NOT NULL)"""
    return {
        "p1_found": f"WITH {_GROUPED} SELECT first AS keep_row, row_id AS dup_row FROM h WHERE n > 1 AND row_id <> first",
        "p1_records": f"WITH {_GROUPED} SELECT first AS keep_row, n AS copies, name, zip FROM h WHERE row_id = first",
        "p4_found": ranked + " SELECT first AS group_row, fld, row_id AS source_row FROM u WHERE k = 1",
        "p8_chars": "SELECT doc_id, greatest(1, CAST(ceil(n_chars / 8192e0) AS BIGINT)) AS pieces, n_chars AS chars, least(n_chars, 8192) AS largest, true AS fits, true AS full FROM documents",
        "p9_found": f"WITH {_P9} SELECT doc_id, item_id FROM f",
        "p9_items": f"WITH {_P9} SELECT item_id, task, count(doc_id) AS documents FROM eval_items LEFT JOIN f USING (item_id) GROUP BY item_id, task",
        "p4_records": ranked
        + """
SELECT first AS group_row, max(n) AS copies, max(name) FILTER (fld = 'name') AS name, max(school_type) FILTER (fld = 'school_type') AS school_type,
  max(la) FILTER (fld = 'location') AS latitude, max(lo) FILTER (fld = 'location') AS longitude FROM u WHERE k = 1 GROUP BY first""",
    }
