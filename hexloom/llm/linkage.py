"""Entities of two sources matched without a key, as one collective decision.

Nodes are schools of a register (rows whose names hold the same words in one zip are one
node) and objects of a map. Edges join nodes that share a block: the same spot, or one of the
object's rarest words in the same part of the country, so that a school whose coordinates are
some streets off is still met by its name. An edge weighs what its ends share, rare words
more than common ones, typing slips, abbreviations and initials allowed for. Edges below
their nodes' average weight at both ends are dropped. What remains
is settled by rounds in which every edge's confidence is its own similarity against what
its neighbours at both ends claim; a school whose object is sure thereby frees the objects
next to it, and the rounds go on until nothing changes any more. They run in each connected
component by itself, so what a pair gets doesn't depend on rows it isn't linked to.
"""

from __future__ import annotations

import math

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, Window

from ..functions import geo, text
from ..operators.iterate import components
from ..operators.nearby import within_distance
from ..session import materialise
from . import variants

#: How far apart rows may be that share a spot, and those that share rare words.
REACH_M, WORD_REACH_M = 160.0, 2_000.0
#: A pair must share this part of the object's name, by weight.
LEAST_PART = 0.5
ACCEPT = 0.3
# An edge is at rest when a round changes it by less than STILL of itself, gone when it falls
# under GONE and still falls.
STILL, GONE = 1e-8, 1e-9

_PLAIN = str.maketrans({"ä": "ae", "ö": "oe", "ü": "ue", "ß": "ss"})

#: Kinds of school, their full words and short forms.
KINDS = {
    "grund": ("grundschule", "volksschule", "gs", "grs"),
    "gym": ("gymnasium", "gym", "gymn"),
    "real": ("realschule", "rs"),
    "mittel": ("mittelschule", "hauptschule", "ms", "hs"),
    "gesamt": ("gesamtschule", "kgs", "igs", "ges"),
    "gemeinschaft": ("gemeinschaftsschule", "gems", "gms"),
    "ober": ("oberschule", "obs", "os"),
    "foerder": ("foerderschule", "foerderzentrum", "foes", "foez", "sbbz"),
    "beruf": ("berufskolleg", "berufsschule", "bk", "bs", "bbs"),
}
#: How the register words a school type, by its start.
REGISTER_KINDS = {
    "grundschul": "grund",
    "volksschul": "grund",
    "primaryeducation": "grund",
    "gymnasi": "gym",
    "uppersecondary": "gym",
    "realschul": "real",
    "mittelschul": "mittel",
    "hauptschul": "mittel",
    "gesamtschul": "gesamt",
    "integrierte gesamt": "gesamt",
    "kooperative gesamt": "gesamt",
    "gemeinschaftsschul": "gemeinschaft",
    "oberschul": "ober",
    "förder": "foerder",
    "beruf": "beruf",
}
#: The map's subcategories.
MAP_KINDS = {"grundschule": "grund", "gymnasium": "gym", "realschule": "real", "mittelschule": "mittel", "gesamtschule": "gesamt", "gemeinschaftsschule": "gemeinschaft", "oberschule": "ober"}
#: Words that tell schools apart too little.
COMMON = frozenset("am an auf bei der die das den zu zur zum im in und von staedt staatl schule sch nord sued ost west i ii iii iv".split())

#: Words that tell a branch from its school. Rows that don't share a spot
#: describe one school only if they agree in these.
BRANCH = frozenset("nord sued ost west mitte i ii iii iv v 1 2 3 4 5 aussenstelle nebenstelle zweigstelle filiale standort dependance".split())

_SHORT = {s: kind for kind, forms in KINDS.items() for s in forms}
_FULL = {s: kind for s, kind in _SHORT.items() if len(s) >= 9}


def distance(a: str, b: str, most: int) -> int:
    """Edits (insert, delete, replace, swap neighbours) between words, or ``most`` + 1."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, row = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row_before = row, before
        row = [i] + [0] * len(b)
        for j, y in enumerate(b, 1):
            row[j] = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                row[j] = min(row[j], row_before[j - 2] + 1)
        if min(row) > most:
            return most + 1
        before = last
    return row[-1]


@lru_cache(1 << 20)
def alike(a: str, b: str) -> float:
    """How far two words may be one: 1 for equal ones, 0 for different ones."""
    if a == b:
        return 1.0
    if len(a) == 1 or len(b) == 1:
        return 0.6 if a[0] == b[0] else 0.0
    short, long = sorted((a, b), key=len)
    if len(short) >= 5 and short in long:
        return 0.85
    most = 2 if len(short) >= 8 else 1 if len(short) >= 4 else 0
    d = distance(a, b, most) if most else 1
    return 0.9 - 0.1 * (d - 1) if most and d <= most else 0.0


def branch(name: str | None) -> str:
    """The words of a name that tell a branch, in order of the alphabet."""
    if not isinstance(name, str):
        return ""
    return " ".join(sorted(BRANCH.intersection(w.translate(_PLAIN) for w in text.words(name))))


def read_name(name: str | None) -> tuple[list[str], str | None]:
    """The words that identify a school, and its kind as far as its name tells."""
    if not isinstance(name, str):
        return [], None
    words, kind = [], None
    for w in text.words(name):
        w = w.translate(_PLAIN)
        found, rest = _SHORT.get(w), ""
        if not found and len(w) >= 4:
            for full, k in _FULL.items():
                if full.startswith(w) and len(w) >= 5 or distance(w, full, 2 if len(full) > 9 else 1) <= (2 if len(full) > 9 else 1):
                    found = k
                elif full in w:
                    found, rest = k, w.replace(full, "")
                if found:
                    break
        if found and (kind is None or found == kind):
            kind = found
            if len(rest) >= 4:
                words.append(rest)
        elif w not in COMMON:
            words.append(w)
    return words, kind


def name_features(names: DataFrame) -> DataFrame:
    """``name``, its ``words``, ``kind`` and ``branch``, for each distinct name."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [read_name(n) for n in b.name]
            yield pd.DataFrame({"name": b.name, "words": [g[0] for g in got], "kind": [g[1] for g in got], "branch": list(map(branch, b.name))})

    return names.select("name").where(F.col("name").isNotNull()).distinct().mapInPandas(read, "name string, words array<string>, kind string, branch string")


def similarity(left: list[tuple[str, float]], right: list[tuple[str, float]]) -> tuple[float, float]:
    """The share of the right name that the left one holds, and the weight they share."""
    total = shared = 0.0
    for r, weight in right:
        weight = weight if len(r) > 1 else 1.0
        best = max((alike(x, r) for x, _ in left), default=0.0)
        total += weight
        shared += weight * best
    return (shared / total if total else 0.0), shared


def edge_score(left: list, right: list, left_kind: str | None, right_kinds: set[str], dist_m: float) -> tuple[float, float]:
    """Similarity of two nodes from 0 to 1, and the edge's weight."""
    same = left_kind in right_kinds if left_kind and right_kinds else None
    if same is False:
        return 0.0, 0.0
    near = max(0.0, 1 - 0.3 * dist_m / REACH_M)
    if left and right:
        part, shared = similarity(left, right)
        # the other way round a short map name would seem to lack words
        if part < LEAST_PART:
            return 0.0, shared
        return part * (1.0 if same else 0.85) * (0.7 + 0.3 * near), shared + 2 * near + (2 if same else 0)
    return (0.5 if same else 0.43) * near, 2 * near + (2 if same else 0)


def _kind_of(column: Column, table: dict[str, str], prefix: bool) -> Column:
    low = F.lower(text.strip(column))
    out = F.lit(None).cast("string")
    for start, kind in reversed(table.items()):
        out = F.when(low.startswith(start) if prefix else low == start, F.lit(kind)).otherwise(out)
    return out


def prefix(words: Column) -> Column:
    """The rarest words of a name without which no pair can share :data:`LEAST_PART` of its
    weight: once what is left weighs less, it can't be enough by itself."""
    rare = F.reverse(F.array_sort(F.transform(words, lambda w: F.struct(w["idf"].alias("idf"), w["word"].alias("word")))))
    total = F.aggregate(rare, F.lit(0.0), lambda a, w: a + w["idf"])
    step = lambda a, w: F.when(a["left"] >= LEAST_PART * total, F.struct((a["left"] - w["idf"]).alias("left"), F.array_append(a["words"], w["word"]).alias("words"))).otherwise(a)
    return F.aggregate(rare, F.struct(total.alias("left"), F.array().cast("array<string>").alias("words")), step)["words"]


def sharing_words(left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs (lid, osm, dist_m) at most :data:`WORD_REACH_M` apart that share one of the
    object's prefix words.

    ``left`` has lid, lat, lon and words, a row for each place of a node, ``right`` osm, lat,
    lon and words. Blocks are a word in a square about as wide as the reach; objects are
    listed in the nine around theirs, so a pair meets in the square of its left row.
    """
    high = WORD_REACH_M / 111_000.0
    # wide enough up to 70 degrees north or south; further towards the poles squares overlap more
    wide = high / math.cos(math.radians(70.0))
    cell = lambda c, size: F.floor(F.col(c) / F.lit(size)).cast("int")
    around = F.array(F.lit(-1), F.lit(0), F.lit(1))
    l = left.where("size(words) > 0").select("lid", "lat", "lon", cell("lat", high).alias("cy"), cell("lon", wide).alias("cx"), F.explode(F.array_distinct(F.transform("words", lambda w: w["word"]))).alias("word"))
    r = right.where("size(words) > 0 and lat between -90 and 90 and not isnan(lon)").select("osm", F.col("lat").alias("o_lat"), F.col("lon").alias("o_lon"), cell("lat", high).alias("y"), cell("lon", wide).alias("x"), F.explode(prefix(F.col("words"))).alias("word"))
    r = r.withColumn("cy", F.explode(F.transform(around, lambda i: F.col("y") + i))).withColumn("cx", F.explode(F.transform(around, lambda i: F.col("x") + i)))
    dist = geo.haversine_m(F.col("lat"), F.col("lon"), F.col("o_lat"), F.col("o_lon"))
    return l.distinct().join(r, ["word", "cy", "cx"]).select("lid", "osm", dist.alias("dist_m")).where(F.col("dist_m") <= WORD_REACH_M)


def _scored(edges: DataFrame) -> DataFrame:
    # so many tasks as are set: the scores are Python's work and must not wait in a few of them
    parts = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    edges = edges.repartition(parts, "lid", "osm")

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            s, w = [], []
            for r in b.itertuples():
                left = [(x["word"], x["idf"]) for x in r.l_words] if r.l_words is not None else []
                right = [(x["word"], x["idf"]) for x in r.r_words] if r.r_words is not None else []
                one, two = edge_score(left, right, r.l_kind, {k for k in (r.r_kind, r.map_kind) if k}, r.dist_m)
                s.append(one)
                w.append(two)
            yield b[["lid", "osm", "name_key", "dist_m"]].assign(s=s, weight=w)

    return edges.mapInPandas(score, "lid long, osm long, name_key long, dist_m double, s double, weight double")


def settle(lid: np.ndarray, osm: np.ndarray, name: np.ndarray, s: np.ndarray, component: np.ndarray) -> np.ndarray:
    """Confidences of edges after all rounds; ends, names (-1 for none) and components are
    numbers. A component is left alone once all its edges are at rest or gone.

    Near ties move slowly but straight, so after some rounds a slow component takes as many at
    once as change it by at most a tenth; the rounds in between let the rest follow.
    """
    out, at, conf = s.copy(), np.arange(len(s)), s.astype(float)
    codes = None
    turn = 0
    while len(at):
        if codes is None:
            l, o, c = (np.unique(x[at], return_inverse=True)[1] for x in (lid, osm, component))
            named = name[at] >= 0
            pair, first, p = np.unique(np.stack([o, name[at]]), axis=1, return_index=True, return_inverse=True)
            codes, pair_osm, pair_named, p = True, o[first], named[first], p.ravel()
            sim = s[at]
        l_sum = np.bincount(l, conf)[l]
        best = np.zeros(len(pair_osm))
        np.maximum.at(best, p, conf)
        best[~pair_named] = 0
        rivals = np.where(named, np.bincount(pair_osm, best, o.max() + 1)[o] - best[p], 0.0)
        total = conf + np.maximum(l_sum - conf, 0) + np.maximum(rivals, 0)
        growth = np.log(sim / total)
        rest = (np.abs(growth) < STILL) | ((conf < GONE) & (growth < 0))
        conf = conf * sim / total
        turn += 1
        if turn % 8:
            continue
        moving = np.zeros(c.max() + 1)
        np.maximum.at(moving, c, np.where(rest, 0.0, np.abs(growth)))
        fast = np.zeros(c.max() + 1)
        np.maximum.at(fast, c, np.where(conf < GONE, 0.0, np.abs(growth)))
        many = np.where((moving > 0) & (fast < 0.01), 0.1 / np.maximum(fast, STILL), 0.0)[c]
        conf = np.maximum(conf * np.exp(np.clip(many * growth, -20, 0.1)), 1e-200)
        done = moving[c] == 0
        if done.any():
            out[at[done]] = conf[done]
            at, conf, codes = at[~done], conf[~done], None
    return out


def _propagate(edges: DataFrame) -> DataFrame:
    """Rounds of competition between edges that share an end, until they are stable.

    Schools of one name (one ``name_key``) are not each other's rivals for an object; nodes
    without a name claim nothing against others. A component is settled in one task.
    """
    edges = materialise(edges)
    # an object's links go through its first school, so a crowded one has no square of links
    first = edges.groupBy("osm").agg(F.min("lid").alias("hub"))
    links = edges.join(first, "osm").select(F.col("lid").alias("a"), F.col("hub").alias("b"))
    labels = components(links, edges.select(F.col("lid").alias("node")).distinct())
    whole = edges.join(labels.withColumnRenamed("node", "lid"), "lid").repartition("component").sortWithinPartitions("component", "lid", "osm")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def settled(e: pd.DataFrame) -> pd.DataFrame:
            name = pd.factorize(e["name_key"])[0]
            conf = settle(e["lid"].to_numpy(), e["osm"].to_numpy(), name, e["s"].to_numpy(float), e["component"].to_numpy())
            return e[["lid", "osm", "name_key", "dist_m", "s"]].assign(conf=conf)

        # the last component of a batch may go on in the next one
        held: list[pd.DataFrame] = []
        for b in batches:
            last = b["component"].iloc[-1] if len(b) else None
            tail = (b["component"] == last).to_numpy()
            if len(b) and (not tail.all() or held and held[-1]["component"].iloc[-1] != last):
                yield settled(pd.concat([*held, b[~tail]]))
                held = []
            held.append(b[tail])
        if held:
            yield settled(pd.concat(held))

    whole = whole.withColumn("name_key", F.col("name_key").cast("string"))
    out = whole.select("lid", "osm", "name_key", "dist_m", "s", "component").mapInPandas(run, "lid long, osm long, name_key string, dist_m double, s double, conf double")
    return materialise(out.withColumn("name_key", F.col("name_key").cast("long")))


def match(register: DataFrame, objects: DataFrame) -> DataFrame:
    """``row_id``, ``osm_id`` and ``confidence`` of each matched pair.

    ``register`` has row_id, name, zip, school_type, latitude and longitude as text;
    ``objects`` osm_id, name, subcategory, lat and lon. Rows without usable coordinates
    match nothing; every other row of a matched school has the pair, wherever its own
    coordinates are. A school gets at most one object; ties go to the nearer, then the
    smaller id. Rows without a name match by kind and place only, and never keep an object
    from others. Repeated objects count once; empty tables give none. Extra columns are
    ignored.
    """
    rows = register.select("row_id", "name", "zip", "school_type", text.usable_lat(F.col("latitude")).alias("lat"), text.usable_lon(F.col("longitude")).alias("lon"))
    coded = variants.encode_records(rows.select("row_id", "name", "zip"), {"name": text.word_bag, "zip": text.zip5}).select("row_id", "code")
    lids = coded.join(variants.groups(coded, "row_id").select("code", F.col("keep").alias("lid")), "code").select("row_id", "lid")
    members = rows.where(F.col("lat").isNotNull() & F.col("lon").isNotNull()).join(lids, "row_id", "left")
    members = materialise(members.withColumn("lid", F.coalesce("lid", "row_id")))
    right = objects.groupBy("osm_id").agg(F.max(F.struct(F.col("name").isNotNull(), "name", "subcategory", "lat", "lon")).alias("o"))
    right = materialise(right.select(F.col("osm_id").alias("osm"), "o.name", "o.subcategory", "o.lat", "o.lon"))
    left = members.groupBy("lid").agg(F.min("name").alias("name"), F.min(text.known(F.col("school_type"))).alias("school_type"))

    names = materialise(name_features(left.select("name").unionByName(right.select("name"))))
    held = left.select("name").unionByName(right.select("name")).join(names, "name").select(F.explode(F.array_distinct("words")).alias("word"))
    seen = held.groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    total = F.lit(float(max(1, left.count() + right.count())))
    weighed = names.select("name", F.explode("words").alias("word")).join(seen, "word")
    weighed = weighed.groupBy("name").agg(F.collect_list(F.struct("word", (F.log(total / F.col("df")) + 0.1).alias("idf"))).alias("words"))
    features = materialise(names.select("name", "kind", "branch").join(weighed, "name", "left"))

    spots = within_distance(members.select("lid", "lat", "lon"), right.select("osm", "lat", "lon"), "lid", "osm", REACH_M)
    l_places = members.select("lid", "lat", "lon").join(left.select("lid", "name"), "lid").join(features.select("name", "words"), "name").drop("name")
    by_word = sharing_words(l_places, right.select("osm", "lat", "lon", "name").join(features.select("name", "words"), "name").drop("name"))
    edges = spots.unionByName(by_word).groupBy("lid", "osm").agg(F.min("dist_m").alias("dist_m"))
    l_side = left.join(features, "name", "left").select("lid", F.col("words").alias("l_words"), F.col("branch").alias("l_branch"), F.coalesce("kind", _kind_of(F.col("school_type"), REGISTER_KINDS, True)).alias("l_kind"), F.when(F.size("words") > 0, F.xxhash64(F.array_sort(F.transform("words", lambda w: w["word"])), "kind")).alias("name_key"))
    r_side = right.join(features, "name", "left").select("osm", F.col("words").alias("r_words"), F.col("branch").alias("r_branch"), F.col("kind").alias("r_kind"), _kind_of(F.col("subcategory"), MAP_KINDS, False).alias("map_kind"))
    both = edges.join(l_side, "lid").join(r_side, "osm").where((F.col("dist_m") <= REACH_M) | (F.col("l_branch") == F.col("r_branch"))).drop("l_branch", "r_branch")
    scored = _scored(both).where("s > 0")
    average = lambda c: F.avg("weight").over(Window.partitionBy(c))
    pruned = scored.withColumns({"l_avg": average("lid"), "r_avg": average("osm")}).where("weight >= l_avg - 1e-9 or weight >= r_avg - 1e-9")
    settled = _propagate(pruned.select("lid", "osm", "name_key", "dist_m", "s"))
    best_first = [F.col("conf").desc(), F.col("dist_m"), F.col("osm")]
    ranked = settled.where(F.col("conf") >= ACCEPT).withColumn("k", F.row_number().over(Window.partitionBy("lid").orderBy(*best_first)))
    ranked = ranked.where("k = 1").withColumn("top", F.max(F.when(F.col("name_key").isNotNull(), F.struct(F.col("conf"), -F.col("dist_m"), "name_key"))).over(Window.partitionBy("osm")))
    kept = ranked.where(F.col("name_key").isNull() | (F.col("top.name_key") == F.col("name_key")))
    return members.select("row_id", "lid").join(kept.select("lid", "osm", "conf"), "lid").select("row_id", F.col("osm").alias("osm_id"), F.round("conf", 4).alias("confidence"))
