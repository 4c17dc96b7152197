"""Formatting variants, survivorship and matching."""

import datetime as dt
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from hexloom.functions import text
from hexloom.llm import linkage, survivorship, variants

FIELDS = {"name": text.word_bag, "zip": text.zip5}


def pairs(df, key="id"):
    return sorted((r.keep, r.dup) for r in variants.duplicates(variants.encode_records(df, FIELDS), key).collect())


def test_variants(spark):
    rows = [(1, "Grundschule „Groß“", "D 04100"), (2, "GROSS grundschule", "04100.0"), (3, "gross,  Grundschule", "041 00 x"), (4, "gross gross grundschule", "04100"), (5, "Grundschule Groß", "4100"), (6, None, "04100"), (7, "–", "04100"), (8, "März", "11111"), (9, "MÄRZ", "11111"), (9, "MÄRZ", "11111")]
    df = spark.createDataFrame(rows, "id long, name string, zip string").withColumns({"code": F.lit("clash"), "raw": F.lit(1), "canon": F.lit(2)})
    assert pairs(df) == [(1, 2), (1, 3), (8, 9), (8, 9)]
    swapped = variants.encode_records(df, dict(reversed(FIELDS.items())))
    assert sorted((r.keep, r.dup) for r in variants.duplicates(swapped, "id").collect()) == [(1, 2), (1, 3), (8, 9), (8, 9)]
    got = {r.keep: (r.copies, r["name"]) for r in variants.collapse(variants.encode_records(df, FIELDS), "id", ["name", "zip"]).collect()}
    assert got[1] == (3, "Grundschule „Groß“") and got[8][0] == 3 and got[4][0] == 1 and len(got) == 3
    assert pairs(df.limit(0)) == []


def test_variants_against_brute_force(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(900):
        w = ["ab", "cd", "ef"][: rnd.randint(1, 3)] if rnd.random() < 0.66 else ["hot"]
        rnd.shuffle(w)
        rows.append((i, rnd.choice([" ", "-", ", "]).join(x.upper() if rnd.random() < 0.5 else x for x in w), rnd.choice(["12345", "1-2345", "1234567", "99999"])))
    groups = defaultdict(list)
    for i, n, z in rows:
        groups[text._bag(n), "".join(c for c in z if c.isdigit())[:5]].append(i)
    want = sorted((min(g), x) for g in groups.values() for x in g if x != min(g))
    assert pairs(spark.createDataFrame(rows, "id long, name string, zip string")) == want


def test_survivors(spark):
    t = lambda d: dt.datetime(2024, 1, d)
    rows = [(1, "g", "s1", None, "a"), (2, "g", "s1", t(1), None), (3, "g", None, t(9), "c"), (4, "g", "s1", t(1), "d"), (5, "g", "zz", t(9), "e"), (6, "h", None, None, None)]
    df = spark.createDataFrame(rows, "id long, g string, source string, at timestamp, v string").withColumn("first", F.lit("clash"))
    sources = spark.createDataFrame([("s1", 2), ("s1", 1)], "source string, trust int")
    attrs = {"v": (F.col("v").isNotNull(), F.col("v")), "all": (F.lit(True), F.col("id"))}
    best = survivorship.survivors(survivorship.with_trust(df, sources), "g", "id", "at", attrs)
    got = {(r["first"], r.fld): r.source_key for r in survivorship.provenance(best, ["v", "all"]).collect()}
    assert got == {(1, "v"): 4, (1, "all"): 2, (6, "all"): 6}
    assert {r.g: r["size"] for r in best.collect()} == {"g": 5, "h": 1}
    assert best.where("g = 'g'").first()["v"]["value"] == "d"
    nobody = survivorship.survivors(survivorship.with_trust(df, sources.limit(0)), "g", "id", "at", attrs).where("g = 'g'").first()
    assert nobody["v"]["source_key"] == 3
    assert survivorship.survivors(survivorship.with_trust(df.limit(0), sources), "g", "id", "at", attrs).count() == 0


@pytest.mark.parametrize("a, b, want", [("abcd", "abcd", 0), ("abcd", "abdc", 1), ("abcd", "abc", 1), ("abcd", "xbcdy", 2), ("abcd", "wxyz", 3)])
def test_distance(a, b, want):
    assert linkage.distance(a, b, 2) == want


@pytest.mark.parametrize("name, kind, words", [("Städt. GS Lutz-Buchried", "grund", ["lutz", "buchried"]), ("Realsch. am Weg", "real", ["weg"]), ("Föredrschule X Haus", "foerder", ["x", "haus"]), ("Bohnheimgrundschule", "grund", ["bohnheim"]), ("Schule", None, ["schule"]), (None, None, [])])
def test_read_name(name, kind, words):
    got = linkage.read_name(name)
    assert got[1] == kind and ([w for w in got[0] if w != "schule"] == [w for w in words if w != "schule"])


def test_match(spark):
    R = "row_id long, name string, zip string, school_type string, latitude string, longitude string, osm_id int"
    reg = [
        (1, "Grundschule Lutz Buchried", "11111", "Grundschule", "50.0", "10.0", 0),
        (2, "LUTZ-BUCHRIED Grundschule", "11111", None, "52.0", "12.0", 0),  # its own place is wrong, its group's is not
        (3, "Gymnasium Lutz Buchried", "11111", "Gymnasium", "50,0004", "10,0", 0),
        (4, "Realschule Amsel", "11111", "Realschule", "50.0", "10.0005", 0),
        (5, "Grundschule Lutz Buchried", "11111", None, None, None, 0),
        (6, None, None, "Realschule", "50.0", "10.0005", 0),
        (7, "Oberschule Fern", "22222", "Oberschule", "51.0", "11.0", 0),
    ]
    O = "osm_id long, name string, subcategory string, lat double, lon double, row_id int"
    osm = [(91, "GS L. Buhcried", "grundschule", 50.0003, 10.0, 0), (92, "Gymn. Lutz-Buchried", "other", 50.0, 10.0003, 0), (93, None, "realschule", 50.0, 10.0004, 0), (94, "Oberschule Fern", "oberschule", 51.3, 11.0, 0), (91, "GS L. Buhcried", "grundschule", 50.0003, 10.0, 0), (95, "Schule", "other", float("nan"), None, 0)]
    got = linkage.match(spark.createDataFrame(reg, R), spark.createDataFrame(osm, O)).collect()
    assert sorted((r.row_id, r.osm_id) for r in got) == [(1, 91), (2, 91), (3, 92), (4, 93), (6, 93)]
    assert all(0 < r.confidence <= 1 for r in got)
    empty = linkage.match(spark.createDataFrame(reg, R).limit(0), spark.createDataFrame(osm, O).limit(0))
    assert empty.count() == 0


def test_far_rows_meet_by_their_words(spark):
    reg = [(1, "Grundschule Nelda-Jägerfleth Premsrode", "11111", "Grundschule", "50.0", "10.0"), (2, "Schillergymnasium", "11111", "Gymnasium", "50.02", "10.0")]
    osm = [
        (11, "GS Nelda Jaegerfleth Premsrode", "grundschule", 50.0045, 10.0),  # 500 m off
        (12, "Grundschule Falko Premsrode", "grundschule", 50.006, 10.0),
        (13, "Schillergymnasium", "gymnasium", 50.3, 10.0),  # 31 km off
        (14, None, "grundschule", 50.0045, 10.0),
    ]
    R, O = "row_id long, name string, zip string, school_type string, latitude string, longitude string", "osm_id long, name string, subcategory string, lat double, lon double"
    got = linkage.match(spark.createDataFrame(reg, R), spark.createDataFrame(osm, O)).collect()
    assert [(r.row_id, r.osm_id) for r in got] == [(1, 11)]


def test_prefix_words_are_enough(spark):
    rnd = random.Random(9)
    rows = []
    for i in range(200):
        rows.append((i, [(f"w{k}", rnd.uniform(0.1, 9.0)) for k in range(rnd.randint(1, 6))]))
    df = spark.createDataFrame(rows, "id long, words array<struct<word string, idf double>>")
    for r in df.select("id", "words", linkage.prefix(F.col("words")).alias("p")).collect():
        total, rest = sum(w.idf for w in r["words"]), [w for w in r["words"] if w.word not in r.p]
        assert sum(w.idf for w in rest) < 0.5 * total and r.p
        # nor is it longer than needed
        last = min((w for w in r["words"] if w.word in r.p), key=lambda w: w.idf)
        assert sum(w.idf for w in rest) + last.idf >= 0.5 * total - 1e-9



E = "lid long, osm long, name_key long, dist_m double, s double"


@pytest.mark.parametrize("sims", [(0.85, 0.83, 0.83), (0.85, 0.83, 0.83, 0.83), (0.85, 0.849999), (0.6, 0.59, 0.59, 0.59, 0.59)])
def test_rounds_go_on_until_stable(spark, sims):
    edges = [(1, 10 + i, 7, 5.0, s) for i, s in enumerate(sims)] + [(50, 60, 8, 5.0, 0.9)]
    got = {r.osm: r.conf for r in linkage._propagate(spark.createDataFrame(edges, E)).collect()}
    assert got[10] == pytest.approx(sims[0], abs=1e-4) and got[60] == pytest.approx(0.9)
    assert all(got[10 + i] < 1e-4 for i in range(1, len(sims)))


def test_settled_as_by_plain_rounds():
    rnd = random.Random(4)
    edges = [(c * 100 + lid, c * 100 + osm, rnd.choice([-1, c * 9 + lid % 2]), rnd.uniform(0.4, 0.95)) for c in range(8) for lid in range(3) for osm in range(3) if rnd.random() < 0.6]
    names = {}
    edges = [(a, b, names.setdefault(a, n), s) for a, b, n, s in edges]
    conf = [e[3] for e in edges]
    for _ in range(1500):
        new = []
        for (a, b, n, s), x in zip(edges, conf):
            best = {}
            for (_, b2, n2, _), y in zip(edges[:0] if n < 0 else edges, conf):
                if b2 == b and n2 >= 0:
                    best[n2] = max(best.get(n2, 0), y)
            left = sum(y for (a2, *_), y in zip(edges, conf) if a2 == a)
            new.append(s * x / (left + sum(y for m, y in best.items() if m != n)))
        moved = max(abs(x - y) for x, y in zip(new, conf))
        conf = new
        if moved < 1e-10:
            break
    lid, osm, name, s = map(np.array, zip(*edges))
    assert linkage.settle(lid, osm, name, s, lid // 100) == pytest.approx(conf, abs=1e-3)
