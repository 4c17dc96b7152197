"""Leakage, template residue and packing."""

import random

import pytest
from pyspark.sql import functions as F

from hexloom.llm import classify, leakage, packing, queries, residue


def brute(docs, items, n):
    grams = {i: {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} for i, t in items if (w := leakage.fold_words(t))}
    out = set()
    for d, t in docs:
        w = leakage.fold_words(t)
        own = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}
        out |= {(d, i) for i, g in grams.items() if g & own}
    return out


@pytest.mark.parametrize("window, shingle, vocabulary", [(20, 5, 400), (8, 3, 12), (6, 5, 4)])
def test_leaks_equal_brute_force(spark, window, shingle, vocabulary):
    rnd = random.Random(window)
    word = lambda: f"w{rnd.randrange(vocabulary)}"
    items = [(i, " ".join(word() for _ in range(rnd.choice([window - 1, 40, 60])))) for i in range(25)] + [(98, None), (99, "")]
    docs = []
    for d in range(120):
        t = [word() for _ in range(rnd.randint(0, 150))]
        if rnd.random() < 0.5:
            w = rnd.choice(items[:25])[1].split()
            a = rnd.randrange(max(1, len(w) - window))
            piece = w[a : a + rnd.choice([window - 1, window, window + 7])]
            t[len(t) // 2 : len(t) // 2] = [x.upper() if rnd.random() < 0.3 else x for x in piece]
        docs.append((d, rnd.choice([" ", "\n", " – "]).join(t)))
    docs += [(900, None), (901, ""), (902, docs[0][1])]
    D = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"item": F.lit(1), "h": F.lit(2), "words": F.lit(3)})
    I = spark.createDataFrame(items + items[:3], "item_id long, text string").withColumn("doc", F.lit("clash"))
    got = leakage.leaked_passages(D, I, window=window, shingle=shingle).collect()
    want = brute(docs, items, window)
    assert {(r.doc_id, r.item_id) for r in got} == want and len(got) == len(want)
    assert all(r["words"] >= window for r in got)


def test_filters_of_many_keys(spark):
    keys = [random.Random(i).getrandbits(64) - 2**63 for i in range(5000)]
    df = spark.createDataFrame([(k,) for k in keys], "h long")
    import numpy as np

    h = np.array(keys, np.int64).view(np.uint64)
    strange = np.array([random.Random(10**6 + i).getrandbits(64) for i in range(1, 20_000)], np.uint64)
    for most, count in ((10**6, 1), (1000, 5)):
        blooms = leakage.blooms_of(df, "h", most)
        assert len(blooms) == count and len(leakage._any_hits(blooms, h)) == len(h)
        assert len(leakage._any_hits(blooms, strange)) < 0.01 * len(strange)


def test_leaks_empty_and_long(spark):
    item = " ".join(f"v{i}" for i in range(30))
    I = spark.createDataFrame([(1, item)], "item_id long, text string")
    D = spark.createDataFrame([(1, "x " * 200_000 + item)], "doc_id long, text string")
    assert [(r.doc_id, r.item_id, r["words"]) for r in leakage.leaked_passages(D, I).collect()] == [(1, 1, 30)]
    assert leakage.leaked_passages(D.limit(0), I).count() == 0
    assert leakage.leaked_passages(D, I.limit(0)).count() == 0


ORDINARY = "Die Kammer folgt der Klägerin. J. Harbeck legte am 3. Mai 2001 Berufung ein. [geschwärzt] gegen [...] – Beklagte, M. K. und S***. Vorsitz: █████"


@pytest.fixture(scope="module")
def model(spark, sf):
    return residue.fit(residue.sampled(residue.mine(spark.read.parquet(f"{sf}/documents.parquet"))[1]))


def kinds_of(model, text):
    u = residue.unquoted(text)
    judge = residue.Judge(model)
    told = {judge.verdict(residue.skeleton(m)) for m in residue.messages(u)} - {None}
    return ["slot"] * residue.has_slot(u) + sorted(told)


@pytest.mark.parametrize(
    "text, kinds",
    [
        (ORDINARY, []),
        ("", []),
        ("Die Meldung „Internal server error. Bitte {{ name }} warten“ war zu sehen.", []),
        ("The website showed nothing but the message “This viewer needs scripts. Your browser blocks them”, a defect.", []),
        ('Exhibit “{"status": 500, "error": "timeout"}” was read.', []),
        ("The clerk opened “exhibit A.\n\nInternal Server Error\n\nThe witness then left “the house", ["error_page"]),
        (ORDINARY + " Az. {{ aktenzeichen }} 3", ["slot"]),
        (ORDINARY + " <Anschrift eintragen> 3", ["slot"]),
        (ORDINARY + " &headnote; 3 R&D; &amp; x", ["slot"]),
        (ORDINARY + " &amp; AT&T 5 % 3", []),
        ("Court of %s\nOrder", ["slot"]),
        ("The claimant is [party name].", ["slot"]),
        ("Order (Nichtzutreffendes streichen) of", ["slot"]),
        ("Landgericht Elmenau\nBitte aktivieren Sie JavaScript, um die Entscheidung zu lesen.", ["script_notice"]),
        ("Court of Holm Case no. 3 U 1/02 404 - the page you asked for does not exist", ["error_page"]),
        ('{"status": 500, "fehler": "timeout", "id": "1f54c5f"}', ["error_page"]),
        ("Court\nNunc magna turpis lorem cursus nibh rutrum.", ["filler"]),
        ("Court\nxxx xxxx xxxxx xxx xx", ["filler"]),
        ("Sample text for layout purposes. {0}", ["slot", "filler"]),
        ("Sorry, we can't find that page.", ["error_page"]),
        ("The requested resource is temporarily offline. Try again shortly.", ["error_page"]),
        ("Diese Seite existiert leider nicht mehr.", ["error_page"]),
        ("Please turn on scripting to continue", ["script_notice"]),
        ("Der Kläger nutzte ein Skript.", []),
        ("Der Zugriff verweigert worden sei, trug die Klägerin vor", []),
        ("He found the access denied by the landlord", []),
        ("The defendant's server error caused a database error in the ledger.", []),
        ("The court said that cookies and data", []),
    ],
)
def test_residue_of_one(model, text, kinds):
    assert kinds_of(model, text) == kinds


def test_extras_of_each_tail():
    # by definition, tail by tail, which is quadratic
    def whole(words):
        words = [w for w in words if w]
        letters = [w for w in words if not w.isdigit()]
        again = 1 - len(set(words)) / len(words) if len(words) >= 3 else 0
        out = [f"e again {b}" for b in range(2, 6) if again >= b / 6]
        out += ["e thrice"] if any(a == b == c for a, b, c in zip(words, words[1:], words[2:])) else []
        return out + (["e one letter"] if len(letters) >= 3 and sum(len(set(w)) == 1 < len(w) for w in letters) >= 0.6 * len(letters) else [])

    rnd = random.Random(10)
    for n in [*range(9), 63, 64, 65, 66, 200]:
        for _ in range(20):
            words = [rnd.choice(["", "0", "xxx", "zz", "a", "der", "klage", *map(str, range(rnd.choice([1, 40])))]) for _ in range(n)]
            assert classify.extras(words) == [tuple(whole(words[i:])) for i in range(n)]


PLAIN = "die kammer folgt der klägerin nicht weil sie den vortrag zu spät und ohne jeden beleg gehalten hat".split()


@pytest.mark.parametrize("tail", ["qqqq qqqq qqqq qqqq", "inhalt inhalt inhalt", "folgt name folgt name folgt name"])
def test_tail_counts_alike_in_messages_of_any_length(model, tail):
    assert kinds_of(model, tail) == ["filler"]
    for n in (5, 12, 17, 58, 59, 60, 61, 63, 64, 65, 200, 5000):
        plain = [PLAIN[i % len(PLAIN)] for i in range(n)]
        assert kinds_of(model, " ".join([*plain, "3"])) == []
        assert kinds_of(model, " ".join([*plain, "3", tail])) == ["filler"]


def test_wordings_unseen(spark):
    # of a corpus large enough to sample from; that of the other tests has a hundred texts
    got = {r.part: r for r in queries.p10_heldout(spark, "/root/testdata/sf0.01").collect()}
    assert got["development"].precision >= 0.9 and got["development"].recall >= 0.9
    assert got["held_out"].cases > 40 and got["held_out"].precision >= 0.9 and got["held_out"].recall >= 0.9


def test_no_wording_stands_twice():
    from hexloom.llm import examples as x

    parts = [x.TRAINING + x.FIELDS, x.DEVELOPMENT + x.DEVELOPMENT_FIELDS, x.HELD_OUT + x.HELD_OUT_FIELDS]
    seen = [{t.lower() for t, _ in p} for p in parts]
    assert not seen[0] & seen[1] and not seen[0] & seen[2] and not seen[1] & seen[2]


def test_residue_whole(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    more = [(10**9, None), (10**9 + 1, ""), (10**9 + 2, "Zugriff verweigert. Vorgangsnummer 4a26b49"), (10**9 + 2, "Zugriff verweigert. Vorgangsnummer 4a26b49"), (10**9 + 3, "wort " * 100_000 + "{{ x }}"), (None, "Internal Server Error")]
    both = docs.unionByName(spark.createDataFrame(more, "doc_id long, text string")).withColumns({"h": F.lit(1), "row": F.lit("clash"), "key": F.lit(2)})
    results = [sorted((r.doc_id or -1, tuple(r.kinds)) for r in residue.residue(d).collect()) for d in (both, both.repartition(5, "text"))]
    assert results[0] == results[1]
    found = [k for k, _ in results[0]]
    assert found.count(10**9 + 2) == 2 and {-1, 10**9 + 3} <= set(found) and not {10**9, 10**9 + 1} & set(found)
    assert 5 < len(found) < 0.1 * both.count()
    assert residue.residue(both.limit(0)).count() == 0


def test_words_for_residue_are_no_wildcards(spark):
    rows = [(1, "Die Begründung wird nachgereicht."), (2, "Die Klage wird abgewiesen."), (3, "Die Klage wird verhandelt.")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for n in (1, 3):
        assert [(r.doc_id, r.kinds) for r in residue.residue(docs.repartition(n)).collect()] == [(1, ["filler"])]


def test_prefix_tree():
    tree = residue.PrefixTree()
    ids = [tree.add(t.split(), 1, t) for t in ("the witness stated on 0 that it rained hard", "the witness stated on 0 that she snowed hard", "the server stated on 0 that it snowed hard")]
    assert ids[0] == ids[1] != ids[2] and tree.templates[ids[0]][-2] == residue.WILD and tree.counts == [2, 1]


def test_histogram_packing():
    rnd = random.Random(1)
    counts = {}
    for _ in range(5000):
        n = max(1, min(2048, int(rnd.lognormvariate(6, 1))))
        counts[n] = counts.get(n, 0) + 1
    patterns = packing.pack_histogram(counts, 2048)
    held = {}
    for n, p in patterns:
        assert sum(p) <= 2048
        for x in p:
            held[x] = held.get(x, 0) + n
    assert held == counts
    used = sum(k * v for k, v in counts.items()) / (2048 * sum(n for n, _ in patterns))
    assert used > 0.97
    assert packing.pack_histogram({3: 10}, 10) == [(3, [3, 3, 3]), (1, [3])] and packing.pack_histogram({}, 10) == []
    with pytest.raises(ValueError):
        packing.pack_histogram({11: 1}, 10)


def test_pack(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.choice([7, 7, 7, rnd.randint(1, 60), 250, None, 0])) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, n int").withColumns({"size": F.lit(1), "part": F.lit(2), "container": F.lit("clash")})
    got = packing.pack(df, 100, "doc_id", "n", spread=7).toPandas()
    total = got.groupby("container")["size"].sum()
    assert total.max() <= 100 and total.sum() == sum(n or 0 for _, n in rows)
    assert total.sum() / (len(total) * 100) > 0.98
    by_doc = got.sort_values("part").groupby("doc_id")
    for i, n in rows:
        part = by_doc.get_group(i)
        assert part["size"].sum() == (n or 0) and len(part) == max(1, -(-(n or 0) // 100))
        assert part["start"].tolist() == [100 * k for k in range(len(part))]
    assert sorted(total.index) == list(range(len(total)))
    again = packing.pack(df.repartition(5, "n"), 100, "doc_id", "n", spread=7).toPandas()
    order = ["doc_id", "part"]
    assert got.sort_values(order)["container"].tolist() == again.sort_values(order)["container"].tolist()
    whole = packing.filled(packing.pack(df, 100, "doc_id", "n", spread=7), 100).collect()[0]
    assert (whole.containers, whole.units, whole.overfull) == (len(total), total.sum(), 0) and whole.fill > 0.98
    assert packing.filled(packing.pack(df.limit(0), 100, "doc_id", "n"), 100).collect()[0].fill is None
    assert packing.pack(df.limit(0), 100, "doc_id", "n").count() == 0
    with pytest.raises(ValueError):
        packing.pack(df, 0, "doc_id", "n")


def test_token_counts(spark, sf):
    import base64

    import tiktoken
    from public_tokenizers import PATTERN

    with open(queries.TOKENIZER, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("x", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    texts += ["", " ", "a b c", "x\x1cy \x85", "½ ² Ⅷ ٣", "日本語 текст", "it's  we'll\n\n\n x_y__z", "😀 é", "DON'T  'S", "  ", "a" * 5000]
    df = spark.createDataFrame(list(enumerate(texts)) + [(-1, None)], "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in packing.token_lengths(df, queries.TOKENIZER).collect()}
    assert got.pop(-1) == 0
    assert got == {i: len(enc.encode_ordinary(t)) for i, t in enumerate(texts)}
