"""Held-out passages inside a corpus, by a prefix-filtered set join on word shingles.

A passage of ``window`` words that stands in a text brings all its shingles along, so it
is enough to look for one of them: the one that is rarest in the corpus. One pass over the
corpus counts the items' shingles (only counts are shuffled); each window of an item then
keeps its rarest shingle, and windows whose rarest shingle never occurs are done with. A
second pass finds the kept shingles, and takes along the words around each hit up to the
bound that the shingle's place in its windows allows; the join verifies those words.

What each task needs to know of the items is bit arrays of bounded size (Bloom filters of at
most 32 MB, one for every 16 million shingles of items); nothing that is sent to the tasks
grows with the corpus. False hits only cost rows, as the join on the exact hash follows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F, Window

from ..functions.text import fold
from ..session import materialise

_WORD = re.compile(r"[^\W_]+")
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MAX_BITS = 1 << 28
_PROBES = 6


class _Ids(dict):
    """64-bit hash of each word, computed when first seen."""

    def __missing__(self, word: str) -> int:
        h = xxhash.xxh64_intdigest(word) | 1
        if len(self) < 2_000_000:
            self[word] = h
        return h


def fold_words(text: str | None) -> list[str]:
    return _WORD.findall(fold(text)) if isinstance(text, str) else []


def shingle_hashes(ids: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words."""
    n = len(ids) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(size):
            h = (h ^ ids[i : i + n]) * _MIX
            h ^= h >> np.uint64(29)
    return h


class Bloom:
    """Six bits a key in an array of a power of two of bits, 16 to 32 bits a key: about one
    in a thousand strange keys or fewer passes."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.mask = np.uint64(len(words) * 64 - 1)

    @staticmethod
    def size(keys: int) -> int:
        return min(_MAX_BITS, max(1 << 12, 1 << (16 * keys - 1).bit_length() if keys else 0))

    def hits(self, h: np.ndarray) -> np.ndarray:
        """Places of the hashes that may be among the keys."""
        at = np.arange(len(h))
        step = (h >> np.uint64(32)) | np.uint64(1)
        for i in range(_PROBES):
            with np.errstate(over="ignore"):
                place = (h[at] + np.uint64(i) * step[at]) & self.mask
            at = at[(self.words[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1]
            if not len(at):
                break
        return at


def bloom_of(keys: DataFrame, column: str, count: int) -> Bloom:
    """The filter of ``count`` hashes; its parts are put together before the driver, which
    holds at most 32 MB of them."""
    bits = Bloom.size(count)
    h = F.col(column)
    step = F.shiftrightunsigned(h, 32).bitwiseOR(F.lit(1))
    # only the low bits count, so the sums may run over
    places = [(h.bitwiseAND(F.lit(bits - 1)) + F.lit(i) * step.bitwiseAND(F.lit(bits - 1))).bitwiseAND(F.lit(bits - 1)) for i in range(_PROBES)]
    parts = keys.select(F.explode(F.array(*places)).alias("p")).groupBy(F.shiftright("p", 6).alias("i")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("w"))
    words = np.zeros(bits // 64, np.uint64)
    got = parts.toPandas()
    words[got.i.to_numpy()] = got.w.to_numpy().astype(np.int64).view(np.uint64)
    return Bloom(words)


def blooms_of(keys: DataFrame, column: str, most: int = _MAX_BITS // 16) -> list[Bloom]:
    """Filters of the distinct hashes of a column, as many as keep each within ``most`` keys:
    more keys mean more passes, never a filter that lets everything through."""
    distinct = materialise(keys.select(column).distinct())
    count = distinct.count()
    parts = max(1, -(-count // most))
    if parts == 1:
        return [bloom_of(distinct, column, count)]
    part = F.pmod(F.xxhash64(column), F.lit(parts))
    return [bloom_of(distinct.where(part == i), column, -(-count // parts)) for i in range(parts)]


def _text_hashes(batch: pd.DataFrame, get, size: int) -> Iterator[tuple[int, list[str], np.ndarray]]:
    for i, t in enumerate(batch.t):
        words = fold_words(t)
        if len(words) >= size:
            yield i, words, shingle_hashes(np.fromiter(map(get, words), np.uint64, len(words)), size)


def _item_shingles(items: DataFrame, size: int) -> DataFrame:
    kind = items.schema["item"].dataType.simpleString()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        get = _Ids().__getitem__
        for b in batches:
            for i, words, h in _text_hashes(b, get, size):
                yield pd.DataFrame({"item": b["item"].iloc[i], "pos": np.arange(len(h)), "h": h.view(np.int64), "n": len(words)})

    return items.mapInPandas(cut, f"item {kind}, pos long, h long, n long")


def _counts(docs: DataFrame, blooms: list[Bloom], keys: DataFrame, size: int) -> DataFrame:
    """How often each of the hashes ``keys`` stands in the texts. What the filters let through
    besides is dropped where the keys arrive."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        get, total = _Ids().__getitem__, {}
        for b in batches:
            for _, _, h in _text_hashes(b, get, size):
                for k in h[_any_hits(blooms, h)].view(np.int64).tolist():
                    total[k] = total.get(k, 0) + 1
            if len(total) > 500_000:
                yield pd.DataFrame(total.items(), columns=["h", "c"])
                total = {}
        yield pd.DataFrame(list(total.items()), columns=["h", "c"]).astype("int64")

    each = docs.select("t").mapInPandas(count, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))
    return each.join(keys.select("h").distinct(), "h", "left_semi")


def _any_hits(blooms: list[Bloom], h: np.ndarray) -> np.ndarray:
    if len(blooms) == 1:
        return blooms[0].hits(h)
    return np.unique(np.concatenate([b.hits(h) for b in blooms]))


def leaked_passages(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", window: int = 20, shingle: int = 5) -> DataFrame:
    """``doc_id``, ``item_id`` and ``words`` (the longest run met) of each leak, once each.

    A leak is a run of at least ``window`` consecutive words of the item that stands
    consecutively in the text; words are unbroken runs of letters and digits, compared by
    full case folding. Items under ``window`` words, NULL and empty texts match nothing.
    Texts are read whole. Repeated documents each report; repeated item rows give one.
    """
    reach = window - shingle
    d = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("t")).where(F.col("t").isNotNull())
    it = items.select(F.col(item_id).alias("item"), F.col(text).alias("t")).where(F.col("t").isNotNull()).dropDuplicates()
    it = it.withColumn("copy", F.xxhash64("t"))
    doc_kind, item_kind = d.schema["doc"].dataType.simpleString(), it.schema["item"].dataType.simpleString()
    single = it.select(F.struct("item", "copy").alias("item"), "t")
    # items are cut by (item, copy), so that two texts under one id stay apart
    cut = _item_shingles(single.select(F.to_json("item").alias("item"), "t"), shingle).where(F.col("n") >= window)
    cut = materialise(cut)
    common = materialise(_counts(d, blooms_of(cut, "h"), cut, shingle))
    by_window = Window.partitionBy("item").orderBy("pos").rowsBetween(0, reach)
    ranked = cut.join(common, "h", "left").select("item", "pos", "h", "n", F.coalesce("c", F.lit(0)).alias("c"))
    least = F.min(F.struct("c", "pos", "h")).over(by_window)
    prefix = ranked.withColumn("m", least).where(F.col("pos") <= F.col("n") - window).where(F.col("m.c") > 0)
    prefix = materialise(prefix.select("item", F.col("m.pos").alias("pos"), F.col("m.h").alias("h")).distinct())
    blooms = blooms_of(prefix, "h")

    def around(words: list[str], at: int) -> tuple[str, str, str]:
        left, right = words[max(0, at - reach) : at], words[at + shingle : at + shingle + reach]
        return " ".join(reversed(left)), " ".join(words[at : at + shingle]), " ".join(right)

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        get = _Ids().__getitem__
        for b in batches:
            out = []
            for i, words, h in _text_hashes(b, get, shingle):
                at = _any_hits(blooms, h)
                if len(at):
                    key = b["doc"].iloc[i]
                    out += [(int(k), key, *around(words, p)) for p, k in zip(at.tolist(), h[at].view(np.int64))]
            if out:
                yield pd.DataFrame(out, columns=["h", "doc", "left", "mid", "right"])

    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for item, t, places in zip(b["item"], b.t, b.places):
                words = fold_words(t)
                out += [(int(x["h"]), item, *around(words, x["pos"])) for x in places]
            yield pd.DataFrame(out, columns=["h", "item", "i_left", "i_mid", "i_right"])

    # an item's own windows: as many as it has words, so they fit one row
    places = prefix.groupBy("item").agg(F.collect_list(F.struct("h", "pos")).alias("places"))
    texts = single.select(F.to_json("item").alias("key"), F.col("item.item").alias("item"), "t")
    # written out, so that its true size decides whether the items' windows go to the tasks or
    # the corpus' hits, which grow, are shuffled
    wanted = materialise(texts.join(places.withColumnRenamed("item", "key"), "key").select("item", "t", "places").mapInPandas(windows, f"h long, item {item_kind}, i_left string, i_mid string, i_right string"))
    found = d.mapInPandas(find, f"h long, doc {doc_kind}, left string, mid string, right string")

    def run(a: str, b: str) -> int:
        n = 0
        for x, y in zip(a.split(), b.split()):
            if x != y:
                break
            n += 1
        return n

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            length = [shingle + run(x.left, x.i_left) + run(x.right, x.i_right) if x.mid == x.i_mid else 0 for x in b.itertuples()]
            b = b.assign(words=np.array(length, dtype=np.int64))
            yield b.loc[b["words"] >= window, ["doc", "item", "words"]]

    hits = found.join(wanted, "h").select("doc", "item", "left", "mid", "right", "i_left", "i_mid", "i_right")
    sure = hits.mapInPandas(verify, f"doc {doc_kind}, item {item_kind}, words long")
    return sure.groupBy(F.col("doc").alias(doc_id), F.col("item").alias(item_id)).agg(F.max("words").alias("words"))
