"""Items of varying length into containers of fixed capacity, with little space unused.

Only the histogram of lengths, at most ``capacity`` numbers, reaches the driver. There the
lengths are placed longest first, each into the pattern with the most space left that still
fits; the result is a list of patterns with counts. Items join their pattern by their rank
among the items of the same length.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, Window

from ..session import materialise

MAX_CAPACITY = 1 << 16
_RANKS = 1 << 40

# The tokenizer's own way of splitting text, for the standard library's engine. It is the
# same on texts in which every number character is a decimal digit; others go to the
# tokenizer whole.
_SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
_ODD = re.compile(r"[^\x00-\x1b\x20-\x7fÀ-ÖØ-öø-ɏ‐-‧‰-›€─-◿§°«»©®·¿¡´﻿]")


class _Counts(dict):
    """Tokens of each piece, counted when first seen."""

    def __init__(self, count: Callable[[str], int]):
        self.count = count

    def __missing__(self, piece: str) -> int:
        n = self.count(piece)
        if len(self) < 500_000:
            self[piece] = n
        return n


def token_counter(path: str) -> Callable[[str], int]:
    """Counts tokens of whole texts with the rank file at ``path``.

    No merge crosses the pieces into which the tokenizer splits a text, so counts of pieces
    add up to the text's, and each distinct piece is encoded once.
    """
    import tiktoken
    from public_tokenizers import PATTERN

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    get = _Counts(lambda piece: len(enc.encode_ordinary(piece))).__getitem__

    def count(text: str) -> int:
        if _ODD.search(text):
            return len(enc.encode_ordinary(text))
        return sum(map(get, _SPLIT.findall(text)))

    return count


def token_lengths(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``n_tokens`` of each text, read whole; NULL and empty texts have 0."""
    kind = docs.schema[key].dataType.simpleString()

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = token_counter(path)
        for b in batches:
            yield pd.DataFrame({key: b[key], "n_tokens": [count(t) if isinstance(t, str) else 0 for t in b[text]]})

    return docs.select(key, text).mapInPandas(measure, f"{key} {kind}, n_tokens long")


def pack_histogram(counts: dict[int, int], capacity: int) -> list[tuple[int, list[int]]]:
    """Patterns (how many containers, lengths in each) that hold the histogram's items.

    Each step either finishes a length or uses a pattern up, and a length opens at most two
    new patterns, so patterns stay within three times the distinct lengths.
    """
    space: dict[int, list[tuple[int, list[int]]]] = defaultdict(list)
    for length in sorted(counts, reverse=True):
        left = counts[length]
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} does not fit")
        rooms = [-r for r in space if r >= length]
        heapq.heapify(rooms)
        while left and rooms:
            most = -heapq.heappop(rooms)
            packs = space.pop(most)
            room = most - length
            while left and packs:
                n, pattern = packs.pop()
                used = min(n, left)
                if n > used:
                    packs.append((n - used, pattern))
                if room >= length and room not in space:
                    heapq.heappush(rooms, -room)
                space[room].append((used, [*pattern, length]))
                left -= used
            if packs:
                space[most] = packs
        # what is left opens containers, filled with as many of this length as fit
        while left:
            each = min(capacity // length, left)
            n = left // each
            space[capacity - each * length].append((n, [length] * each))
            left -= n * each
    return [(n, pattern) for r in sorted(space) for n, pattern in space[r]]


def _slots(patterns: list[tuple[int, list[int]]]) -> dict[str, np.ndarray]:
    """Rank intervals of each length: (length, first rank) -> containers."""
    rows, ranks, base = [], defaultdict(int), 0
    for n, pattern in patterns:
        for length in dict.fromkeys(pattern):
            rows.append((length * _RANKS + ranks[length], ranks[length], base, n))
            ranks[length] += n * pattern.count(length)
        base += n
    rows.sort()
    table = np.array(rows, dtype=np.int64).reshape(-1, 4)
    return {"key": table[:, 0], "start": table[:, 1], "base": table[:, 2], "n": table[:, 3]}


def pack(lengths: DataFrame, capacity: int, key: str, length: str, spread: int = 256) -> DataFrame:
    """Assign each item to a container: key, ``part``, ``start``, ``size``, ``container``.

    An item over ``capacity`` is cut into full containers and a rest, which is packed as
    any other; nothing else is split. Items of length 0 (or NULL) take no space and go to
    container 0. Keys must be unique. Items of one length are ranked in ``spread`` hash
    buckets whose sizes are added up first, so no task sorts all of a length; the ranks,
    and with them the containers, follow from the items alone.
    """
    if not 0 < capacity <= MAX_CAPACITY:
        raise ValueError(f"capacity must be from 1 to {MAX_CAPACITY}")
    n = F.greatest(F.coalesce(F.col(length).cast("long"), F.lit(0)), F.lit(0))
    pieces = F.greatest(F.ceil(n / capacity).cast("long"), F.lit(1))
    items = lengths.select(F.col(key), n.alias("_n"), F.explode(F.sequence(F.lit(0).cast("long"), pieces - 1)).alias("part"))
    items = items.select(key, "part", (F.col("part") * capacity).alias("start"), F.least(F.col("_n") - F.col("part") * capacity, F.lit(capacity)).alias("size"))
    items = materialise(items)
    histogram = {r["size"]: r["c"] for r in items.where("size > 0").groupBy("size").agg(F.count(F.lit(1)).alias("c")).collect()}  # at most ``capacity`` rows
    slots = _slots(pack_histogram(histogram, capacity))
    full = items.where("size > 0").withColumn("_b", F.pmod(F.xxhash64(key, "part"), F.lit(spread)).cast("int"))
    sizes = full.groupBy("size", "_b").agg(F.count(F.lit(1)).alias("_c"))
    before = Window.partitionBy("size").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("size", "_b", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"))
    in_bucket = Window.partitionBy("size", "_b").orderBy(key, "part")
    ranked = full.withColumn("_k", F.row_number().over(in_bucket) - 1)
    # both sides are where the windows put them: a merge moves only the offsets
    ranked = ranked.join(offsets.hint("merge"), ["size", "_b"]).withColumn("_rank", F.col("_off") + F.col("_k"))
    kind = lengths.schema[key].dataType.simpleString()

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rank = b["_rank"].to_numpy()
            i = np.searchsorted(slots["key"], b["size"].to_numpy() * _RANKS + rank, "right") - 1
            yield b.drop(columns="_rank").assign(container=slots["base"][i] + (rank - slots["start"][i]) % slots["n"][i])

    placed = ranked.select(key, "part", "start", "size", "_rank").mapInPandas(assign, f"{key} {kind}, part long, start long, size long, container long")
    nothing = items.where("size = 0").select(key, "part", "start", "size", F.lit(0).cast("long").alias("container"))
    return placed.unionByName(nothing)


def filled(packed: DataFrame, capacity: int) -> DataFrame:
    """One row: ``pieces``, ``containers``, ``units`` in them, ``overfull`` ones and the ``fill``
    (the share of the space that is used); without an item the fill is NULL."""
    each = packed.where("size > 0").groupBy("container").agg(F.sum("size").alias("used"), F.count(F.lit(1)).alias("n"))
    total = each.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("pieces"), F.count(F.lit(1)).alias("containers"), F.coalesce(F.sum("used"), F.lit(0)).alias("units"), F.count_if(F.col("used") > capacity).alias("overfull"))
    return total.withColumn("fill", F.col("units") / F.nullif(F.col("containers") * capacity, F.lit(0)))
