"""Percentiles of very large columns from mergeable relative-error sketches.

A sketch is a stack of compactors. An overfull one is sorted and its part away from the
protected tail is compacted: every second item moves up a level with twice the weight. How
much is compacted follows a binary counter, sections get smaller and more as it grows, so
the rank error stays in proportion to the distance from the protected end: at the upper
end, 1 - rank is known to a few per cent of itself, however extreme. Sketches of
partitions, builds or days merge level by level and keep the bound.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

FIRST_SECTIONS = 3
LEAST_K = 4


class _Compactor:
    __slots__ = ("coin", "items", "parts", "section", "sections", "size", "state")

    def __init__(self, k: float, sections: int = FIRST_SECTIONS, state: int = 0, coin: int = 0):
        self.section, self.sections, self.state, self.coin = float(k), sections, state, coin
        self.parts: list[np.ndarray] = []
        self.size = 0

    @property
    def k(self) -> int:
        return max(LEAST_K, 2 * round(self.section / 2))

    @property
    def capacity(self) -> int:
        return 2 * self.sections * self.k

    def add(self, items: np.ndarray) -> None:
        self.parts.append(items)
        self.size += len(items)

    def all(self) -> np.ndarray:
        if len(self.parts) > 1:
            self.parts = [np.concatenate(self.parts)]
        return self.parts[0] if self.parts else np.empty(0)

    def grow(self) -> None:
        """More and smaller sections once the counter has run through the present ones."""
        while self.state >= 1 << (self.sections - 1) and self.section / math.sqrt(2) >= LEAST_K:
            self.section /= math.sqrt(2)
            self.sections *= 2

    def compact(self, high: bool, seed: int) -> np.ndarray:
        """Take the part away from the protected tail out; return what moves up."""
        items = np.sort(self.all())
        ones = (~self.state & (self.state + 1)).bit_length() - 1
        keep = self.capacity // 2 + (self.sections - min(ones + 1, self.sections)) * self.k
        keep += (len(items) - keep) % 2
        if high:
            out, rest = items[: len(items) - keep], items[len(items) - keep :]
        else:
            out, rest = items[keep:], items[:keep]
        # every second compaction takes the other half, which cancels the errors of a pair
        self.coin = 1 - self.coin if self.state & 1 else (seed * 0x9E3779B1 + self.state * 0x85EBCA6B >> 13) & 1
        self.parts, self.size = [rest], len(rest)
        self.state += 1
        self.grow()
        return out[self.coin :: 2]


class RelativeSketch:
    """Quantile sketch with multiplicative rank error at one tail.

    ``k`` sets the accuracy: the standard error of a rank at distance d from the protected
    end is about 0.13 * d / sqrt(k * FIRST_SECTIONS / 3) for k = 32 about 2 % of d. Up to
    6 * k values are kept whole and the answer is exact.
    """

    def __init__(self, k: int = 32, high: bool = True):
        self.k, self.high, self.n = k, high, 0
        self.levels = [_Compactor(k)]

    def update(self, values: np.ndarray) -> None:
        self.n += len(values)
        at = 0
        while at < len(values):
            room = max(1, self.levels[0].capacity - self.levels[0].size)
            self.levels[0].add(values[at : at + room])
            at += room
            self._compress()

    def merge(self, other: RelativeSketch) -> None:
        if other.k != self.k or other.high != self.high:
            raise ValueError("sketches of different parameters")
        self.n += other.n
        while len(self.levels) < len(other.levels):
            self.levels.append(_Compactor(self.k))
        for mine, theirs in zip(self.levels, other.levels):
            mine.state |= theirs.state
            if theirs.sections > mine.sections:
                mine.sections, mine.section = theirs.sections, theirs.section
            mine.grow()
            mine.add(theirs.all())
        self._compress()

    def _compress(self) -> None:
        h = 0
        while h < len(self.levels):
            level = self.levels[h]
            if level.size >= level.capacity:
                if h + 1 == len(self.levels):
                    self.levels.append(_Compactor(self.k))
                self.levels[h + 1].add(level.compact(self.high, self.n + h))
            h += 1

    def quantiles(self, ps: list[float]) -> list[float | None]:
        """The smallest kept value of which at least a share p of all lies at or below."""
        if not self.n:
            return [None] * len(ps)
        items = np.concatenate([x.all() for x in self.levels])
        weights = np.concatenate([np.full(x.size, 1 << h, dtype=np.int64) for h, x in enumerate(self.levels)])
        order = np.argsort(items, kind="stable")
        total = np.cumsum(weights[order])
        at = np.searchsorted(total, [max(1, math.ceil(p * self.n - 1e-9)) for p in ps])
        return [float(items[order[min(i, len(order) - 1)]]) for i in at]

    def to_bytes(self) -> bytes:
        head = [self.k, int(self.high), self.n, len(self.levels)]
        body = []
        for x in self.levels:
            head += [x.state, x.sections, int(round(x.section * 1e9)), x.coin, x.size]
            body.append(x.all())
        return np.array(head, dtype="<i8").tobytes() + np.concatenate(body).astype("<f8").tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> RelativeSketch:
        k, high, n, count = np.frombuffer(data, "<i8", 4).tolist()
        head = np.frombuffer(data, "<i8", 5 * count, 32).tolist()
        items = np.frombuffer(data, "<f8", offset=32 + 40 * count)
        out, at = cls(k, bool(high)), 0
        out.n, out.levels = n, []
        for h in range(count):
            state, sections, section, coin, size = head[5 * h : 5 * h + 5]
            level = _Compactor(section / 1e9, sections, state, coin)
            level.add(items[at : at + size])
            at += size
            out.levels.append(level)
        return out


def sketches(df: DataFrame, keys: list[str], fields: list[str], k: int = 32, high: bool = True, held: int = 10_000) -> DataFrame:
    """One sketch for each combination of ``keys`` and field: keys, ``fld``, ``sketch``.

    NULL and NaN values, and texts that are no numbers, are not counted; a NULL key is a key like any other; a group
    without a present value has no row. Each task sketches its rows, and only sketches are
    shuffled, in two steps, so neither the rows nor the sketches of a group of any size
    are ever together in one place. A task that has more than ``held`` sketches open writes
    them out and goes on with new ones; where a sketch is cut decides which values it
    keeps, never how far a rank may be off, as merging keeps the bound. Extra columns are
    ignored.
    """
    kinds = {key: df.schema[key].dataType.simpleString() for key in keys}
    out = ", ".join([*(f"{key} {kind}" for key, kind in kinds.items()), "fld string", "sketch binary"])

    def flush(open_: dict) -> pd.DataFrame:
        rows = [(*key, s.to_bytes()) for key, s in open_.items()]
        open_.clear()
        return pd.DataFrame(rows, columns=[*keys, "fld", "sketch"]).astype(object)

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_: dict[tuple, RelativeSketch] = {}
        for b in batches:
            codes, seen = pd.factorize(pd.MultiIndex.from_frame(b[keys]), use_na_sentinel=False)
            order = np.argsort(codes, kind="stable")
            edges = np.append(np.flatnonzero(np.diff(codes[order], prepend=-1)), len(order))
            columns = {f: b[f].to_numpy(float)[order] for f in fields}
            for i in range(len(edges) - 1):
                key = tuple(None if v != v else v for v in seen[codes[order[edges[i]]]])
                for f, v in columns.items():
                    part = v[edges[i] : edges[i + 1]]
                    part = part[part == part]
                    if len(part):
                        s = open_.get((*key, f))
                        if s is None:
                            s = open_[(*key, f)] = RelativeSketch(k, high)
                        s.update(part)
            if len(open_) > held:
                yield flush(open_)
        if open_:
            yield flush(open_)

    parts = df.select(*keys, *[F.col(f).try_cast("double").alias(f) for f in fields]).mapInPandas(build, out)
    return combined(parts, keys)


def merged(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches combined over everything but ``keys`` and ``fld``.

    Rows of one key arrive sorted and are merged as they stream by; one sketch is held at
    a time.
    """
    by = [*keys, "fld"]
    kinds = ", ".join(f"{c} {parts.schema[c].dataType.simpleString()}" for c in by)

    def combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, now = None, None
        for b in batches:
            done = []
            for row in b.itertuples(index=False):
                this = tuple(None if v != v else v for v in row[:-1])
                s = RelativeSketch.from_bytes(row[-1])
                if now is not None and this == key:
                    now.merge(s)
                else:
                    if now is not None:
                        done.append((*key, now.to_bytes()))
                    key, now = this, s
            if done:
                yield pd.DataFrame(done, columns=[*by, "sketch"]).astype(object)
        if now is not None:
            yield pd.DataFrame([(*key, now.to_bytes())], columns=[*by, "sketch"]).astype(object)

    sorted_ = parts.select(*by, "sketch").repartition(*by).sortWithinPartitions(*by)
    return sorted_.mapInPandas(combine, f"{kinds}, sketch binary")


def combined(parts: DataFrame, keys: list[str], spread: int = 16) -> DataFrame:
    """As :func:`merged` in two steps, for keys with very many sketches each."""
    salted = parts.withColumn("_salt", F.pmod(F.xxhash64("sketch"), F.lit(spread)).cast("int"))
    return merged(merged(salted, [*keys, "_salt"]), keys)


def rank_bound(n: int, p: float, k: int, high: bool) -> float:
    """How far, as a share of all values, the rank of a percentile may be off: four standard
    errors in proportion to the distance from the protected end; 0 while all values are
    kept."""
    if n <= 2 * FIRST_SECTIONS * max(LEAST_K, 2 * round(k / 2)) - 1:
        return 0.0
    return 4 * 0.02 * math.sqrt(32 / k) * (1 - p if high else p)


def percentiles(sketched: DataFrame, keys: list[str], ps: list[float]) -> DataFrame:
    """keys, ``fld``, ``n``, ``p``, ``value`` and ``rank_bound`` of each sketch."""
    kinds = ", ".join(f"{c} {sketched.schema[c].dataType.simpleString()}" for c in [*keys, "fld"])

    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for row in b.itertuples(index=False):
                s = RelativeSketch.from_bytes(row[-1])
                rows += [(*row[:-1], s.n, p, v, rank_bound(s.n, p, s.k, s.high)) for p, v in zip(ps, s.quantiles(ps))]
            yield pd.DataFrame(rows, columns=[*keys, "fld", "n", "p", "value", "rank_bound"]).astype({"n": "int64", "p": float, "value": float, "rank_bound": float})

    return sketched.select(*keys, "fld", "sketch").mapInPandas(answer, f"{kinds}, n long, p double, value double, rank_bound double")
