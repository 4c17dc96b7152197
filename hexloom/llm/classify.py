"""A small text classifier in plain numpy: words and parts of words, softmax.

A message's evidence adds up word by word, so the evidence of each distinct word is
worked out once, and that of every span of a message follows from running sums. Features
are kept as they are, not hashed: a name never borrows the weight of another word.
"""

from __future__ import annotations

import re

import numpy as np

WILD = "<*>"
#: Widths of the parts of a word, which is marked at both ends.
PARTS = (5, 6)
_CORE = re.compile(r"[^\W_]+")
_MARKUP = re.compile(r"</?\w+>|[{}]|\"\w+\" ?:")
_DIGITS = re.compile(r"\d+")
_HELD = 500_000


def core(token: str) -> str:
    """The letters of a token in lower case; digits count as 0, nothing else counts."""
    return _DIGITS.sub("0", "".join(_CORE.findall(token.lower())))


class _Features(dict):
    """Features of each token by itself, worked out when first seen."""

    def __missing__(self, token: str) -> tuple[str, ...]:
        out = {"m wild"} if token.startswith(WILD) else set()
        for w in _CORE.findall(_DIGITS.sub("0", token.lower())):
            marked = f"^{w}$"
            out.add(marked)
            out.update(marked[i : i + n] for n in PARTS for i in range(len(marked) - n + 1))
        if _MARKUP.search(token):
            out.add("m markup")
        got = tuple(sorted(out))
        if len(self) < _HELD:
            self[token] = got
        return got


_FEATURES = _Features()


def extras(words: list[str]) -> list[tuple[str, ...]]:
    """Features of each tail of a message as a whole, the first being all of it: words said
    again, words of one letter. ``words`` are the cores of its tokens, "" counts for nothing.

    One pass from the end, so a tail has the same features whatever stands before it and
    however long the message is.
    """
    seen: set[str] = set()
    count = letters = single = 0
    thrice = False
    after = then = None
    out = []
    for w in reversed(words):
        if w:
            count += 1
            seen.add(w)
            thrice = thrice or w == after == then
            after, then = w, after
            if not w.isdigit():
                letters += 1
                single += len(set(w)) == 1 and len(w) > 1
        f: list[str] = []
        if count >= 3:
            again = 1 - len(seen) / count
            f += [f"e again {b}" for b in range(2, 6) if again >= b / 6]
            f += ["e thrice"] if thrice else []
        if letters >= 3 and single >= 0.6 * letters:
            f.append("e one letter")
        out.append(tuple(f))
    return out[::-1]


def features(tokens: list[str]) -> tuple[list[str], list[float]]:
    """Features and their weights in one message; every word counts alike, and long
    messages count as much as short ones."""
    names, values = [], []
    scale = max(1, len(tokens)) ** -0.5
    for t in tokens:
        f = _FEATURES[t]
        names += f
        values += [scale * max(1, len(f)) ** -0.5] * len(f)
    more = extras(list(map(core, tokens)))[0] if tokens else ()
    return [*names, *more], values + [1.0] * len(more)


class Softmax:
    """Weights (features x classes) and biases; class 0 is "ordinary"."""

    def __init__(self, classes: list, known: dict[str, int], weights: np.ndarray, bias: np.ndarray):
        self.classes, self.known, self.weights, self.bias = classes, known, weights, bias
        self.lead = bias[1:].max() - bias[0]

    @classmethod
    def fit(cls, tokens: list[list[str]], labels: list, classes: list, weight: np.ndarray | None = None, rounds: int = 120, penalty: float = 2e-4) -> Softmax:
        """Full-batch Adagrad, the same for the same input whatever the machine."""
        known: dict[str, int] = {}
        index, values, size = [], [], []
        for t in tokens:
            f, v = features(t)
            index += [known.setdefault(x, len(known)) for x in f]
            values += v
            size.append(len(f))
        index, size = np.array(index, dtype=np.int64), np.array(size)
        value = np.array(values, dtype=np.float32)[:, None]
        row = np.repeat(np.arange(len(size)), size)
        by = np.argsort(index, kind="stable")
        by_row, by_value, starts = row[by], value[by], np.searchsorted(index[by], np.arange(len(known)))
        full = np.flatnonzero(size)
        begins = (np.cumsum(size) - size)[full]
        y = np.array([classes.index(x) for x in labels])
        target = np.eye(len(classes), dtype=np.float32)[y]
        share = np.ones(len(y)) if weight is None else weight
        share = (share / share.sum()).astype(np.float32)[:, None]
        w, b = np.zeros((len(known), len(classes)), np.float32), np.zeros(len(classes), np.float32)
        gw, gb = np.full_like(w, 1e-8), np.full_like(b, 1e-8)
        for _ in range(rounds):
            z = np.tile(b, (len(y), 1))
            z[full] += np.add.reduceat(value * w[index], begins, 0)
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            g = (p - target) * share
            dw = np.add.reduceat(by_value * g[by_row], starts, 0) + np.float32(penalty / len(y)) * w
            db = g.sum(0)
            gw += dw**2
            gb += db**2
            w -= 0.3 * dw / np.sqrt(gw)
            b -= 0.3 * db / np.sqrt(gb)
        return cls(classes, known, w, b)

    def total(self, names, scale: float = 1.0) -> np.ndarray:
        """Sum of the weights of features; unknown ones have none."""
        at = [self.known[f] for f in names if f in self.known]
        return self.weights[at].sum(0) * scale if at else np.zeros(len(self.classes), np.float32)

    def best(self, tokens: list[str]):
        """The class of a message, and by how much it beats "ordinary"."""
        names, values = features(tokens)
        z = self.bias.copy()
        for f, v in zip(names, values):
            if f in self.known:
                z += v * self.weights[self.known[f]]
        k = int(np.argmax(z))
        return self.classes[k], float(z[k] - z[0])


class Evidence(dict):
    """What each token adds to each class, worked out when first seen."""

    def __init__(self, model: Softmax):
        self.model = model

    def __missing__(self, token: str) -> tuple[float, ...]:
        f = _FEATURES[token]
        v = self.model.total(f, max(1, len(f)) ** -0.5).tolist()
        got = (*v, max(v[1:]) - v[0])
        if len(self) < _HELD:
            self[token] = got
        return got
