"""Template residue, filler, error pages and script notices in texts.

Texts are cut into sentences and lines. Digits become 0 and capitalised words that say
nothing about residue become ``<*>``; the distinct messages that remain are counted over
the whole corpus and placed in a prefix tree of fixed depth (token count, first tokens, last
token), whose leaves hold templates that match token by token above a share. A word that
speaks for residue never becomes a wildcard. Each template is classified once, by a
softmax over its words and parts of words that was fitted to the labelled messages of
:mod:`hexloom.llm.examples` and to a bounded sample of the corpus' own messages as ordinary
ones; its verdict goes to all of its messages and from there to the texts. Slots that were
left unfilled inside ordinary sentences are looked for separately. What stands between
quotation marks is quoted or reported and never counts.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import cache
from operator import eq

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..session import materialise
from . import examples
from .classify import WILD, Evidence, Softmax, core, extras

DEPTH = 4
SIMILAR = 0.6
#: Messages of the corpus that the classifier takes as ordinary ones, at most.
SAMPLE = 4_000
#: Evidence from which a word speaks for residue.
SPEAKS = 0.4
#: By how much a whole message, one of a single word, or a part of one must beat "ordinary".
WHOLE, SINGLE, PART = 0.0, 1.0, 1.0
#: By how much a bracket's content must look like a field.
FIELD_LEAD = 0.5
KINDS = ("error_page", "script_notice", "filler")

# Between German or English quotation marks, which open and close with the same sign; a
# quotation doesn't go on over an empty line.
_GO_ON = r"(?:[^„“”\n]|\n(?![ \t\r]*\n))*"
_QUOTED = re.compile(rf"„{_GO_ON}[“”]|“{_GO_ON}[”“]")
# Between plain ones, but not the keys and values of an object.
_PLAIN_QUOTED = re.compile(r'(?<=[\s(])(?<![:,{] )"(?=[^\s:,}])[^"\n]+"(?=[\s.,;)]|$)')
_END = re.compile(r"(?<=[.!?])[ \t]+(?=\S)|[\r\n]+")
_DIGITS = re.compile(r"\d+")
_NAMES = re.compile(r"<\*>(?: (?:<\*>|&|–|0(?= <\*>)))+")
_CAPITAL = re.compile(r"[\W_]*[A-ZÄÖÜ]")
_TAIL = re.compile(r"[.,;:!?)\]]*$")

#: Marks of fields that a system would have filled in.
SLOTS = (
    r"\{\{[^{}\n]{0,80}\}?\}?",
    r"\{%[^{}\n]{0,80}",
    r"\$\{[^{}\n]{0,80}",
    r"\{[A-Za-z_][\w.]{0,40}\}|\{\d{1,3}\}",
    r"<%=?[^<>\n]{0,80}",
    r"<</?[\w. -]{1,60}>>",
    r"</?[A-Za-zÄÖÜäöü_][\w.\-]{0,40} ?/>",
    r"<[A-Za-zÄÖÜäöü][^<>\n]{0,60}(?:eintragen|einsetzen|einfügen|eingeben|ausfüllen|ergänzen|address|name|date|amount|here|text)[^<>\n]{0,20}>",
    r"<(?:insert|enter|your)\b[^<>\n]{0,60}>",
    r"\[\[[^\[\]\n]{1,60}\]?\]?",
    r"@@[\w.\- ]{1,60}@@",
    r"(?<![\w#&])#[A-Za-zÄÖÜäöü][\w.]{1,40}#",
    r"(?<![\w$])\$[A-Za-zÄÖÜäöü][\w.]{1,40}\$",
    r"«[\w.\- ]{1,60}»",
    r"\?\?\?[\w. ]{1,60}\?\?\?",
    r"(?<!\w)__[A-Za-zÄÖÜäöü][\w.]*?__(?!\w)|(?<!\w)__[a-zA-Z]\w*(?:\.\w+)+__",
    r"(?<![\w%])%(?:s|d|\([a-z_]+\)s|[A-Za-zÄÖÜäöü][\w.]{1,40}%)(?!\w)",
    r"&(?!(?:amp|lt|gt|quot|apos|nbsp|sect|euro|pound|copy|reg|shy|ensp|emsp|[mn]dash|[lrb][sd]quo|hellip|middot|[aouAOU]uml|szlig|[a-zA-Z]{1,2}(?:acute|grave|circ|tilde|cedil|ring));)[A-Za-zÄÖÜäöü][\w.]{2,40};",
    r"\b(?:TODO|FIXME|TBD|XXX)\b",
    r"\b(?:TT|DD|tt|dd)[./-](?:MM|mm)[./-](?:JJJJ|YYYY|jjjj|yyyy)\b|\b(?:JJJJ|YYYY)-MM-(?:TT|DD)\b",
    r"(?<![\w.])(?:undefined|NaN|N/A)(?![\w.])",
    r"(?<!\w)_{4,}(?!\w)",
)
_SLOT = re.compile("|".join(f"(?:{s})" for s in SLOTS))
#: Any of these slots has one of these signs; a text without is spared the full search.
_SLOT_HINT = re.compile(r"[{<@#$«%]|&\w|\[\[|\?\?\?|__|TODO|FIXME|TBD|XXX|undefined|NaN|N/A|MM|mm\b")
_IN_BRACKETS = re.compile(r"[\[(]([A-Za-zÄÖÜäöü][^\[\]()<>\n]{1,60})[\])]|<([A-Za-zÄÖÜäöü]+ [^\[\]()<>\n=]{1,60})>")


def unquoted(text: str) -> str:
    """The text without what stands between quotation marks."""
    if "„" in text or "“" in text or "”" in text:
        text = _QUOTED.sub(" ", text)
    if '"' in text:
        text = _PLAIN_QUOTED.sub(" ", text)
    return text


def _tokens(message: str) -> list[str]:
    return _DIGITS.sub("0", message).split()


@cache
def _seed_model() -> Softmax:
    return Softmax.fit([_tokens(x) for x, _ in examples.TRAINING], [k for _, k in examples.TRAINING], [None, *KINDS])


@cache
def _field_model() -> Softmax:
    rows = [*examples.FIELDS, *[(x, False) for x, k in examples.TRAINING if k is None]]
    return Softmax.fit([_tokens(x) for x, _ in rows], [k for _, k in rows], [False, True])


class _Fields(dict):
    """Whether what stands in brackets asks a writer to fill it in, judged when first seen."""

    def __missing__(self, inner: str) -> bool:
        field, lead = _field_model().best(_tokens(inner))
        got = field and lead > FIELD_LEAD
        if len(self) < 200_000:
            self[inner] = got
        return got


_FIELD = _Fields()


def has_slot(text: str) -> bool:
    """Whether a field was left unfilled somewhere in the text."""
    if _SLOT_HINT.search(text) and _SLOT.search(text):
        return True
    return any(_FIELD[_DIGITS.sub("0", a or b)] for a, b in _IN_BRACKETS.findall(text))


class _Speaks(dict):
    def __init__(self):
        self.evidence = Evidence(_seed_model())

    def __missing__(self, token: str) -> bool:
        got = self.evidence[token][-1] > SPEAKS
        if len(self) < 500_000:
            self[token] = got
        return got


@cache
def _speaks() -> _Speaks:
    return _Speaks()


class _Mask(dict):
    """A token as it stands in skeletons: ``<*>`` for names."""

    def __missing__(self, token: str) -> str:
        got = token
        if _CAPITAL.match(token) and not _speaks()[token] and f"^{core(token)}$" not in _seed_model().known:
            got = WILD + _TAIL.search(token)[0]
        if len(self) < 500_000:
            self[token] = got
        return got


_MASK = _Mask()


def skeleton(message: str) -> str:
    """The message (digits as 0 already) with names as ``<*>``."""
    s = " ".join(map(_MASK.__getitem__, message.split()))
    if "<*> " in s:
        if "<*> <*> <*>" in s:
            t = message.split()
            if any(a == b == c for a, b, c in zip(t, t[1:], t[2:])):
                return " ".join(t)
        s = _NAMES.sub(WILD, s)
    return s


def messages(text: str) -> list[str]:
    """The text's sentences and lines, with digits as 0."""
    return [s for s in _END.split(_DIGITS.sub("0", text)) if s and not s.isspace()]


def _wild(token: str) -> bool:
    return token.startswith(WILD)


class PrefixTree:
    """Templates in leaves under (token count, first tokens, last token)."""

    def __init__(self):
        self.leaves: dict[tuple, list[int]] = {}
        self.templates: list[list[str]] = []
        self.counts: list[int] = []
        self.examples: list[str] = []

    @staticmethod
    def leaf(tokens: list[str]) -> tuple:
        return (len(tokens), *tokens[:DEPTH], tokens[-1] if tokens else "")

    def add(self, tokens: list[str], count: int, example: str) -> int:
        """Place one message; return its template's number.

        The template of the leaf that agrees in most tokens takes it if they are enough,
        and turns the others into wildcards. Wildcards count neither for nor against, and
        a word that speaks for residue agrees with nothing but itself.
        """
        speaks = _speaks()
        at = self.leaves.setdefault(self.leaf(tokens), [])
        best, share, n = -1, 0.0, len(tokens)
        for i in at:
            other = self.templates[i]
            same = sum(map(eq, other, tokens))
            if same == n:
                best, share = i, 1.0
                break
            if same >= SIMILAR * n and same > share * n:
                both = sum(a == b and _wild(a) for a, b in zip(other, tokens))
                agree = (same - both) / (n - both)
                if agree > share and not any(a != b and (speaks[a] or speaks[b]) for a, b in zip(other, tokens)):
                    best, share = i, agree
        if best >= 0 and share >= SIMILAR:
            if share < 1:
                self.templates[best] = [a if a == b else WILD for a, b in zip(self.templates[best], tokens)]
            self.counts[best] += count
            self.examples[best] = min(self.examples[best], example)
            return best
        self.templates.append(tokens)
        self.counts.append(count)
        self.examples.append(example)
        at.append(len(self.templates) - 1)
        return len(self.templates) - 1


class Judge:
    """Verdicts of templates by one model."""

    def __init__(self, model: Softmax):
        self.model, self.evidence = model, Evidence(model)

    def verdict(self, template: str) -> str | None:
        """The kind of residue that a template is, if any.

        A template is judged as a whole and from each place where a sentence may begin
        inside it (a capital, a number, the end of a name) to its end, as headings run into
        what follows them. A wildcard speaks for a name, whichever. What a part shows as a
        whole counts in messages of any length.
        """
        tokens = [t for t in template.split() if _wild(t) or core(t)]
        n = len(tokens)
        cores = ["" if _wild(t) else core(t) for t in tokens]
        words = [w for w in cores if w]
        if not words:
            return None
        more = extras(cores)
        if not any(more):
            # what no span can reach even if only the words for residue counted
            total, reach = 0.0, False
            for left, t in enumerate(reversed(tokens), 1):
                total += max(0.0, self.evidence[t][-1])
                if total + (self.model.lead - (PART if left < n else WHOLE)) * math.sqrt(left) > 0:
                    reach = True
                    break
            if not reach:
                return None
        own = np.array([self.evidence[t][:-1] for t in tokens])
        back = np.cumsum(own[::-1], 0)[::-1]
        z = back / np.sqrt(np.arange(n, 0, -1.0))[:, None] + self.model.bias
        if any(more):
            added = {f: self.model.total(f) for f in set(more)}
            z += np.array([added[f] for f in more])
        lead = z[:, 1:].max(1) - z[:, 0]
        lead[0] -= SINGLE if len(words) == 1 else WHOLE
        best, most = -1, 0.0
        for i in range(n):
            if lead[i] - (PART if i else 0.0) > most and (i == 0 or n - i >= 3 and (_CAPITAL.match(tokens[i]) or tokens[i - 1][0] in "0<")):
                best, most = i, lead[i] - (PART if i else 0.0)
        return self.model.classes[1 + int(np.argmax(z[best, 1:]))] if best >= 0 else None


def fit(sample: list[str]) -> Softmax:
    """The classifier: labelled messages, and ``sample`` as ordinary ones.

    Some of the sample may be residue. Each half is judged by a fit to the other half, and
    what that takes for residue is left out of the final fit.
    """
    labelled = [skeleton(_DIGITS.sub("0", x)).split() for x, _ in examples.TRAINING]
    kinds = [k for _, k in examples.TRAINING]

    def once(own: list[str], rounds: int) -> Softmax:
        weight = np.array([1.0] * len(labelled) + [min(1.0, 2 * len(labelled) / max(1, len(own)))] * len(own))
        return Softmax.fit(labelled + [s.split() for s in own], kinds + [None] * len(own), [None, *KINDS], weight, rounds)

    halves = sample[::2], sample[1::2]
    judges = [Judge(once(half, 60)) for half in halves]
    return once([s for half, judge in zip(halves, judges[::-1]) for s in half if judge.verdict(s) is None], 100)


def mine(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Texts (``row``, ``key``, ``slot``, ``hashes`` of their messages) and the distinct
    messages of all of them (``h``, ``skeleton``, ``count``), both written out.

    A text is read whole, once. NULL and empty texts have no messages. Tasks add up what
    they see before the messages are brought together; when they let go of sums that
    became large, only more rows are shuffled.
    """
    kind = docs.schema[key].dataType.simpleString()

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        row = TaskContext.get().partitionId() << 40
        known: dict[str, int] = {}
        seen: dict[str, int] = {}

        def flush() -> pd.DataFrame:
            out = pd.DataFrame({"h": [known[s] for s in seen], "skeleton": list(seen), "count": list(seen.values())})
            seen.clear()
            return out.assign(row=None, key=None, slot=None, hashes=None)[["row", "key", "slot", "hashes", "h", "skeleton", "count"]].astype(object)

        masked: dict[str, str] = {}
        for b in batches:
            rows = []
            for k, t in zip(b.k, b.t):
                own: set[int] = set()
                slot = False
                if isinstance(t, str):
                    t = unquoted(t)
                    slot = has_slot(t)
                    for m in messages(t):
                        s = masked.get(m)
                        if s is None:
                            s = skeleton(m)
                            if len(masked) < 200_000:
                                masked[m] = s
                        h = known.get(s)
                        if h is None:
                            h = known[s] = xxhash.xxh64_intdigest(s) - (1 << 63)
                        seen[s] = seen.get(s, 0) + 1
                        own.add(h)
                rows.append((row, k, slot, sorted(own)))
                row += 1
            yield pd.DataFrame(rows, columns=["row", "key", "slot", "hashes"]).assign(h=None, skeleton=None, count=None).astype(object)
            if len(known) > 200_000:
                yield flush()
                known.clear()
        yield flush()

    schema = f"row long, key {kind}, slot boolean, hashes array<long>, h long, skeleton string, count long"
    mined = materialise(docs.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInPandas(read, schema))
    texts = mined.where(F.col("row").isNotNull()).select("row", "key", "slot", "hashes")
    known = mined.where(F.col("h").isNotNull()).groupBy("h").agg(F.first("skeleton").alias("skeleton"), F.sum("count").alias("count"))
    return texts, materialise(known)


def sampled(known: DataFrame, most: int = SAMPLE) -> list[str]:
    """At most ``most`` of the corpus' messages, the same however they are stored: half the
    most frequent ones, half by hash."""
    often = known.orderBy(F.col("count").desc(), "h").limit(most // 2)
    other = known.orderBy(F.xxhash64("h"), "h").limit(most // 2)
    return sorted({r.skeleton for r in often.union(other).select("skeleton").collect()})


def placed(known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Messages in templates: (``h``, ``leaf``, ``id``), and the templates themselves:
    (``leaf``, ``id``, ``template``, ``count``, ``example``).

    Each leaf's messages are streamed, in order, into one prefix tree, and leave again at
    once; only templates are held, and of one leaf only. Leaves are fine enough (length,
    four first words, last word) that none grows with the corpus.
    """

    def leaf_of(s: pd.Series) -> pd.Series:
        return pd.Series(["\x1f".join(map(str, PrefixTree.leaf(x.split()))) for x in s], dtype=object)

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tree, now = PrefixTree(), None
        columns = ["leaf", "id", "h", "template", "count", "example"]

        def done() -> list[tuple]:
            return [(now, i, None, " ".join(t), tree.counts[i], tree.examples[i]) for i, t in enumerate(tree.templates)]

        for b in batches:
            rows = []
            for leaf, h, s, n in zip(b["leaf"], b["h"], b["skeleton"], b["count"]):
                if leaf != now:
                    rows += done()
                    tree, now = PrefixTree(), leaf
                rows.append((leaf, tree.add(s.split(), n, s), h, None, None, None))
            yield pd.DataFrame(rows, columns=columns, dtype=object)
        yield pd.DataFrame(done(), columns=columns, dtype=object)

    keyed = known.withColumn("leaf", F.pandas_udf(leaf_of, "string")("skeleton"))
    ordered = keyed.repartition("leaf").sortWithinPartitions("leaf", "skeleton")
    out = materialise(ordered.mapInPandas(merge, "leaf string, id int, h long, template string, count long, example string"))
    return out.where(F.col("h").isNotNull()).select("h", "leaf", "id"), out.where(F.col("template").isNotNull()).drop("h")


def judged(templates: DataFrame, model: Softmax) -> DataFrame:
    """Templates with their ``verdict``, NULL for ordinary ones."""

    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        by = Judge(model)
        for s in batches:
            yield pd.Series([by.verdict(t) for t in s], dtype=object)

    # annotations name what pandas_udf goes by
    judge.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return templates.withColumn("verdict", F.pandas_udf(judge, "string")("template"))


def residue(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``kinds`` (of slot, error_page, script_notice, filler) of texts with residue.

    NULL and empty texts have none. Texts are read whole, however long. A text has a kind
    if any of its messages' templates has it; repeated rows each report. An empty table
    gives an empty result; extra columns, whatever their names, are ignored.
    """
    texts, known = mine(docs, key, text)
    members, templates = placed(known)
    bad = judged(templates, fit(sampled(known))).where(F.col("verdict").isNotNull()).select("leaf", "id", "verdict")
    bad = materialise(members.join(bad, ["leaf", "id"]).select("h", "verdict"))
    hit = texts.select("row", "key", F.explode("hashes").alias("h")).join(bad, "h").select("row", "key", F.col("verdict").alias("kind"))
    slots = texts.where("slot").select("row", "key", F.lit("slot").alias("kind"))
    found = hit.unionByName(slots).groupBy("row", "key").agg(F.array_sort(F.collect_set("kind")).alias("kinds"))
    return found.select(F.col("key").alias(key), "kinds")


def held_out(known: DataFrame) -> DataFrame:
    """How the model fitted to a corpus' messages does on labelled messages and fields that it
    was not fitted to: ``part`` (development: looked at while it was made; held_out: not),
    ``cases``, ``found``, ``both``, ``precision``, ``recall``."""
    judge = Judge(fit(sampled(known)))
    rows = []
    for part, texts, fields in (("development", examples.DEVELOPMENT, examples.DEVELOPMENT_FIELDS), ("held_out", examples.HELD_OUT, examples.HELD_OUT_FIELDS)):
        rows += [(part, judge.verdict(skeleton(_DIGITS.sub("0", x))) is not None, y) for x, y in texts]
        rows += [(part, has_slot(f"Az. [{x}] Urteil"), y) for x, y in fields]
    out = known.sparkSession.createDataFrame(rows, "part string, got boolean, true boolean")
    both = F.count_if(F.col("got") & F.col("true"))
    counts = out.groupBy("part").agg(F.count_if("true").alias("cases"), F.count_if("got").alias("found"), both.alias("both"))
    return counts.select("*", F.round(F.col("both") / F.col("found"), 4).alias("precision"), F.round(F.col("both") / F.col("cases"), 4).alias("recall"))
