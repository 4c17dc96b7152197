"""Text and number expressions shared by the operators."""

from __future__ import annotations

import unicodedata

import pandas as pd
import regex
from pyspark.sql import Column, functions as F

_WORD = regex.compile(r"[\p{L}\p{Nd}][\p{L}\p{Nd}\p{M}]*")

#: What stands in registers for "not known", lower case and trimmed.
STAND_INS = ("", "-", "--", "?", "n/a", "na", "n.a.", "k. a.", "k.a.", "keine angabe", "nan", "none", "null", "unbekannt", "unknown")

#: Coordinates that can lie in the covered country.
LAT_RANGE, LON_RANGE = (47.2, 55.1), (5.8, 15.1)

_BLANKS = r"^[\s   ﻿]+|[\s   ﻿]+$"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, _BLANKS, "")


def number(c: Column) -> Column:
    """A plain decimal number with point or comma as double, anything else NULL."""
    s = strip(c)
    return F.when(s.rlike(r"^[+-]?[0-9]+([.,][0-9]+)?$"), F.regexp_replace(s, ",", ".").try_cast("double"))


def within(c: Column, bounds: tuple[float, float]) -> Column:
    """``c`` where it lies in the closed range, else NULL (NaN too)."""
    return F.when(~F.isnan(c) & c.between(*bounds), c)


def usable_lat(c: Column) -> Column:
    return within(number(c), LAT_RANGE)


def usable_lon(c: Column) -> Column:
    return within(number(c), LON_RANGE)


def zip5(c: Column) -> Column:
    digits = F.regexp_replace(c, "[^0-9]", "")
    return F.when(F.length(digits) >= 5, F.substring(digits, 1, 5))


def known(c: Column) -> Column:
    """``c`` unless it is NULL, blank or a stand-in for "not known"."""
    return F.when(~F.lower(strip(c)).isin(*STAND_INS), c)


def fold(s: str) -> str:
    """Canonical Unicode form and full case folding."""
    if s.isascii():
        return s.lower()
    return unicodedata.normalize("NFC", unicodedata.normalize("NFC", s).casefold())


def words(s: str) -> list[str]:
    """The folded words of a text: unbroken runs of letters and digits."""
    return _WORD.findall(fold(s))


def _bag(s: str | None) -> str | None:
    return (" ".join(sorted(words(s))) or None) if s is not None else None


def word_bag(c: Column) -> Column:
    """The words of a text in sorted order, joined by blanks; NULL without a word."""

    def bags(s: pd.Series) -> pd.Series:
        return s.map(_bag, na_action="ignore")

    return F.pandas_udf(bags, "string")(c)
