"""Delimited records: typed rows apart from rejected records with the reason."""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import LAT_RANGE, LON_RANGE

COLUMNS = ("id", "name", "zip", "city", "address", "school_type", "latitude", "longitude")
QUOTING, COLUMN_COUNT, INVALID = "quoting", "column_count", "invalid_value"

_NUMBER = re.compile(r"[+-]?[0-9]+(?:[.,][0-9]+)?")
_FIELD = r'(?:"(?:[^"]|"")*+"|[^",]*+)'
_RECORD = re.compile(rf"{_FIELD}(?:,{_FIELD})*+", re.S)


def assemble(lines: Iterable[str]) -> Iterator[str]:
    """Physical lines to records: a line break inside quotes belongs to the record.

    A quote opens a quoted field only at the field's start; a record whose quotes never
    close takes all lines that follow, as it must.
    """
    held: list[str] = []
    quoted = False
    for line in lines:
        held.append(line)
        for part in line.split('"')[:-1]:
            if quoted:
                quoted = False
            elif part == "" or part.endswith(","):
                quoted = True
        if not quoted:
            yield "".join(held)
            held = []
    if held:
        yield "".join(held)


class Rejected(Exception):
    """A record that can't be read; ``args[0]`` is the reason."""


def coordinate(text: str, bounds: tuple[float, float]) -> float | None:
    text = text.strip()
    if not text:
        return None
    if not _NUMBER.fullmatch(text):
        raise Rejected(INVALID)
    value = float(text.replace(",", "."))
    if not bounds[0] <= value <= bounds[1]:
        raise Rejected(INVALID)
    return value


def parse(record: str) -> tuple:
    """One record to its eight typed values, or :class:`Rejected`.

    Structure comes first: the strict reader and, as it lets a quote in an unquoted field
    pass, the grammar of the format; then the number of fields; then the typed fields.
    """
    try:
        # only line breaks end a line here; splitlines would also cut at separators in a text
        rows = list(csv.reader(io.StringIO(record, newline=""), strict=True))
    except csv.Error:
        raise Rejected(QUOTING) from None
    if '"' in record and not _RECORD.fullmatch(record):
        raise Rejected(QUOTING)
    if len(rows) != 1 or len(rows[0]) != len(COLUMNS):
        raise Rejected(COLUMN_COUNT)
    row = rows[0]
    return (*row[:6], coordinate(row[6], LAT_RANGE), coordinate(row[7], LON_RANGE))


def read_records(raw: DataFrame, key: str = "line_id", line: str = "raw_line") -> DataFrame:
    """Every record with its typed fields and ``reason`` (NULL where it could be read).

    NULL and empty records have no eight fields: ``column_count``. Very long fields are
    read whole. Repeated records are judged each by itself; extra columns are ignored.
    An empty table gives an empty result. No shuffle.
    """

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        csv.field_size_limit(2**31 - 1)
        for b in batches:
            out = []
            for k, text in zip(b.k, b.t):
                try:
                    out.append((k, *parse(text if isinstance(text, str) else ""), None))
                except Rejected as e:
                    out.append((k, *(None,) * len(COLUMNS), e.args[0]))
            yield pd.DataFrame(out, columns=["k", *COLUMNS, "reason"])

    kind = raw.schema[key].dataType.simpleString()
    typed = ", ".join(f"{c} {'double' if c in ('latitude', 'longitude') else 'string'}" for c in COLUMNS)
    out = raw.select(F.col(key).alias("k"), F.col(line).alias("t")).mapInPandas(judge, f"k {kind}, {typed}, reason string")
    return out.withColumnRenamed("k", key)


def records_of_files(spark: SparkSession, path: str, encoding: str = "utf-8") -> DataFrame:
    """The records of delimited files: ``file_name``, ``line_no`` (of the record's first line, from
    1) and ``raw_line``, for :func:`read_records`.

    Lines become records where the quotes say so, which only the file's beginning can tell:
    a file is one task's work, and many files are many tasks. A byte that is no text in the
    encoding becomes the replacement sign. Empty files and blank last lines give no record.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for name, data in zip(b["path"], b["content"]):
                out, at = [], 1
                for record in assemble(io.StringIO(bytes(data).decode(encoding, "replace"), newline="")):
                    body = record.removesuffix("\n").removesuffix("\r")
                    if body:
                        out.append((name, at, body))
                    at += record.count("\n") or 1
                    if len(out) >= 10_000:
                        yield pd.DataFrame(out, columns=["file_name", "line_no", "raw_line"])
                        out = []
                if out:
                    yield pd.DataFrame(out, columns=["file_name", "line_no", "raw_line"])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(cut, "file_name string, line_no long, raw_line string")


def rejected(raw: DataFrame, key: str = "line_id", line: str = "raw_line") -> DataFrame:
    return read_records(raw, key, line).where(F.col("reason").isNotNull()).select(key, "reason")


def accepted(raw: DataFrame, key: str = "line_id", line: str = "raw_line") -> DataFrame:
    return read_records(raw, key, line).where(F.col("reason").isNull()).drop("reason")
