"""A data source over a folder of cached JSON answers: ``format("cached_json")``."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


def cache_key(url: str, body: str = "") -> str:
    return hashlib.sha256(f"{url}\n{body}".encode()).hexdigest()


def remember(folder: str, url: str, answer: object, body: str = "") -> str:
    """Store an answer under the hash of its request, in one step."""
    path = Path(folder) / f"{cache_key(url, body)}.json"
    path.parent.mkdir(parents=True, exist_ok=True)
    part = path.with_suffix(".part")
    part.write_text(json.dumps({"url": url, "body": body, "answer": answer}))
    part.replace(path)
    return str(path)


class _File(InputPartition):
    pass


class _Reader(DataSourceReader):
    def __init__(self, folder: str):
        self.folder = folder

    def partitions(self) -> list[InputPartition]:
        return [_File(str(p)) for p in sorted(Path(self.folder).glob("*.json"))]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        if partition is None or partition.value is None:
            return
        got = json.loads(Path(partition.value).read_text())
        yield got["url"], got["body"], json.dumps(got["answer"])


class CachedJson(DataSource):
    """Rows (url, body, answer) of the files in ``path``; one partition a file."""

    @classmethod
    def name(cls) -> str:
        return "cached_json"

    def schema(self) -> str:
        return "url string, body string, answer string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"].removeprefix("file://"))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(CachedJson)
