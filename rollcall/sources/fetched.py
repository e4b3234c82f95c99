"""API responses as a streaming source: each is landed before any batch that reads it is planned.

A fetch can't be repeated: asked again, an API gives other records. So the source writes what it fetches to a folder
first, and its offsets count the files there. A batch that is replayed reads the same files; a crash between fetch and
commit leaves a file that the next batch takes. A file that a crash left torn is never read, its number is fetched again.
"""

from __future__ import annotations

import hashlib
import importlib
import json
import posixpath
import re
import time
import urllib.request
from collections.abc import Callable, Iterator
from datetime import UTC, datetime

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from rollcall.functions import stable_id

SCHEMA = "landed string, number bigint, fetched timestamp, response string"


Fetch = Callable[[int], str | None]


def http(url: str, timeout: str = "30") -> Fetch:
    """A response per call from an address, whatever the number."""

    def fetch(number: int) -> str:
        with urllib.request.urlopen(url, timeout=float(timeout)) as answer:
            return answer.read().decode()

    return fetch


def folder(path: str) -> Fetch:
    """The files of a folder by the order of their names, which must not change; a stand-in for an API."""
    system, place = fs.FileSystem.from_uri(path if ":" in path else posixpath.abspath(path))

    def fetch(number: int) -> str | None:
        names = sorted(info.path for info in system.get_file_info(fs.FileSelector(place)) if info.is_file)
        return system.open_input_stream(names[number]).read().decode() if number < len(names) else None

    return fetch


class Landing:
    """The folder of landed responses: `<number>.json` with the time and the text."""

    def __init__(self, path: str):
        self.uri = path
        self.system, self.path = fs.FileSystem.from_uri(path if ":" in path else posixpath.abspath(path))
        self.system.create_dir(self.path, recursive=True)

    def _content(self, number: int) -> dict | None:
        name = f"{self.path}/{number:012d}.json"
        if not self.system.get_file_info(name).is_file:
            return None
        try:
            return json.loads(self.system.open_input_stream(name).read())
        except ValueError:
            return None

    def count(self) -> int:
        """Whole responses that have landed. Only the last file can be torn; the next fetch takes its number."""
        names = [info.base_name for info in self.system.get_file_info(fs.FileSelector(self.path))]
        last = max((int(m[1]) for name in names if (m := re.fullmatch(r"(\d+)\.json", name))), default=-1)
        return last + 1 if last < 0 or self._content(last) is not None else last

    def land(self, number: int, response: str) -> None:
        with self.system.open_output_stream(f"{self.path}/{number:012d}.json") as out:
            out.write(json.dumps({"fetched": time.time(), "response": response}).encode())

    def read(self, number: int) -> dict:
        return self._content(number)


class Numbers(InputPartition):
    def __init__(self, start: int, end: int):
        super().__init__((start, end))


class Reader(DataSourceStreamReader):
    """Offsets are numbers of landed responses."""

    def __init__(self, options: dict):
        named = options["fetcher"]
        module, _, name = named.partition(":")
        given = {key.removeprefix("fetch."): value for key, value in options.items() if key.startswith("fetch.")}
        self.fetch = getattr(importlib.import_module(module), name)(**given)
        self.landing = Landing(options["landing"])
        self.most = int(options.get("perbatch", options.get("perBatch", "100")))
        self.rows = int(options.get("pertask", options.get("perTask", "1000")))

    def initialOffset(self) -> dict:
        return {"landed": 0}

    def latestOffset(self) -> dict:
        """Fetch, land, and only then name what a batch may read."""
        landed = self.landing.count()
        for _ in range(self.most):
            response = self.fetch(landed)
            if response is None:
                break
            self.landing.land(landed, response)
            landed += 1
        return {"landed": landed}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [Numbers(at, min(at + self.rows, end["landed"])) for at in range(start["landed"], end["landed"], self.rows)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        for number in range(*partition.value):
            landed = self.landing.read(number)
            yield self.landing.uri, number, datetime.fromtimestamp(landed["fetched"], UTC), landed["response"]


class FetchedResponses(DataSource):
    """`spark.readStream.format("fetched")`, with the options fetcher (`module:function`, which makes a function that
    fetches the response of a number, or None when there is none), its arguments as `fetch.<name>`, landing (a shared folder), perBatch and perTask."""

    @classmethod
    def name(cls) -> str:
        return "fetched"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return Reader(dict(self.options))


def fetched_responses(spark: SparkSession, fetcher: str, landing: str, **options) -> DataFrame:
    """Responses as `ingest_responses` takes them: an id from the landing folder and number, and the order of arrival."""
    spark.dataSource.register(FetchedResponses)
    rows = spark.readStream.format("fetched").options(fetcher=fetcher, landing=landing, **options).load()
    arrival = F.struct("fetched", "number").alias("arrival")
    return rows.select(stable_id("landed", "number").alias("id"), "response", arrival)
