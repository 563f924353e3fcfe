"""Paged requests and polling as Spark data sources, around a fetch function of the caller.

No HTTP client is included. ``fetch`` names a function as ``"module:function"`` that the executors
can import; keys and addresses are its business.
"""

from __future__ import annotations

import importlib
import json
import time
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    InputPartition,
)

from vejrkraft import fixed_values as fv


def _function(name: str) -> Callable:
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


class PageRequest(InputPartition):
    def __init__(self, parameter: str, offset: int, limit: int):
        super().__init__((parameter, offset, limit))


class _PageReader(DataSourceReader):
    def __init__(self, options):
        self.fetch = options["fetch"]
        self.parameters = [p.strip() for p in options["parameters"].split(",")]
        self.limit = int(options.get("limit", fv.OBSERVATION_PAGE_ROWS))
        if "offset_end" not in options:
            raise ValueError("offset_end: how many rows to ask for, in steps of limit")
        self.end = int(options["offset_end"])

    def partitions(self):
        return [
            PageRequest(p, offset, self.limit)
            for p in self.parameters
            for offset in range(0, self.end, self.limit)
        ]

    def read(self, partition) -> Iterator[tuple]:
        parameter, offset, limit = partition.value
        fetch = _function(self.fetch)
        try:
            page = fetch(parameter, offset, limit)
        except Exception as e:  # noqa: BLE001  told as a row
            yield parameter, offset, None, f"{type(e).__name__}: {e}"
            return
        if page is not None:
            yield parameter, offset, page if isinstance(page, str) else json.dumps(page), None


class PagedRequests(DataSource):
    """``parameter, offset, document, error``: one task per (parameter, offset) below ``offset_end``.

    ``fetch(parameter, offset, limit)`` returns the page as JSON text or as an object, None where there is
    none. A failed request gives a row with its error and no document; see ``answered``.
    """

    @classmethod
    def name(cls) -> str:
        return "paged_requests"

    def schema(self) -> str:
        return "parameter string, offset long, document string, error string"

    def reader(self, schema) -> DataSourceReader:
        return _PageReader(self.options)


def answered(requested: DataFrame) -> DataFrame:
    """The documents of all requests; the query fails if one of them failed."""
    failed = F.concat(F.lit("request failed: "), "parameter", F.lit(" at "), F.col("offset"), F.lit(": "), "error")
    document = F.when(F.col("error").isNotNull(), F.raise_error(failed)).otherwise(F.col("document"))
    return requested.select("parameter", "offset", document.alias("document"))


class Poll(InputPartition):
    def __init__(self, number: int, fetch: str):
        super().__init__((number, fetch))


class _Poller(DataSourceStreamReader):
    """The offset is the time of a poll in milliseconds. The driver only reads the clock; every document is fetched by a
    task of its own."""

    def __init__(self, options):
        self.fetches = [f.strip() for f in options["fetch"].split(",")]
        self.last = 0

    def initialOffset(self) -> dict:
        return {"poll": 0}

    def latestOffset(self) -> dict:
        self.last = max(self.last + 1, time.time_ns() // 1_000_000)
        return {"poll": self.last}

    def partitions(self, start: dict, end: dict) -> list[Poll]:
        # However long the source was not asked, there is one document to fetch now.
        return [Poll(end["poll"], f) for f in self.fetches] if end["poll"] > start["poll"] else []

    def read(self, partition: Poll) -> Iterator[tuple]:
        # After a failure a document cannot be asked for again, so the poll is repeated.
        number, name = partition.value
        try:
            document = _function(name)()
        except Exception as e:  # noqa: BLE001  told as a row
            yield number, name, None, f"{type(e).__name__}: {e}"
            return
        if document is not None:
            yield number, name, document if isinstance(document, str) else json.dumps(document), None

    def commit(self, end: dict) -> None:
        pass


class PolledDocument(DataSource):
    """A stream of ``poll, source, document, error``: one call of each function named in ``fetch`` (comma separated) per
    micro-batch, each in a task of its own; a failed one has its error.

    The poll interval is the trigger of the query.
    """

    @classmethod
    def name(cls) -> str:
        return "polled_document"

    def schema(self) -> str:
        return "poll long, source string, document string, error string"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Poller(self.options)


def register(spark: SparkSession) -> None:
    for source in (PagedRequests, PolledDocument):
        spark.dataSource.register(source)
