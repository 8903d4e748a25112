"""Paged JSON API as a Spark data source.

`GET base/table?limit&offset[&<hwm>_gt=since]`. With a known total every task fetches its own run
of pages; without one a single task follows pages until an empty or short one. Offset paging may
repeat rows while the server takes inserts, so `read_paged_api` drops repeats by key when given one.
"""

from __future__ import annotations

import importlib
import json
import os
from collections.abc import Iterator, Mapping
from typing import Any
from urllib import parse, request

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


def http_get(url: str, params: Mapping[str, Any], headers: Mapping[str, str], timeout: int):
    """(decoded JSON body, total rows if the server tells) of one request."""
    req = request.Request(f"{url}?{parse.urlencode(params)}", headers=dict(headers))
    with request.urlopen(req, timeout=timeout) as resp:
        total = resp.headers.get("X-Total-Count")
        return json.load(resp), int(total) if total is not None else None


class Pages(InputPartition):
    """Offsets [start, stop) in steps of the page size; `stop` None means until the last page."""

    def __init__(self, start: int, stop: int | None):
        self.start = start
        self.stop = stop


class PagedReader(DataSourceReader):
    def __init__(self, schema, options):
        self.fields = [f.name for f in schema.fields]
        self.url = f"{options['base_url'].rstrip('/')}/{options['table']}"
        self.page = int(options.get("page_size", "5000"))
        self.tasks = int(options.get("tasks", "64"))
        self.timeout = int(options.get("timeout", "30"))
        self.records_key = options.get("records_key")
        self.token_env = options.get("token_env")
        self.transport = options.get("transport")
        self.filter = {}
        if options.get("since") is not None:
            self.filter[options.get("since_param") or f"{options['hwm']}_gt"] = options["since"]
        if self.page < 1:
            raise ValueError("page_size must be positive")

    def _get(self, limit: int, offset: int):
        send = http_get
        if self.transport:
            module, name = self.transport.split(":")
            send = getattr(importlib.import_module(module), name)
        token = os.environ.get(self.token_env) if self.token_env else None
        headers = {"Authorization": f"Bearer {token}"} if token else {}
        body, total = send(self.url, {"limit": limit, "offset": offset, **self.filter}, headers, self.timeout)
        return (body[self.records_key] if self.records_key else body), total

    def partitions(self):
        _, total = self._get(1, 0)
        if total is None:
            return [Pages(0, None)]
        pages = max(1, -(-total // self.page))
        run = -(-pages // min(self.tasks, pages))
        starts = range(0, pages, run)
        # the last task reads on to the end: rows may arrive between the count and the fetch
        return [
            Pages(s * self.page, (s + run) * self.page if s + run < pages else None) for s in starts
        ]

    def read(self, partition: Pages) -> Iterator[tuple]:
        offset = partition.start
        while partition.stop is None or offset < partition.stop:
            rows, _ = self._get(self.page, offset)
            for row in rows:
                yield tuple(row.get(f) for f in self.fields)
            if len(rows) < self.page:
                return
            offset += self.page


class PagedApi(DataSource):
    @classmethod
    def name(cls):
        return "paged_api"

    def schema(self):
        raise ValueError("paged_api needs a schema: spark.read.format('paged_api').schema(...)")

    def reader(self, schema):
        return PagedReader(schema, self.options)


def read_paged_api(spark: SparkSession, source: Mapping[str, Any], table: str, hwm: str, since: Any = None) -> DataFrame:
    spark.dataSource.register(PagedApi)
    options = {
        k: str(source[k])
        for k in ("base_url", "page_size", "tasks", "timeout", "records_key", "token_env", "since_param", "transport")
        if source.get(k) is not None
    }
    options.update(table=table, hwm=hwm)
    if since is not None:
        options["since"] = str(since)
    df = spark.read.format("paged_api").schema(source["schema"]).options(**options).load()
    return df.dropDuplicates(list(source["key"])) if source.get("key") else df
