"""A paged open-data API as a Spark data source.

Each partition reads a range of row ids page by page: the next page begins
after the last id of the one before. Filters are pushed to the API as far as
they compare a field with a literal.
"""

from __future__ import annotations

import json
import random
import sys
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

from gneiss.config import IngestSettings

RETRY = {429, 500, 502, 503, 504}

Fetch = Callable[[str, dict[str, str]], tuple[int, dict[str, str], str]]


def fetch(url: str, params: dict[str, str]) -> tuple[int, dict[str, str], str]:
    """(status, headers, body) of a GET."""
    try:
        with urllib.request.urlopen(f"{url}?{urllib.parse.urlencode(params)}", timeout=IngestSettings().timeout_s) as r:
            return r.status, dict(r.headers), r.read().decode()
    except urllib.error.HTTPError as e:
        return e.code, dict(e.headers), ""


def delay(attempt: int, headers: dict[str, str], s: IngestSettings, jitter: float | None = None) -> float:
    """Seconds before the next attempt: what the server asks for, else doubling up to a cap, with up to a quarter more."""
    asked = headers.get("Retry-After", "")
    if asked.isdigit():
        return float(asked)
    return min(s.backoff_cap_s, s.backoff_base_s * 2**attempt) * (1 + 0.25 * (random.random() if jitter is None else jitter))


def get(url: str, params: dict[str, str], s: IngestSettings, get_: Fetch = fetch, sleep: Callable[[float], None] = time.sleep) -> list[dict]:
    """A page's objects; passing errors are tried again."""
    for attempt in range(s.max_retries + 1):
        status, headers, body = get_(url, params)
        if status == 200:
            return json.loads(body)
        if status not in RETRY or attempt == s.max_retries:
            raise RuntimeError(f"{url} answered {status} after {attempt + 1} attempts")
        sleep(delay(attempt, headers, s))
    return []


def pages(url: str, where: str | None, fields: tuple[str, ...], s: IngestSettings, low: str | None = None, high: str | None = None, get_: Fetch = fetch, sleep: Callable[[float], None] = time.sleep) -> Iterator[list[dict]]:
    """Pages of rows with ids above `low` and up to `high`, in the order of ids, at most max_records rows."""
    left, last = s.max_records, low
    while left > 0:
        limit = min(s.page_size, left)
        parts = [f"({where})"] if where else []
        parts += [f":id > '{last}'"] if last else []
        parts += [f":id <= '{high}'"] if high else []
        params = {"$select": ",".join((":id", ":updated_at", *fields)) if fields else ":*,*", "$order": ":id", "$limit": str(limit)}
        if parts:
            params["$where"] = " AND ".join(parts)
        rows = get(url, params, s, get_, sleep)
        if not rows:
            return
        yield rows
        left, last = left - len(rows), rows[-1][":id"]
        if len(rows) < limit:
            return


class OpenDataSource(DataSource):
    """format("opendata"): the API's rows as text columns, and whole as JSON in `payload`.

    Options: url; where, a filter for the API; fields, comma-separated; ordered,
    those of the fields whose order at the API is that of their text, as of
    dates; bounds, comma-separated row ids that cut partitions; page_size; and
    max_records, a cap on the whole read (0: none), which takes one partition
    because pages are then counted in the order of row ids.
    """

    @classmethod
    def name(cls) -> str:
        return "opendata"

    def schema(self) -> str:
        return ", ".join(f"`{f}` string" for f in (":id", ":updated_at", *_listed(self.options, "fields"), "payload"))

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options), [f.name for f in schema.fields])


def _listed(options: dict, key: str) -> tuple[str, ...]:
    return tuple(x.strip() for x in options.get(key, "").split(",") if x.strip())


class _Reader(DataSourceReader):
    """Filters go to the API and are applied again by Spark, so that a looser reading there does no harm."""

    def __init__(self, options: dict, columns: list[str]):
        self.options, self.columns, self.pushed = options, columns, []

    def pushFilters(self, filters: list):
        marks = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}
        ordered = {":id", ":updated_at", *_listed(self.options, "ordered")}
        for f in filters:
            name = ".".join(getattr(f, "attribute", ()))
            if type(f) in marks and name != "payload" and (type(f) is EqualTo or name in ordered) and isinstance(f.value, str):
                literal = f.value.replace("'", "''")
                self.pushed.append(f"{name} {marks[type(f)]} '{literal}'")
            yield f

    def partitions(self):
        cuts = _listed(self.options, "bounds") if self._limits().max_records == sys.maxsize else ()
        return [InputPartition(x) for x in zip([None, *cuts], [*cuts, None])]

    def _limits(self) -> IngestSettings:
        o, s = self.options, IngestSettings()
        return IngestSettings(max_records=int(o.get("max_records", s.max_records)) or sys.maxsize, page_size=int(o.get("page_size", s.page_size)))

    def read(self, partition):
        o = self.options
        parts = [f"({x})" for x in (o.get("where"), *self.pushed) if x]
        for page in pages(o["url"], " AND ".join(parts) or None, _listed(o, "fields"), self._limits(), *partition.value):
            for row in page:
                yield tuple(json.dumps(row) if c == "payload" else None if (v := row.get(c)) is None else v if isinstance(v, str) else json.dumps(v) for c in self.columns)


def read_api(spark: SparkSession, url: str, **options: str) -> DataFrame:
    """The rows at `url`; see OpenDataSource for the options."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(OpenDataSource)
    return spark.read.format("opendata").options(url=url, **{k: v for k, v in options.items() if v is not None}).load()
