"""Paged services as a Spark data source: one input partition per request key (a day's hour), pages read in order."""

from __future__ import annotations

import json
import time
import urllib.request
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import date, timedelta

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from velora.sources.objects import ObjectStore


class TransientError(OSError):
    """Worth another try."""


def with_retry(call: Callable[[], dict], tries: int = 5, wait: float = 0.5, sleep: Callable[[float], None] = time.sleep) -> dict:
    """Doubles the wait after each transient failure and gives up after ``tries``."""
    for n in range(tries):
        try:
            return call()
        except TransientError:
            if n == tries - 1:
                raise
            sleep(wait * 2**n)
    raise AssertionError("unreachable")


def pages(fetch: Callable[[int, int], list[dict]], size: int = 1000) -> Iterator[dict]:
    """The rows of all pages; a short page is the last."""
    start = 1
    while True:
        got = fetch(start, start + size - 1)
        yield from got
        if len(got) < size:
            return
        start += size


def http_rows(url: str, row_path: str = "row") -> list[dict]:
    def call() -> dict:
        try:
            with urllib.request.urlopen(url, timeout=30) as r:  # noqa: S310
                return json.load(r)
        except OSError as e:
            raise TransientError(str(e)) from e

    doc = with_retry(call)
    for part in row_path.split("."):
        doc = doc.get(part, []) if isinstance(doc, dict) else doc
    return list(doc)


#: The services by name; a request adds its day, hour or page to the base address.
ENDPOINTS = {
    "rentals": "{base}/rentHist/{{first}}/{{last}}/{{key}}",
    "reports": "{base}/brokenReport/{{first}}/{{last}}/{{key}}",
    "stations": "{base}/stationInfo/{{first}}/{{last}}/",
    "live": "{base}/stationLive/{{first}}/{{last}}/",
}


def endpoint(name: str, base: str) -> str:
    """The address template of a service for ``PagedSource``."""
    return ENDPOINTS[name].format(base=base.rstrip("/"))


def report_days(day: date) -> list[str]:
    """Reports come in late, so a day's run asks for the day before and the day itself."""
    return [(day - timedelta(days=1)).isoformat(), day.isoformat()]


def collect_hours(store: ObjectStore, prefix: str, day: date, hours: Sequence[int], fetch: Callable[[int], list[dict]], manifest: dict, threads: int = 8) -> dict:
    """Fetches a day's hours side by side and stores their rows in the order of the hours, then the manifest.

    An hour that fails leaves out its rows alone: the others are kept, and the manifest names the hours that are there and
    is COMPLETE only with all of them.  The manifest is written after the payload, so it never tells of rows that are not there.
    """
    with ThreadPoolExecutor(threads) as pool:
        running = {h: pool.submit(fetch, h) for h in sorted(hours)}
    got = {h: f.result() for h, f in running.items() if f.exception() is None}
    rows = [r for h in sorted(got) for r in got[h]]
    store.put_json(f"{prefix}/payload.json", {"rows": rows})
    doc = manifest | {"target_date": day.isoformat(), "hours": sorted(got), "failed": sorted(set(hours) - set(got)), "rows": len(rows), "status": "COMPLETE" if len(got) == len(hours) else "PARTIAL"}
    store.put_json(f"{prefix}/manifest.json", doc)
    return doc


class KeyPartition(InputPartition):
    def __init__(self, key: str):
        super().__init__(key)


class PagedReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.schema, self.options = schema, options

    def partitions(self) -> list[KeyPartition]:
        return [KeyPartition(k) for k in self.options.get("keys", "").split(",")]

    def read(self, partition: KeyPartition) -> Iterator[tuple]:
        template, size = self.options["url"], int(self.options.get("pagesize", "1000"))
        names = self.schema.fieldNames()
        fetch = lambda first, last: http_rows(template.format(first=first, last=last, key=partition.value), self.options.get("rowpath", "row"))
        for row in pages(fetch, size):
            yield tuple(None if row.get(n) is None else str(row.get(n)) for n in names)


class PagedSource(DataSource):
    """Options: ``url`` with {first}, {last} and {key}; ``keys`` by commas; ``pagesize``; ``rowpath``."""

    @classmethod
    def name(cls) -> str:
        return "paged_rest"

    def schema(self) -> str:
        raise ValueError("give the columns by .schema(...): all are texts")

    def reader(self, schema: StructType) -> PagedReader:
        return PagedReader(schema, dict(self.options))
