"""Incremental state: watermarks, gaps, ranges, markers.  Control state is small and lives in JSON documents."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from velora.sources.objects import ObjectStore

DAY = timedelta(days=1)
#: Fixed value: days of one backfill chunk and of the window that every run repeats.
CHUNK_DAYS, WINDOW_DAYS, MOST_DAYS = 31, 31, 70


def read_watermark(store: ObjectStore, key: str, backfill_start: date, legacy_key: str = "last_date") -> date:
    """The last fully committed day; the day before the backfill start if there is none yet."""
    doc = store.get_json(key)
    value = (doc or {}).get("watermark") or (doc or {}).get(legacy_key)
    return date.fromisoformat(value) if value else backfill_start - DAY


def write_watermark(store: ObjectStore, key: str, day: date) -> None:
    store.put_json(key, {"watermark": day.isoformat()})


def bootstrap_watermark(store: ObjectStore, key: str, day: date) -> None:
    """Sets the first watermark; one that is there already is never overwritten."""
    if store.get_json(key) is not None:
        raise ValueError(f"{key} has a watermark already")
    write_watermark(store, key, day)


def require_watermark(store: ObjectStore, key: str, day: date) -> None:
    """Stops a run that was started for another day than the stored one."""
    found = (store.get_json(key) or {}).get("watermark")
    if found != day.isoformat():
        raise ValueError(f"the watermark is {found}, not {day}")


def contiguous_until(done: Iterable[date], watermark: date, before: date) -> date:
    """The watermark after all unbroken finished days before ``before``."""
    finished = set(done)
    while watermark + DAY < before and watermark + DAY in finished:
        watermark += DAY
    return watermark


def contiguous_islands(days: DataFrame, column: str) -> DataFrame:
    """Runs of unbroken days: ``first_day, last_day, days``; the days are few (one row a day)."""
    one = days.select(F.col(column).alias("d")).distinct()
    order = Window.orderBy("d")
    tagged = one.withColumn("island", F.date_sub("d", F.row_number().over(order)))
    return tagged.groupBy("island").agg(F.min("d").alias("first_day"), F.max("d").alias("last_day"), F.count(F.lit(1)).alias("days")).drop("island")


def missing_days(df: DataFrame, column: str, first: date, last: date) -> DataFrame:
    """Calendar days of the closed range without a row."""
    calendar = df.sparkSession.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("missing_day"))
    return calendar.join(df.select(F.col(column).alias("missing_day")).distinct(), "missing_day", "left_anti")


def confirmed_range(silver: date, bronze: date, most_days: int = MOST_DAYS) -> tuple[date, date] | None:
    """The days after the silver watermark that bronze has, at most so many; None if there are none."""
    first, last = silver + DAY, min(bronze, silver + timedelta(days=most_days))
    return (first, last) if first <= last else None


def sliding_ranges(silver: date, bronze: date, cutoff: date, window: int = WINDOW_DAYS) -> tuple[tuple[date, date] | None, tuple[date, date]]:
    """The backlog below the window (moves the watermark) and the window up to the cut-off (is repeated each run)."""
    first = cutoff - timedelta(days=window - 1)
    backlog = confirmed_range(silver, min(bronze, first - DAY))
    return backlog, (first, cutoff)


def lookback_start(first: date, days: int = 30) -> date:
    """Reports of a day may come in up to so many days earlier requests' partitions."""
    return first - timedelta(days=days)


def chunks(first: date, last: date, days: int = CHUNK_DAYS) -> list[tuple[date, date]]:
    out = []
    while first <= last:
        end = min(last, first + timedelta(days=days - 1))
        out.append((first, end))
        first = end + DAY
    return out


def open_chunks(first: date, last: date, done: Iterable[tuple[date, date]], days: int = CHUNK_DAYS) -> list[tuple[date, date]]:
    """Chunks without a completion marker."""
    finished = set(done)
    return [c for c in chunks(first, last, days) if c not in finished]


def advance_over(chunks_: Sequence[tuple[date, date]], done: Iterable[tuple[date, date]], watermark: date) -> tuple[date, tuple[date, date] | None]:
    """The watermark after the finished chunks up to the first gap, and that gap."""
    finished = set(done)
    for c in sorted(chunks_):
        if c not in finished:
            return watermark, c
        watermark = max(watermark, c[1])
    return watermark, None


def is_stale(watermark: date, today: date, most_days: int = 3) -> bool:
    return (today - watermark).days > most_days


def is_ready(watermark: date, target: date, offset: int = 0) -> bool:
    return watermark >= target - timedelta(days=offset)


def batches(items: Sequence, size: int) -> list[list]:
    """Consecutive lists of so many items, in order."""
    return [list(items[i : i + size]) for i in range(0, len(items), size)]


def marker(kind: str, day: date, at: datetime, **more) -> dict:
    return {"status": kind, "date": day.isoformat(), "written_at": at.isoformat()} | more
