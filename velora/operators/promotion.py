"""Promotion of collected days into a table: count first, one swap, markers last."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velora.operators.state import batches, marker
from velora.sources.objects import ObjectStore
from velora.sources.tables import Table

#: Fixed value: days of one catch-up batch.
CATCH_UP_DAYS = 6
log = logging.getLogger(__name__)


def marker_key(dataset: str, day: date) -> str:
    return f"promotion/{dataset}/{day.isoformat()}.json"


def promote(table: Table, payloads: Mapping[date, DataFrame], store: ObjectStore, dataset: str, at: datetime) -> dict[date, int]:
    """Replace all the days at once and mark each complete.

    A payload that cannot be read or lacks rows stops the promotion before the table is touched; a day is marked only
    after the swap, so a crash in between is repaired by running again.
    """
    if not payloads:
        return {}
    days = {d.isoformat(): d for d in payloads}
    kind = table.schema[table.partition].dataType
    parts = [payloads[d].withColumn(table.partition, F.lit(text).cast(kind)) for text, d in days.items()]
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    counted = {r[0]: r.n for r in whole.groupBy(F.col(table.partition).cast("string")).agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a day
    empty = sorted(set(days) - set(counted))
    if empty:
        raise ValueError(f"payloads without rows: {empty}")
    table.replace_partitions(whole, list(days))
    for text, d in days.items():
        store.put_json(marker_key(dataset, d), marker("COMPLETE", d, at, rows=counted[text]))
    return {d: counted[t] for t, d in days.items()}


def catch_up(table: Table, payloads: Mapping[date, DataFrame], store: ObjectStore, dataset: str, at: datetime, size: int = CATCH_UP_DAYS) -> int:
    """Many days, a few of them per swap, in order; how many swaps were made."""
    groups = batches(sorted(payloads), size)
    for group in groups:
        promote(table, {d: payloads[d] for d in group}, store, dataset, at)
    return len(groups)


def catch_up_day(table: Table, payload: Callable[[], DataFrame], store: ObjectStore, dataset: str, day: date, at: datetime) -> str:
    """One day that was missed, collected and replaced; its marker tells how it ended, and a failure is raised after it.

    A day whose payload has no rows is emptied and marked COMPLETE_EMPTY.
    """
    try:
        rows = payload().withColumn(table.partition, F.lit(day.isoformat()).cast(table.schema[table.partition].dataType))
        table.replace_partitions(rows, [day.isoformat()])
        count = table.read(F.col(table.partition).cast("string") == day.isoformat()).count()
        doc = marker("COMPLETE" if count else "COMPLETE_EMPTY", day, at, rows=count, error=None)
    except Exception as e:
        store.put_json(marker_key(dataset, day), marker("FAILED", day, at, rows=0, error=str(e)[:500]))
        raise
    store.put_json(marker_key(dataset, day), doc)
    return doc["status"]


def confirm_empty(store: ObjectStore, dataset: str, day: date, watermark: date, manifest: Mapping, at: datetime) -> None:
    """Mark a day as truly empty: all 24 hours were collected, none had rows, and the day follows the watermark."""
    if day != watermark + timedelta(days=1):
        raise ValueError(f"{day} does not follow the watermark {watermark}")
    if sorted(manifest.get("hours", ())) != list(range(24)) or manifest.get("rows") != 0:
        raise ValueError(f"no evidence that {day} is empty")
    store.put_json(marker_key(dataset, day), marker("COMPLETE_EMPTY", day, at))


def finished_days(store: ObjectStore, dataset: str, accepted: tuple[str, ...] = ("COMPLETE", "COMPLETE_EMPTY")) -> list[date]:
    """Days with an accepted marker."""
    names = [k for k in store.keys(f"promotion/{dataset}") if k.endswith(".json")]
    docs = (store.get_json(f"promotion/{dataset}/{k}") for k in names)
    return sorted(date.fromisoformat(d["date"]) for d in docs if d and d["status"] in accepted)


def collect_stats(payload: DataFrame, day: str) -> DataFrame:
    """Rows, first and last day and number of days of a collected response."""
    return payload.agg(F.count(F.lit(1)).alias("rows"), F.min(day).alias("first"), F.max(day).alias("last"), F.countDistinct(day).alias("days"))


def append_quietly(table: Table, df: DataFrame) -> bool:
    """Append results that must never stop the data's own path."""
    try:
        table.append(df)
    except Exception:  # the quality log is an extra
        log.exception("results were not stored")
        return False
    return True


def write_samples(df: DataFrame, root: str, anchor_type: str) -> None:
    """Training samples as one folder per anchor type, partitioned by snapshot."""
    df.hint("rebalance", "snapshot_date").write.mode("overwrite").partitionBy("snapshot_date").parquet(f"{root}/anchor_type={anchor_type}")


def rebuild(table: Table, partition: str) -> Table:
    """The same rows under another partitioning: written beside, then swapped by renames that a second run completes."""
    root, name = table.root.rsplit("/", 1)
    store = ObjectStore(table.spark, root)
    new, old = f"{name}.new", f"{name}.old"
    if not store.exists(old):  # else a run stopped between the renames
        if not store.exists(f"{new}/_SUCCESS"):
            table.read().repartition(partition).write.mode("overwrite").partitionBy(partition).parquet(f"{root}/{new}")
        store.rename(name, old)
    if store.exists(new):
        store.rename(new, name)
    store.delete(old)
    fields = [f for f in table.schema if f.name != partition] + [table.schema[partition]]
    return Table(table.spark, table.root, type(table.schema)(fields), partition)
