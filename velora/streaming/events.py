"""Streaming forms of the daily operators.  The batch model repeats a few days each run; a stream waits for them instead."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velora.operators.latest import merge_state
from velora.sources.tables import Table


def daily_counts(events: DataFrame, at: str = "occurred_at", late: str = "3 days") -> DataFrame:
    """Events by day, type and vehicle; events up to ``late`` behind the newest one still count, once each."""
    once = events.withWatermark(at, late).dropDuplicatesWithinWatermark(["bike_id", "event_type", at])
    return once.groupBy(F.window(at, "1 day").alias("w"), "bike_id", "event_type").agg(F.count(F.lit(1)).alias("events")).select(F.to_date("w.start").alias("day"), "bike_id", "event_type", "events")


def keep_state(table: Table, key: str, at: str, values: list[str], buckets: int = 64) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that merges each batch's newest rows into a current-state table; replays change nothing.

    A table that is partitioned is dealt into ``buckets`` by a hash of the key, and a batch reads and rewrites only the
    buckets that it has keys of; one without partitions is small and rewritten whole.
    """

    def merge(batch: DataFrame, _: int) -> None:
        newest = batch.groupBy(key).agg(F.max(F.struct(at, *values)).alias("n")).select(key, *(f"n.{v}" for v in (*values, at)))
        if table.partition is None:
            table.replace_all(merge_state(table.read(), newest, key, at, values))
            return
        kind = table.schema[table.partition].dataType
        bucket = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast(kind)
        touched = [r[0] for r in newest.select(bucket.alias("b")).distinct().collect()]  # ``buckets`` at most
        if touched:
            state = table.read(F.col(table.partition).isin(touched)).drop(table.partition)
            table.replace_partitions(merge_state(state, newest, key, at, values).withColumn(table.partition, bucket), [str(b) for b in touched])

    return merge
