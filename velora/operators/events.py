"""Synthetic field events for the daily cycle of collection and return."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velora.functions.values import event_uuid

WORKERS = 20


def events_for(targets: DataFrame, kind: str, day: date, namespace: uuid.UUID, workers: int = WORKERS) -> DataFrame:
    """One event a vehicle at nine o'clock, received a quarter of an hour later; ids depend on vehicle, kind and day alone,
    so that a repeated run adds nothing, and the worker is chosen by a hash for the same reason."""
    name = F.concat_ws(":", F.col("bike_id").cast("string"), F.lit(kind), F.lit(day.isoformat()))
    at = F.to_timestamp(F.lit(f"{day.isoformat()} 09:00:00"))
    worker = F.concat(F.lit("W-"), F.pmod(F.xxhash64("bike_id", F.lit(kind), F.lit(day.isoformat())), F.lit(workers)) + 1)
    return targets.select(event_uuid(name, namespace).alias("event_id"), F.lit(kind).alias("event_type"), "bike_id", "station_id", worker.alias("worker_id"), at.alias("occurred_at"), (at + F.expr("INTERVAL 15 MINUTES")).alias("received_at"))
