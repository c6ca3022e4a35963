"""Daily marts and the reads that serve them."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velora.operators.decide import aging

#: The least healthy share in percent, and the labels of the urgency.
HEALTHY_ENOUGH = 70.0
PLENTY, SHORT = "여유있음", "부족함"


def bike_mart(risk: DataFrame, decision: DataFrame, location: DataFrame, stations: DataFrame, bikes: DataFrame, features: DataFrame, health: DataFrame, history: DataFrame, day: date) -> DataFrame:
    """One row per vehicle with a decision: place, health of the station, use, age and latest reports."""
    base = risk.join(decision.select("bike_id"), "bike_id", "left_semi").join(location.select("bike_id", F.col("last_station_id").alias("station_id")), "bike_id", "left")
    out = base.join(bikes.select("bike_id", "start_year"), "bike_id", "left").join(features.select("bike_id", "dist_km"), "bike_id", "left").join(history.select("bike_id", F.col("entries").alias("fail_history")), "bike_id", "left")
    out = out.join(stations.select("station_id", "station_name", "region", "district"), "station_id", "left").join(health.select("station_id", "healthy_ratio"), "station_id", "left")
    return out.select(
        "bike_id", "station_id", "station_name", "region", "district",
        F.coalesce("healthy_ratio", F.lit(100.0)).alias("healthy_ratio"),
        "risk_score", "risk_grade", "dist_km", "start_year",
        aging(F.col("start_year"), F.lit(day)).alias("aging"),
        F.coalesce("fail_history", F.array().cast("array<string>")).alias("fail_history"),
        F.lit(day).alias("snapshot_date"),
    )


def station_mart(stations: DataFrame, inventory: DataFrame, health: DataFrame, day: date) -> DataFrame:
    """One row per active station with its vehicles, those at risk and the urgency."""
    ratio = F.coalesce("healthy_ratio", F.lit(100.0))
    out = stations.join(inventory.select("station_id", "bike_cnt"), "station_id", "left").join(health, "station_id", "left")
    return out.select(
        "station_id", "station_name", "region", "district", "latitude", "longitude", "hold_num",
        F.coalesce("bike_cnt", F.lit(0)).cast("int").alias("bike_cnt"),
        F.coalesce("risk_cnt", F.lit(0)).cast("int").alias("risk_cnt"),
        ratio.alias("healthy_ratio"),
        F.when(ratio >= HEALTHY_ENOUGH, PLENTY).otherwise(SHORT).alias("urgency"),
        F.lit(day).alias("snapshot_date"),
    )


def at_latest(df: DataFrame, column: str = "snapshot_date", until: date | None = None) -> DataFrame:
    """The rows of the latest snapshot (at or before ``until``), by a scalar subquery's worth of one row."""
    seen = df if until is None else df.where(F.col(column) <= F.lit(until))
    newest = seen.agg(F.max(column).alias("__newest"))
    return df.join(F.broadcast(newest), F.col(column) == F.col("__newest")).drop("__newest")


def serving_pool(bikes: DataFrame, stations: DataFrame) -> DataFrame:
    """Vehicles of the latest day that need action, with the urgency of their station."""
    pool = at_latest(bikes).where("region IS NOT NULL AND risk_grade <> 'Normal'")
    return pool.join(stations.select("station_id", "snapshot_date", F.col("urgency").alias("station_urgency")), ["station_id", "snapshot_date"], "left").orderBy(F.desc("risk_score"), "bike_id")


def latest_batch(log: DataFrame, action: str, at: str = "actioned_at") -> DataFrame:
    """The rows of the newest confirmed batch as a whole."""
    mine = log.where(F.col("action_taken") == action)
    newest = mine.agg(F.max(at).alias("__newest"))
    return mine.join(F.broadcast(newest), F.col(at) == F.col("__newest")).drop("__newest")


def collect_targets(bikes: DataFrame, until: date, limit: int = 500) -> DataFrame:
    """The riskiest vehicles of the latest day at or before ``until``."""
    return at_latest(bikes, until=until).orderBy(F.desc_nulls_last("risk_score"), "bike_id").limit(limit).select("bike_id", "station_id")


def deploy_targets(events: DataFrame, day: date) -> DataFrame:
    """Vehicles whose newest event before ``day`` is a collection of the day before; at equal times the collection wins."""
    newest = F.max(F.struct("occurred_at", (F.col("event_type") == "COLLECT").alias("collected"), "station_id")).alias("e")
    found = events.where(F.col("occurred_at") < F.lit(day)).groupBy("bike_id").agg(newest)
    return found.where(F.col("e.collected") & (F.to_date("e.occurred_at") == F.date_sub(F.lit(day), 1))).select("bike_id", F.col("e.station_id").alias("station_id"))
