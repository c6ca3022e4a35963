"""The quality checks of each table, and how severe they are."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velora.operators.quality import Check, Result

log = logging.getLogger(__name__)
#: Fixed value: grades from the lowest to the highest.
GRADES = ("Normal", "Warning", "Critical")


def trips(name: str = "trips") -> Check:
    return Check(name).complete("bike_id").complete("rent_dt").uniqueness(["bike_id", "rent_dt"], 0.98)


def reports(name: str = "reports") -> Check:
    return Check(name).complete("bike_no").complete("reg_dttm").complete("failure_type").uniqueness(["bike_no", "reg_dttm", "failure_type"])


def stations(name: str = "stations") -> Check:
    return Check(name).complete("station_id").complete("region").non_negative("hold_num").uniqueness(["station_id"])


def actions(name: str = "actions") -> Check:
    return Check(name).complete("bike_id").complete("occurred_at").contained("event_type", ["COLLECT", "DEPLOY"]).uniqueness(["bike_id", "event_type", "occurred_at"])


def vehicles(name: str = "vehicles") -> Check:
    return Check(name).complete("bike_id").complete("start_year").uniqueness(["bike_id"])


def locations(name: str = "locations") -> Check:
    return Check(name).min_rows(1).complete("bike_id").complete("last_event_at").uniqueness(["bike_id"])


def inventory(name: str = "inventory") -> Check:
    return Check(name).min_rows(1).complete("station_id").non_negative("bike_cnt").non_negative("hold_num").uniqueness(["station_id"])


def features(name: str = "features") -> Check:
    return Check(name).min_rows(1).complete("bike_id").non_negative("trips").non_negative("dist_km").satisfies(F.col("trend_ratio") > 0, "trend").uniqueness(["snapshot_date", "bike_id"])


def risk(name: str = "risk") -> Check:
    return Check(name).min_rows(1).complete("bike_id").complete("risk_score").contained("risk_grade", GRADES).uniqueness(["bike_id"])


def decisions(name: str = "decisions") -> Check:
    return Check(name).min_rows(1).complete("bike_id").complete("action").contained("action", ["suspend", "hold"]).uniqueness(["bike_id"])


SETS: dict[str, Callable[[], Check]] = {f.__name__: f for f in (trips, reports, stations, actions, vehicles, locations, inventory, features, risk, decisions)}
#: Tables whose failed checks are reported and do not stop the batch.
LOG_ONLY = {"stations"}


def critical_share(df: DataFrame) -> DataFrame:
    """The share of Critical rows; a share far above the grade's percentile is worth a warning, not a stop."""
    return df.agg(F.round(F.avg((F.col("risk_grade") == "Critical").cast("int")), 6).alias("critical_share"))


def check_table(table: str, df: DataFrame) -> list[Result]:
    """Runs a table's checks and logs each; a failure is an error unless the table is log-only."""
    check = SETS[table]()
    results = check.run(df) if table in LOG_ONLY else check.require(df)
    for r in results:
        log.log(logging.WARNING if r.status == "FAIL" else logging.INFO, "%s %s: %s (%d of %d)", table, r.name, r.status, r.violations, r.total)
    return results
