"""Cleansing: aliases, typed rows, normalised places, quarantine and gates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velora.functions.dates import parse_datetime, parse_failed, report_day
from velora.functions.values import entity_id, squeezed
from velora.schemas import PAGING_COLUMNS


class GateError(ValueError):
    """A batch must stop before anything is written."""


def alias_select(df: DataFrame, aliases: Mapping[str, Sequence[str]], required: Sequence[str] = ()) -> DataFrame:
    """Standard columns as text, each from the first alias that the input has; NULL without one."""
    found = {name: next((a for a in options if a in df.columns), None) for name, options in aliases.items()}
    missing = [n for n in required if found.get(n) is None]
    if missing:
        raise GateError(f"required columns are missing: {missing}")
    return df.select(*((F.col(f"`{src}`").cast("string") if src else F.lit(None).cast("string")).alias(n) for n, src in found.items()))


def first_alias(df: DataFrame, aliases: Mapping[str, Sequence[str]]) -> DataFrame:
    """Standard columns, each row taking the first alias that is not NULL in it."""
    return df.select(*(F.coalesce(*(F.col(f"`{a}`").cast("string") for a in options if a in df.columns), F.lit(None).cast("string")).alias(n) for n, options in aliases.items()))


def without_paging(df: DataFrame) -> DataFrame:
    """Without the columns that tell a page's place in a paged answer."""
    return df.drop(*PAGING_COLUMNS)


def standard_trips(trips: DataFrame, names: Mapping[str, str], since: str | None = None) -> DataFrame:
    """Trips under their standard names, with minutes: those of the input if ``names`` has ``dur_min``, else from start and
    return.  Vehicles are in upper case without white space; rows without vehicle or start, and those before ``since``, go.
    """
    c = lambda n: F.col(f"`{names[n]}`")
    base = trips.select(
        entity_id(c("bike_id")).alias("bike_id"),
        c("rent_at").cast("timestamp_ntz").alias("rent_at"),
        c("return_at").cast("timestamp_ntz").alias("return_at"),
        c("dist_m").cast("double").alias("dist_m"),
        c("rent_station").cast("string").alias("rent_station"),
        c("return_station").cast("string").alias("return_station"),
        *([c("dur_min").cast("double").alias("dur_min")] if names.get("dur_min") else []),
    )
    if not names.get("dur_min"):
        seconds = F.timestamp_diff("SECOND", F.col("rent_at"), F.col("return_at"))
        base = base.withColumn("dur_min", seconds.cast("double") / 60.0)
    base = base.where("bike_id IS NOT NULL AND rent_at IS NOT NULL")
    return base if since is None else base.where(F.col("rent_at") >= F.lit(since).cast("timestamp_ntz"))


def recognised(columns: Sequence[str], aliases: Mapping[str, Sequence[str]], least: int) -> bool:
    """Whether enough known headers are there to take a file for the dataset."""
    return sum(any(a in columns for a in options) for options in aliases.values()) >= least


def typed_trips(bronze: DataFrame) -> DataFrame:
    """Typed rows; ``bad_date`` marks a date that no known format fits."""
    typed = bronze.withColumn("rent_at", parse_datetime(F.col("rent_dt"))).withColumn("return_at", parse_datetime(F.col("return_dt")))
    bad = parse_failed(F.col("rent_dt"), F.col("rent_at")) | parse_failed(F.col("return_dt"), F.col("return_at"))
    rest = [c for c in bronze.columns if c not in ("bike_id", "rent_dt", "return_dt", "use_distance_m")]
    return typed.select("bike_id", F.col("rent_at").alias("rent_dt"), F.col("return_at").alias("return_dt"), F.col("use_distance_m").try_cast("double").alias("use_distance_m"), *rest, bad.alias("bad_date"))


def silver_trips(bronze: DataFrame) -> DataFrame:
    """Typed trips without unknown keys, one per vehicle and start; an unknown date format stops the batch."""
    from velora.operators.latest import first_rows

    typed = typed_trips(bronze)
    failed = typed.agg(F.count(F.when(F.col("bad_date"), 1)).alias("n")).first().n
    if failed:
        raise GateError(f"{failed} rows have a date in an unknown format")
    order = [F.asc_nulls_last("return_dt"), *(F.asc_nulls_first(c) for c in ("rent_station_id", "return_station_id", "use_distance_m", "source_file", "ingested_at"))]
    return first_rows(typed.drop("bad_date").where("bike_id IS NOT NULL AND rent_dt IS NOT NULL"), ["bike_id", "rent_dt"], order)


def with_reasons(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """``quarantine_reason``: the broken rules' names joined by commas, NULL if none is broken."""
    reasons = F.concat_ws(",", *(F.when(F.coalesce(broken, F.lit(False)), F.lit(name)) for name, broken in rules.items()))
    return df.withColumn("quarantine_reason", F.nullif(reasons, F.lit("")))


def split_quarantine(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Clean rows, and broken ones with their reasons."""
    marked = with_reasons(df, rules)
    return marked.where("quarantine_reason IS NULL").drop("quarantine_reason"), marked.where("quarantine_reason IS NOT NULL")


def trip_rules() -> dict[str, Column]:
    return {"return_before_rent": F.col("return_dt") < F.col("rent_dt"), "negative_distance": F.col("use_distance_m") < 0}


def quarantine_gate(broken: int, total: int, most: float = 0.01) -> None:
    if total and broken / total > most:
        raise GateError(f"{broken} of {total} rows are in quarantine, more than {most:.2%}")


def failure_reports(bronze: DataFrame) -> DataFrame:
    """Reports with their own day and the day that was asked for."""
    if "requested_date" not in bronze.columns:
        bronze = bronze.withColumn("requested_date", F.lit(None).cast("string"))
    day = bronze.select("bike_no", report_day(F.col("reg_dttm")).alias("reg_dttm"), F.trim("failure_type").alias("failure_type"), F.coalesce("requested_date", "reg_date_partition").alias("declared_reg_date"))
    return day.withColumn("reg_date_partition", F.date_format("reg_dttm", "yyyy-MM-dd"))


def split_future(df: DataFrame, cutoff: date, column: str = "reg_date_partition") -> tuple[DataFrame, DataFrame]:
    """Rows up to the cut-off, and later or undated ones."""
    within = F.coalesce(F.col(column) <= F.lit(cutoff.isoformat()), F.lit(False))
    return df.where(within), df.where(~within)


def in_range(df: DataFrame, column: str, low: str, high: str) -> DataFrame:
    return df.where(F.col(column).between(low, high))


def stations(bronze: DataFrame, region_of: Mapping[str, str]) -> DataFrame:
    """Typed stations with the region of their district; a text that is no number becomes NULL."""
    region = F.create_map(*(F.lit(x) for pair in region_of.items() for x in pair)) if region_of else None
    return bronze.select(
        F.col("snapshot_date").try_cast("date").alias("snapshot_date"),
        "station_id",
        squeezed(F.col("station_name")).alias("station_name"),
        "district",
        (F.try_element_at(region, F.col("district")) if region is not None else F.lit(None).cast("string")).alias("region"),
        F.col("latitude").try_cast("double").alias("latitude"),
        F.col("longitude").try_cast("double").alias("longitude"),
        F.round(F.col("hold_num").try_cast("double")).try_cast("int").alias("hold_num"),
    )


def districts_without_region(df: DataFrame) -> DataFrame:
    """``district`` once for each that has no region."""
    return df.where("district IS NOT NULL AND region IS NULL").select("district").distinct()


def event_rules(now: datetime, service_start: date, allowed: Sequence[str]) -> dict[str, Column]:
    """Rules for field events; an empty text counts as absent."""
    absent = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    return {
        "null_bike_id": absent("bike_id"),
        "null_event_type": absent("event_type"),
        "invalid_event_type": ~absent("event_type") & ~F.col("event_type").isin(*allowed),
        "null_occurred_at": F.col("occurred_at").isNull(),
        "occurred_before_service_start": F.to_date("occurred_at") < F.lit(service_start),
        "occurred_in_future": F.col("occurred_at") > F.lit(now),
        "occurred_after_received": F.col("occurred_at") > F.col("received_at"),
    }


def classify_events(df: DataFrame, now: datetime, service_start: date, allowed: Sequence[str]) -> DataFrame:
    """All events with their reasons; an unknown type is named in its reason."""
    marked = with_reasons(df, event_rules(now, service_start, allowed))
    named = F.expr("replace(quarantine_reason, 'invalid_event_type', concat('invalid_event_type:', event_type))")
    return marked.withColumn("quarantine_reason", F.when(F.col("event_type").isNull(), F.col("quarantine_reason")).otherwise(named))
