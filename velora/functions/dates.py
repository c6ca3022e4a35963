"""Date and number parsing with the rules of the fleet model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Formats in order of priority; one-letter fields take one or two digits.
DATETIME_FORMATS = ("yyyy-M-d H:m:s", "yyyyMMddHHmmss", "yyyy-M-d", "yyyyMMdd")


def parse_datetime(text: Column) -> Column:
    """The first format that fits; NULL if none does."""
    return F.coalesce(*(F.try_to_timestamp(text, F.lit(f)) for f in DATETIME_FORMATS))


def parse_failed(raw: Column, parsed: Column) -> Column:
    """A value was there and no format fitted."""
    return F.coalesce((raw.isNotNull() & (F.trim(raw) != "") & parsed.isNull()), F.lit(False))


def report_day(text: Column) -> Column:
    """A day inside a longer text (``2026.1.2`` or ``2026-01-02``), else a bare ``yyyyMMdd``."""
    found = F.translate(F.regexp_extract(text, r"(\d{4}[-.]\d{1,2}[-.]\d{1,2})", 1), ".", "-")
    return F.coalesce(F.try_to_timestamp(found, F.lit("yyyy-M-d")), F.try_to_timestamp(text, F.lit("yyyyMMdd")))


def date_partition(text: Column) -> Column:
    """``yyyy-MM-dd`` from the first eight digits; an absent text gives the empty text."""
    digits = F.regexp_replace(F.coalesce(text, F.lit("")), r"\D", "")
    parts = F.concat_ws("-", F.substring(digits, 1, 4), F.substring(digits, 5, 2), F.substring(digits, 7, 2))
    return F.when(F.length(digits) >= 8, parts).otherwise(F.lit(""))


def rounded_int(text: Column) -> Column:
    """An integer from a decimal text, halves away from zero; NULL if it is no number."""
    return F.round(text.try_cast("double")).try_cast("int")


def kst_cutoff(value: str | None):
    """A cut-off with a time zone, in Seoul time and without microseconds; without a value it is now."""
    from datetime import datetime, timedelta, timezone

    seoul = timezone(timedelta(hours=9))
    at = datetime.fromisoformat(value) if value else datetime.now(seoul)
    if at.tzinfo is None:
        raise ValueError(f"the cut-off needs a time zone: {value}")
    return at.astimezone(seoul).replace(microsecond=0)


def stamped(df: DataFrame, column: str = "ingested_at") -> DataFrame:
    """Rows with the time at which their query started, the same for all of them."""
    return df.withColumn(column, F.current_timestamp())
