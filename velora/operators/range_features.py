"""Look-back features and labels for anchor dates, in one pass over a vehicle's days.

A vehicle's rows are sorted by day once.  A row knows the day of the next row, so it answers for just the anchors that lie
between the two (an as-of merge without a join), and it holds the rows of the bounded windows that may end there; open
windows are running sums.  How many anchors stand before a day is looked up in a constant table, so no row is compared with
anchors that do not concern it.  A vehicle and an anchor come out as one finished row: nothing behind the sort is grouped,
joined or shuffled, so a task's memory follows the vehicles' days and not the anchors, however many there are.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

NEVER_FAILED = 9999
KEY = "bike_id"
USED = ("trips", "dist_m", "dur_min", "instant_ret")
#: Days before and after all others, for rows without a neighbour.
NO_DAY, NO_NEXT = date(1000, 1, 1), date(9999, 12, 31)


class AnchorIndex:
    """The anchors in order, and how many of them are not after a day: one look into a table of the calendar's days."""

    def __init__(self, anchors: Sequence[date]):
        self.days = sorted(set(anchors))
        first, last = self.days[0], self.days[-1]
        self._counts = F.array(*(F.lit(bisect_right(self.days, first + timedelta(days=i))) for i in range((last - first).days + 1)))

    def upto(self, day: Column) -> Column:
        first, last = F.lit(self.days[0]), F.lit(self.days[-1])
        return F.when(day < first, F.lit(0)).when(day >= last, F.lit(len(self.days))).otherwise(F.get(self._counts, F.datediff(day, first)))

    def between(self, low: Column, high: Column) -> tuple[Column, Column]:
        """Bounds (from, to) of the numbers of the anchors after ``low`` and not after ``high``, for ``numbers``."""
        return self.upto(low), self.upto(high)

    def day(self, number: str) -> Column:
        return F.get(F.array(*(F.lit(d) for d in self.days)), F.col(number))


def numbers(a: Column, b: Column) -> Column:
    """a, ..., b - 1; none if b is not larger."""
    return F.when(b > a, F.sequence(a, b - 1)).otherwise(F.array().cast("array<int>"))


def _window_sums(held: str, names: dict[str, str], back: dict[int, int]) -> Column:
    """Sums over the rows of an array ``held`` (structs with ``day`` and values of the given types) that stand in each of
    the windows before ``as_of``: a struct of ``<value>_<i>``."""
    wide = [(n, i, kind) for n, kind in names.items() for i in back]
    start = F.struct(*(F.lit(0).cast(kind).alias(f"{n}_{i}") for n, i, kind in wide))

    def more(acc: Column, x: Column) -> Column:
        inside = {i: x["day"] >= F.date_sub("as_of", b) for i, b in back.items()}
        return F.struct(*((acc[f"{n}_{i}"] + F.when(inside[i], x[n]).otherwise(F.lit(0).cast(kind))).cast(kind).alias(f"{n}_{i}") for n, i, kind in wide))

    return F.aggregate(held, start, more)


def anchored_sums(rows: DataFrame, day: str, values: dict[str, Column], anchors: Sequence[date], back: Sequence[int | None], ahead: int = 0) -> DataFrame:
    """Per vehicle and anchor with a row in the first window: ``as_of, bike_id, last_day`` and ``<value>_<i>`` for the
    i-th window, which holds the days from ``as_of - back[i]`` up to, but without, ``as_of + ahead``.

    The first window is the longest; None leaves it open to the past.  Rows without day count nowhere, several rows of a
    day are added up (a row keeps all rows of its bounded windows, so a day should have few), and NULL values count as 0.
    """
    index, order = AnchorIndex(anchors), Window.partitionBy(KEY).orderBy(F.unix_date("__day"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.select(*(F.sum(v).alias(n) for n, v in values.items())).schema}
    bounded, opened = {i: b for i, b in enumerate(back) if b is not None}, [i for i, b in enumerate(back) if b is None]
    zeroed = [F.coalesce(v.cast(kinds[n]), F.lit(0).cast(kinds[n])).alias(n) for n, v in values.items()]
    src = near(rows, day, anchors, back[0], ahead).select(KEY, F.col(day).alias("__day"), *zeroed)
    ran = [F.sum(n).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)).cast(kinds[n]).alias(f"__{n}") for n in values if opened]
    held = [F.collect_list(F.struct(F.col("__day").alias("day"), *values)).over(order.rangeBetween(-(max(bounded.values()) + ahead), Window.currentRow)).alias("__held")] if bounded else []
    own = src.select(KEY, "__day", *ran, *held, F.coalesce(F.lead("__day").over(order), F.lit(NO_NEXT)).alias("__next"))
    longest = F.lit(NO_NEXT) if back[0] is None else F.date_add("__day", back[0])
    # the bounds are columns of a step before, as each is read several times
    first, last = index.between(F.date_sub("__day", ahead), F.least(F.date_sub("__next", ahead), longest))
    kept = own.withColumns({"__from": first, "__to": last}).where("__to > __from")
    each = kept.select("*", F.explode(numbers(F.col("__from"), F.col("__to"))).alias("k")).withColumn("as_of", index.day("k"))
    if bounded:
        each = each.withColumn("__sums", _window_sums("__held", kinds, bounded))
    sums = [(F.col(f"__{n}") if i in opened else F.col("__sums")[f"{n}_{i}"]).alias(f"{n}_{i}") for n in values for i in range(len(back))]
    return each.select("as_of", KEY, F.col("__day").alias("last_day"), *sums)


def near(df: DataFrame, at: str, anchors: Sequence[date], back: int | None, ahead: int = 0, include_today: bool = False) -> DataFrame:
    """Rows that some anchor's window may hold, by plain bounds on the column itself (a date or a timestamp), so that they
    reach the scan and whatever follows sees these days alone."""
    end = max(anchors) + timedelta(days=ahead + include_today)
    out = df.where(F.col(at) < F.lit(end))
    return out if back is None else out.where(F.col(at) >= F.lit(min(anchors) - timedelta(days=back)))


def trip_filters(df: DataFrame, max_kmh: float = 45.0, max_m: float = 50_000.0, zero_time_m: float = 5_000.0) -> DataFrame:
    """Without trips that are too fast, too long or far in no time.  A NULL distance or duration drops a trip where a
    condition depends on it, as in SQL's three-valued logic."""
    speed = F.try_divide(F.col("dist_m") / 1000.0, F.col("dur_min") / 60.0)
    # a zero duration is no speed: the first condition is then false, whatever the distance is
    fast = F.when(F.col("dur_min") > 0, speed > max_kmh).when(F.col("dur_min").isNull(), F.lit(None).cast("boolean")).otherwise(F.lit(False))
    still = (F.coalesce("dur_min", F.lit(0.0)) == 0) & (F.col("dist_m") > zero_time_m)
    return df.where(~fast & ~(F.col("dist_m") > max_m) & ~still)


def daily_rollup(trips: DataFrame, instant_m: float = 10.0) -> DataFrame:
    """Trips by vehicle and day, with distance, minutes and instant returns (same station, hardly any distance)."""
    instant = F.col("rent_station").isNotNull() & (F.col("rent_station") == F.col("return_station")) & (F.coalesce("dist_m", F.lit(99999.0)) <= instant_m)
    return trips.groupBy("bike_id", F.to_date("rent_at").alias("rent_date")).agg(
        F.count(F.lit(1)).alias("trips"),
        F.sum(F.coalesce("dist_m", F.lit(0.0))).alias("dist_m"),
        F.sum(F.coalesce("dur_min", F.lit(0.0))).alias("dur_min"),
        F.count(F.when(instant, 1)).alias("instant_ret"),
    )


def _usage(sums: DataFrame, *more: str | Column) -> DataFrame:
    first, one = F.col("trips_0") - F.col("trips_1"), F.lit(1.0).cast("double")
    trend = (F.col("trips_1").cast("double") + one) / (first.cast("double") + one)
    return sums.select("as_of", "bike_id", F.col("trips_0").alias("trips"), (F.col("dist_m_0") / 1000.0).alias("dist_km"), (F.col("dur_min_0") / 60.0).alias("dur_h"), F.col("instant_ret_0").alias("instant_ret"), F.datediff("as_of", "last_day").alias("days_since_last_rent"), trend.alias("trend_ratio"), *more)


def usage_features(daily: DataFrame, anchors: Sequence[date], window: int) -> DataFrame:
    """Use in the window before each anchor, and how its second half compares with its first."""
    return _usage(anchored_sums(daily, "rent_date", {c: F.col(c) for c in USED}, anchors, [window, window // 2]))


def usage_of(trips: DataFrame, anchors: Sequence[date], window: int) -> DataFrame:
    """``usage_features`` of trips: only the days of the windows are read and rolled up."""
    return usage_features(daily_rollup(near(trips, "rent_at", anchors, window)), anchors, window)


def fault_days(faults: DataFrame) -> DataFrame:
    """One row for each vehicle and day with a report."""
    return faults.select("bike_id", "reg_date").distinct()


def fault_features(faults: DataFrame, anchors: Sequence[date], fail_window: int = 150, lookback: int | None = None, include_today: bool = False) -> DataFrame:
    within = lookback is not None and lookback <= fail_window
    sums = anchored_sums(faults, "reg_date", {"n": F.lit(1)}, anchors, [lookback] if within else [lookback, fail_window], int(include_today))
    return sums.select("as_of", "bike_id", F.col("n_0" if within else "n_1").alias("fail_150d"), F.col("last_day").alias("last_fail_date"))


def _anchors_of(faults: DataFrame, anchors: Sequence[date], low: Column, high: Column) -> DataFrame:
    """A row for each anchor after ``low`` and not after ``high``; the bounds of a vehicle's rows do not overlap."""
    index = AnchorIndex(anchors)
    a, b = index.between(low, high)
    bounds = faults.select(KEY, a.alias("__from"), b.alias("__to"))
    return bounds.select(KEY, F.explode(numbers(F.col("__from"), F.col("__to"))).alias("k")).select(index.day("k").alias("as_of"), KEY)


def recently_reported(faults: DataFrame, anchors: Sequence[date], days: int) -> DataFrame:
    """Vehicles with a report in the days before the anchor; none for zero days.  The last report before it answers."""
    if days <= 0:
        return faults.select(F.lit(None).cast("date").alias("as_of"), "bike_id").where("false")
    following = F.coalesce(F.lead("reg_date").over(Window.partitionBy(KEY).orderBy("reg_date")), F.lit(NO_NEXT))
    rows = near(faults, "reg_date", anchors, days).select(KEY, "reg_date", following.alias("__next"))
    return _anchors_of(rows, anchors, F.col("reg_date"), F.least("__next", F.date_add("reg_date", days)))


def positives(faults: DataFrame, anchors: Sequence[date], horizon: int) -> DataFrame:
    """Vehicles with a report from the anchor on, within the horizon.  The first report from it on answers."""
    previous = F.coalesce(F.lag("reg_date").over(Window.partitionBy(KEY).orderBy("reg_date")), F.lit(NO_DAY))
    rows = near(faults, "reg_date", anchors, 0, horizon).select(KEY, "reg_date", previous.alias("__previous"))
    return _anchors_of(rows, anchors, F.greatest("__previous", F.date_sub("reg_date", horizon)), F.col("reg_date"))


def new_positives(faults: DataFrame, anchors: Sequence[date], horizon: int, exclude_days: int) -> DataFrame:
    return positives(faults, anchors, horizon).join(recently_reported(faults, anchors, exclude_days), ["as_of", "bike_id"], "left_anti")


def samples(trips: DataFrame, faults: DataFrame, anchors: Sequence[date], bike_class: Column, window: int = 14, horizon: int = 14, exclude_days: int = 30, fail_window: int = 150, lookback: int | None = None, include_today: bool = False, labels: bool = True) -> DataFrame:
    """Features of all vehicles used in the window, with label, exclusion flag and class.

    Days of use and days with a report go through one pass by vehicle: each row answers for the anchors up to the next one
    and holds the days of use in the window and the reports that its anchors' conditions may ask for, so features of
    anchors without use are never made and nothing is joined by anchor.  ``faults`` has a row for each day with a report.
    """
    index, order, today = AnchorIndex(anchors), Window.partitionBy(KEY).orderBy(F.unix_date("__day")), int(include_today)
    counted = fail_window if lookback is None else min(lookback, fail_window)
    ahead = max(horizon if labels else 0, today)
    daily = daily_rollup(near(trips, "rent_at", anchors, window))
    kinds = {c: daily.schema[c].dataType.simpleString() for c in USED}
    days = daily.select(KEY, F.col("rent_date").alias("__day"), F.struct(F.col("rent_date").alias("day"), *USED).alias("__used"), F.lit(None).cast("date").alias("__report"))
    known = near(faults, "reg_date", anchors, None if lookback is None else max(lookback, exclude_days), ahead)
    reports = known.select(KEY, F.col("reg_date").alias("__day"), F.lit(None).cast(days.schema["__used"].dataType).alias("__used"), F.col("reg_date").alias("__report"))
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = days.unionByName(reports).select(
        KEY,
        "__day",
        F.coalesce(F.lead("__day").over(order), F.lit(NO_NEXT)).alias("__next"),
        F.max("__used.day").over(so_far).alias("last_day"),
        F.max("__report").over(so_far).alias("__last"),
        F.collect_list("__used").over(order.rangeBetween(-window, Window.currentRow)).alias("__held"),
        F.collect_list("__report").over(order.rangeBetween(-counted, window + ahead)).alias("__reports"),
    )
    first, last = index.between(F.col("__day"), F.least("__next", F.date_add("last_day", window)))
    kept = own.where("last_day IS NOT NULL").withColumns({"__from": first, "__to": last}).where("__to > __from")
    each = kept.select("*", F.explode(numbers(F.col("__from"), F.col("__to"))).alias("k")).withColumn("as_of", index.day("k"))
    sums = each.withColumn("__sums", _window_sums("__held", kinds, {0: window, 1: window // 2})).select("*", "__sums.*")
    on_day = F.array_contains("__reports", F.col("as_of")) if include_today else F.lit(False)
    failed = F.when(on_day, F.col("as_of")).otherwise(F.col("__last"))
    if lookback is not None:
        failed = F.when(failed >= F.date_sub("as_of", lookback), failed)
    within = lambda low, high: lambda x: (x >= F.date_add("as_of", low)) & (x < F.date_add("as_of", high))
    out = _usage(
        sums,
        F.size(F.filter("__reports", within(-counted, today))).cast("long").alias("fail_150d"),
        F.coalesce(F.datediff("as_of", failed), F.lit(NEVER_FAILED)).alias("days_since_fail"),
        (F.exists("__reports", within(0, horizon)).cast("int") if labels else F.lit(None).cast("int")).alias("label"),
        (F.coalesce(F.col("__last") >= F.date_sub("as_of", exclude_days), F.lit(False)) if exclude_days > 0 else F.lit(False)).alias("excluded"),
    )
    return out.select(
        F.col("as_of").alias("snapshot_date"),
        "bike_id",
        "trips",
        "dist_km",
        "instant_ret",
        "fail_150d",
        "days_since_fail",
        "days_since_last_rent",
        "trend_ratio",
        "dur_h",
        "label",
        "excluded",
        bike_class.alias("bike_class"),
    )


def anchor_calendar(end: date, horizon: int, holdout_days: int = 60, step: int = 7, months: int = 24) -> dict[str, list[date]]:
    """Daily holdout anchors up to ``end``, a gap of the horizon, then training anchors every ``step`` days."""
    holdout = [end - timedelta(days=i) for i in range(holdout_days)][::-1]
    last, first = holdout[0] - timedelta(days=horizon), end - timedelta(days=30 * months)
    train = []
    while last >= first:
        train.append(last)
        last -= timedelta(days=step)
    return {"holdout": holdout, "train": train[::-1]}


def label_ready_until(rent_max: date, fault_max: date, horizon: int) -> date:
    return min(rent_max, fault_max - timedelta(days=horizon))
