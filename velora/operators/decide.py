"""Grades from scores, decisions under station capacity, and station inventory."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velora.operators.ranking import within_capacity
from velora.sources.tables import written


def exact_percentiles(df: DataFrame, column: str, shares: Sequence[float], cells: int = 4096, most: int = 100_000) -> list[float | None]:
    """The exact, linearly interpolated percentiles of a numeric column without its NULLs; None of nothing.

    One pass counts the values of equal ranges between the smallest and the largest.  A range that holds a wanted rank is
    narrowed by further passes until it has ``most`` different values or fewer, which are then counted one by one.  No task and
    no driver ever holds more than ``cells`` counts or ``most`` values.
    """
    v = F.col(column).cast("double")
    values = df.select(v.alias("v")).where("v IS NOT NULL")
    whole = values.agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).first()
    if not whole.n:
        return [None for _ in shares]
    places = [(whole.n - 1) * s for s in shares]
    found: dict[int, float] = {}

    def search(low: float, high: float, before: int, ranks: list[int]) -> None:
        """Values of these ranks, all between low and high, with ``before`` smaller values."""
        if low == high:
            found.update(dict.fromkeys(ranks, low))
            return
        part = values.where(F.col("v").between(low, high))
        different = part.groupBy("v").agg(F.count(F.lit(1)).alias("n")).limit(most + 1).collect()
        if len(different) <= most:
            seen = before
            for r in sorted(different):
                found.update({k: r.v for k in ranks if seen <= k < seen + r.n})
                seen += r.n
            return
        cell = F.least(F.floor((F.col("v") - low) / ((high - low) / cells)), F.lit(cells - 1))
        counts = part.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).orderBy("cell").collect()
        seen = before
        for c in counts:
            mine = [k for k in ranks if seen <= k < seen + c.n]
            if mine:
                search(c.low, c.high, seen, mine)
            seen += c.n

    search(whole.low, whole.high, 0, sorted({int(p) for p in places} | {min(int(p) + 1, whole.n - 1) for p in places}))
    between = lambda p: found[int(p)] + (p - int(p)) * (found[min(int(p) + 1, whole.n - 1)] - found[int(p)])
    return [between(p) for p in places]


def grade_cuts(scores: DataFrame, score: str, warning: float, critical: float) -> DataFrame:
    """The exact, linearly interpolated percentiles as one row."""
    cuts = exact_percentiles(scores, score, (warning, critical))
    return scores.sparkSession.createDataFrame([tuple(cuts)], "warning_cut double, critical_cut double")


def graded(scores: DataFrame, score: str = "risk_score", warning: float = 0.97, critical: float = 0.99) -> DataFrame:
    """``risk_grade`` by percentile: Critical, Warning or Normal; the two cut-offs are constants of the plan."""
    low, high = exact_percentiles(scores, score, (warning, critical))
    grade = F.when(F.col(score) >= F.lit(high).cast("double"), "Critical").when(F.col(score) >= F.lit(low).cast("double"), "Warning").otherwise("Normal")
    return scores.withColumn("risk_grade", grade)


def resolved_places(location: DataFrame, action: DataFrame) -> DataFrame:
    """Where each vehicle stands after its newest action: collected ones nowhere, deployed ones at the action's station."""
    joined = location.alias("l").join(action.alias("a"), "bike_id", "left")
    newer = F.coalesce(F.col("action_at") > F.col("last_event_at"), F.lit(False))
    place = F.when(newer & (F.col("action_event_type") == "COLLECT"), F.lit(None).cast("string")).when(newer & (F.col("action_event_type") == "DEPLOY"), F.coalesce("action_station_id", "last_station_id")).otherwise(F.col("last_station_id"))
    return joined.select("bike_id", place.alias("effective_station_id"), (newer & F.coalesce(F.col("action_event_type") == "COLLECT", F.lit(False))).alias("excluded"))


def station_inventory(resolved: DataFrame, stations: DataFrame) -> DataFrame:
    """Vehicles at every active station, zero where none stands."""
    counts = resolved.where("NOT excluded AND effective_station_id IS NOT NULL").groupBy(F.col("effective_station_id").alias("station_id")).agg(F.count(F.lit(1)).alias("bikes"))
    return stations.join(counts, "station_id", "left").select("station_id", F.coalesce("bikes", F.lit(0)).cast("int").alias("bike_cnt"), "hold_num", F.col("hold_num").alias("target_bike_cnt"))


def station_health(risk: DataFrame, location: DataFrame) -> DataFrame:
    """Vehicles at risk by station, and the healthy share in percent with one decimal."""
    at = risk.select("bike_id", "risk_grade").join(location.where("last_station_id IS NOT NULL").select("bike_id", "last_station_id"), "bike_id")
    n, bad = F.count(F.lit(1)), F.count(F.when(F.col("risk_grade") != "Normal", 1))
    return at.groupBy(F.col("last_station_id").alias("station_id")).agg(bad.cast("int").alias("risk_cnt"), F.round(F.lit(100.0).cast("double") * (n - bad) / n, 1).alias("healthy_ratio"))


def decisions(risk: DataFrame, location: DataFrame, inventory: DataFrame, suspend: str = "suspend", hold: str = "hold") -> DataFrame:
    """Critical vehicles are suspended; Warning ones while their rank in the station fits what capacity is left.

    The rank runs over all grades, while the capacity has the Critical ones taken off already, so each of those costs a
    place twice; this is the model's rule.  Stations without inventory have no places.  Critical vehicles are counted with
    map-side combining and only the rows within the largest capacity are ranked, so a station with a large part of all
    vehicles is no task of its own.
    """
    bikes = written(risk.select("bike_id", "risk_score", "risk_grade").join(location.select("bike_id", F.col("last_station_id").alias("station_id")), "bike_id"), "graded")
    critical = bikes.where("risk_grade = 'Critical'").groupBy("station_id").agg(F.count(F.lit(1)).alias("critical"))
    surplus = F.greatest(F.lit(0), F.col("bike_cnt") - F.col("target_bike_cnt"))
    known = F.col("bike_cnt").isNotNull() & F.col("target_bike_cnt").isNotNull()
    free = F.when(known, F.greatest(F.lit(0), surplus - F.coalesce("critical", F.lit(0)))).otherwise(0)
    places = inventory.select("station_id", "bike_cnt", "target_bike_cnt").join(critical, "station_id", "left").select("station_id", free.alias("free"))
    placed = bikes.where("station_id IS NOT NULL").join(places, "station_id", "left")
    ranked = within_capacity(placed, "station_id", F.coalesce("free", F.lit(0)), "risk_score", "bike_id")
    action = F.when(F.col("risk_grade") == "Critical", suspend).when((F.col("risk_grade") == "Warning") & F.col("in_capacity"), suspend).otherwise(hold)
    # vehicles without a station compete for no place
    nowhere = bikes.where("station_id IS NULL").select("bike_id", F.when(F.col("risk_grade") == "Critical", suspend).otherwise(hold).alias("action"))
    return ranked.select("bike_id", action.alias("action")).unionByName(nowhere)


def aging(year: Column, of: Column) -> Column:
    return (F.year(of) - year).cast("int")
