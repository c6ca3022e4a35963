"""The fleet model's relations on the driver's tables, and the same relations as SQL for the oracle.

Vehicles are users (in ``events``) or parts (in ``lineitem``), stations are suppliers, reports are error events, field
events are purchases (COLLECT) and clicks (DEPLOY).  Risk scores are a fixed arithmetic of the id, so both sides agree.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velora.operators.decide import graded, resolved_places, station_health, station_inventory
from velora.operators.latest import latest_values
from velora.operators.range_features import fault_days, near

ANCHORS = [date(2024, 1, 22), date(2024, 1, 29)]
DAY = date(2024, 1, 29)
CUT = date(2001, 1, 1)
HISTORY_FROM = date(1999, 1, 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trips(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").where("event_type <> 'error'")
    n = F.col("event_id")
    return e.select(
        F.concat(F.lit("B"), "user_id").alias("bike_id"),
        F.col("ts").alias("rent_at"),
        F.when(n % 17 != 0, F.col("value") * 200).alias("dist_m"),
        F.when(n % 13 != 0, (n % 61).cast("double")).alias("dur_min"),
        F.concat(F.lit("ST-"), (n % 40)).alias("rent_station"),
        F.concat(F.lit("ST-"), F.floor(n / 7) % 40).alias("return_station"),
    )


def faults(spark: SparkSession, d: str, back: int | None = None, ahead: int = 0, include_today: bool = False, anchored: bool = False) -> DataFrame:
    """Reports by vehicle and day; ``anchored`` reads only the days that the anchors' windows may hold."""
    e = table(spark, d, "events").where("event_type = 'error'")
    e = near(e, "ts", ANCHORS, back, ahead, include_today) if anchored else e
    return fault_days(e.select(F.concat(F.lit("B"), "user_id").alias("bike_id"), F.to_date("ts").alias("reg_date")))


def actions(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").where(F.col("event_type").isin("purchase", "click"))
    kind = F.when(F.col("event_type") == "purchase", "COLLECT").otherwise("DEPLOY")
    return e.select("event_id", F.concat(F.lit("B"), "user_id").alias("bike_id"), kind.alias("event_type"), F.col("ts").alias("occurred_at"), F.concat(F.lit("ST-"), F.col("event_id") % 40).alias("station_id"))


def location(spark: SparkSession, d: str) -> DataFrame:
    """Every part at the supplier of its newest line; equal days are settled by order and line."""
    li = table(spark, d, "lineitem").select(F.col("l_partkey").alias("bike_id"), F.col("l_shipdate").alias("last_event_at"), "l_orderkey", "l_linenumber", F.col("l_suppkey").alias("last_station_id"))
    return latest_values(li, "bike_id", "last_event_at", ["l_orderkey", "l_linenumber", "last_station_id"]).select("bike_id", "last_station_id", "last_event_at")


def scores(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select(F.col("p_partkey").alias("bike_id"), (F.col("p_partkey") * 7919 % 10007 / 100.0).cast("double").alias("risk_score"))


def risk(spark: SparkSession, d: str) -> DataFrame:
    return graded(scores(spark, d), "risk_score", 0.9, 0.97)


def part_actions(spark: SparkSession, d: str) -> DataFrame:
    """Half of the parts have an action at a day that depends on the id."""
    p = table(spark, d, "part").where("p_size <= 25")
    at = F.expr("TIMESTAMP_NTZ '2000-01-01 00:00:00' + make_dt_interval(CAST(p_partkey % 700 AS INT))")
    return p.select(F.col("p_partkey").alias("bike_id"), F.when(F.col("p_partkey") % 6 == 0, "COLLECT").otherwise("DEPLOY").alias("action_event_type"), F.when(F.col("p_partkey") % 10 != 0, F.col("p_partkey") % 50).alias("action_station_id"), at.alias("action_at"))


def stations(spark: SparkSession, d: str) -> DataFrame:
    s, n, r = (table(spark, d, t) for t in ("supplier", "nation", "region"))
    named = s.join(F.broadcast(n), F.col("s_nationkey") == F.col("n_nationkey"), "left").join(F.broadcast(r), F.col("n_regionkey") == F.col("r_regionkey"), "left")  # 25 and 5 rows by the schema
    k = F.col("s_suppkey")
    return named.select(k.alias("station_id"), F.col("s_name").alias("station_name"), F.col("r_name").alias("region"), F.col("n_name").alias("district"), (37.0 + k % 100 / 1000.0).cast("double").alias("latitude"), (127.0 + k % 77 / 1000.0).cast("double").alias("longitude"), (F.lit(8) + k % 11).cast("int").alias("hold_num"))


def resolved(spark: SparkSession, d: str) -> DataFrame:
    return resolved_places(location(spark, d), part_actions(spark, d))


def inventory(spark: SparkSession, d: str) -> DataFrame:
    return station_inventory(resolved(spark, d), stations(spark, d))


def health(spark: SparkSession, d: str) -> DataFrame:
    return station_health(risk(spark, d), location(spark, d))


#: The relations above in SQL; each may use those before it.
SQL = {
    "trips": """SELECT 'B' || user_id AS bike_id, ts AS rent_at, CASE WHEN event_id % 17 <> 0 THEN value * 200 END AS dist_m,
        CASE WHEN event_id % 13 <> 0 THEN CAST(event_id % 61 AS DOUBLE) END AS dur_min, 'ST-' || (event_id % 40) AS rent_station,
        'ST-' || ((event_id // 7) % 40) AS return_station FROM events WHERE event_type <> 'error'""",
    "faults": "SELECT DISTINCT 'B' || user_id AS bike_id, CAST(ts AS DATE) AS reg_date FROM events WHERE event_type = 'error'",
    "actions": """SELECT event_id, 'B' || user_id AS bike_id, CASE WHEN event_type = 'purchase' THEN 'COLLECT' ELSE 'DEPLOY' END AS event_type,
        ts AS occurred_at, 'ST-' || (event_id % 40) AS station_id FROM events WHERE event_type IN ('purchase', 'click')""",
    "anchors": "SELECT * FROM (VALUES (DATE '2024-01-22'), (DATE '2024-01-29')) AS t(as_of)",
    "daily": """SELECT bike_id, CAST(rent_at AS DATE) AS rent_date, count(*) AS trips, sum(coalesce(dist_m, 0.0)) AS dist_m, sum(coalesce(dur_min, 0.0)) AS dur_min,
        CAST(sum(CASE WHEN rent_station IS NOT NULL AND rent_station = return_station AND coalesce(dist_m, 99999.0) <= 10 THEN 1 ELSE 0 END) AS BIGINT) AS instant_ret
        FROM trips GROUP BY ALL""",
    "usage": """SELECT as_of, bike_id, trips, dist_km, dur_h, instant_ret, CAST(as_of - last_day AS INTEGER) AS days_since_last_rent, (b + 1.0) / (a + 1.0) AS trend_ratio FROM (
        SELECT as_of, bike_id, CAST(sum(trips) AS BIGINT) AS trips, sum(dist_m) / 1000.0 AS dist_km, sum(dur_min) / 60.0 AS dur_h, CAST(sum(instant_ret) AS BIGINT) AS instant_ret,
        CAST(sum(CASE WHEN rent_date < as_of - 7 THEN trips ELSE 0 END) AS DOUBLE) AS a, CAST(sum(CASE WHEN rent_date >= as_of - 7 THEN trips ELSE 0 END) AS DOUBLE) AS b, max(rent_date) AS last_day
        FROM daily JOIN anchors ON rent_date >= as_of - 14 AND rent_date < as_of GROUP BY as_of, bike_id)""",
    "fails": """SELECT as_of, bike_id, CAST(sum(CASE WHEN reg_date >= as_of - 10 THEN 1 ELSE 0 END) AS BIGINT) AS fail_150d, max(reg_date) AS last_fail_date
        FROM faults JOIN anchors ON reg_date < as_of GROUP BY as_of, bike_id""",
    "recent": "SELECT DISTINCT as_of, bike_id FROM faults JOIN anchors ON reg_date >= as_of - 5 AND reg_date < as_of",
    "pos": "SELECT DISTINCT as_of, bike_id FROM faults JOIN anchors ON reg_date >= as_of AND reg_date < as_of + 3",
    "location": """SELECT l_partkey AS bike_id, l_suppkey AS last_station_id, l_shipdate AS last_event_at FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_suppkey DESC) = 1""",
    "scores": "SELECT p_partkey AS bike_id, CAST(p_partkey * 7919 % 10007 / 100.0 AS DOUBLE) AS risk_score FROM part",
    "cuts": "SELECT quantile_cont(risk_score, 0.9) AS w, quantile_cont(risk_score, 0.97) AS c FROM scores",
    "risk": "SELECT bike_id, risk_score, CASE WHEN risk_score >= c THEN 'Critical' WHEN risk_score >= w THEN 'Warning' ELSE 'Normal' END AS risk_grade FROM scores, cuts",
    "part_actions": """SELECT p_partkey AS bike_id, CASE WHEN p_partkey % 6 = 0 THEN 'COLLECT' ELSE 'DEPLOY' END AS action_event_type,
        CASE WHEN p_partkey % 10 <> 0 THEN p_partkey % 50 END AS action_station_id, TIMESTAMP '2000-01-01' + to_days(CAST(p_partkey % 700 AS INTEGER)) AS action_at
        FROM part WHERE p_size <= 25""",
    "stations": """SELECT s_suppkey AS station_id, s_name AS station_name, r_name AS region, n_name AS district, CAST(37.0 + (s_suppkey % 100) / 1000.0 AS DOUBLE) AS latitude,
        CAST(127.0 + (s_suppkey % 77) / 1000.0 AS DOUBLE) AS longitude, CAST(8 + s_suppkey % 11 AS INTEGER) AS hold_num
        FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
    "resolved": """SELECT bike_id, CASE WHEN newer AND action_event_type = 'COLLECT' THEN NULL WHEN newer AND action_event_type = 'DEPLOY' THEN coalesce(action_station_id, last_station_id)
        ELSE last_station_id END AS effective_station_id, coalesce(newer AND action_event_type = 'COLLECT', false) AS excluded
        FROM (SELECT l.*, a.* EXCLUDE (bike_id), coalesce(a.action_at > l.last_event_at, false) AS newer FROM location l LEFT JOIN part_actions a USING (bike_id))""",
    "inventory": """SELECT s.station_id, CAST(coalesce(n, 0) AS INTEGER) AS bike_cnt, hold_num, hold_num AS target_bike_cnt FROM stations s
        LEFT JOIN (SELECT effective_station_id AS station_id, count(*) AS n FROM resolved WHERE NOT excluded AND effective_station_id IS NOT NULL GROUP BY 1) USING (station_id)""",
    "health": """SELECT last_station_id AS station_id, CAST(count(*) FILTER (WHERE risk_grade <> 'Normal') AS INTEGER) AS risk_cnt,
        round(100.0 * (count(*) - count(*) FILTER (WHERE risk_grade <> 'Normal')) / count(*), 1) AS healthy_ratio
        FROM risk JOIN location USING (bike_id) WHERE last_station_id IS NOT NULL GROUP BY 1""",
}


def sql(select: str, *names: str) -> str:
    """A statement with the named relations in front, in the order above."""
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in SQL.items() if k in names) + "\n" + select


PLACES = ("location", "scores", "cuts", "risk", "part_actions", "stations", "resolved", "inventory", "health")
