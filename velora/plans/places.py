"""Queries on places, state, risk, decisions and marts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velora.functions.values import start_year
from velora.operators import decide, latest, marts
from velora.plans import inputs as i
from velora.plans.inputs import CUT, DAY, HISTORY_FROM, PLACES, sql, table
from velora.plans.registry import query


def _lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines as rentals with absent values and repeated keys."""
    odd = F.col("l_returnflag") != "R"
    return table(spark, d, "lineitem").select(
        F.col("l_suppkey").alias("bike_id"),
        F.col("l_shipdate").alias("rent_dt"),
        F.when(F.col("l_linenumber") != 1, F.expr("l_shipdate + make_dt_interval(0, l_linenumber)")).alias("return_dt"),
        F.when(odd, F.concat("l_returnflag", "l_linestatus")).alias("rent_station_id"),
        F.col("l_linestatus").alias("return_station_id"),
        F.col("l_extendedprice").alias("use_distance_m"),
        F.col("l_orderkey").alias("source_file"),
        F.col("l_linenumber").alias("ingested_at"),
    )


@query("""SELECT * FROM (SELECT l_suppkey AS bike_id, l_shipdate AS rent_dt, CASE WHEN l_linenumber <> 1 THEN l_shipdate + to_hours(l_linenumber) END AS return_dt,
    CASE WHEN l_returnflag <> 'R' THEN l_returnflag || l_linestatus END AS rent_station_id, l_linestatus AS return_station_id, l_extendedprice AS use_distance_m,
    l_orderkey AS source_file, l_linenumber AS ingested_at FROM lineitem) WHERE bike_id IS NOT NULL AND rent_dt IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY bike_id, rent_dt ORDER BY return_dt NULLS LAST, rent_station_id NULLS FIRST, return_station_id NULLS FIRST,
    use_distance_m NULLS FIRST, source_file NULLS FIRST, ingested_at NULLS FIRST) = 1""")
def dedupe_trips(spark: SparkSession, d: str) -> DataFrame:
    order = [F.asc_nulls_last("return_dt"), *(F.asc_nulls_first(c) for c in ("rent_station_id", "return_station_id", "use_distance_m", "source_file", "ingested_at"))]
    return latest.first_rows(_lines(spark, d).where("bike_id IS NOT NULL AND rent_dt IS NOT NULL"), ["bike_id", "rent_dt"], order)


@query("SELECT DISTINCT CAST(year(l_shipdate) AS INTEGER) AS ship_year, l_suppkey AS station_id FROM lineitem")
def distinct_entities(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(F.year("l_shipdate").alias("ship_year"), F.col("l_suppkey").alias("station_id")).distinct()


@query(sql("SELECT * FROM location", "location"))
def latest_location(spark: SparkSession, d: str) -> DataFrame:
    return i.location(spark, d)


LAST_ACTION = "SELECT bike_id, event_type, occurred_at, station_id FROM actions QUALIFY row_number() OVER (PARTITION BY bike_id ORDER BY occurred_at DESC, event_id DESC) = 1"


def _last_actions(actions: DataFrame) -> DataFrame:
    return latest.latest_values(actions, "bike_id", "occurred_at", ["event_id", "event_type", "station_id"]).drop("event_id")


@query(sql(f"SELECT bike_id, occurred_at FROM ({LAST_ACTION}) WHERE event_type = 'COLLECT'", "actions"))
def latest_action_is_collect(spark: SparkSession, d: str) -> DataFrame:
    return _last_actions(i.actions(spark, d)).where("event_type = 'COLLECT'").select("bike_id", "occurred_at")


@query(sql(f"""SELECT coalesce(b.bike_id, e.bike_id) AS bike_id, CASE WHEN newer THEN e.event_type ELSE b.event_type END AS event_type,
    CASE WHEN newer THEN e.station_id ELSE b.station_id END AS station_id, CASE WHEN newer THEN e.occurred_at ELSE b.occurred_at END AS occurred_at FROM (
    SELECT b, e, (e.occurred_at IS NOT NULL AND (b.occurred_at IS NULL OR e.occurred_at > b.occurred_at)) AS newer FROM
    (SELECT * FROM ({LAST_ACTION.replace('FROM actions', "FROM actions WHERE occurred_at < TIMESTAMP '2024-01-20'")})) b FULL JOIN
    (SELECT * FROM ({LAST_ACTION.replace('FROM actions', "FROM actions WHERE occurred_at >= TIMESTAMP '2024-01-18' AND event_type = 'COLLECT'")})) e ON b.bike_id = e.bike_id)""", "actions"))
def merge_state(spark: SparkSession, d: str) -> DataFrame:
    a = i.actions(spark, d)
    base = _last_actions(a.where(F.col("occurred_at") < F.lit("2024-01-20").cast("timestamp_ntz")))
    delta = _last_actions(a.where((F.col("occurred_at") >= F.lit("2024-01-18").cast("timestamp_ntz")) & (F.col("event_type") == "COLLECT")))
    return latest.merge_state(base, delta, "bike_id", "occurred_at", ["event_type", "station_id"])


BANDS = "CASE WHEN n BETWEEN 1 AND 10000 THEN 2015 WHEN n BETWEEN 10001 AND 20000 THEN 2017 WHEN n BETWEEN 20001 AND 35000 THEN 2019 WHEN n BETWEEN 40001 AND 49999 THEN 2020 WHEN n BETWEEN 50001 AND 69999 THEN 2022 WHEN n BETWEEN 70001 AND 79999 THEN 2024 WHEN n BETWEEN 80001 AND 99999 THEN 2020 ELSE year(first_seen_at) END"
BIKES = f"SELECT bike_id, first_seen_at, CAST({BANDS} AS INTEGER) AS start_year FROM (SELECT l_partkey AS bike_id, min(l_shipdate) AS first_seen_at, l_partkey * 41 AS n FROM lineitem GROUP BY l_partkey)"


def _bikes(spark: SparkSession, d: str) -> DataFrame:
    first = table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("bike_id")).agg(F.min("l_shipdate").alias("first_seen_at"))
    return first.withColumn("start_year", start_year(F.concat(F.lit("P-"), F.col("bike_id") * 41), F.col("first_seen_at")))


@query(f"""SELECT bike_id, first_seen_at, CAST(first_seen_at AS DATE) AS snapshot_date, start_year FROM ({BIKES.replace('FROM lineitem', "FROM lineitem WHERE l_shipdate >= TIMESTAMP '1999-01-01'")})
    WHERE bike_id NOT IN (SELECT l_partkey FROM lineitem WHERE l_shipdate < TIMESTAMP '1999-01-01' AND l_returnflag = 'R')""", days=("snapshot_date",))
def new_entities_anti(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").select(F.col("l_partkey").alias("bike_id"), "l_shipdate", "l_returnflag")
    known = li.where((F.col("l_shipdate") < F.lit(HISTORY_FROM)) & (F.col("l_returnflag") == "R"))
    fresh = li.where(F.col("l_shipdate") >= F.lit(HISTORY_FROM)).groupBy("bike_id").agg(F.min("l_shipdate").alias("first_seen_at"))
    year = start_year(F.concat(F.lit("P-"), F.col("bike_id") * 41), F.col("first_seen_at"))
    return latest.new_keys(fresh, known, "bike_id").select("bike_id", "first_seen_at", F.to_date("first_seen_at").alias("snapshot_date"), year.alias("start_year"))


@query(sql(f"SELECT bike_id, count(*) AS trips FROM trips WHERE bike_id NOT IN (SELECT bike_id FROM ({LAST_ACTION}) WHERE event_type = 'COLLECT') GROUP BY 1", "trips", "actions"))
def exclude_collected(spark: SparkSession, d: str) -> DataFrame:
    gone = latest_action_is_collect(spark, d)
    return i.trips(spark, d).groupBy("bike_id").agg(F.count(F.lit(1)).alias("trips")).join(gone, "bike_id", "left_anti")


@query(sql("SELECT bike_id, rent_at FROM trips WHERE NOT EXISTS (SELECT 1 FROM faults f WHERE f.bike_id = trips.bike_id AND f.reg_date = CAST(rent_at AS DATE))", "trips", "faults"))
def exclude_suspended_days(spark: SparkSession, d: str) -> DataFrame:
    t, off = i.trips(spark, d).select("bike_id", "rent_at"), i.faults(spark, d).withColumnRenamed("bike_id", "off_id")
    return t.join(off, (F.col("bike_id") == F.col("off_id")) & (F.to_date("rent_at") == F.col("reg_date")), "left_anti")


@query(sql("SELECT station_id, bike_cnt, hold_num, target_bike_cnt FROM inventory", *PLACES))
def station_inventory(spark: SparkSession, d: str) -> DataFrame:
    return i.inventory(spark, d)


@query(sql("SELECT * FROM resolved", "location", "part_actions", "resolved"))
def resolved_places(spark: SparkSession, d: str) -> DataFrame:
    return i.resolved(spark, d)


@query(sql("SELECT * FROM health", "location", "scores", "cuts", "risk", "health"))
def station_health(spark: SparkSession, d: str) -> DataFrame:
    return i.health(spark, d)


@query(sql("SELECT * FROM risk", "scores", "cuts", "risk"))
def risk_grades(spark: SparkSession, d: str) -> DataFrame:
    return i.risk(spark, d)


@query(sql("SELECT round(w, 6) AS warning_cut, round(c, 6) AS critical_cut FROM cuts", "scores", "cuts"))
def grade_percentile(spark: SparkSession, d: str) -> DataFrame:
    return decide.grade_cuts(i.scores(spark, d), "risk_score", 0.9, 0.97).select(F.round("warning_cut", 6).alias("warning_cut"), F.round("critical_cut", 6).alias("critical_cut"))


DECISION = """bikes AS (SELECT r.*, last_station_id AS station_id, bike_cnt, target_bike_cnt FROM risk r JOIN location USING (bike_id) LEFT JOIN inventory ON last_station_id = inventory.station_id),
    cap AS (SELECT station_id, greatest(0, greatest(0, bike_cnt - target_bike_cnt) - sum(CASE WHEN risk_grade = 'Critical' THEN 1 ELSE 0 END)) AS free FROM bikes GROUP BY station_id, bike_cnt, target_bike_cnt),
    decision AS (SELECT bike_id, CASE WHEN risk_grade = 'Critical' THEN 'suspend' WHEN risk_grade = 'Warning' AND place <= coalesce(free, 0) THEN 'suspend' ELSE 'hold' END AS action FROM
    (SELECT b.*, free, row_number() OVER (PARTITION BY b.station_id ORDER BY risk_score DESC, bike_id) AS place FROM bikes b LEFT JOIN cap ON b.station_id = cap.station_id))"""


def _decision(spark: SparkSession, d: str, risk: DataFrame | None = None) -> DataFrame:
    return decide.decisions(i.risk(spark, d) if risk is None else risk, i.location(spark, d), i.inventory(spark, d))


@query(sql("", *PLACES) + f", {DECISION} SELECT * FROM decision")
def bike_decision(spark: SparkSession, d: str) -> DataFrame:
    return _decision(spark, d)


@query(sql("", *PLACES) + f", {DECISION} SELECT count(*) AS orphans FROM decision WHERE bike_id NOT IN (SELECT bike_id FROM risk WHERE risk_grade <> 'Critical')")
def orphan_count(spark: SparkSession, d: str) -> DataFrame:
    risk = i.risk(spark, d)
    return latest.orphans(_decision(spark, d, risk), risk.where("risk_grade <> 'Critical'"), "bike_id").agg(F.count(F.lit(1)).alias("orphans"))


FAILS = """SELECT bike_id, string_agg(entry, '|' ORDER BY place) AS entries FROM (SELECT 'B' || user_id AS bike_id, strftime(ts, '%Y-%m-%d') || ' ' || event_type AS entry,
    row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS place FROM events WHERE event_type = 'error' AND ts < TIMESTAMP '2024-01-29') WHERE place <= 5 GROUP BY 1"""


@query(FAILS)
def fail_history_topn(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").where((F.col("event_type") == "error") & (F.col("ts") < F.lit(DAY))).withColumn("bike_id", F.concat(F.lit("B"), "user_id"))
    entry = F.concat_ws(" ", F.date_format("ts", "yyyy-MM-dd"), "event_type")
    return latest.recent_list(e, "bike_id", "ts", entry, 5, ["event_id"]).select("bike_id", F.array_join("entries", "|").alias("entries"))


PART_FAILS = """history AS (SELECT bike_id, string_agg(entry, '|' ORDER BY place) AS fail_history FROM (SELECT l_partkey AS bike_id, strftime(l_shipdate, '%Y-%m-%d') || ' ' || l_linestatus AS entry,
    row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC, l_orderkey, l_linenumber) AS place FROM lineitem WHERE l_returnflag = 'R') WHERE place <= 5 GROUP BY 1)"""


def _part_history(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").where("l_returnflag = 'R'").withColumnRenamed("l_partkey", "bike_id")
    return latest.recent_list(li, "bike_id", "l_shipdate", F.concat_ws(" ", F.date_format("l_shipdate", "yyyy-MM-dd"), "l_linestatus"), 5, ["l_orderkey", "l_linenumber"])


def _bike_mart(spark: SparkSession, d: str) -> DataFrame:
    use = table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("bike_id")).agg((F.sum("l_quantity") / 10).alias("dist_km"))
    risk = i.risk(spark, d)  # its cut-offs are searched once
    return marts.bike_mart(risk, _decision(spark, d, risk), i.location(spark, d), i.stations(spark, d), _bikes(spark, d), use, decide.station_health(risk, i.location(spark, d)), _part_history(spark, d), CUT)


BIKE_MART = f""", {DECISION}, bikes_dim AS ({BIKES}), {PART_FAILS}, use AS (SELECT l_partkey AS bike_id, sum(l_quantity) / 10 AS dist_km FROM lineitem GROUP BY 1),
    mart AS (SELECT r.bike_id, l.last_station_id AS station_id, station_name, region, district, coalesce(healthy_ratio, 100.0) AS healthy_ratio, risk_score, risk_grade, dist_km, start_year,
    CAST(2001 - start_year AS INTEGER) AS aging, coalesce(fail_history, '') AS fail_history, DATE '2001-01-01' AS snapshot_date FROM risk r SEMI JOIN decision USING (bike_id)
    LEFT JOIN location l USING (bike_id) LEFT JOIN bikes_dim USING (bike_id) LEFT JOIN use USING (bike_id) LEFT JOIN history USING (bike_id)
    LEFT JOIN stations s ON s.station_id = l.last_station_id LEFT JOIN health h ON h.station_id = l.last_station_id)"""


@query(sql("", *PLACES) + BIKE_MART + " SELECT * FROM mart", days=("snapshot_date",))
def mart_bike(spark: SparkSession, d: str) -> DataFrame:
    return _bike_mart(spark, d).withColumn("fail_history", F.array_join("fail_history", "|"))


STATION_MART = """station_mart AS (SELECT s.station_id, station_name, region, district, latitude, longitude, s.hold_num, CAST(coalesce(bike_cnt, 0) AS INTEGER) AS bike_cnt,
    CAST(coalesce(risk_cnt, 0) AS INTEGER) AS risk_cnt, coalesce(healthy_ratio, 100.0) AS healthy_ratio, CASE WHEN coalesce(healthy_ratio, 100.0) >= 70.0 THEN '여유있음' ELSE '부족함' END AS urgency,
    DATE '2001-01-01' AS snapshot_date FROM stations s LEFT JOIN inventory USING (station_id) LEFT JOIN health h ON h.station_id = s.station_id)"""


def _station_mart(spark: SparkSession, d: str) -> DataFrame:
    return marts.station_mart(i.stations(spark, d), i.inventory(spark, d), i.health(spark, d), CUT)


@query(sql("", *PLACES) + f", {STATION_MART} SELECT * FROM station_mart", days=("snapshot_date",))
def mart_station(spark: SparkSession, d: str) -> DataFrame:
    return _station_mart(spark, d)


@query(sql("", *PLACES) + BIKE_MART + f""", {STATION_MART} SELECT m.bike_id, m.station_id, m.risk_score, m.risk_grade, m.aging, m.fail_history, urgency AS station_urgency
    FROM mart m LEFT JOIN station_mart s ON s.station_id = m.station_id WHERE m.region IS NOT NULL AND risk_grade <> 'Normal'""")
def serving_pool(spark: SparkSession, d: str) -> DataFrame:
    pool = marts.serving_pool(_bike_mart(spark, d), _station_mart(spark, d))
    return pool.select("bike_id", "station_id", "risk_score", "risk_grade", "aging", F.array_join("fail_history", "|").alias("fail_history"), "station_urgency")


def _daily_risk(spark: SparkSession, d: str) -> DataFrame:
    """Lines as a serving table with a day, a vehicle, a place and a score."""
    return table(spark, d, "lineitem").select(F.to_date("l_shipdate").alias("snapshot_date"), F.concat("l_orderkey", F.lit("-"), "l_linenumber").alias("bike_id"), F.col("l_suppkey").alias("station_id"), F.when(F.col("l_linenumber") != 3, F.col("l_extendedprice")).alias("risk_score"))


@query("""SELECT bike_id, station_id FROM (SELECT CAST(l_shipdate AS DATE) AS snapshot_date, l_orderkey || '-' || l_linenumber AS bike_id, l_suppkey AS station_id,
    CASE WHEN l_linenumber <> 3 THEN l_extendedprice END AS risk_score FROM lineitem)
    WHERE snapshot_date = (SELECT max(CAST(l_shipdate AS DATE)) FROM lineitem WHERE l_shipdate <= TIMESTAMP '2001-01-01') ORDER BY risk_score DESC NULLS LAST, bike_id LIMIT 500""")
def collect_topn(spark: SparkSession, d: str) -> DataFrame:
    return marts.collect_targets(_daily_risk(spark, d), CUT, 500)


@query(sql("""SELECT bike_id, station_id FROM (SELECT * FROM actions WHERE occurred_at < TIMESTAMP '2024-01-29' QUALIFY row_number() OVER
    (PARTITION BY bike_id ORDER BY occurred_at DESC, (event_type = 'COLLECT') DESC, station_id DESC) = 1) WHERE event_type = 'COLLECT' AND CAST(occurred_at AS DATE) = DATE '2024-01-28'""", "actions"))
def deploy_cycle(spark: SparkSession, d: str) -> DataFrame:
    return marts.deploy_targets(i.actions(spark, d), DAY)


LOG = "log AS (SELECT o_orderkey AS bike_id, o_orderdate AS actioned_at, CASE WHEN o_orderpriority = '1-URGENT' THEN 'collect' ELSE 'other' END AS action_taken FROM orders)"


def _log(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("bike_id"), F.col("o_orderdate").alias("actioned_at"), F.when(F.col("o_orderpriority") == "1-URGENT", "collect").otherwise("other").alias("action_taken"))


@query(f"WITH {LOG} SELECT * FROM log WHERE action_taken = 'collect' AND actioned_at = (SELECT max(actioned_at) FROM log WHERE action_taken = 'collect')")
def latest_batch(spark: SparkSession, d: str) -> DataFrame:
    return marts.latest_batch(_log(spark, d), "collect")


@query(f"WITH {LOG} SELECT count(*) AS confirmed, max(actioned_at) AS actioned_at FROM log WHERE action_taken = 'collect' AND actioned_at = (SELECT max(actioned_at) FROM log WHERE action_taken = 'collect')")
def latest_confirmation(spark: SparkSession, d: str) -> DataFrame:
    return marts.latest_batch(_log(spark, d), "collect").agg(F.count(F.lit(1)).alias("confirmed"), F.max("actioned_at").alias("actioned_at"))


@query(sql("SELECT s.*, bike_cnt FROM (SELECT station_id, station_name FROM stations) s JOIN inventory USING (station_id) WHERE station_id IN (SELECT l_suppkey FROM lineitem WHERE l_shipdate >= TIMESTAMP '2001-06-01')", *PLACES))
def active_stations(spark: SparkSession, d: str) -> DataFrame:
    live = table(spark, d, "lineitem").where(F.col("l_shipdate") >= F.lit(date(2001, 6, 1))).select(F.col("l_suppkey").alias("station_id")).distinct()
    return i.stations(spark, d).select("station_id", "station_name").join(i.inventory(spark, d).select("station_id", "bike_cnt"), "station_id").join(live, "station_id", "left_semi")
