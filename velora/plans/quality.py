"""Queries on cleansing, quarantine, quality and incremental state."""

from __future__ import annotations

import uuid
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, LongType, StructType

from velora.functions import dates, values
from velora.operators import cleanse, quality, state
from velora.plans.inputs import sql, table
from velora.plans.registry import query
from velora.schemas import EVENT_TYPES
from velora.sources.objects import shared_root
from velora.sources.tables import Table


@query("""SELECT event_id, coalesce(try_strptime(raw, '%Y-%m-%d %H:%M:%S'), try_strptime(raw, '%Y%m%d%H%M%S'), try_strptime(raw, '%Y-%m-%d'), try_strptime(raw, '%Y%m%d')) AS parsed,
    coalesce(raw IS NOT NULL AND trim(raw) <> '' AND coalesce(try_strptime(raw, '%Y-%m-%d %H:%M:%S'), try_strptime(raw, '%Y%m%d%H%M%S'), try_strptime(raw, '%Y-%m-%d'), try_strptime(raw, '%Y%m%d')) IS NULL, false) AS failed
    FROM (SELECT event_id, CASE event_id % 7 WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') WHEN 1 THEN strftime(ts, '%Y%m%d%H%M%S') WHEN 2 THEN strftime(ts, '%Y-%m-%d')
    WHEN 3 THEN strftime(ts, '%Y%m%d') WHEN 4 THEN '' WHEN 5 THEN NULL ELSE strftime(ts, '%d/%m/%Y') END AS raw FROM events)""")
def parse_dates(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("event_id") % 7
    raw = F.when(k == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).when(k == 1, F.date_format("ts", "yyyyMMddHHmmss")).when(k == 2, F.date_format("ts", "yyyy-MM-dd"))
    raw = raw.when(k == 3, F.date_format("ts", "yyyyMMdd")).when(k == 4, "").when(k == 5, F.lit(None)).otherwise(F.date_format("ts", "dd/MM/yyyy"))
    e = table(spark, d, "events").select("event_id", raw.alias("raw")).withColumn("parsed", dates.parse_datetime(F.col("raw")))
    return e.select("event_id", F.col("parsed").cast("timestamp_ntz").alias("parsed"), dates.parse_failed(F.col("raw"), F.col("parsed")).alias("failed"))


@query("""SELECT p_partkey, trim(regexp_replace('  ' || p_name || '  x ', '\\s+', ' ', 'g')) AS name, upper(regexp_replace(' b ' || p_partkey || ' x', '\\s+', '', 'g')) AS entity,
    CASE WHEN p_partkey % 5 = 0 THEN 'A' || p_partkey WHEN p_partkey % 100 = 1 THEN '0' ELSE CAST(p_partkey AS VARCHAR) END AS station,
    coalesce(CAST(round(TRY_CAST(CASE WHEN p_partkey % 9 = 0 THEN '' ELSE p_partkey || '.5' END AS DOUBLE)) AS INTEGER), -1) AS hold_num, nullif(CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_brand END, '') AS brand,
    CASE WHEN p_partkey >= 1000 THEN 'saessak' ELSE 'normal' END AS class FROM part""")
def normalize_text(spark: SparkSession, d: str) -> DataFrame:
    k, text = F.col("p_partkey"), F.col("p_partkey").cast("string")
    padded = F.when(k % 5 == 0, F.concat(F.lit("A"), text)).when(k % 100 == 1, "000").otherwise(F.concat(F.lit("00"), text))
    return table(spark, d, "part").select(
        "p_partkey",
        values.squeezed(F.concat(F.lit("  "), "p_name", F.lit("  x "))).alias("name"),
        values.entity_id(F.concat(F.lit(" b "), text, F.lit(" x"))).alias("entity"),
        F.when(k == 0, F.lit("A0")).otherwise(values.without_zero_pad(padded)).alias("station"),
        F.coalesce(dates.rounded_int(F.when(k % 9 == 0, "").otherwise(F.concat(text, F.lit(".5")))), F.lit(-1)).alias("hold_num"),
        values.blank_to_null(F.when(k % 3 == 0, "").otherwise(F.col("p_brand"))).alias("brand"),
        values.class_by_number(F.concat(F.lit("SPB-"), text), 1000).alias("class"),
    )


REPORTS = """SELECT 'B' || user_id AS bike_no, CASE event_id % 3 WHEN 0 THEN strftime(ts, '%Y.%-m.%-d') WHEN 1 THEN strftime(ts, '%Y%m%d') ELSE 'at ' || strftime(ts, '%Y-%m-%d') || ' noon' END AS reg_dttm,
    '  ' || event_type || ' ' AS failure_type, '2024-01-31' AS reg_date_partition, CASE WHEN event_id % 4 = 0 THEN '2024-01-15' END AS requested_date FROM events WHERE event_type = 'error'"""
TYPED = f"""SELECT bike_no, t AS reg_dttm, trim(failure_type) AS failure_type, coalesce(requested_date, reg_date_partition) AS declared_reg_date, strftime(t, '%Y-%m-%d') AS reg_date_partition FROM
    (SELECT *, coalesce(try_strptime(replace(regexp_extract(reg_dttm, '(\\d{{4}}[-.]\\d{{1,2}}[-.]\\d{{1,2}})', 1), '.', '-'), '%Y-%m-%d'), try_strptime(reg_dttm, '%Y%m%d')) AS t FROM ({REPORTS}))"""


def _reports(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("event_id") % 3
    raw = F.when(k == 0, F.date_format("ts", "yyyy.M.d")).when(k == 1, F.date_format("ts", "yyyyMMdd")).otherwise(F.concat(F.lit("at "), F.date_format("ts", "yyyy-MM-dd"), F.lit(" noon")))
    e = table(spark, d, "events").where("event_type = 'error'")
    bronze = e.select(F.concat(F.lit("B"), "user_id").alias("bike_no"), raw.alias("reg_dttm"), F.concat(F.lit("  "), "event_type", F.lit(" ")).alias("failure_type"), F.lit("2024-01-31").alias("reg_date_partition"), F.when(F.col("event_id") % 4 == 0, "2024-01-15").alias("requested_date"))
    return cleanse.failure_reports(bronze)


@query(TYPED)
def failure_reports(spark: SparkSession, d: str) -> DataFrame:
    return _reports(spark, d).withColumn("reg_dttm", F.col("reg_dttm").cast("timestamp_ntz"))


@query(f"SELECT CASE WHEN coalesce(reg_date_partition <= '2024-01-25', false) THEN 'kept' ELSE 'future' END AS side, count(*) AS n FROM ({TYPED}) GROUP BY 1")
def future_split(spark: SparkSession, d: str) -> DataFrame:
    kept, future = cleanse.split_future(_reports(spark, d), date(2024, 1, 25))
    count = lambda df, side: df.groupBy(F.lit(side).alias("side")).agg(F.count(F.lit(1)).alias("n"))
    return count(kept, "kept").unionByName(count(future, "future"))


@query(f"SELECT bike_no, reg_dttm, failure_type, reg_date_partition FROM ({TYPED}) WHERE reg_date_partition BETWEEN '2024-01-05' AND '2024-01-20' GROUP BY ALL")
def dedupe_group_all(spark: SparkSession, d: str) -> DataFrame:
    r = cleanse.in_range(_reports(spark, d), "reg_date_partition", "2024-01-05", "2024-01-20")
    return r.select("bike_no", F.col("reg_dttm").cast("timestamp_ntz").alias("reg_dttm"), "failure_type", "reg_date_partition").distinct()


@query(f"SELECT count(*) AS repeated_keys FROM (SELECT bike_no, reg_dttm, failure_type FROM ({TYPED}) GROUP BY ALL HAVING count(*) > 1)")
def duplicate_keys(spark: SparkSession, d: str) -> DataFrame:
    return _reports(spark, d).groupBy("bike_no", "reg_dttm", "failure_type").agg(F.count(F.lit(1)).alias("n")).where("n > 1").agg(F.count(F.lit(1)).alias("repeated_keys"))


LINES = "SELECT l_orderkey, l_linenumber, l_shipdate AS rent_dt, CASE WHEN l_linenumber % 4 <> 0 THEN l_shipdate + to_days(l_linenumber - 2) END AS return_dt, CASE WHEN l_linenumber = 5 THEN -l_quantity ELSE l_quantity END AS use_distance_m FROM lineitem"
REASONS = "nullif(concat_ws(',', CASE WHEN return_dt < rent_dt THEN 'return_before_rent' END, CASE WHEN use_distance_m < 0 THEN 'negative_distance' END), '')"


def _violations(spark: SparkSession, d: str) -> DataFrame:
    back = F.expr("l_shipdate + make_dt_interval(l_linenumber - 2)")
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_shipdate").alias("rent_dt"), F.when(F.col("l_linenumber") % 4 != 0, back).alias("return_dt"), F.when(F.col("l_linenumber") == 5, -F.col("l_quantity")).otherwise(F.col("l_quantity")).alias("use_distance_m"))


@query(f"SELECT * FROM (SELECT *, {REASONS} AS quarantine_reason FROM ({LINES})) WHERE quarantine_reason IS NOT NULL")
def quarantine_split(spark: SparkSession, d: str) -> DataFrame:
    return cleanse.split_quarantine(_violations(spark, d), cleanse.trip_rules())[1]


@query(f"SELECT count(*) FILTER (WHERE {REASONS} IS NOT NULL) AS broken, count(*) AS total, round(count(*) FILTER (WHERE {REASONS} IS NOT NULL) / count(*), 8) AS ratio FROM ({LINES})")
def quarantine_ratio(spark: SparkSession, d: str) -> DataFrame:
    broken = F.count("quarantine_reason")
    return cleanse.with_reasons(_violations(spark, d), cleanse.trip_rules()).agg(broken.alias("broken"), F.count(F.lit(1)).alias("total"), F.round(broken / F.count(F.lit(1)), 8).alias("ratio"))


@query("""SELECT event_id, nullif(concat_ws(',', CASE WHEN coalesce(bike_id, '') = '' THEN 'null_bike_id' END, CASE WHEN coalesce(event_type, '') = '' THEN 'null_event_type' END,
    CASE WHEN coalesce(event_type, '') <> '' AND event_type NOT IN ('COLLECT', 'DEPLOY') THEN 'invalid_event_type:' || event_type END, CASE WHEN occurred_at IS NULL THEN 'null_occurred_at' END,
    CASE WHEN CAST(occurred_at AS DATE) < DATE '2024-01-03' THEN 'occurred_before_service_start' END, CASE WHEN occurred_at > TIMESTAMP '2024-01-28' THEN 'occurred_in_future' END,
    CASE WHEN occurred_at > received_at THEN 'occurred_after_received' END), '') AS quarantine_reason FROM (SELECT event_id, CASE event_id % 11 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'B' || user_id END AS bike_id,
    CASE event_type WHEN 'purchase' THEN 'COLLECT' WHEN 'click' THEN 'DEPLOY' WHEN 'error' THEN '' WHEN 'view' THEN NULL ELSE event_type END AS event_type,
    CASE WHEN event_id % 23 <> 0 THEN ts END AS occurred_at, CASE WHEN event_id % 19 = 0 THEN ts - to_hours(1) WHEN event_id % 19 <> 1 THEN ts + to_hours(1) END AS received_at FROM events)""")
def event_classifier(spark: SparkSession, d: str) -> DataFrame:
    k, kind = F.col("event_id"), F.col("event_type")
    e = table(spark, d, "events").select(
        "event_id",
        F.when(k % 11 == 0, F.lit(None)).when(k % 11 == 1, "").otherwise(F.concat(F.lit("B"), "user_id")).alias("bike_id"),
        F.when(kind == "purchase", "COLLECT").when(kind == "click", "DEPLOY").when(kind == "error", "").when(kind == "view", F.lit(None)).otherwise(kind).alias("event_type"),
        F.when(k % 23 != 0, F.col("ts")).alias("occurred_at"),
        F.when(k % 19 == 0, F.expr("ts - INTERVAL 1 HOUR")).when(k % 19 != 1, F.expr("ts + INTERVAL 1 HOUR")).alias("received_at"),
    )
    return cleanse.classify_events(e, datetime(2024, 1, 28), date(2024, 1, 3), EVENT_TYPES).select("event_id", "quarantine_reason")


@query("""SELECT bike_id, event_type, occurred_at FROM (SELECT 'B' || user_id AS bike_id, event_type, date_trunc('hour', ts) AS occurred_at FROM events WHERE event_type IN ('purchase', 'click')) GROUP BY ALL""")
def event_dedupe(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").where(F.col("event_type").isin("purchase", "click"))
    return e.select(F.concat(F.lit("B"), "user_id").alias("bike_id"), "event_type", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("occurred_at")).dropDuplicates(["bike_id", "event_type", "occurred_at"])


def _check() -> quality.Check:
    return quality.Check("lines").complete("return_dt").contained("l_linenumber", [1, 2, 3, 4, 5, 6]).non_negative("use_distance_m").satisfies(F.col("return_dt") >= F.col("rent_dt"), "order").min_rows(100_000).uniqueness(["l_orderkey", "l_linenumber"], 0.98)


@query(f"""WITH t AS ({LINES}), c AS (SELECT 'complete(return_dt)' AS "constraint", count(*) FILTER (WHERE return_dt IS NULL) AS violations, count(*) AS total FROM t
    UNION ALL SELECT 'contained(l_linenumber)', count(*) FILTER (WHERE l_linenumber NOT IN (1, 2, 3, 4, 5, 6)), count(*) FROM t
    UNION ALL SELECT 'non_negative(use_distance_m)', count(*) FILTER (WHERE use_distance_m < 0), count(*) FROM t
    UNION ALL SELECT 'satisfies(order)', count(*) FILTER (WHERE NOT coalesce(return_dt >= rent_dt, false)), count(*) FROM t
    UNION ALL SELECT 'min_rows(100000)', greatest(0, 100000 - count(*)), count(*) FROM t)
    SELECT "constraint", CASE WHEN violations = 0 THEN 'PASS' ELSE 'FAIL' END AS status, violations, total FROM c
    UNION ALL SELECT 'uniqueness(l_orderkey,l_linenumber)', CASE WHEN CAST(sum(n) FILTER (WHERE n = 1) AS BIGINT) >= 0.98 * CAST(sum(n) AS BIGINT) THEN 'PASS' ELSE 'FAIL' END, CAST(sum(n) FILTER (WHERE n > 1) AS BIGINT), CAST(sum(n) AS BIGINT)
    FROM (SELECT count(*) AS n FROM t GROUP BY l_orderkey, l_linenumber)""")
def dq_constraints(spark: SparkSession, d: str) -> DataFrame:
    return _check().table(_violations(spark, d))


@query("SELECT round(count(*) FILTER (WHERE n = 1) / sum(n), 8) AS uniqueness FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_partkey, l_suppkey)")
def uniqueness_ratio(spark: SparkSession, d: str) -> DataFrame:
    return quality.uniqueness_ratio(table(spark, d, "lineitem"), ["l_partkey", "l_suppkey"]).select(F.round("uniqueness", 8).alias("uniqueness"))


METRICS = [
    {"name": "late", "metric_sql": "SELECT count(*) FILTER (WHERE o_orderstatus IS DISTINCT FROM 'F') FROM {t}", "threshold": 10, "operator": "lte"},
    {"name": "rows", "metric_sql": "SELECT count(*) FROM {t}", "threshold": 1, "operator": "gte"},
    {"name": "mean", "metric_sql": "SELECT round(avg(o_totalprice), 2) FROM {t}"},
    {"name": "broken", "metric_sql": "SELECT sum(no_such_column) FROM {t}", "threshold": 0},
    {"name": "empty", "metric_sql": "SELECT avg(o_totalprice) FROM {t} WHERE o_orderkey < 0", "threshold": 0, "operator": "eq"},
]


@query("""SELECT 'late' AS name, CASE WHEN count(*) FILTER (WHERE o_orderstatus IS DISTINCT FROM 'F') <= 10 THEN 'PASS' ELSE 'FAIL' END AS status, CAST(count(*) FILTER (WHERE o_orderstatus IS DISTINCT FROM 'F') AS DOUBLE) AS value FROM orders
    UNION ALL SELECT 'rows', CASE WHEN count(*) >= 1 THEN 'PASS' ELSE 'FAIL' END, CAST(count(*) AS DOUBLE) FROM orders UNION ALL SELECT 'mean', 'MONITOR', round(avg(o_totalprice), 2) FROM orders
    UNION ALL SELECT 'broken', 'ERROR', NULL UNION ALL SELECT 'empty', 'PASS', 0.0""")
def dq_metrics(spark: SparkSession, d: str) -> DataFrame:
    view = f"orders_{uuid.uuid4().hex[:8]}"
    table(spark, d, "orders").createOrReplaceTempView(view)
    rows = quality.metric_checks(spark, [c | {"metric_sql": c["metric_sql"].format(t=view)} for c in METRICS])
    spark.catalog.dropTempView(view)
    return spark.createDataFrame([(r["name"], r["status"], r["value"]) for r in rows], "name string, status string, value double")


@query("SELECT execution_date, round(sum(v), 2) AS metric FROM (SELECT CAST(o_orderdate AS DATE) AS execution_date, o_totalprice AS v FROM orders) WHERE execution_date < DATE '1998-06-01' AND execution_date >= DATE '1998-06-01' - 14 GROUP BY 1", days=("execution_date",))
def dq_history(spark: SparkSession, d: str) -> DataFrame:
    h = table(spark, d, "orders").groupBy(F.to_date("o_orderdate").alias("execution_date")).agg(F.round(F.sum("o_totalprice"), 2).alias("metric"))
    return quality.history_before(h, date(1998, 6, 1))


@query("SELECT CAST(day AS DATE) AS missing_day FROM generate_series(DATE '1998-01-01', DATE '1998-12-31', INTERVAL 1 DAY) AS t(day) WHERE CAST(day AS DATE) NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders)", days=("missing_day",))
def gap_dates(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").withColumn("day", F.to_date("o_orderdate"))
    return state.missing_days(o, "day", date(1998, 1, 1), date(1998, 12, 31))


@query("""SELECT min(d) AS first_day, max(d) AS last_day, count(*) AS days FROM (SELECT d, d - CAST(row_number() OVER (ORDER BY d) AS INTEGER) AS island FROM
    (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 300000)) GROUP BY island""", days=("first_day", "last_day",))
def contiguous_watermark(spark: SparkSession, d: str) -> DataFrame:
    return state.contiguous_islands(table(spark, d, "orders").where("o_orderpriority = '1-URGENT' AND o_totalprice > 300000").withColumn("day", F.to_date("o_orderdate")), "day")


@query("SELECT CAST(l_shipdate AS DATE) AS day, count(*) AS n, min(l_extendedprice) AS low, max(l_extendedprice) AS high FROM lineitem GROUP BY 1", days=("day",))
def partition_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").groupBy(F.to_date("l_shipdate").alias("day")).agg(F.count(F.lit(1)).alias("n"), F.min("l_extendedprice").alias("low"), F.max("l_extendedprice").alias("high"))


@query("SELECT event_type, user_id, count(*) AS n FROM (SELECT event_type, user_id FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-05' UNION ALL SELECT event_type, user_id FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-06') GROUP BY ALL")
def union_days(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("event_type", "user_id", F.to_date("ts").alias("day"))
    both = e.where(F.col("day") == F.lit(date(2024, 1, 5))).unionByName(e.where(F.col("day") == F.lit(date(2024, 1, 6))))
    return both.groupBy("event_type", "user_id").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT day, user_id, total FROM (SELECT CAST(ts AS DATE) AS day, user_id, round(sum(value), 2) AS total FROM events GROUP BY ALL)
    WHERE (day BETWEEN DATE '2024-01-01' AND DATE '2024-01-20' AND day NOT BETWEEN DATE '2024-01-10' AND DATE '2024-01-15') OR (day BETWEEN DATE '2024-01-10' AND DATE '2024-01-15' AND day <> DATE '2024-01-12' AND total >= 50)""", days=("day",))
def sliding_window_reload(spark: SparkSession, d: str) -> DataFrame:
    """A table is written, a range of it replaced by other rows (one of its days by none), and read back."""
    schema = StructType().add("day", DateType()).add("user_id", LongType()).add("total", DoubleType())
    t = Table(spark, f"{shared_root(spark)}/reload-{uuid.uuid4().hex}", schema, "day")
    rows = table(spark, d, "events").groupBy(F.to_date("ts").alias("day"), "user_id").agg(F.round(F.sum("value"), 2).alias("total"))
    t.replace_range(rows.where(F.col("day").between(date(2024, 1, 1), date(2024, 1, 20))), "2024-01-01", "2024-01-20")
    again = rows.where(F.col("day").between(date(2024, 1, 10), date(2024, 1, 15)) & (F.col("day") != F.lit(date(2024, 1, 12))) & (F.col("total") >= 50))
    t.replace_range(again, "2024-01-10", "2024-01-15")
    return t.read()


@query(sql("SELECT bike_id, occurred_at, regexp_replace(bike_id, '[0-9]', '', 'g') AS letters FROM actions WHERE starts_with(station_id, 'ST-1')", "actions"))
def prefix_scan(spark: SparkSession, d: str) -> DataFrame:
    from velora.plans.inputs import actions

    return actions(spark, d).where(F.col("station_id").startswith("ST-1")).select("bike_id", "occurred_at", F.regexp_replace("bike_id", "[0-9]", "").alias("letters"))
