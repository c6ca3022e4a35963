"""Queries on features, labels and their evaluation."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velora.functions.values import class_by_number
from velora.operators import range_features as rf
from velora.operators.model import candidates
from velora.operators.model import score as model_score
from velora.operators.ranking import average_precision, capture_at_k, capture_summary
from velora.plans import inputs as i
from velora.plans.inputs import ANCHORS, faults, sql, table, trips
from velora.plans.registry import query
from velora.sources.tables import written

ROUNDED = "round(dist_km, 4) AS dist_km, round(dur_h, 4) AS dur_h, round(trend_ratio, 6) AS trend_ratio"


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({"dist_km": F.round("dist_km", 4), "dur_h": F.round("dur_h", 4), "trend_ratio": F.round("trend_ratio", 6)})


@query(sql("SELECT bike_id, rent_date, trips, round(dist_m, 4) AS dist_m, round(dur_min, 4) AS dur_min, instant_ret FROM daily", "trips", "daily"), days=("rent_date",))
def daily_rollup(spark: SparkSession, d: str) -> DataFrame:
    return rf.daily_rollup(trips(spark, d)).withColumns({"dist_m": F.round("dist_m", 4), "dur_min": F.round("dur_min", 4)})


@query(sql(f"SELECT as_of, bike_id, trips, {ROUNDED}, instant_ret, days_since_last_rent FROM usage", "trips", "anchors", "daily", "usage"), days=("as_of",))
def usage_features(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(rf.usage_of(trips(spark, d), ANCHORS, 14))


@query(sql("SELECT as_of, bike_id, fail_150d, last_fail_date FROM fails", "faults", "anchors", "fails"), days=("as_of", "last_fail_date",))
def fault_features(spark: SparkSession, d: str) -> DataFrame:
    return rf.fault_features(faults(spark, d, anchored=True), ANCHORS, fail_window=10)


@query(sql("""SELECT as_of, bike_id, CAST(sum(CASE WHEN reg_date >= as_of - 10 THEN 1 ELSE 0 END) AS BIGINT) AS fail_150d, max(reg_date) AS last_fail_date
    FROM faults JOIN anchors ON reg_date <= as_of AND reg_date >= as_of - 12 GROUP BY as_of, bike_id""", "faults", "anchors"), days=("as_of", "last_fail_date",))
def fault_features_with_today(spark: SparkSession, d: str) -> DataFrame:
    return rf.fault_features(faults(spark, d, 12, include_today=True, anchored=True), ANCHORS, fail_window=10, lookback=12, include_today=True)


@query(sql("SELECT as_of, bike_id FROM recent", "faults", "anchors", "recent"), days=("as_of",))
def recently_reported(spark: SparkSession, d: str) -> DataFrame:
    return rf.recently_reported(faults(spark, d, 5, anchored=True), ANCHORS, 5)


@query(sql("SELECT * FROM pos", "faults", "anchors", "pos"), days=("as_of",))
def positives(spark: SparkSession, d: str) -> DataFrame:
    return rf.positives(faults(spark, d, 0, 3, anchored=True), ANCHORS, 3)


@query(sql("SELECT as_of, bike_id FROM pos ANTI JOIN recent USING (as_of, bike_id)", "faults", "anchors", "recent", "pos"), days=("as_of",))
def positives_new(spark: SparkSession, d: str) -> DataFrame:
    return rf.new_positives(faults(spark, d, 5, 3, anchored=True), ANCHORS, 3, 5)


CLEAN = """WHERE NOT (dur_min > 0 AND (dist_m / 1000.0) / (nullif(dur_min, 0) / 60.0) > 45)
    AND NOT (dist_m > 50000) AND NOT (coalesce(dur_min, 0) = 0 AND dist_m > 5000)"""


@query(sql(f"SELECT bike_id, rent_at, round(dist_m, 4) AS dist_m, dur_min, rent_station, return_station FROM trips {CLEAN}", "trips"))
def trip_filters(spark: SparkSession, d: str) -> DataFrame:
    return rf.trip_filters(trips(spark, d)).withColumn("dist_m", F.round("dist_m", 4))


SAMPLES = f"""SELECT u.as_of AS snapshot_date, u.bike_id, trips, {ROUNDED}, instant_ret, coalesce(fail_150d, 0) AS fail_150d,
    coalesce(CAST(u.as_of - last_fail_date AS INTEGER), 9999) AS days_since_fail, days_since_last_rent,
    CASE WHEN p.bike_id IS NOT NULL THEN 1 ELSE 0 END AS label, r.bike_id IS NOT NULL AS excluded,
    CASE WHEN CAST(regexp_extract(u.bike_id, '(\\d+)\\s*$', 1) AS BIGINT) >= 100 THEN 'saessak' ELSE 'normal' END AS bike_class
    FROM usage u LEFT JOIN fails f ON f.as_of = u.as_of AND f.bike_id = u.bike_id LEFT JOIN recent r ON r.as_of = u.as_of AND r.bike_id = u.bike_id
    LEFT JOIN pos p ON p.as_of = u.as_of AND p.bike_id = u.bike_id"""
SAMPLE_TABLES = ("trips", "faults", "anchors", "daily", "usage", "fails", "recent", "pos")


def _samples(spark: SparkSession, d: str) -> DataFrame:
    return rf.samples(trips(spark, d), faults(spark, d, None, 3, anchored=True), ANCHORS, class_by_number(F.col("bike_id"), 100), window=14, horizon=3, exclude_days=5, fail_window=10)


@query(sql(SAMPLES, *SAMPLE_TABLES), days=("snapshot_date",))
def train_samples(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(_samples(spark, d))


@query(sql(f"""SELECT snapshot_date, count(*) AS n, CAST(sum(label) AS BIGINT) AS positives, round(avg(label), 6) AS positive_rate, count(DISTINCT bike_class) AS classes,
    round(avg(trips), 6) AS mean_trips FROM ({SAMPLES}) GROUP BY 1""", *SAMPLE_TABLES), days=("snapshot_date",))
def sample_report(spark: SparkSession, d: str) -> DataFrame:
    return _samples(spark, d).groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("positives"), F.round(F.avg("label"), 6).alias("positive_rate"), F.countDistinct("bike_class").alias("classes"), F.round(F.avg("trips"), 6).alias("mean_trips"))


# the whole calendar: 60 daily anchors and about 100 weekly ones, on the lines as trips and their returns as reports

CALENDAR = [a for part in rf.anchor_calendar(date(2001, 6, 30), 14, months=26).values() for a in part]
LINES = {
    "trips": """SELECT l_partkey AS bike_id, l_shipdate AS rent_at, l_quantity * 100 AS dist_m, CASE WHEN l_linenumber <> 7 THEN l_linenumber * 10.0 END AS dur_min,
        l_suppkey % 3 AS rent_station, l_suppkey % 2 AS return_station FROM lineitem""",
    "faults": "SELECT DISTINCT l_partkey AS bike_id, CAST(l_shipdate AS DATE) AS reg_date FROM lineitem WHERE l_returnflag = 'R'",
    "anchors": f"SELECT * FROM (VALUES {', '.join(f"(DATE '{a}')" for a in CALENDAR)}) AS t(as_of)",
}


def _calendar(select: str, *names: str) -> str:
    """A statement over the lines' relations; what ``names`` tell comes from the common ones."""
    out = sql(select, *names)
    for name in ("trips", "faults", "anchors"):
        out = out.replace(f"{name} AS ({i.SQL[name]})", f"{name} AS ({LINES[name]})")
    return out


def _line_trips(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("l_suppkey")
    minutes = F.when(F.col("l_linenumber") != 7, F.col("l_linenumber") * F.lit(10.0).cast("double"))
    return table(spark, d, "lineitem").select(F.col("l_partkey").alias("bike_id"), F.col("l_shipdate").alias("rent_at"), (F.col("l_quantity") * 100).alias("dist_m"), minutes.alias("dur_min"), (k % 3).alias("rent_station"), (k % 2).alias("return_station"))


def _line_faults(spark: SparkSession, d: str) -> DataFrame:
    return rf.fault_days(table(spark, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_partkey").alias("bike_id"), F.to_date("l_shipdate").alias("reg_date")))


@query(_calendar(f"SELECT as_of, bike_id, trips, {ROUNDED}, instant_ret, days_since_last_rent FROM usage", "trips", "anchors", "daily", "usage"), days=("as_of",))
def usage_calendar(spark: SparkSession, d: str) -> DataFrame:
    """Use before every anchor of the calendar; each day of a vehicle is read once."""
    return _rounded(rf.usage_of(_line_trips(spark, d), CALENDAR, 14))


@query(_calendar("""SELECT as_of, bike_id, CAST(sum(CASE WHEN reg_date >= as_of - 150 THEN 1 ELSE 0 END) AS BIGINT) AS fail_150d, max(reg_date) AS last_fail_date
    FROM faults JOIN anchors ON reg_date < as_of GROUP BY as_of, bike_id""", "faults", "anchors"), days=("as_of", "last_fail_date"))
def fault_calendar(spark: SparkSession, d: str) -> DataFrame:
    """The whole history before every anchor, with counts of its last 150 days."""
    return rf.fault_features(_line_faults(spark, d), CALENDAR)


@query(_calendar("""SELECT as_of, bike_id, bool_or(reg_date < as_of) AS recent, bool_or(reg_date >= as_of) AS soon FROM faults JOIN anchors ON reg_date >= as_of - 30 AND reg_date < as_of + 14
    GROUP BY as_of, bike_id""", "faults", "anchors"), days=("as_of",))
def label_calendar(spark: SparkSession, d: str) -> DataFrame:
    """Which vehicles were reported in the 30 days before an anchor, and which are in the 14 days from it on."""
    f, keys = _line_faults(spark, d), ["as_of", "bike_id"]
    recent = rf.recently_reported(f, CALENDAR, 30).withColumn("recent", F.lit(True))
    both = recent.join(rf.positives(f, CALENDAR, 14).withColumn("soon", F.lit(True)), keys, "full")
    return both.select(*keys, F.coalesce("recent", F.lit(False)).alias("recent"), F.coalesce("soon", F.lit(False)).alias("soon"))


@query(_calendar(f"""SELECT snapshot_date, count(*) AS n, CAST(sum(label) AS BIGINT) AS positives, CAST(sum(CASE WHEN excluded THEN 1 ELSE 0 END) AS BIGINT) AS excluded, CAST(sum(fail_150d) AS BIGINT) AS fails, CAST(sum(days_since_fail) AS BIGINT) AS since
    FROM ({SAMPLES.replace("u.bike_id, '", "CAST(u.bike_id AS VARCHAR), '")}) GROUP BY 1""", *SAMPLE_TABLES), days=("snapshot_date",))
def samples_calendar(spark: SparkSession, d: str) -> DataFrame:
    """The training set over the whole calendar, summed by anchor."""
    s = rf.samples(_line_trips(spark, d), _line_faults(spark, d), CALENDAR, F.lit("normal"), window=14, horizon=3, exclude_days=5, fail_window=10)
    return s.groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("positives"), F.count(F.when(F.col("excluded"), 1)).alias("excluded"), F.sum("fail_150d").alias("fails"), F.sum("days_since_fail").alias("since"))


def _scored(spark: SparkSession, d: str) -> DataFrame:
    return _samples(spark, d).where("NOT excluded").select(F.col("snapshot_date").alias("as_of"), "bike_id", "label", (F.col("trips") / 1000.0).cast("double").alias("score"))


SCORED = f"SELECT snapshot_date AS as_of, bike_id, label, CAST(trips / 1000.0 AS DOUBLE) AS score FROM ({SAMPLES}) WHERE NOT excluded"
CAPTURE = f"""SELECT as_of, n AS positives, coalesce(h, 0) AS hits, round(coalesce(h, 0) * 100.0 / n, 2) AS capture FROM
    (SELECT as_of, count(*) AS n FROM fresh GROUP BY 1) JOIN (SELECT DISTINCT as_of FROM scored) USING (as_of) LEFT JOIN
    (SELECT as_of, count(*) AS h FROM (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY as_of ORDER BY score DESC, bike_id) <= 20) SEMI JOIN fresh USING (as_of, bike_id) GROUP BY 1) USING (as_of)"""
FRESH = "fresh AS (SELECT as_of, bike_id FROM pos ANTI JOIN recent USING (as_of, bike_id))"


@query(sql(f"SELECT * FROM (WITH scored AS ({SCORED}), {FRESH} {CAPTURE})", *SAMPLE_TABLES), days=("as_of",))
def capture_top_k(spark: SparkSession, d: str) -> DataFrame:
    return capture_at_k(_scored(spark, d), positives_new(spark, d), 20)


@query(sql(f"""SELECT round(avg(capture), 3) AS capture_at_k, round(stddev_samp(capture), 3) AS capture_std, round(min(capture), 3) AS capture_min, count(capture) AS eval_days
    FROM (WITH scored AS ({SCORED}), {FRESH} {CAPTURE})""", *SAMPLE_TABLES))
def capture_metrics(spark: SparkSession, d: str) -> DataFrame:
    return capture_summary(capture_top_k(spark, d))


@query(sql(f"""SELECT round(sum(tp * ctp / cn) / sum(tp), 8) AS average_precision FROM (SELECT score, sum(label) AS tp, CAST(sum(sum(label)) OVER (ORDER BY score DESC) AS DOUBLE) AS ctp,
    CAST(sum(count(*)) OVER (ORDER BY score DESC) AS DOUBLE) AS cn FROM ({SCORED}) GROUP BY score)""", *SAMPLE_TABLES))
def pr_auc(spark: SparkSession, d: str) -> DataFrame:
    return average_precision(_scored(spark, d)).select(F.round("average_precision", 8).alias("average_precision"))


@query()
def boosted_scores(spark: SparkSession, d: str) -> DataFrame:
    """A few boosted trees on the training set of the calendar's last years, and their score of every row of it; no SQL can
    say what they learn, so they are tested against a plain fit."""
    s = written(rf.samples(_line_trips(spark, d), _line_faults(spark, d), CALENDAR, F.lit("normal")).where("NOT excluded"), "samples")
    fitted = candidates(trees=3, leaves=6, least_rows=20)["boosted"].fit(s)
    return model_score(fitted, s).select("snapshot_date", "bike_id", "label", F.round("score", 6).alias("score"))


@query("SELECT event_type, count(*) AS events, round(sum(value), 2) AS total FROM events GROUP BY 1")
def event_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("events"), F.round(F.sum("value"), 2).alias("total"))


@query("SELECT event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS events FROM events GROUP BY ALL")
def event_props(spark: SparkSession, d: str) -> DataFrame:
    k = F.from_json("props", "k long")["k"]
    return table(spark, d, "events").groupBy("event_type", k.alias("k")).agg(F.count(F.lit(1)).alias("events"))
