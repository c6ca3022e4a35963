"""Queries on sources, sinks, cleansing of collected rows, promotion and planning of runs.

Tables are written to new folders under the shared root and read back, so these queries test the writers too.
"""

from __future__ import annotations

import uuid
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, LongType, StringType, StructType

from velora.functions import dates, values
from velora.functions.values import class_by_number
from velora.operators import check_sets, cleanse, policy, promotion, quality, range_features, same_day, state, training
from velora.operators.events import events_for
from velora.operators.running import size_chunks
from velora.plans import inputs as i
from velora.plans.inputs import PLACES, sql, table
from velora.plans.registry import query
from velora.plans.serving import NAMESPACE
from velora.schemas import FAILURE_ALIASES, RENTAL_ALIASES
from velora.sources import files
from velora.sources.objects import ObjectStore, shared_root
from velora.sources.tables import IncompatibleSpec, Table, digest, sync_matches


def _root(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


# cleansing of collected rows

NAMES = {"bike_id": "bike", "rent_at": "out", "return_at": "back", "dist_m": "metres", "rent_station": "from", "return_station": "to"}


@query("""SELECT 'P' || l_partkey AS bike_id, l_shipdate AS rent_at, CASE WHEN l_linenumber <> 2 THEN l_shipdate + to_minutes(l_linenumber * 7) END AS return_at, l_quantity AS dist_m,
    CAST(l_suppkey AS VARCHAR) AS rent_station, CAST(l_orderkey AS VARCHAR) AS return_station, CASE WHEN l_linenumber <> 2 THEN l_linenumber * 7.0 END::DOUBLE AS dur_min
    FROM lineitem WHERE l_shipdate >= TIMESTAMP '1999-01-01' AND l_linenumber <> 6""")
def standard_trips(spark: SparkSession, d: str) -> DataFrame:
    li, n = table(spark, d, "lineitem"), F.col("l_linenumber")
    raw = li.select(
        F.when(n != 6, F.concat(F.lit(" p "), "l_partkey", F.lit("\t"))).alias("bike"),
        F.col("l_shipdate").alias("out"),
        F.when(n != 2, F.expr("l_shipdate + make_dt_interval(0, 0, l_linenumber * 7)")).alias("back"),
        F.col("l_quantity").cast("string").alias("metres"),
        F.col("l_suppkey").alias("from"),
        F.col("l_orderkey").alias("to"),
    )
    return cleanse.standard_trips(raw, NAMES, "1999-01-01")


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS bike_id, strftime(o_orderdate, '%Y-%m-%d') AS rent_dt, CAST(o_custkey AS VARCHAR) AS rent_station_id,
    CAST(NULL AS VARCHAR) AS return_dt, o_orderstatus AS return_station_id, o_orderpriority AS use_distance_m FROM orders""")
def alias_columns(spark: SparkSession, d: str) -> DataFrame:
    """A file with headers of several generations, and without one of the columns."""
    o = table(spark, d, "orders")
    raw = o.select(F.col("o_orderkey").alias("BIKE_ID"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("대여일시"), F.col("o_custkey").alias("대여 대여소번호"), F.col("o_orderstatus").alias("RTN_ID"), F.col("o_orderpriority").alias("USE_DST"))
    return cleanse.alias_select(raw, RENTAL_ALIASES, ["bike_id", "rent_dt"])


@query("""SELECT coalesce(CASE WHEN o_orderstatus = 'F' THEN 'A' || o_orderkey END, CASE WHEN o_orderpriority <> '1-URGENT' THEN 'B' || o_orderkey END) AS bike_no,
    CASE WHEN o_orderstatus <> 'O' THEN strftime(o_orderdate, '%Y%m%d') END AS reg_dttm, o_orderpriority AS failure_type FROM orders""")
def first_alias(spark: SparkSession, d: str) -> DataFrame:
    """Rows of two answers whose keys differ: each row takes the key that it has."""
    o, k = table(spark, d, "orders"), F.col("o_orderkey")
    raw = o.select(F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("A"), k)).alias("bike_no"), F.when(F.col("o_orderpriority") != "1-URGENT", F.concat(F.lit("B"), k)).alias("bikeNum"), F.when(F.col("o_orderstatus") != "O", F.date_format("o_orderdate", "yyyyMMdd")).alias("regDttm"), F.col("o_orderpriority").alias("value"))
    return cleanse.first_alias(raw, FAILURE_ALIASES)


@query("SELECT c_custkey, c_name FROM customer")
def paging_stripped(spark: SparkSession, d: str) -> DataFrame:
    paged = table(spark, d, "customer").select("c_custkey", F.lit(1).alias("START_INDEX"), "c_name", F.lit(1000).alias("END_INDEX"), F.lit("7").alias("RNUM"))
    return cleanse.without_paging(paged)


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN '' WHEN o_orderstatus = 'P' THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders")
def date_partitions(spark: SparkSession, d: str) -> DataFrame:
    o, kind = table(spark, d, "orders"), F.col("o_orderstatus")
    raw = F.when(kind == "F", F.lit(None)).when(kind == "P", F.date_format("o_orderdate", "yyyy.MM")).otherwise(F.date_format("o_orderdate", "yyyy/MM/dd HH:mm"))
    return o.select("o_orderkey", dates.date_partition(raw).alias("day"))


REGION_OF = {"FRANCE": "west", "GERMANY": "west", "JAPAN": "east", "CHINA": "east", "INDIA": "east"}
MASTER = f"""SELECT DATE '2026-01-02' AS snapshot_date, 'ST-' || s_suppkey AS station_id, 'Station ' || s_name AS station_name, n_name AS district,
    CASE n_name {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in REGION_OF.items())} END AS region, CASE WHEN s_acctbal >= 0 THEN s_acctbal END AS latitude,
    CAST(127.5 AS DOUBLE) AS longitude, CAST(CASE WHEN s_acctbal >= 0 THEN floor(s_acctbal + 0.5) END AS INTEGER) AS hold_num FROM supplier JOIN nation ON s_nationkey = n_nationkey"""


def _master(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier").join(F.broadcast(table(spark, d, "nation")), F.col("s_nationkey") == F.col("n_nationkey"))  # 25 rows by the schema
    known = F.when(F.col("s_acctbal") >= 0, F.col("s_acctbal").cast("string")).otherwise("none")
    raw = s.select(F.lit("2026-01-02").alias("snapshot_date"), F.concat(F.lit("ST-"), "s_suppkey").alias("station_id"), F.concat(F.lit("  Station \t "), "s_name", F.lit(" ")).alias("station_name"), F.col("n_name").alias("district"), known.alias("latitude"), F.lit("127.5").alias("longitude"), known.alias("hold_num"))
    return cleanse.stations(raw, REGION_OF)


@query(MASTER, days=("snapshot_date",))
def station_master(spark: SparkSession, d: str) -> DataFrame:
    return _master(spark, d)


@query(f"SELECT DISTINCT district FROM ({MASTER}) WHERE district IS NOT NULL AND region IS NULL")
def unknown_districts(spark: SparkSession, d: str) -> DataFrame:
    return cleanse.districts_without_region(_master(spark, d))


# files

@query("SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name, CASE WHEN n_regionkey = 1 THEN '' ELSE CAST(n_regionkey AS VARCHAR) END AS n_regionkey FROM nation")
def csv_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows written as a text table with quoted and empty fields, and read back as texts."""
    root = _root(spark, "csv")
    table(spark, d, "nation").select("n_nationkey", "n_name", F.when(F.col("n_regionkey") != 1, F.col("n_regionkey")).alias("n_regionkey")).write.option("header", True).option("quoteAll", True).csv(root)
    return files.read_csv(spark, root, ["n_nationkey", "n_name", "n_regionkey"])


@query("SELECT CAST(c_custkey AS VARCHAR) AS bike_no, CASE WHEN c_custkey > 10 THEN c_name END AS failure_type FROM customer")
def payload_rows(spark: SparkSession, d: str) -> DataFrame:
    """Collected answers of some hundred rows (a document each, the rows of one without a key) written and read back."""
    root = _root(spark, "payload")
    rows = F.struct(F.col("c_custkey").cast("string").alias("bike_no"), F.when(F.col("c_custkey") > 10, F.col("c_name")).alias("failure_type"))
    table(spark, d, "customer").groupBy(F.when(F.col("c_custkey") > 10, F.floor(F.col("c_custkey") / 500)).otherwise(-1).alias("part")).agg(F.collect_list(rows).alias("rows")).write.partitionBy("part").json(root)
    return files.read_payload(spark, root, "bike_no string, failure_type string")


# tables

DAILY = StructType().add("day", DateType()).add("kind", StringType()).add("total", DoubleType()).add("n", LongType())
ROWS = "SELECT CAST(ts AS DATE) AS day, event_type AS kind, round(sum(value), 2) AS total, count(*) AS n FROM events GROUP BY ALL"
D5, D6, D7 = "DATE '2024-01-05'", "DATE '2024-01-06'", "DATE '2024-01-07'"


def _rows(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy(F.to_date("ts").alias("day"), F.col("event_type").alias("kind")).agg(F.round(F.sum("value"), 2).alias("total"), F.count(F.lit(1)).alias("n"))


def _daily(spark: SparkSession, d: str, name: str) -> Table:
    t = Table(spark, _root(spark, name), DAILY, "day")
    t.create()
    t.append(_rows(spark, d))
    return t


def _on(day: int):
    return F.col("day") == F.lit(date(2024, 1, day))


@query(f"WITH r AS ({ROWS}) SELECT * FROM r WHERE day <> {D5} UNION ALL SELECT day, kind, total, n * 10 FROM r WHERE day = {D5} AND kind <> 'click'", days=("day",))
def overwrite_partition(spark: SparkSession, d: str) -> DataFrame:
    """One day is replaced, twice, with the same end."""
    t = _daily(spark, d, "one")
    for _ in range(2):
        t.replace_partitions(_rows(spark, d).where(_on(5) & (F.col("kind") != "click")).withColumn("n", F.col("n") * 10), ["2024-01-05"])
    return t.read()


@query(f"WITH r AS ({ROWS}) SELECT * FROM r WHERE day NOT IN ({D5}, {D6}, {D7}) UNION ALL SELECT * FROM r WHERE day = {D6} AND kind = 'view'", days=("day",))
def overwrite_partitions(spark: SparkSession, d: str) -> DataFrame:
    """Three days are declared and one has rows: the two others end up empty."""
    t = _daily(spark, d, "three")
    t.replace_partitions(_rows(spark, d).where(_on(6) & (F.col("kind") == "view")), ["2024-01-05", "2024-01-06", "2024-01-07"])
    return t.read()


@query(f"SELECT * FROM ({ROWS}) WHERE kind = 'error'", days=("day",))
def overwrite_all(spark: SparkSession, d: str) -> DataFrame:
    t = _daily(spark, d, "all")
    t.replace_all(_rows(spark, d).where("kind = 'error'"))
    return t.read()


@query(f"WITH r AS ({ROWS}) SELECT * FROM r UNION ALL SELECT * FROM r WHERE day = {D5}", days=("day",))
def append_rows(spark: SparkSession, d: str) -> DataFrame:
    t = _daily(spark, d, "append")
    t.append(_rows(spark, d).where(_on(5)))
    return t.read()


@query(f"WITH r AS ({ROWS}) SELECT * FROM r WHERE day <> {D6} UNION ALL SELECT day, kind, total, -n FROM r WHERE day = {D6} AND kind = 'click'", days=("day",))
def overwrite_present(spark: SparkSession, d: str) -> DataFrame:
    """Only days with rows are replaced."""
    t = _daily(spark, d, "present")
    t.replace_present(_rows(spark, d).where(_on(6) & (F.col("kind") == "click")).withColumn("n", -F.col("n")))
    return t.read()


@query("SELECT c_custkey, min(c_name) AS c_name, count(*) AS n FROM customer GROUP BY c_custkey")
def insert_ignored(spark: SparkSession, d: str) -> DataFrame:
    """The same rows are added three times, with repeats; each key comes in once."""
    t = Table(spark, _root(spark, "insert"), StructType().add("c_custkey", LongType()).add("c_name", StringType()))
    rows = table(spark, d, "customer").select("c_custkey", "c_name")
    for part in (rows.where("c_custkey <= 50"), rows, rows.unionByName(rows)):
        t.insert_new(part, "c_custkey")
    return t.read().groupBy("c_custkey").agg(F.min("c_name").alias("c_name"), F.count(F.lit(1)).alias("n"))


@query(f"SELECT kind, CAST(sum(n) AS BIGINT) AS n, CAST(NULL AS VARCHAR) AS note FROM ({ROWS}) GROUP BY 1")
def column_added(spark: SparkSession, d: str) -> DataFrame:
    """Old files read as NULL in a new column, also after they were compacted."""
    t = _daily(spark, d, "column")
    t.add_columns(StructType().add("note", StringType()))
    t.replace_all(t.read())
    return t.read().groupBy("kind").agg(F.sum("n").alias("n"), F.max("note").alias("note"))


@query(f"SELECT kind, total FROM ({ROWS}) WHERE day BETWEEN {D5} AND {D6} AND n > 1")
def pruned_read(spark: SparkSession, d: str) -> DataFrame:
    """Days and columns reach the scan."""
    return _daily(spark, d, "scan").read(F.col("day").between(date(2024, 1, 5), date(2024, 1, 6)) & (F.col("n") > 1), ["kind", "total"])


@query(f"SELECT CAST(min(day) AS VARCHAR) AS first_day, CAST(max(day) AS VARCHAR) AS last_day, CAST(max(day) FILTER (WHERE kind = 'error' AND total < 100) AS VARCHAR) AS low_day FROM ({ROWS})")
def partition_bounds(spark: SparkSession, d: str) -> DataFrame:
    """First and last day by folder names alone, and the newest day with a matching row."""
    t = _daily(spark, d, "bounds")
    return spark.createDataFrame([(t.min_partition(), t.max_partition(), t.latest_with((F.col("kind") == "error") & (F.col("total") < 100)))], "first_day string, last_day string, low_day string")


@query(f"SELECT DISTINCT CAST(day AS VARCHAR) AS day FROM ({ROWS})")
def partition_list(spark: SparkSession, d: str) -> DataFrame:
    return spark.createDataFrame([(v,) for v in _daily(spark, d, "list").partitions()], "day string")


@query(f"SELECT case_, outcome, CASE WHEN outcome = 'opened' THEN n ELSE 0 END AS rows FROM (SELECT count(*) AS n FROM ({ROWS})), (VALUES ('same', 'opened'), ('other partition', 'refused'), ('other type', 'refused'), ('new column', 'opened')) AS t(case_, outcome)")
def spec_refused(spark: SparkSession, d: str) -> DataFrame:
    """A table is opened again under four definitions; two of them do not fit it, and the others see all rows."""
    made = _daily(spark, d, "spec")
    cases = {
        "same": (DAILY, "day"),
        "other partition": (DAILY, "kind"),
        "other type": (StructType([*DAILY.fields[:3], StructType().add("n", StringType()).fields[0]]), "day"),
        "new column": (StructType([*DAILY.fields, StructType().add("note", StringType()).fields[0]]), "day"),
    }
    out = []
    for name, (schema, partition) in cases.items():
        try:
            t = Table(spark, made.root, schema, partition)
            t.create()
            out.append((name, "opened", t.read().count()))
        except IncompatibleSpec:
            out.append((name, "refused", 0))
    return spark.createDataFrame(out, "case_ string, outcome string, rows long")


@query(f"SELECT count(*) AS n, true AS same, false AS other FROM ({ROWS})")
def sync_verified(spark: SparkSession, d: str) -> DataFrame:
    """A mart equals its copy by content, and not one with as many rows of other content."""
    rows = _rows(spark, d)
    t = _daily(spark, d, "sync")
    same, other = sync_matches(rows, t.read()), sync_matches(rows, t.read().withColumn("n", F.col("n") + 1))
    return digest(rows).select(F.col("rows").alias("n"), F.lit(same).alias("same"), F.lit(other).alias("other"))


# promotion and same-day runs

@query(f"WITH r AS ({ROWS}) SELECT r.*, c.rows AS counted FROM r JOIN (SELECT day, count(*) AS rows FROM r GROUP BY 1) c USING (day) WHERE day IN ({D5}, {D6})", days=("day",))
def promoted_days(spark: SparkSession, d: str) -> DataFrame:
    """Two days are promoted at once, and each marker tells its rows."""
    t, store = Table(spark, _root(spark, "promoted"), DAILY, "day"), ObjectStore(spark, _root(spark, "markers"))
    days = [date(2024, 1, 5), date(2024, 1, 6)]
    promotion.promote(t, {x: _rows(spark, d).where(F.col("day") == F.lit(x)).drop("day") for x in days}, store, "daily", datetime(2024, 1, 7))
    marks = [(x, store.get_json(promotion.marker_key("daily", x))["rows"]) for x in promotion.finished_days(store, "daily")]
    return t.read().join(spark.createDataFrame(marks, "day date, counted long"), "day")


@query(f"SELECT 'DEGRADED' AS mode, CAST(count(*) AS BIGINT) AS rows, '2024-01-06' AS confirmed_through FROM ({ROWS}) WHERE day = {D7}")
def same_day_run(spark: SparkSession, d: str) -> DataFrame:
    """The day itself is written, the watermark stays, and the mode follows the preliminary snapshot."""
    t, store = _daily(spark, d, "same"), ObjectStore(spark, _root(spark, "same"))
    run = {"status": "COMPLETE", "same_day": True, "run_date": "2024-01-07", "promotion_id": "p1", "mode": "NORMAL", "snapshots": [{"target_date": "2024-01-07", "snapshot_type": policy.PRELIMINARY}]}
    doc = same_day.process_same_day(t, _rows(spark, d).where(_on(7)), run, date(2024, 1, 6), datetime(2024, 1, 7, 9))
    same_day.finish_same_day(store, "daily", doc)
    stored = store.get_json(same_day.same_day_key("daily", date(2024, 1, 7), "p1"))
    return spark.createDataFrame([(stored["mode"], stored["rows"], stored["confirmed_through"])], "mode string, rows long, confirmed_through string")


CHUNKS = """SELECT CAST(s AS DATE) AS first_day, least(CAST(s AS DATE) + 30, h) AS last_day FROM
    (SELECT CAST(min(o_orderdate) AS DATE) AS l, CAST(max(o_orderdate) AS DATE) AS h FROM orders), generate_series(l, h, INTERVAL 31 DAY) AS t(s)"""


def _span(spark: SparkSession, d: str) -> tuple[date, date]:
    r = table(spark, d, "orders").agg(F.to_date(F.min("o_orderdate")).alias("low"), F.to_date(F.max("o_orderdate")).alias("high")).first()
    return r.low, r.high


@query(CHUNKS, days=("first_day", "last_day"))
def chunk_plan(spark: SparkSession, d: str) -> DataFrame:
    return spark.createDataFrame(state.chunks(*_span(spark, d)), "first_day date, last_day date")


@query(f"SELECT * FROM ({CHUNKS}) WHERE first_day > (SELECT CAST(min(o_orderdate) AS DATE) FROM orders) + 31", days=("first_day", "last_day"))
def open_chunk_plan(spark: SparkSession, d: str) -> DataFrame:
    low, high = _span(spark, d)
    return spark.createDataFrame(state.open_chunks(low, high, state.chunks(low, high)[:2]), "first_day date, last_day date")


@query("SELECT CAST(min(o_orderdate) AS DATE) + 1 AS first_day, CAST(min(o_orderdate) AS DATE) + 70 AS last_day, CAST(min(o_orderdate) AS DATE) + 1 - 30 AS read_from FROM orders", days=("first_day", "last_day", "read_from"))
def capped_range(spark: SparkSession, d: str) -> DataFrame:
    first, last = state.confirmed_range(*_span(spark, d))
    return spark.createDataFrame([(first, last, state.lookback_start(first))], "first_day date, last_day date, read_from date")


@query("SELECT CAST(row_number() OVER (ORDER BY n_nationkey) - 1 AS BIGINT) // 10 AS batch, n_nationkey, n_name FROM nation")
def ordered_batches(spark: SparkSession, d: str) -> DataFrame:
    """Names in order, ten a batch."""
    return size_chunks(table(spark, d, "nation").select("n_nationkey", "n_name", F.lit(1).alias("w")), ["n_nationkey"], "w", 10, 1 << 40).select(F.col("chunk").alias("batch"), "n_nationkey", "n_name")


@query("SELECT strftime(m, '%Y-%m') AS month FROM (SELECT date_trunc('month', min(o_orderdate)) AS l, max(o_orderdate) AS h FROM orders), generate_series(CAST(l AS TIMESTAMP), CAST(h AS TIMESTAMP), INTERVAL 1 MONTH) AS t(m)")
def months_needed(spark: SparkSession, d: str) -> DataFrame:
    """The months of all orders, for which samples are needed."""
    return spark.createDataFrame([(m,) for m in training.months_between(*_span(spark, d))], "month string")


# quality

def _checked(spark: SparkSession, d: str, name: str) -> DataFrame:
    if name == "risk":
        return check_sets.SETS[name]().table(i.risk(spark, d))
    return check_sets.SETS[name]().table(table(spark, d, "lineitem").select(F.when(F.col("l_linenumber") != 4, F.col("l_partkey")).alias("bike_id"), F.col("l_shipdate").alias("rent_dt")))


LINE_TRIPS = "SELECT CASE WHEN l_linenumber <> 4 THEN l_partkey END AS bike_id, l_shipdate AS rent_dt FROM lineitem"


@query(f"""WITH t AS ({LINE_TRIPS}), u AS (SELECT count(*) AS n FROM t GROUP BY bike_id, rent_dt)
    SELECT 'complete(bike_id)' AS "constraint", CASE WHEN count(*) FILTER (WHERE bike_id IS NULL) = 0 THEN 'PASS' ELSE 'FAIL' END AS status, count(*) FILTER (WHERE bike_id IS NULL) AS violations, count(*) AS total FROM t
    UNION ALL SELECT 'complete(rent_dt)', 'PASS', count(*) FILTER (WHERE rent_dt IS NULL), count(*) FROM t
    UNION ALL SELECT 'uniqueness(bike_id,rent_dt)', CASE WHEN count(*) FILTER (WHERE n = 1) >= 0.98 * sum(n) THEN 'PASS' ELSE 'FAIL' END, CAST(sum(n) - count(*) FILTER (WHERE n = 1) AS BIGINT), CAST(sum(n) AS BIGINT) FROM u""")
def check_set_trips(spark: SparkSession, d: str) -> DataFrame:
    return _checked(spark, d, "trips")


@query(sql("""SELECT c AS "constraint", 'PASS' AS status, CAST(0 AS BIGINT) AS violations, (SELECT count(*) FROM risk) AS total
    FROM (VALUES ('min_rows(1)'), ('complete(bike_id)'), ('complete(risk_score)'), ('contained(risk_grade)'), ('uniqueness(bike_id)')) AS t(c)""", "scores", "cuts", "risk"))
def check_set_risk(spark: SparkSession, d: str) -> DataFrame:
    return _checked(spark, d, "risk")


@query(sql("SELECT round(count(*) FILTER (WHERE risk_grade = 'Critical') / count(*), 6) AS critical_share FROM risk", "scores", "cuts", "risk"))
def critical_share(spark: SparkSession, d: str) -> DataFrame:
    return check_sets.critical_share(i.risk(spark, d))


@query("""SELECT CASE WHEN count(*) < 1000000000 THEN 'too few rows' END AS rows_gate, CASE WHEN count(DISTINCT o_orderdate) < 10 THEN 'too few anchors' ELSE 'fine' END AS anchor_gate,
    CASE WHEN avg(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) BETWEEN 0.01 AND 0.99 THEN 'fine' ELSE 'rate' END AS rate_gate, 'nulls' AS null_gate FROM orders""")
def training_gate(spark: SparkSession, d: str) -> DataFrame:
    """A set with enough anchors and a fair rate, but with too few rows and a feature that is mostly NULL."""
    df = table(spark, d, "orders").select(F.col("o_orderdate").alias("snapshot_date"), (F.col("o_orderstatus") == "F").cast("int").alias("label"), F.lit(None).cast("double").alias("dist_km"), F.col("o_totalprice").alias("trips"))
    wrong = " ".join(quality.training_gate(quality.training_report(df, ["dist_km", "trips"]), 1_000_000_000, 10, (0.01, 0.99), 0.5))
    row = ("too few rows" if "rows" in wrong else None, "too few anchors" if "anchors" in wrong else "fine", "rate" if "positive rate" in wrong else "fine", "nulls" if "null_dist_km" in wrong and "null_trips" not in wrong else "fine")
    return spark.createDataFrame([row], "rows_gate string, anchor_gate string, rate_gate string, null_gate string")


# events

UUID5 = """(SELECT *, sha1(unhex('{ns}') || encode({name})) AS h FROM ({rows}))"""
AS_UUID = "substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab', 1 + CAST(('0x' || substr(h, 17, 1)) AS INTEGER) % 4, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12)"


@query(f"SELECT {AS_UUID} AS event_id, 'COLLECT' AS event_type, bike_id, station_id, TIMESTAMP '2024-01-29 09:00:00' AS occurred_at, TIMESTAMP '2024-01-29 09:15:00' AS received_at FROM "
    + UUID5.format(ns=NAMESPACE.hex, name="bike_id || ':COLLECT:2024-01-29'", rows="SELECT 'B' || c_custkey AS bike_id, c_nationkey AS station_id FROM customer"))
def synthetic_events(spark: SparkSession, d: str) -> DataFrame:
    targets = table(spark, d, "customer").select(F.concat(F.lit("B"), "c_custkey").alias("bike_id"), F.col("c_nationkey").alias("station_id"))
    e = events_for(targets, "COLLECT", i.DAY, NAMESPACE).drop("worker_id")
    return e.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("occurred_at", "received_at")})


@query("SELECT count(*) AS anchors, min(a) AS first_anchor, max(a) AS last_anchor, CAST(sum(n) AS BIGINT) AS events FROM (SELECT max(CAST(ts AS DATE)) AS h FROM events), generate_series(0, 59) AS t(x), LATERAL (SELECT h - CAST(x AS INTEGER) AS a, (SELECT count(*) FROM events WHERE CAST(ts AS DATE) = h - CAST(x AS INTEGER)) AS n)", days=("first_anchor", "last_anchor"))
def holdout_anchors(spark: SparkSession, d: str) -> DataFrame:
    """The holdout days that end with the newest event, and the events on them."""
    days = table(spark, d, "events").groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    held = range_features.anchor_calendar(days.agg(F.max("day")).first()[0], 14)["holdout"]
    mine = days.where(F.col("day").between(F.lit(held[0]), F.lit(held[-1])))
    return mine.agg(F.lit(len(held)).cast("long").alias("anchors"), F.lit(held[0]).alias("first_anchor"), F.lit(held[-1]).alias("last_anchor"), F.sum("n").alias("events"))


@query("SELECT p_partkey, CASE WHEN p_partkey < 100 THEN 'unknown' WHEN p_partkey >= 1000 THEN 'saessak' ELSE 'normal' END AS class, CASE WHEN p_retailprice >= 1000 THEN p_brand END AS brand FROM part")
def classes_and_blanks(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    named = F.when(k < 100, F.concat(k.cast("string"), F.lit("-x"))).otherwise(F.concat(F.lit("SPB-"), k, F.lit("  ")))
    brand = F.when(F.col("p_retailprice") >= 1000, F.col("p_brand")).otherwise(F.lit("0.0"))
    return table(spark, d, "part").select("p_partkey", class_by_number(named, 1000).alias("class"), values.falsy_to_null(brand).alias("brand"))
