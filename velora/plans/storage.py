"""Queries on stored tables: versions, units of several tables, quality states, chunks by size, footers."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructType, TimestampNTZType

from velora.operators import cleanse
from velora.operators.quality import Check
from velora.operators.quality_states import Measures
from velora.operators.running import size_chunks
from velora.operators.unit_write import UnitWrite, write_chunk
from velora.plans.ingest import D5, D6, DAILY, ROWS, _daily, _on, _root, _rows
from velora.plans.inputs import table
from velora.plans.quality import LINES, REASONS, _violations
from velora.plans.registry import query
from velora.sources.footers import footer_stats, partition_stats, total_stats
from velora.sources.objects import ObjectStore
from velora.sources.tables import Table
from velora.sources.versions import VersionedTable

T0 = datetime(2024, 2, 1)


def _versions(spark: SparkSession, d: str, name: str) -> VersionedTable:
    """Four versions: all rows; day 5 without clicks; day 6 gone; compacted where files are many."""
    t = VersionedTable(spark, _root(spark, name), DAILY, "day")
    rows = _rows(spark, d)
    t.replace_all(rows, T0)
    t.replace_partitions(rows.where(_on(5) & (F.col("kind") != "click")), ["2024-01-05"], T0 + timedelta(days=1))
    t.replace_range(rows.limit(0), "2024-01-06", "2024-01-06", T0 + timedelta(days=2))
    t.restore(1, T0 + timedelta(days=3))
    t.compact(T0 + timedelta(days=4))
    return t


@query(f"SELECT * FROM ({ROWS}) WHERE day <> {D5} OR kind <> 'click'", days=("day",))
def older_version(spark: SparkSession, d: str) -> DataFrame:
    """What the table was after its second write, though a day has gone and come back since."""
    return _versions(spark, d, "older").read(1)


@query(f"""WITH r AS (SELECT * FROM ({ROWS}) WHERE day <> {D5} OR kind <> 'click')
    SELECT v AS version, count(*) AS rows, count(DISTINCT day) AS days FROM r, (VALUES (2), (3)) AS t(v) WHERE v = 3 OR day <> {D6} GROUP BY v""")
def versions_left(spark: SparkSession, d: str) -> DataFrame:
    """Rows of the versions that seven days and two versions leave, each read back."""
    t = _versions(spark, d, "left")
    t.expire(T0 + timedelta(days=8, hours=12), keep=2)
    parts = [t.read(v).agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("day").alias("days")).select(F.lit(v).alias("version"), "rows", "days") for v in t.versions()[:2]]
    return parts[0].unionByName(parts[1])


TRIPS = StructType().add("l_orderkey", LongType()).add("l_linenumber", LongType()).add("rent_dt", TimestampNTZType()).add("return_dt", TimestampNTZType()).add("use_distance_m", DoubleType()).add("year", StringType())
BAD_TRIPS = StructType([*TRIPS.fields, StructType().add("quarantine_reason", StringType()).fields[0]])


@query(f"""SELECT year, side, count(*) AS n, sum(count(*)) OVER (PARTITION BY side) AS marked FROM (SELECT strftime(rent_dt, '%Y') AS year, CASE WHEN {REASONS} IS NULL THEN 'main' ELSE 'quarantine' END AS side FROM ({LINES}))
    WHERE year BETWEEN '1996' AND '1999' GROUP BY year, side""".replace("sum(count(*)) OVER (PARTITION BY side)", "CAST(sum(count(*)) OVER (PARTITION BY side) AS BIGINT)"))
def unit_written(spark: SparkSession, d: str) -> DataFrame:
    """Four years are cleansed into a table and its quarantine as one unit, twice; the marker tells both counts."""
    main, bad = Table(spark, _root(spark, "main"), TRIPS, "year"), Table(spark, _root(spark, "bad"), BAD_TRIPS, "year")
    store = ObjectStore(spark, _root(spark, "units"))
    rows = _violations(spark, d).withColumns({"year": F.date_format("rent_dt", "yyyy"), "l_linenumber": F.col("l_linenumber").cast("long"), "rent_dt": F.col("rent_dt").cast("timestamp_ntz"), "return_dt": F.col("return_dt").cast("timestamp_ntz")})
    unit, check = UnitWrite(store, "trips", [main, bad]), Check("trips").complete("l_orderkey").non_negative("use_distance_m")
    for _ in range(2):
        write_chunk(unit, main, bad, rows.where("year BETWEEN '1996' AND '1999'"), cleanse.trip_rules(), "1996", "1999", ("trips/1996.json", {"status": "COMPLETE"}), check, most=1.0)
    doc = store.get_json("trips/1996.json")
    count = lambda t, side, n: t.read().groupBy("year").agg(F.count(F.lit(1)).alias("n")).select("year", F.lit(side).alias("side"), "n", F.lit(n).cast("long").alias("marked"))
    return count(main, "main", doc["rows"]).unionByName(count(bad, "quarantine", doc["quarantined"]))


# quality states

def _measures() -> Measures:
    check = Check("events").complete("user_id").contained("event_type", ["view", "click", "purchase"]).non_negative("value").min_rows(10**9).uniqueness(["user_id", "event_type"], 0.5).uniqueness(["day", "user_id"])
    return Measures("day", check, ["value"])


def _stored_states(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """States of three runs, each of which takes the days that it has got; stored by day and read back."""
    m, e = _measures(), table(spark, d, "events").withColumn("day", F.to_date("ts"))
    states, keys = m.states(e.limit(0)), m.key_states(e.limit(0))
    kept = Table(spark, _root(spark, "states"), states.schema, "day"), Table(spark, _root(spark, "keys"), keys.schema, "day")
    for low, high in (("2024-01-01", "2024-01-10"), ("2024-01-11", "2024-01-20"), ("2024-01-18", "2099-12-31")):  # the last run repeats days
        days = e.where(F.col("day").between(F.lit(low).cast("date"), F.lit(high).cast("date")))
        kept[0].replace_present(m.states(days))
        kept[1].replace_present(m.key_states(days))
    return kept[0].read(), kept[1].read()


@query("""SELECT day, count(*) AS days, CAST(sum(rows) AS BIGINT) AS rows, round(sum(broken) / sum(rows), 8) AS unknown_share, round(sum(total) / sum(rows), 6) AS mean_value, min(low) AS low, max(high) AS high FROM (
    SELECT a.day, b.rows, b.broken, b.total, b.low, b.high FROM (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events) a JOIN (SELECT CAST(ts AS DATE) AS day, count(*) AS rows, count(*) FILTER (WHERE event_type NOT IN ('view', 'click', 'purchase')) AS broken,
    sum(value) AS total, min(value) AS low, max(value) AS high FROM events GROUP BY 1) b ON b.day <= a.day AND b.day > a.day - 30) GROUP BY day""".replace("count(*) AS days, ", ""), days=("day",))
def state_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Metrics over the 30 days that end with each day, from stored states alone."""
    w = _measures().windowed(_stored_states(spark, d)[0], 30)
    return w.select("day", "rows", F.round(F.col("c1") / F.col("rows"), 8).alias("unknown_share"), F.round(F.col("sum_value") / F.col("rows"), 6).alias("mean_value"), F.col("low_value").alias("low"), F.col("high_value").alias("high"))


@query("""WITH e AS (SELECT *, CAST(ts AS DATE) AS day FROM events), c AS (SELECT 'complete(user_id)' AS "constraint", count(*) FILTER (WHERE user_id IS NULL) AS violations, count(*) AS total FROM e
    UNION ALL SELECT 'contained(event_type)', count(*) FILTER (WHERE event_type NOT IN ('view', 'click', 'purchase')), count(*) FROM e UNION ALL SELECT 'non_negative(value)', count(*) FILTER (WHERE value < 0), count(*) FROM e
    UNION ALL SELECT 'min_rows(1000000000)', 1000000000 - count(*), count(*) FROM e)
    SELECT "constraint", CASE WHEN violations = 0 THEN 'PASS' ELSE 'FAIL' END AS status, violations, total FROM c
    UNION ALL SELECT 'uniqueness(user_id,event_type)', CASE WHEN count(*) FILTER (WHERE n = 1) >= 0.5 * sum(n) THEN 'PASS' ELSE 'FAIL' END, CAST(sum(n) - count(*) FILTER (WHERE n = 1) AS BIGINT), CAST(sum(n) AS BIGINT) FROM (SELECT count(*) AS n FROM e GROUP BY user_id, event_type)
    UNION ALL SELECT 'uniqueness(day,user_id)', CASE WHEN count(*) FILTER (WHERE n = 1) >= sum(n) THEN 'PASS' ELSE 'FAIL' END, CAST(sum(n) - count(*) FILTER (WHERE n = 1) AS BIGINT), CAST(sum(n) AS BIGINT) FROM (SELECT count(*) AS n FROM e GROUP BY day, user_id)""")
def checks_from_states(spark: SparkSession, d: str) -> DataFrame:
    """A whole check set of the table, answered from the states of its days."""
    return _measures().table(*_stored_states(spark, d))


# sizes and footers

@query("""WITH RECURSIVE o AS MATERIALIZED (SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) AS w, row_number() OVER (ORDER BY o_orderkey) - 1 AS i, CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) OVER (ORDER BY o_orderkey) AS BIGINT) AS e FROM orders),
    f AS MATERIALIZED (SELECT *, CAST(unnest(range(i, i + 100)) AS BIGINT) AS j FROM o),
    n AS MATERIALIZED (SELECT a.i, max(b.i) + 1 AS nxt FROM f a JOIN o b ON b.i = a.j AND (b.e <= a.e - a.w + 12000000 OR b.i = a.i) GROUP BY a.i HAVING max(b.i) + 1 < (SELECT count(*) FROM o)),
    s AS (SELECT CAST(0 AS BIGINT) AS i UNION ALL SELECT n.nxt FROM s JOIN n USING (i)),
    c AS (SELECT i, row_number() OVER (ORDER BY i) - 1 AS chunk, lead(i) OVER (ORDER BY i) AS stop FROM s)
    SELECT o_orderkey, chunk FROM o JOIN c ON o.i >= c.i AND (c.stop IS NULL OR o.i < c.stop)""")
def order_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Orders by key in chunks of at most 100 and of a total price of 12 million."""
    o = table(spark, d, "orders").select("o_orderkey", F.floor("o_totalprice").alias("w"))
    return size_chunks(o, ["o_orderkey"], "w", 100, 12_000_000).select("o_orderkey", "chunk")


@query("""SELECT count(*) AS rows, min(l_orderkey) AS l_orderkey_low, max(l_orderkey) AS l_orderkey_high, min(l_quantity) AS l_quantity_low, max(l_quantity) AS l_quantity_high, min(l_returnflag) AS l_returnflag_low, max(l_returnflag) AS l_returnflag_high,
    CAST(min(l_shipdate) AS VARCHAR) AS l_shipdate_low, CAST(max(l_shipdate) AS VARCHAR) AS l_shipdate_high, count(*) FILTER (WHERE l_shipdate IS NULL) AS nulls FROM lineitem""")
def footer_bounds(spark: SparkSession, d: str) -> DataFrame:
    """Rows and bounds of the lines from their files' footers."""
    lines, columns = table(spark, d, "lineitem"), ["l_orderkey", "l_quantity", "l_returnflag", "l_shipdate"]
    out = total_stats(footer_stats(spark, lines.inputFiles(), lines.schema, columns), columns)
    return out.withColumns({c: F.col(c).cast("string") for c in ("l_shipdate_low", "l_shipdate_high")}).withColumnRenamed("l_shipdate_nulls", "nulls").drop("l_orderkey_nulls", "l_quantity_nulls", "l_returnflag_nulls")


@query(f"SELECT CAST(day AS VARCHAR) AS partition, count(*) AS rows, min(kind) AS kind_low, max(kind) AS kind_high, min(total) AS total_low, max(total) AS total_high FROM ({ROWS}) WHERE day >= {D5} GROUP BY 1")
def partition_footers(spark: SparkSession, d: str) -> DataFrame:
    """Rows and bounds by day of a stored table, from day 5 on, without reading a row."""
    return partition_stats(_daily(spark, d, "footers"), ["kind", "total"], low="2024-01-05").drop("kind_nulls", "total_nulls")
