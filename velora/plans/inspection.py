"""Queries that look at tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velora.operators import inspection
from velora.plans.inputs import PLACES, resolved, sql, table, trips
from velora.plans.registry import query


@query(sql("SELECT concat_ws(',', CASE WHEN dist_m IS NULL THEN 'dist_m' END, CASE WHEN dur_min IS NULL THEN 'dur_min' END) AS missing, count(*) AS n FROM trips GROUP BY 1", "trips"))
def null_groups(spark: SparkSession, d: str) -> DataFrame:
    return inspection.null_groups(trips(spark, d), ["dist_m", "dur_min"])


@query(sql("SELECT CASE WHEN effective_station_id IS NULL THEN 'effective_station_id' ELSE '' END AS missing, count(*) AS n FROM resolved GROUP BY 1", *PLACES))
def in_transit_counts(spark: SparkSession, d: str) -> DataFrame:
    """Vehicles without a place, and those with one."""
    return inspection.null_groups(resolved(spark, d), ["effective_station_id"])


@query("""WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 4 > 0 THEN o_orderpriority END AS priority, CAST(o_orderdate AS DATE) AS order_day FROM orders)
    SELECT 'o_orderkey' AS "column", count(*) AS rows, count(*) - count(o_orderkey) AS nulls, CAST(min(o_orderkey) AS VARCHAR) AS smallest, CAST(max(o_orderkey) AS VARCHAR) AS largest, count(DISTINCT o_orderkey) AS distinct_values FROM o
    UNION ALL SELECT 'priority', count(*), count(*) - count(priority), min(priority), max(priority), count(DISTINCT priority) FROM o
    UNION ALL SELECT 'order_day', count(*), count(*) - count(order_day), CAST(min(order_day) AS VARCHAR), CAST(max(order_day) AS VARCHAR), count(DISTINCT order_day) FROM o""")
def column_report(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    o = o.select("o_orderkey", F.when(F.col("o_orderkey") % 4 > 0, F.col("o_orderpriority")).alias("priority"), F.to_date("o_orderdate").alias("order_day"))
    return inspection.column_report(o, distinct=o.columns)


@query("""SELECT 'orders' AS "table", 'OK' AS status, count(*) AS rows, 'order_date' AS "column", CAST(min(CAST(o_orderdate AS DATE)) AS VARCHAR) AS first, CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR) AS last FROM orders
    UNION ALL SELECT 'open_orders', 'EMPTY', 0, 'order_date', NULL, NULL
    UNION ALL SELECT 'customer', 'OK', count(*), NULL, NULL, NULL FROM customer
    UNION ALL SELECT 'lost', 'ERROR', 0, NULL, NULL, NULL""")
def catalog_report(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("order_date"))
    tables = {"orders": lambda: o, "open_orders": lambda: o.where("o_orderkey < 0"), "customer": lambda: table(spark, d, "customer"), "lost": lambda: table(spark, d, "lost")}
    return inspection.catalog_report(spark, tables).drop("error").withColumn("rows", F.coalesce("rows", F.lit(0)))
