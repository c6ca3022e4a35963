"""Queries on capacity, regions and served rows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velora.functions.values import equirectangular, event_uuid, half_even
from velora.operators import ranking
from velora.plans import inputs as i
from velora.plans.inputs import PLACES, sql, table
from velora.plans.registry import query

POOL = """pool AS (SELECT r.bike_id, risk_score, risk_grade, s.station_id, region, district FROM risk r JOIN location l USING (bike_id) JOIN stations s ON s.station_id = l.last_station_id WHERE risk_grade <> 'Normal' AND region IS NOT NULL)"""


def _pool(spark: SparkSession, d: str) -> DataFrame:
    at = i.location(spark, d).select("bike_id", F.col("last_station_id").alias("station_id"))
    return i.risk(spark, d).where("risk_grade <> 'Normal'").join(at, "bike_id").join(i.stations(spark, d).select("station_id", "region", "district"), "station_id").where("region IS NOT NULL")


@query(sql("", *PLACES) + f", {POOL} SELECT bike_id, region, risk_score, row_number() OVER (PARTITION BY region ORDER BY risk_score DESC, bike_id) <= greatest(0, floor(7.5 + 0.5)) AS in_capacity FROM pool")
def capacity_split(spark: SparkSession, d: str) -> DataFrame:
    return ranking.within_capacity(_pool(spark, d), "region", F.lit(7.5), "risk_score", "bike_id").select("bike_id", "region", "risk_score", "in_capacity")


@query(sql("", *PLACES) + f", {POOL} SELECT bike_id, row_number() OVER (ORDER BY risk_score DESC, bike_id) <= 25 AS in_capacity FROM pool")
def capacity_total(spark: SparkSession, d: str) -> DataFrame:
    return ranking.within_total(_pool(spark, d), 25.2, "risk_score", "bike_id").select("bike_id", "in_capacity")


@query(sql("", *PLACES) + f", {POOL} SELECT district, count(*) AS bikes, least(count(*), 3) AS in_capacity FROM pool GROUP BY 1")
def capacity_counts(spark: SparkSession, d: str) -> DataFrame:
    return _pool(spark, d).groupBy("district").agg(F.count(F.lit(1)).alias("bikes")).withColumn("in_capacity", F.least("bikes", F.lit(3)))


SPLIT = "even AS (SELECT n_name AS district, n_regionkey AS side, 120.0 / count(*) OVER () AS capacity FROM nation)"


def _even(spark: SparkSession, d: str) -> DataFrame:
    return ranking.even_split(table(spark, d, "nation").select(F.col("n_name").alias("district"), F.col("n_regionkey").alias("side")), 120.0)


@query(f"WITH {SPLIT} SELECT district, round(CASE WHEN side = 1 THEN capacity * (50.0 / (SELECT sum(capacity) FROM even WHERE side = 1)) ELSE capacity END, 6) AS capacity FROM even")
def capacity_rescale(spark: SparkSession, d: str) -> DataFrame:
    return ranking.rescaled(_even(spark, d), F.col("side") == 1, 50.0).select("district", F.round("capacity", 6).alias("capacity"))


@query(f"WITH {SPLIT} SELECT side, round(sum(capacity), 6) AS capacity FROM even GROUP BY 1")
def capacity_parents(spark: SparkSession, d: str) -> DataFrame:
    return _even(spark, d).groupBy("side").agg(F.round(F.sum("capacity"), 6).alias("capacity"))


@query(sql("SELECT region, CAST(sum(bike_cnt) AS BIGINT) AS bikes, count(*) AS stations FROM inventory JOIN (SELECT station_id, region FROM stations) USING (station_id) WHERE region IN ('ASIA', 'EUROPE') GROUP BY 1", *PLACES))
def region_totals(spark: SparkSession, d: str) -> DataFrame:
    at = i.inventory(spark, d).join(i.stations(spark, d).select("station_id", "region"), "station_id").where(F.col("region").isin("ASIA", "EUROPE"))
    return at.groupBy("region").agg(F.sum("bike_cnt").alias("bikes"), F.count(F.lit(1)).alias("stations"))


@query(sql("", *PLACES) + f", {POOL} SELECT station_id, string_agg(bike_id, ',' ORDER BY bike_id) AS bikes FROM pool GROUP BY 1")
def bikes_by_station(spark: SparkSession, d: str) -> DataFrame:
    return _pool(spark, d).groupBy("station_id").agg(F.array_join(F.array_sort(F.collect_list("bike_id")), ",").alias("bikes"))


@query("SELECT n_name AS district, min(r_name) AS side FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1")
def district_lookup(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).groupBy(F.col("n_name").alias("district")).agg(F.min("r_name").alias("side"))


@query(sql("SELECT station_id, round(radians(longitude - 127.0) * cos(radians(37.5)) * 6371000.0, 3) AS x, round(radians(latitude - 37.5) * 6371000.0, 3) AS y FROM stations", "stations"))
def map_projection(spark: SparkSession, d: str) -> DataFrame:
    x, y = equirectangular(F.col("latitude"), F.col("longitude"), 37.5, 127.0)
    return i.stations(spark, d).select("station_id", F.round(x, 3).alias("x"), F.round(y, 3).alias("y"))


@query("SELECT p_partkey, (k // 10 + CASE WHEN k % 10 > 5 OR (k % 10 = 5 AND (k // 10) % 2 = 1) THEN 1 ELSE 0 END) / 1000.0 AS score FROM (SELECT p_partkey, p_partkey * 5 AS k FROM part)")
def half_even_scores(spark: SparkSession, d: str) -> DataFrame:
    exact = (F.col("p_partkey") * 5).cast("decimal(18,4)") / 10000
    return table(spark, d, "part").select("p_partkey", half_even(exact, 3).cast("double").alias("score"))


NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "velora.fact_worker_event")


@query("SELECT event_id, name, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab', 1 + CAST(('0x' || substr(h, 17, 1)) AS INTEGER) % 4, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS id FROM "
    f"(SELECT *, sha1(unhex('{NAMESPACE.hex}') || encode(name)) AS h FROM (SELECT event_id, 'B' || user_id || ':' || event_type || ':' || strftime(ts, '%Y-%m-%d') AS name FROM events))")
def event_ids(spark: SparkSession, d: str) -> DataFrame:
    """Version 5 ids from built-in functions; tested against the standard library too."""
    name = F.concat_ws(":", F.concat(F.lit("B"), "user_id"), "event_type", F.date_format("ts", "yyyy-MM-dd"))
    return table(spark, d, "events").select("event_id", name.alias("name"), event_uuid(name, NAMESPACE).alias("id"))


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey IN (1, 5, 9, 999999999)")
def confirmed_rows(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").where(F.col("o_orderkey").isin(1, 5, 9, 999999999)).select("o_orderkey", "o_custkey", "o_totalprice")


@query("SELECT c_custkey, c_name, o_orderkey, o_totalprice FROM customer JOIN (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) <= 2) ON o_custkey = c_custkey")
def newest_two(spark: SparkSession, d: str) -> DataFrame:
    from velora.operators.latest import first_rows

    o = first_rows(table(spark, d, "orders"), ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")], 2)
    return table(spark, d, "customer").join(o, F.col("o_custkey") == F.col("c_custkey")).select("c_custkey", "c_name", "o_orderkey", "o_totalprice")
