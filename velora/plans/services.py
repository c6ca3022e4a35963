"""Queries on streams, serving databases, workbooks and the growing dimension, all over data derived from the tables."""

from __future__ import annotations

import io
import sqlite3
import zipfile
from urllib.parse import urlparse
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructType, TimestampNTZType, TimestampType

from velora.operators.dimension import GrowingDimension
from velora.operators.quality import Check
from velora.plans.ingest import _root
from velora.plans.inputs import table
from velora.plans.registry import query
from velora.session import workers_find_package
from velora.sources.dbapi import DatabaseDays
from velora.sources.objects import ObjectStore
from velora.sources.tables import Table
from velora.sources.xlsx import read_xlsx
from velora.streaming.event_hours import EventHours, replace_days

EVENT = StructType().add("day", StringType()).add("event_id", LongType()).add("event_type", StringType()).add("ts", TimestampType())


@query("SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM events GROUP BY ALL")
def late_events_stream(spark: SparkSession, d: str) -> DataFrame:
    """A stream of hourly objects, stopped and started again: every tenth event of the days before the stop comes late."""
    root, store = _root(spark, "hours"), ObjectStore(spark, _root(spark, "stream"))
    t = Table(spark, _root(spark, "events"), EVENT, "day")
    e = table(spark, d, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"), F.date_format("ts", "HH").alias("hour"))
    late = (F.col("day") > "2024-01-20") | ((F.col("day") > "2024-01-17") & (F.col("event_id") % 10 == 0))
    spark.dataSource.register(EventHours)
    for wave in (e.where(~late), e.where(late)):
        wave.repartition("day").sortWithinPartitions("hour").write.mode("append").partitionBy("day", "hour").parquet(root)
        stream = spark.readStream.format("event_hours").schema(EVENT).option("root", root).load()
        q = stream.writeStream.foreachBatch(replace_days(t, store, "events")).option("checkpointLocation", f"{store.root}/checkpoint").start()
        try:
            q.processAllAvailable()
        finally:
            q.stop()
    return t.read().groupBy("day", "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))


@query("SELECT o_orderkey, o_orderpriority, CASE WHEN o_orderpriority <> '5-LOW' THEN round(o_totalprice, 2) END AS o_totalprice FROM orders")
def served_partitions(spark: SparkSession, d: str) -> DataFrame:
    """Orders in a database, each priority replaced in a transaction of its own and one of them twice, read by key ranges."""
    path = urlparse(_root(spark, "serving")).path + ".db"
    with sqlite3.connect(path) as c:
        c.execute("CREATE TABLE mart (o_orderkey BIGINT, o_orderpriority TEXT, o_totalprice DOUBLE)")
    spark.dataSource.register(DatabaseDays)
    how, schema = {"module": "sqlite3", "dsn": path, "table": "mart"}, "o_orderkey long, o_orderpriority string, o_totalprice double"
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", F.round("o_totalprice", 2).alias("o_totalprice"))
    names = [r[0] for r in rows.select("o_orderpriority").distinct().collect()]  # five by the schema
    blank = rows.withColumn("o_totalprice", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice")))
    for source, values in ((rows, names), (blank, ["5-LOW"])):
        for v in values:
            source.where(F.col("o_orderpriority") == v).coalesce(4).write.format("database_day").mode("append").options(**how, column="o_orderpriority", day=v).save()
    return spark.read.format("database_day").schema(schema).options(**how, key="o_orderkey", parts="8").load()


def workbook(header: list[str], rows: list[list]) -> bytes:
    """A workbook with shared texts and numbers, as a spreadsheet program writes it."""
    texts: dict[str, int] = {}

    def cell(v) -> str:
        if v is None:
            return "<c/>"
        if isinstance(v, (int, float)):
            return f"<c><v>{v}</v></c>"
        return f'<c t="s"><v>{texts.setdefault(v, len(texts))}</v></c>'

    body = "".join(f"<row>{''.join(map(cell, r))}</row>" for r in [header, *rows])
    out, ns = io.BytesIO(), 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    link = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns} xmlns:r="{link}"><sheets><sheet name="a" sheetId="1" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships><Relationship Id="r1" Type="{link}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {ns}><sheetData>{body}</sheetData></worksheet>")
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}>{''.join(f'<si><t>{escape(t)}</t></si>' for t in texts)}</sst>")
    return out.getvalue()


@query("SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CASE WHEN c_nationkey % 3 = 0 THEN '' ELSE CAST(c_nationkey AS VARCHAR) END AS c_nationkey FROM customer")
def xlsx_rows(spark: SparkSession, d: str) -> DataFrame:
    """Customers written as workbooks, one a task, and read back as texts."""
    root = _root(spark, "xlsx")
    ObjectStore(spark, root).put_text("_made", "")  # the folder
    workers_find_package(spark)

    def write(batches):
        from pyarrow import fs

        rows = [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]
        where, top = fs.FileSystem.from_uri(root)
        name = f"{top}/{rows[0][0] if rows else 'none'}.xlsx"
        with where.open_output_stream(name) as f:
            f.write(workbook(["c_custkey", "c_name", "c_nationkey"], rows))
        yield pa.RecordBatch.from_pydict({"name": [name]})

    c = table(spark, d, "customer").select("c_custkey", "c_name", F.when(F.col("c_nationkey") % 3 != 0, F.col("c_nationkey")).alias("c_nationkey"))
    c.repartition(4, "c_custkey").mapInArrow(write, "name string").collect()  # four names
    return read_xlsx(spark, f"{root}/*.xlsx", ["c_custkey", "c_name", "c_nationkey"])


BIKES = StructType().add("bike_id", LongType()).add("first_seen_at", TimestampNTZType()).add("snapshot_date", DateType())


@query("SELECT bike_id, first_seen_at, CAST(date_trunc('month', first_seen_at) AS DATE) AS snapshot_date FROM (SELECT l_partkey AS bike_id, min(l_shipdate) AS first_seen_at FROM lineitem GROUP BY 1)", days=("snapshot_date",))
def grown_dimension(spark: SparkSession, d: str) -> DataFrame:
    """Parts by the month of their first line, grown in three increments that overlap."""
    at = F.col("l_shipdate").cast("timestamp_ntz")
    seen = table(spark, d, "lineitem").select(F.col("l_partkey").alias("bike_id"), at.alias("first_seen_at"), F.trunc("l_shipdate", "month").alias("snapshot_date"))
    dim = GrowingDimension(Table(spark, _root(spark, "bikes"), BIKES, "snapshot_date"), "bike_id", Check("bikes").complete("bike_id").uniqueness(["bike_id"]), bits=1 << 18)
    for low, high in (("1990-01-01", "1995-03-01"), ("1995-02-01", "1996-01-01"), ("1995-12-01", "2099-01-01")):
        dim.grow(seen.where(F.col("first_seen_at").between(F.lit(low).cast("timestamp_ntz"), F.lit(high).cast("timestamp_ntz"))))
    return dim.table.read()
