"""Late events as a stream, and serving databases whose days change at once or not at all."""

import sqlite3
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from velora.sources.dbapi import DatabaseDays
from velora.sources.objects import ObjectStore
from velora.sources.serving import ServingDatabase
from velora.sources.tables import Table
from velora.streaming.event_hours import EventHours, EventHoursReader, replace_days

EVENTS = StructType().add("day", "string").add("event_id", "long").add("at", "timestamp")
_N = iter(range(1000))


def add(spark, root, *rows):
    """An object for each hour of the rows (day, hour, id)."""
    df = spark.createDataFrame([(f"2026-01-{d:02}", i, datetime(2026, 1, d, h), f"{h:02}") for d, h, i in rows], "day string, event_id long, at timestamp, hour string")
    for r in df.select("day", "hour").distinct().collect():
        part = df.where((F.col("day") == r.day) & (F.col("hour") == r.hour)).drop("hour")
        part.coalesce(1).write.mode("append").parquet(f"{root}/day={r.day}/hour={r.hour}")


def start(spark, root, table, store, checkpoint, write=None):
    spark.dataSource.register(EventHours)
    stream = spark.readStream.format("event_hours").schema(EVENTS).option("root", root).load()
    return stream.writeStream.foreachBatch(write or replace_days(table, store, "events")).option("checkpointLocation", checkpoint).start()


def ids(table):
    return sorted(r.event_id for r in table.read().collect())


def test_late_events_and_a_restart(spark, tmp_path):
    root, table, store = f"file://{tmp_path}/in", Table(spark, f"file://{tmp_path}/t", EVENTS, "day"), ObjectStore(spark, f"file://{tmp_path}/notes")
    add(spark, root, (1, 0, 1), (1, 5, 2), (2, 3, 3), (3, 9, 4))
    q = start(spark, root, table, store, f"file://{tmp_path}/c")
    q.processAllAvailable()
    assert ids(table) == [1, 2, 3, 4]
    add(spark, root, (2, 3, 5), (1, 7, 6))  # late, into an hour that is there and into a new one; the newest hour stays
    q.processAllAvailable()
    assert ids(table) == [1, 2, 3, 4, 5, 6]
    q.stop()
    add(spark, root, (4, 1, 7), (2, 4, 8), (1, 1, 9))  # while it is down
    q = start(spark, root, table, store, f"file://{tmp_path}/c")
    q.processAllAvailable()
    assert ids(table) == list(range(1, 10))
    add(spark, root, (6, 1, 10))
    q.processAllAvailable()
    add(spark, root, (3, 1, 11), (4, 1, 12))  # day 3 is behind the look-back by now
    q.processAllAvailable()
    q.stop()
    assert ids(table) == [*range(1, 11), 12]
    done = [store.get_json(f"stream/events/{k}") for k in store.keys("stream/events")]
    assert [d["batch"] for d in done] == list(range(len(done))) and sorted(done[-1]["days"]) == ["2026-01-04", "2026-01-06"]


def test_a_batch_that_is_cut_off_runs_again(spark, tmp_path):
    root, table, store = f"file://{tmp_path}/in", Table(spark, f"file://{tmp_path}/t", EVENTS, "day"), ObjectStore(spark, f"file://{tmp_path}/notes")
    add(spark, root, (1, 0, 1), (2, 3, 2))
    whole, left_out = replace_days(table, store, "events"), []

    def cut(batch, number):
        whole(batch, number)
        store.delete(f"stream/events/{number:09}.json")  # as if it had stopped between the swap and its note
        raise RuntimeError("stopped")

    q = start(spark, root, table, store, f"file://{tmp_path}/c", cut)
    with pytest.raises(Exception, match="stopped"):
        q.processAllAvailable()
    add(spark, root, (1, 4, 3))
    q = start(spark, root, table, store, f"file://{tmp_path}/c")
    q.processAllAvailable()
    q.stop()
    assert ids(table) == [1, 2, 3]
    whole(table.read().limit(0).sparkSession.createDataFrame([("2026-01-01", 99, None)], EVENTS), 0)  # its number is noted
    assert ids(table) == [1, 2, 3] and not left_out


def test_offsets(tmp_path):
    r = EventHoursReader(EVENTS, {"root": f"file://{tmp_path}/none"})
    assert r.latestOffset() == r.initialOffset() and r.partitions(r.initialOffset(), r.latestOffset()) == []


# databases

MART = StructType().add("k", "integer").add("snapshot_date", "date").add("v", "double")
D1, D2 = date(2026, 1, 1), date(2026, 1, 2)


def failing(df):
    return df.withColumn("v", F.when(F.col("k") == 5, F.raise_error(F.lit("a task fails")).cast("double")).otherwise(F.col("v")))


def test_a_day_in_derby(spark):
    db = ServingDatabase(spark, "jdbc:derby:memory:serving;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"})
    spark.createDataFrame([(1, D1, 1.0), (2, D2, 2.0)], MART).write.jdbc(db.url, "mart", properties=db.properties)
    mart = spark.createDataFrame([(i, D2, i / 2) for i in range(3, 9)], MART).repartition(4)
    content = lambda: sorted((r.k, r.v) for r in db.read_range("mart", "k", parts=3).collect())
    with pytest.raises(Exception, match="a task fails"):
        db.replace_day(failing(mart), "mart", "snapshot_date", D2)
    assert content() == [(1, 1.0), (2, 2.0)]
    for _ in range(2):
        assert db.sync_day(mart, "mart", "snapshot_date", D2, date(2026, 1, 3)) == 6
        assert content() == [(1, 1.0), *((i, i / 2) for i in range(3, 9))]
    with pytest.raises(Exception, match="."):
        db.transaction([('DELETE FROM mart WHERE "k" > ?', [0]), ("no statement", [])])
    assert len(content()) == 7  # the first statement was taken back
    assert [r.k for r in db.read_range("mart", "k", 4, 6).orderBy("k").collect()] == [4, 5]
    assert db.read_range("mart", "k", 100).count() == 0 and db.read_range("mart", "k", parts=3).rdd.getNumPartitions() == 3


def test_a_day_by_a_python_driver(spark, tmp_path):
    """Commit and abort of the writer, and that only reported attempts count."""
    dsn = str(tmp_path / "serving.db")
    with sqlite3.connect(dsn) as c:
        c.execute("CREATE TABLE mart (k BIGINT, snapshot_date DATE, v DOUBLE)")
        c.executemany("INSERT INTO mart VALUES (?, ?, ?)", [(1, "2026-01-01", 1.0), (2, "2026-01-02", 2.0), (None, "2026-01-01", None)])
    spark.dataSource.register(DatabaseDays)
    how = {"module": "sqlite3", "dsn": dsn, "table": "mart"}
    read = lambda parts=3: spark.read.format("database_day").schema(MART).options(**how, key="k", parts=str(parts)).load()
    content = lambda: sorted(((r.k, r.snapshot_date, r.v) for r in read().collect()), key=repr)
    old = content()
    assert old == sorted([(1, D1, 1.0), (2, D2, 2.0), (None, D1, None)], key=repr)
    mart = spark.createDataFrame([(i, D2, i / 2) for i in range(3, 13)], MART).repartition(4)
    save = lambda df: df.write.format("database_day").mode("append").options(**how, column="snapshot_date", day="2026-01-02").save()
    with pytest.raises(Exception, match="a task fails"):
        save(failing(mart))
    assert content() == old
    for _ in range(2):
        save(mart)
        assert content() == sorted([(1, D1, 1.0), (None, D1, None), *((i, D2, i / 2) for i in range(3, 13))], key=repr)
    assert read(4).rdd.getNumPartitions() == 4
    with sqlite3.connect(dsn) as c:
        assert [r[0] for r in c.execute("SELECT name FROM sqlite_master")] == ["mart"]  # no staging table is left
    from velora.sources.dbapi import DayWriter

    w = DayWriter(MART, how | {"column": "snapshot_date", "day": "2026-01-02"})
    w.write(iter([(50, D2, 0.0)]))  # an attempt that is never reported
    w.commit([w.write(iter([(51, D2, 0.5)])), None])
    assert [r for r in content() if r[0] and r[0] >= 50] == [(51, D2, 0.5)]
