"""A task of the database writer holds no lock while it waits for its rows, and rows travel in batches."""

import sqlite3
from datetime import date

import pytest
from pyspark.sql.datasource import DataSourceArrowWriter
from pyspark.sql.types import DoubleType, LongType, StringType, StructType

from velora.sources import dbapi

MART = StructType().add("k", LongType()).add("day", StringType()).add("v", DoubleType())


@pytest.fixture
def how(tmp_path):
    dsn = str(tmp_path / "mart.db")
    with sqlite3.connect(dsn) as c:
        c.execute("CREATE TABLE mart (k BIGINT, day TEXT, v DOUBLE)")
    return {"module": "sqlite3", "dsn": dsn, "table": "mart", "column": "day", "day": "a"}


def test_no_lock_between_blocks(how, monkeypatch):
    """Another connection writes while a task is between two blocks of its rows."""
    monkeypatch.setattr(dbapi, "BLOCK", 2)
    w = dbapi.DayWriter(MART, how)

    def rows():
        for i in range(5):
            with sqlite3.connect(how["dsn"], timeout=0.2) as c:
                c.execute("INSERT INTO mart VALUES (?, 'other', NULL)", (-i,))
            yield i, "a", i / 2

    message = w.write(rows())
    assert message.rows == 5
    w.commit([message, w.write(iter([])), None])
    with sqlite3.connect(how["dsn"]) as c:
        assert c.execute("SELECT k, v FROM mart WHERE day = 'a' ORDER BY k").fetchall() == [(i, i / 2) for i in range(5)]
        assert c.execute("SELECT count(*) FROM mart WHERE day = 'other'").fetchone() == (5,)


def test_batches_with_nulls_and_dates(spark, how):
    spark.dataSource.register(dbapi.DatabaseDays)
    assert isinstance(dbapi.DatabaseDays(how).writer(MART, False), DataSourceArrowWriter)
    with sqlite3.connect(how["dsn"]) as c:  # what that writer made
        c.execute(f"DROP TABLE {c.execute('SELECT name FROM sqlite_master WHERE name LIKE ?', ('mart_stage%',)).fetchone()[0]}")
    df = spark.createDataFrame([(1, "a", None), (2, "a", 0.5), (None, "a", 1.0)], MART)
    df.repartition(3).write.format("database_day").mode("append").options(**how).save()
    read = lambda schema: spark.read.format("database_day").schema(schema).options(**how, key="k", parts="2").load()
    assert sorted(map(tuple, read(MART).collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)
    with sqlite3.connect(how["dsn"]) as c:
        c.execute("UPDATE mart SET day = '2024-02-03'")
    assert {r.day for r in read("k long, day date, v double").collect()} == {date(2024, 2, 3)}
