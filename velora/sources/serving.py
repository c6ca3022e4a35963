"""Serving databases over JDBC: a day is replaced in one transaction, and large tables are read by ranges of their key."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velora.sources.tables import sync_matches


class ServingDatabase:
    """``properties`` are those of Spark's JDBC source (user, password, driver)."""

    def __init__(self, spark: SparkSession, url: str, properties: dict[str, str] | None = None):
        self.spark, self.url, self.properties = spark, url, dict(properties or {})

    def transaction(self, statements: Sequence[tuple[str, Sequence]]) -> list[int]:
        """Runs statements with their values all together or not at all; the rows that each has changed."""
        jvm = self.spark._jvm
        own = jvm.java.util.Properties()
        for k, v in self.properties.items():
            own.setProperty(k, v)
        c = jvm.java.sql.DriverManager.getConnection(self.url, own)
        try:
            c.setAutoCommit(False)
            out = []
            for text, values in statements:
                s = c.prepareStatement(text)
                for i, v in enumerate(values, 1):
                    s.setObject(i, self._java(v))
                s.execute()
                out.append(s.getUpdateCount())
                s.close()
            c.commit()
            return out
        except BaseException:
            c.rollback()
            raise
        finally:
            c.close()

    def _java(self, v):
        sql = self.spark._jvm.java.sql
        if isinstance(v, datetime):
            return sql.Timestamp.valueOf(v.isoformat(" "))
        return sql.Date.valueOf(v.isoformat()) if isinstance(v, date) else v

    def replace_day(self, df: DataFrame, table: str, column: str, day: date | str, batch: int = 500) -> int:
        """The rows of a day, replaced at once; how many there are now.

        Tasks write to a staging table of this run, each in its own transaction; what readers see changes in the one
        transaction that follows.  A task that fails leaves the old day, and the staging table goes in any case.
        """
        stage = f"{table}_stage_{uuid.uuid4().hex[:12]}"
        columns = ", ".join(f'"{c}"' for c in df.columns)  # quoted, as Spark creates them
        try:
            df.write.option("batchsize", batch).jdbc(self.url, stage, mode="overwrite", properties=self.properties)
            changed = self.transaction([(f'DELETE FROM {table} WHERE "{column}" = ?', [day]), (f"INSERT INTO {table} ({columns}) SELECT {columns} FROM {stage}", [])])
        finally:
            self._drop(stage)
        return changed[1]

    def _drop(self, stage: str) -> None:
        try:
            self.transaction([(f"DROP TABLE {stage}", [])])
        except Exception:  # noqa: S110 - it was never made: the failure that is on its way tells why
            pass

    def read_range(self, table: str, key: str, low=None, high=None, parts: int = 8) -> DataFrame:
        """Rows with low <= key < high, read by ``parts`` connections that share the range of the keys found."""
        quoted = lambda v: f"'{v}'" if isinstance(v, (str, date)) else str(v)
        bounds = ([f'"{key}" >= {quoted(low)}'] if low is not None else []) + ([f'"{key}" < {quoted(high)}'] if high is not None else [])
        chosen = f"(SELECT * FROM {table}{' WHERE ' + ' AND '.join(bounds) if bounds else ''}) AS chosen"
        read = self.spark.read.format("jdbc").options(url=self.url, **self.properties)
        found = read.option("dbtable", f'(SELECT MIN("{key}") AS "low", MAX("{key}") AS "high", COUNT(*) AS "n" FROM {chosen}) AS bounds').load().first()
        read = self.spark.read.format("jdbc").options(url=self.url, dbtable=chosen, **self.properties)
        if found.n > 1 and parts > 1 and found.low is not None:
            read = read.options(partitionColumn=key, lowerBound=str(found.low), upperBound=str(found.high), numPartitions=str(min(parts, found.n)))
        return read.load()

    def sync_day(self, mart: DataFrame, table: str, column: str, day: date | str, next_day: date | str) -> int:
        """Replaces a day of a mart and reads it back: other rows than the mart's are an error."""
        n = self.replace_day(mart, table, column, day)
        served = self.read_range(table, column, day, next_day, parts=1)
        served = served.select(*(F.col(c).cast(mart.schema[c].dataType).alias(c) for c in mart.columns))
        if not sync_matches(mart, served):
            raise ValueError(f"{table} does not hold the mart's rows of {day}")
        return n
