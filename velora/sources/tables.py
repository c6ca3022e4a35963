"""Parquet tables with the write vocabulary of the fleet model.

A table is a folder of Hive partitions, with one writer at a time.  Replacing partitions writes all new files into a
staging folder of the same file system first and checks there that none stands outside the declared partitions; until
then a failed job leaves the table as it was.  Then a note of the swap is stored, old partitions are moved aside, new
ones are moved in, and the old ones and the note go.  A writer that died in between has left the note: the next one that
opens the table finishes the swap from it, so no day is ever lost.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from urllib.parse import quote, unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from velora.sources.objects import ObjectStore, shared_root


SPEC, SWAP = "_spec.json", "_swap.json"


#: Size of the files that compaction aims at.
FILE_BYTES = 128 << 20


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read back: readers see the same rows however often they read, and a lost
    executor costs a re-read."""
    path = f"{shared_root(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    where = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).deleteOnExit(where)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class IncompatibleSpec(ValueError):
    """A table has another partitioning or other column types."""


class Table:
    def __init__(self, spark: SparkSession, root: str, schema: StructType, partition: str | None = None):
        self.spark, self.root, self.schema, self.partition = spark, root.rstrip("/"), schema, partition
        self.store = ObjectStore(spark, self.root)
        self.recover()

    def create(self) -> bool:
        """Makes the table if it is not there yet, and notes its partitioning; whether it was made.

        A table that was made with another partitioning is refused, as its folders could not be read.
        """
        note = self.store.get_json(SPEC)
        if note is not None:
            self.check_spec()
            return False
        found = {k.split("=", 1)[0] for k in self.store.keys() if "=" in k}
        if found - {self.partition}:
            raise IncompatibleSpec(f"{self.root} is partitioned by {sorted(found)}, not by {self.partition}")
        self.store.put_json(SPEC, {"partition": self.partition, "columns": {f.name: f.dataType.simpleString() for f in self.schema}})
        return True

    def check_spec(self) -> None:
        """Refuses a table whose noted partitioning or column types differ; new columns are no difference."""
        note = self.store.get_json(SPEC) or {}
        if note and note["partition"] != self.partition:
            raise IncompatibleSpec(f"{self.root} is partitioned by {note['partition']}, not by {self.partition}")
        own = {f.name: f.dataType.simpleString() for f in self.schema}
        wrong = sorted(c for c, t in note.get("columns", {}).items() if own.get(c, t) != t)
        if wrong:
            raise IncompatibleSpec(f"{self.root} has other types of {wrong}")

    # reads

    def exists(self) -> bool:
        return any(k.startswith(f"{self.partition}=") or k.endswith(".parquet") for k in self.store.keys())

    def read(self, where: Column | None = None, columns: Sequence[str] | None = None) -> DataFrame:
        """Filter and columns reach the scan; an absent table reads as an empty one."""
        if not self.exists():
            df = self.spark.createDataFrame([], self.schema)
        else:
            df = self.spark.read.schema(self.schema).parquet(self.root)
        df = df if where is None else df.where(where)
        return df.select(*columns) if columns else df

    def partitions(self) -> list[str]:
        """Partition values from the folder names alone, without NULL and empty ones."""
        names = (k.split("=", 1)[1] for k in self.store.keys() if k.startswith(f"{self.partition}="))
        return sorted(unquote(n) for n in names if n not in ("", "__HIVE_DEFAULT_PARTITION__"))

    def max_partition(self) -> str | None:
        return max(self.partitions(), default=None)

    def min_partition(self) -> str | None:
        return min(self.partitions(), default=None)

    def latest_with(self, condition: Column) -> str | None:
        """The newest partition with a row that meets a condition, newest first."""
        for value in reversed(self.partitions()):
            if not self.read((F.col(self.partition).cast("string") == value) & condition).isEmpty():
                return value
        return None

    # writes

    def _files(self, df: DataFrame, folder: str) -> None:
        df = df.select(*self.schema.names)
        if self.partition is None:
            df.write.mode("overwrite").parquet(f"{self.root}/{folder}")
        else:
            # rows of a partition come together before the write, and a large one is split by its size: few files, no hot task
            df.hint("rebalance", self.partition).write.mode("overwrite").partitionBy(self.partition).parquet(f"{self.root}/{folder}")

    def _staged(self, df: DataFrame) -> tuple[str, list[str]]:
        """The staging folder with the rows, and the partition values in it; None for rows without one."""
        stage = f".staging-{uuid.uuid4().hex}"
        self._files(df, stage)
        names = (k.split("=", 1)[1] for k in self.store.keys(stage) if k.startswith(f"{self.partition}="))
        return stage, [None if n in ("", "__HIVE_DEFAULT_PARTITION__") else unquote(n) for n in names]

    def append(self, df: DataFrame) -> None:
        out = df.select(*self.schema.names).write.mode("append")
        (out.partitionBy(self.partition) if self.partition else out).parquet(self.root)

    def replace_partitions(self, df: DataFrame, values: Sequence[str]) -> None:
        """Exactly these partitions, at once; one without rows ends up empty.  Rows elsewhere are an error."""
        wanted = {str(v) for v in values}
        self._replace(df, lambda v: v in wanted, f"partitions {sorted(wanted)[:5]}")

    def replace_range(self, df: DataFrame, low: str, high: str) -> None:
        """All partitions of the closed range; days without rows are cleared.  Rows outside, or without key, are an error."""
        self._replace(df, lambda v: low <= v <= high, f"range {low} to {high}")

    def _replace(self, df: DataFrame, declared: Callable[[str], bool], name: str) -> None:
        self.apply(self.prepare(df, declared, name))

    def prepare(self, df: DataFrame, declared: Callable[[str], bool], name: str) -> dict:
        """Stages the rows that replace the declared partitions and returns the swap that ``apply`` makes; the table itself
        is not touched."""
        stage, values = self._staged(df)
        if not all(v is not None and declared(v) for v in values):
            self.store.delete(stage)
            raise ValueError(f"rows outside the declared {name}")
        old = [k for k in self.store.keys() if k.startswith(f"{self.partition}=") and declared(unquote(k.split("=", 1)[1]))]
        return self._note(stage, old)

    def apply(self, note: dict) -> None:
        """Makes a prepared swap; one that was made already is left alone."""
        if self.store.exists(note["stage"]):
            if self.store.get_json(SWAP) is None:
                self.store.put_json(SWAP, note)
            self.recover()

    def discard_stages(self) -> None:
        """Takes back what was staged and never swapped."""
        for k in self.store.keys():
            if k.startswith(".staging-"):
                self.store.delete(k)

    def replace_present(self, df: DataFrame) -> None:
        """Only the partitions that have rows, at once."""
        stage, _ = self._staged(df)
        new = {k for k in self.store.keys(stage) if "=" in k}
        self.apply(self._note(stage, [k for k in self.store.keys() if k in new]))

    def replace_all(self, df: DataFrame) -> None:
        stage, _ = self._staged(df)
        self.apply(self._note(stage, [k for k in self.store.keys() if not k.startswith((".", "_"))]))

    def _note(self, stage: str, old: Sequence[str]) -> dict:
        new = [k for k in self.store.keys(stage) if not k.startswith(("_", "."))]
        return {"stage": stage, "aside": f".old-{uuid.uuid4().hex}", "old": sorted(old), "new": new}

    def recover(self) -> bool:
        """Finishes a noted swap; whether there was one.  Every step may be repeated."""
        note = self.store.get_json(SWAP)
        if note is None:
            return False
        for k in note["old"]:
            # what stands at its place is the old partition as long as the new one waits or none is to come
            if not self.store.exists(f"{note['aside']}/{k}") and self.store.exists(k):
                self.store.rename(k, f"{note['aside']}/{k}")
        for k in note["new"]:
            if self.store.exists(f"{note['stage']}/{k}") and not self.store.rename(f"{note['stage']}/{k}", k):
                raise OSError(f"cannot move {k} into {self.root}")
        self.store.delete(note["stage"])
        self.store.delete(SWAP)  # before the old files: with the note gone nothing is moved aside again
        self.store.delete(note["aside"])
        return True

    def insert_new(self, df: DataFrame, key: str) -> int:
        """Only rows whose key is not there yet, of repeated keys the smallest row; how many were added.

        The rows are written first and then counted and appended from there, so both see the same ones.
        """
        rows = df.select(*self.schema.names)
        one = rows.groupBy(key).agg(F.min(F.struct(*(c for c in rows.columns if c != key))).alias("r")) if len(rows.columns) > 1 else rows.distinct()
        one = one.select(key, "r.*") if "r" in one.columns and len(rows.columns) > 1 else one
        added = written(one.join(self.read(columns=[key]), key, "left_anti").select(*self.schema.names), "insert")
        n = added.count()
        if n:
            self.append(added)
        return n

    def compact(self, file_bytes: int = FILE_BYTES) -> int:
        """Files of about one size again, partition by partition; the rows stay the same.  How many partitions were
        written: one whose files are as few as its size asks for is left alone, and a large one is split over tasks."""
        done = 0
        for v in self.partitions() if self.partition else [None]:
            folder = "" if v is None else f"{self.partition}={quote(v, safe=' -_.')}"
            found = self.store.files(folder)
            wanted = max(1, -(-sum(size for _, size, _ in found) // file_bytes))
            if len(found) <= wanted:
                continue
            part = self.read() if v is None else self.read(F.col(self.partition).cast("string") == v)
            part, stage = part.repartition(wanted) if wanted > 1 else part.coalesce(1), f".staging-{uuid.uuid4().hex}"
            out = part.write if v is None else part.write.partitionBy(self.partition)
            out.parquet(f"{self.root}/{stage}")
            old = [k for k in self.store.keys() if not k.startswith((".", "_"))] if v is None else [folder]
            self.apply(self._note(stage, old))
            done += 1
        return done

    def add_columns(self, fields: StructType) -> None:
        """Old files read as NULL in the new columns; the table's note knows them from now on."""
        self.check_spec()
        self.schema = StructType([*self.schema.fields, *(f for f in fields if f.name not in self.schema.names)])
        note = self.store.get_json(SPEC)
        if note is not None:
            self.store.put_json(SPEC, note | {"columns": note["columns"] | {f.name: f.dataType.simpleString() for f in self.schema if f.name not in note["columns"]}})


def digest(df: DataFrame) -> DataFrame:
    """``rows`` and ``sum`` of a table's content, whatever the order of its rows is; columns count by name."""
    columns = [F.col(c).cast("string") for c in sorted(df.columns)]
    return df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.xxhash64(*columns).cast("decimal(38,0)")), F.lit(0)).alias("sum"))


def sync_matches(mart: DataFrame, served: DataFrame) -> bool:
    """Whether the serving store has just the rows of a day that the mart has."""
    return digest(mart).first() == digest(served.select(*mart.columns)).first()


def write_jdbc_day(df: DataFrame, url: str, table: str, column: str, day: str, execute, properties: dict | None = None, batch: int = 500) -> None:
    """Replace one day in a database: rows go to a staging table in batches, ``execute`` then runs delete and insert in one transaction."""
    stage = f"{table}_staging"
    df.write.option("batchsize", batch).jdbc(url, stage, mode="overwrite", properties=properties or {})
    columns = ", ".join(f'"{c}"' for c in df.columns)  # quoted, as Spark creates them
    execute([f"DELETE FROM {table} WHERE \"{column}\" = '{day}'", f"INSERT INTO {table} ({columns}) SELECT {columns} FROM {stage}", f"DROP TABLE {stage}"])


def read_jdbc_day(spark: SparkSession, url: str, table: str, at: str, day: str, next_day: str, properties: dict | None = None) -> DataFrame:
    """The events of one day; the condition is part of the database's query."""
    query = f"(SELECT * FROM {table} WHERE \"{at}\" >= '{day}' AND \"{at}\" < '{next_day}') AS one_day"
    return spark.read.jdbc(url, query, properties=properties or {}).orderBy(at)


def sync_day(mart: DataFrame, url: str, table: str, column: str, day: str, next_day: str, execute, properties: dict | None = None) -> None:
    """Replaces a day of a mart in the serving database and reads it back: other rows than the mart's are an error."""
    write_jdbc_day(mart, url, table, column, day, execute, properties)
    served = read_jdbc_day(mart.sparkSession, url, table, column, day, next_day, properties)
    served = served.select(*(F.col(c).cast(mart.schema[c].dataType).alias(c) for c in mart.columns))
    if not sync_matches(mart, served):
        raise ValueError(f"{table} does not hold the mart's rows of {day}")
