"""Counts and bounds from the footers of Parquet files; no row group is read.

The files' names are dealt over tasks, each of which reads footers alone.  A file whose footer does not tell a bound (an
old timestamp type, statistics that were not written, a file system that only Spark's readers reach) is scanned by Spark,
so the answer is whole in any case.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StringType, StructField, StructType

from velora.session import workers_find_package
from velora.sources.tables import Table


def _footer(path: str, columns: Sequence[str]) -> dict | None:
    """A file's rows and its columns' lowest and highest value and NULLs; None if the footer does not tell all of them."""
    import pyarrow.parquet as pq
    from pyarrow import fs

    try:
        where, name = fs.FileSystem.from_uri(path)
        with where.open_input_file(name) as f:
            meta = pq.read_metadata(f)
    except (OSError, ValueError, NotImplementedError):
        return None
    place = {meta.schema.column(i).path: i for i in range(meta.num_columns)}
    out: dict = {"path": path, "rows": meta.num_rows}
    for c in columns:
        low = high = None
        nulls = 0
        for g in range(meta.num_row_groups):
            group = meta.row_group(g)
            if c not in place:  # a column that was added later: NULL in this file
                nulls += group.num_rows
                continue
            own = group.column(place[c]).statistics
            if own is None or not own.has_null_count or not (own.has_min_max or own.null_count == group.num_rows):
                return None
            nulls += own.null_count
            if own.has_min_max and (own.min != own.min or own.max != own.max):  # some writers let NaN into the bounds
                return None
            if own.has_min_max:
                low = own.min if low is None else min(low, own.min)
                high = own.max if high is None else max(high, own.max)
        out |= {f"{c}_low": low, f"{c}_high": high, f"{c}_nulls": nulls}
    return out


def footer_stats(spark: SparkSession, files: Sequence[str], schema: StructType, columns: Sequence[str], per_task: int = 64) -> DataFrame:
    """``path, rows`` and for each column ``<c>_low, <c>_high, <c>_nulls``, one row a file.

    Bounds of floating numbers leave NaN out, as footers do.  Binary columns have no order here and are refused.
    """
    workers_find_package(spark)
    wrong = [c for c in columns if schema[c].dataType.typeName() in ("binary", "struct", "array", "map")]
    if wrong:
        raise ValueError(f"no bounds of {wrong}")
    bounds = [f for c in columns for f in (StructField(f"{c}_low", schema[c].dataType), StructField(f"{c}_high", schema[c].dataType), StructField(f"{c}_nulls", LongType()))]
    whole = StructType([StructField("path", StringType()), StructField("rows", LongType()), *bounds])
    arrow = to_arrow_schema(whole)

    def task(batches):
        for b in batches:
            found = []
            for p in b.column("path").to_pylist():
                one = _footer(p, columns)
                found.append({"path": p} if one is None else one)
            yield pa.RecordBatch.from_pylist([{f.name: r.get(f.name) for f in arrow} for r in found], schema=arrow)

    names = spark.createDataFrame([(f,) for f in files], "path string").repartition(max(1, -(-len(files) // per_task)))
    read = names.mapInArrow(task, whole).cache()
    silent = [r.path for r in read.where("rows IS NULL").select("path").collect()]  # names of files, as the driver listed them
    if not silent:
        return read
    tell = [x for c in columns for x in (F.min(_number(c, schema)).alias(f"{c}_low"), F.max(_number(c, schema)).alias(f"{c}_high"), F.count(F.when(F.col(c).isNull(), 1)).alias(f"{c}_nulls"))]
    scanned = spark.read.schema(schema).parquet(*silent).groupBy(F.input_file_name().alias("path")).agg(F.count(F.lit(1)).alias("rows"), *tell)
    return read.where("rows IS NOT NULL").unionByName(scanned)


def _number(c: str, schema: StructType):
    return F.when(~F.isnan(c), F.col(c)) if schema[c].dataType.typeName() in ("double", "float") else F.col(c)


def total_stats(stats: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """The files' statistics merged, for the table or by columns that tell files apart."""
    own = [x for c in columns for x in (F.min(f"{c}_low").alias(f"{c}_low"), F.max(f"{c}_high").alias(f"{c}_high"), F.coalesce(F.sum(f"{c}_nulls"), F.lit(0)).alias(f"{c}_nulls"))]
    return stats.groupBy(*by).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), *own)


def partition_stats(table: Table, columns: Sequence[str] = (), low: str | None = None, high: str | None = None) -> DataFrame:
    """Rows and bounds of each partition of a table from its footers: ``partition`` as text, ``rows`` and the bounds.

    ``low`` and ``high`` close the range of partitions whose files are looked at.
    """
    name, kind = table.partition, F.col(table.partition).cast("string")
    where = None if low is None and high is None else (F.lit(True) if low is None else kind >= low) & (F.lit(True) if high is None else kind <= high)
    files = table.read(where).inputFiles() if table.exists() else []
    schema = StructType([f for f in table.schema if f.name != name])
    stats = footer_stats(table.spark, files, schema, columns)
    value = F.url_decode(F.regexp_extract("path", rf"/{name}=([^/]*)/", 1))
    out = total_stats(stats.withColumn("partition", value), columns, ["partition"])
    return out if where is None else out.where(F.lit(True) if low is None else F.col("partition") >= low).where(F.lit(True) if high is None else F.col("partition") <= high)
