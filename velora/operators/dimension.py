"""A dimension that grows by what is seen for the first time.

Each increment adds the keys that the dimension lacks, in the partition of their first day.  Beside every partition stands
a Bloom filter of its keys (bitmaps that Spark's own aggregates build and merge).  A key whose bit is not set is new for
certain and never meets the dimension; only the others go through the exact anti join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from velora.operators.quality import Check
from velora.sources.tables import Table, written

#: Bits of one bitmap row of Spark's bitmap functions.
ROW_BITS = 32768


class GrowingDimension:
    """``table`` holds ``key`` and the first day as its partition; the filters stand in a table beside it.

    ``bits`` is the filter's size for all partitions together, some 16 for each key that is expected; more keys than that
    make more of them take the exact way and change nothing.
    """

    def __init__(self, table: Table, key: str, check: Check | None = None, bits: int = 1 << 25):
        self.table, self.key, self.check, self.buckets = table, key, check, max(1, bits // ROW_BITS)
        schema = StructType([StructField("bucket", LongType()), StructField("bits", BinaryType()), table.schema[table.partition]])
        self.filters = Table(table.spark, f"{table.root}.filters", schema, table.partition)

    def _place(self, key: Column) -> tuple[Column, Column]:
        h = F.pmod(F.xxhash64(key.cast("string")), F.lit(self.buckets * ROW_BITS))
        return F.bitmap_bucket_number(h), F.bitmap_bit_position(h)

    def _filters_of(self, rows: DataFrame) -> DataFrame:
        bucket, at = self._place(F.col(self.key))
        return rows.groupBy(self.table.partition, bucket.alias("bucket")).agg(F.bitmap_construct_agg(at).alias("bits"))

    def maybe_known(self, keys: DataFrame) -> DataFrame:
        """``keys`` with ``__maybe``: false only for keys that the dimension lacks."""
        bucket, at = self._place(F.col(self.key))
        whole = self.filters.read().groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("__bits")).withColumnRenamed("bucket", "__bucket")
        placed = keys.withColumns({"__bucket": bucket, "__at": at}).join(whole, "__bucket", "left")
        byte = F.conv(F.hex(F.substring("__bits", (F.col("__at") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
        is_set = F.coalesce(F.expr("shiftright(__byte, CAST(__at % 8 AS INT)) & 1") == 1, F.lit(False))
        return placed.withColumn("__byte", byte).withColumn("__maybe", is_set).select(*keys.columns, "__maybe")

    def grow(self, seen: DataFrame) -> int:
        """Adds the keys of ``seen`` (all columns of the table; the first row by partition, then by the others, of a key)
        that are not there yet; how many.  Rows without key or first day are left out.

        Old rows of the touched partitions stay.  Filters are written before the rows, so that a run that stops between
        the two leaves bits too many and none too few; the next run adds the rows.  The whole table is checked after the
        write, which a failed check does not take back.
        """
        part, others = self.table.partition, [c for c in self.table.schema.names if c != self.key]
        order = F.struct(part, *(c for c in others if c != part))
        first = seen.where(F.col(self.key).isNotNull() & F.col(part).isNotNull()).groupBy(self.key).agg(F.min(order).alias("r")).select(self.key, "r.*")
        judged = written(self.maybe_known(first.select(*self.table.schema.names)), "judged")
        unsure = judged.where("__maybe").join(self.table.read(columns=[self.key]), self.key, "left_anti")
        new = written(judged.where("NOT __maybe").unionByName(unsure.select(*judged.columns)).drop("__maybe"), "new")
        days = {r[0]: r.n for r in new.groupBy(F.col(part).cast("string")).agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a day
        if days:
            own = self.filters.read(F.col(part).cast("string").isin(list(days))).unionByName(self._filters_of(new).select("bucket", "bits", part))
            self.filters.replace_partitions(own.groupBy(part, "bucket").agg(F.bitmap_or_agg("bits").alias("bits")), list(days))
            kept = self.table.read(F.col(part).cast("string").isin(list(days)))
            self.table.replace_partitions(kept.unionByName(new.select(*kept.columns)), list(days))
        if self.check is not None:
            self.check.require(self.table.read())
        return sum(days.values())
