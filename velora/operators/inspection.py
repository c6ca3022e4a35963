"""A look at tables: what is missing, how far columns reach, and which tables can be read and hold rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

REPORT = "`table` string, status string, rows long, column string, first string, last string, error string"


def _quoted(column: str) -> str:
    return f"`{column.replace('`', '``')}`"


def null_groups(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows by the set of columns that are NULL in them: ``missing`` (names in the given order, joined by commas), ``n``.

    Tasks count their rows first, so at most one row a set and task is shuffled.  An empty table gives no rows.
    """
    absent = [F.when(F.col(_quoted(c)).isNull(), c) for c in columns]
    return df.groupBy(F.concat_ws(",", *absent).alias("missing")).agg(F.count(F.lit(1)).alias("n"))


def column_report(df: DataFrame, distinct: Sequence[str] = ()) -> DataFrame:
    """One row a column: ``rows``, ``nulls``, ``smallest`` and ``largest`` as text, ``distinct_values`` for the named columns.

    It is one scan and one aggregation; only the named columns cost a shuffle of their values.  Columns of nested types have
    no bounds.  An empty table has zeros and NULL bounds.
    """

    def line(name: str, kind) -> F.Column:
        c = F.col(_quoted(name))
        low, high = (f(c).cast("string") if isinstance(kind, AtomicType) else F.lit(None).cast("string") for f in (F.min, F.max))
        different = F.count_distinct(c) if name in distinct else F.lit(None).cast("long")
        return F.struct(F.lit(name).alias("column"), F.count(F.lit(1)).alias("rows"), F.count_if(c.isNull()).alias("nulls"), low.alias("smallest"), high.alias("largest"), different.alias("distinct_values"))

    lines = df.agg(F.array(*(line(f.name, f.dataType) for f in df.schema)).alias("lines"))
    return lines.select(F.inline("lines"))


def dated(columns: Sequence[str]) -> str | None:
    """The first column whose name is that of a day or time."""
    return next((c for c in columns if "date" in c.lower() or c.lower().endswith(("_dt", "dttm"))), None)


def catalog_report(spark: SparkSession, tables: Mapping[str, Callable[[], DataFrame]]) -> DataFrame:
    """One row a table: OK, EMPTY or ERROR, its rows, and the reach of its first day column.

    A table that cannot be read, be it for its metadata or a lost file, is reported and does not hide the others.
    """
    found = []
    for name, read in tables.items():  # one row comes back from each
        try:
            df = read()
            column = dated(df.columns)
            low, high = (f(_quoted(column)).cast("string") if column else F.lit(None).cast("string") for f in (F.min, F.max))
            rows, first, last = df.agg(F.count(F.lit(1)), low, high).first()
            found.append((name, "OK" if rows else "EMPTY", rows, column, first, last, None))
        except (PySparkException, Py4JError) as e:  # the latter for failed tasks
            found.append((name, "ERROR", None, None, None, None, str(e)[:500]))
    return spark.createDataFrame(found, REPORT)
