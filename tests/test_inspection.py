"""What is missing, how far columns reach, and which tables can be read."""

from pyspark.sql.types import MapType, StringType, StructType

from velora.operators.inspection import catalog_report, column_report, dated, null_groups
from velora.sources.objects import shared_root


def test_null_groups(spark):
    df = spark.createDataFrame([(1, None, None), (2, None, "x"), (3, 5, None), (4, None, "y")], "`a.b` int, n int, t string")
    assert {r.missing: r.n for r in null_groups(df, ["n", "t"]).collect()} == {"n,t": 1, "n": 2, "t": 1}
    assert [tuple(r) for r in null_groups(df, ["a.b"]).collect()] == [("", 4)]
    assert null_groups(df.limit(0), ["n"]).count() == 0


def test_column_report(spark):
    df = spark.createDataFrame([(3, {"a": "b"}, "x"), (None, None, "x"), (10, None, None)], StructType().add("a.b", "integer").add("m", MapType(StringType(), StringType())).add("rows", "string"))
    got = {r.column: tuple(r)[1:] for r in column_report(df, distinct=["rows"]).collect()}
    assert got == {"a.b": (3, 1, "3", "10", None), "m": (3, 2, None, None, None), "rows": (3, 1, "x", "x", 1)}
    empty = {r.column: tuple(r)[1:] for r in column_report(df.where("false"), distinct=["a.b"]).collect()}
    assert empty["a.b"] == (0, 0, None, None, 0)


def test_catalog_report(spark):
    assert dated(["id", "reg_dttm", "date"]) == "reg_dttm" and dated(["id", "rent_dt"]) == "rent_dt" and dated(["id"]) is None
    root = shared_root(spark) + "/inspected"
    rows = spark.createDataFrame([(1, "2024-01-02"), (2, "2024-01-05"), (3, None)], "id int, reg_date string")
    rows.write.mode("overwrite").parquet(root)
    stale = spark.read.parquet(root)
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)  # known files that are gone
    tables = {"here": lambda: rows, "none": lambda: rows.where("id > 9"), "gone": lambda: stale, "never": lambda: spark.read.parquet(f"{root}-never")}
    got = {r.table: r for r in catalog_report(spark, tables).collect()}
    assert tuple(got["here"])[1:] == ("OK", 3, "reg_date", "2024-01-02", "2024-01-05", None)
    assert tuple(got["none"])[1:4] == ("EMPTY", 0, "reg_date")
    assert {t: got[t].status for t in ("gone", "never")} == {"gone": "ERROR", "never": "ERROR"} and got["gone"].error
