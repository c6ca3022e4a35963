"""Mergeable quality states, running totals, chunks by size and footers against plain computations."""

import random
from datetime import date

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from velora.operators.quality import Check, metric_checks
from velora.operators.quality_states import Measures, table_metrics
from velora.operators.running import running, size_chunks
from velora.sources import footers
from velora.sources.tables import Table

# states


def measures():
    check = Check("t").complete("k").non_negative("v").satisfies(F.col("v") > F.col("w"), "more").min_rows(50).uniqueness(["k"], 0.4).uniqueness(["day", "k"], 0.9).uniqueness(["k", "w"])
    return Measures("day", check, ["v", "w"])


def day_rows(spark, seed=1, n=400):
    rng = random.Random(seed)
    rows = [(date(2024, 1, 1 + rng.randrange(9)), rng.choice([None, "", *map(str, range(60))]), rng.choice([None, *range(-2, 50)]), rng.choice([None, 0.5, 7.25])) for _ in range(n)]
    return spark.createDataFrame(rows, "day date, k string, v long, w double")


def test_merged_states_equal_the_table(spark):
    """States of separate parts, in any grouping of days, say what one scan of all rows says."""
    m, df = measures(), day_rows(spark)
    parts = [df.where(F.dayofmonth("day").isin(*days)) for days in ([1, 5, 9], [2], [3, 4, 6, 7, 8])]
    states = m.states(parts[0]).unionByName(m.states(parts[1])).unionByName(m.states(parts[2]))
    keys = m.key_states(parts[0]).unionByName(m.key_states(parts[1])).unionByName(m.key_states(parts[2]))
    got = {tuple(r) for r in m.table(states, keys).collect()}
    assert got == {tuple(r) for r in m.check.table(df).collect()} and {s for _, s, _, _ in got} == {"PASS", "FAIL"}
    one = m.merged(states).first()
    want = df.agg(F.sum("v"), F.min("v"), F.max("w"), F.count(F.when(F.col("w").isNull(), 1))).first()
    assert (one.sum_v, one.low_v, one.high_w, one.nulls_w) == tuple(want)


def test_states_of_nothing(spark):
    m, df = measures(), day_rows(spark).limit(0)
    got = {r["constraint"]: (r.status, r.total) for r in m.table(m.states(df), m.key_states(df)).collect()}
    assert got.pop("min_rows(50)") == ("FAIL", 0) and set(got.values()) == {("PASS", 0)} and len(got) == 6
    assert m.merged(m.states(df)).first().rows == 0


def test_windowed_states(spark):
    m, df = measures(), day_rows(spark).where("dayofmonth(day) <> 4")
    got = {r.day: (r.rows, r.sum_v, r.low_v) for r in m.windowed(m.states(df), 3).collect()}
    for day in got:
        want = df.where((F.col("day") <= F.lit(day)) & (F.col("day") > F.date_sub(F.lit(day), 3))).agg(F.count(F.lit(1)), F.coalesce(F.sum("v"), F.lit(0)), F.min("v")).first()
        assert got[day] == tuple(want)


def test_metrics_of_a_table_are_one_job(spark):
    df = day_rows(spark)
    checks = [{"name": "rows", "expr": "count(*)", "threshold": 1, "operator": "gte"}, {"name": "none", "expr": "sum(nothing)"}, {"name": "mean", "expr": "avg(v)"}, {"name": "text", "expr": "max('abc')"}, {"name": "empty", "expr": "max(v) FILTER (WHERE v > 99)", "threshold": 0}]
    got = {r["name"]: (r["status"], r["value"]) for r in table_metrics(df, checks)}
    assert got["rows"] == ("PASS", 400.0) and got["none"] == ("ERROR", None) and got["mean"][0] == "MONITOR" and got["text"] == ("ERROR", None) and got["empty"] == ("PASS", 0.0)
    spark.sparkContext.setJobGroup("metrics", "metrics")
    table_metrics(df, [c for c in checks if c["name"] in ("rows", "mean", "empty")])
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("metrics")) <= 2  # one action; AQE may split it
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_a_text_metric_is_an_error_of_its_own(spark):
    got = metric_checks(spark, [{"name": "text", "metric_sql": "SELECT 'abc'"}, {"name": "one", "metric_sql": "SELECT 1", "threshold": 1}])
    assert [r["status"] for r in got] == ["ERROR", "PASS"]


# running totals and chunks


def test_running(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice(["a", "b"]), rng.choice([None, *range(20)])) for i in range(500)]
    df = spark.createDataFrame(rng.sample(rows, 500), "i int, g string, v int").repartition(7)
    got = {r.i: (r.s, r.m) for r in running(df, ["g", "i"], {"s": "v"}, {"m": "v"}).collect()}
    s, m = 0, None
    for i, _, v in sorted(rows, key=lambda r: (r[1], r[0])):
        s, m = s + (v or 0), v if m is None else m if v is None else max(m, v)
        assert got[i] == (s, m)


def greedy(sizes, max_items, max_size):
    out, n, total, chunk = [], 0, 0, 0
    for s in sizes:
        if n and (n >= max_items or total + s > max_size):
            chunk, n, total = chunk + 1, 0, 0
        out.append(chunk)
        n, total = n + 1, total + s
    return out


@pytest.mark.parametrize(("n", "max_items", "max_size"), [(700, 10, 60), (700, 3, 10_000), (300, 1000, 25), (300, 1, 1), (200, 1000, 10_000), (1, 5, 5), (0, 5, 5)])
def test_size_chunks(spark, n, max_items, max_size):
    """Items without size, and items beyond the bound, at the first and the last place too."""
    rng = random.Random(max_items)
    sizes = [rng.choice([0, 0, 1, 5, 9, 24, 26, 80]) for _ in range(n)]
    rows = [(f"f{i:05}", s or None, "x") for i, s in enumerate(sizes)]
    df = spark.createDataFrame(rng.sample(rows, n), "name string, size int, chunk_note string").repartition(5)
    got = {r.name: r.chunk for r in size_chunks(df, ["name"], "size", max_items, max_size).collect()}
    assert [got[f"f{i:05}"] for i in range(n)] == greedy(sizes, max_items, max_size)


def test_negative_sizes_are_refused(spark):
    with pytest.raises(Exception, match="negative size"):
        size_chunks(spark.createDataFrame([("a", -1)], "name string, size int"), ["name"], "size", 5, 5).collect()


# footers

FIELDS = StructType().add("i", "long").add("d", "double").add("s", "string").add("day", "date").add("at", "timestamp").add("late", "integer")
COLUMNS = ["i", "d", "s", "day", "at", "late"]


def numbers(spark):
    one = spark.range(1000).select("id", (F.col("id") % 7).alias("m"))
    return one.select(F.when(F.col("m") != 0, F.col("id")).alias("i"), F.when(F.col("m") == 1, F.lit(float("nan"))).otherwise(F.col("id") / 3.0).alias("d"), F.concat(F.lit("s"), "m").alias("s"), F.date_add(F.lit(date(2024, 1, 1)), F.col("m").cast("int")).alias("day"), F.timestamp_seconds("id").alias("at"), F.lit(None).cast("int").alias("late"))


def expected(df):
    return df.agg(F.count(F.lit(1)), *(x for c in COLUMNS for x in (F.min(F.when(~F.isnan(c), F.col(c)) if c == "d" else F.col(c)), F.max(F.when(~F.isnan(c), F.col(c)) if c == "d" else F.col(c)), F.count(F.when(F.col(c).isNull(), 1))))).first()


@pytest.mark.parametrize("stamps", ["TIMESTAMP_MICROS", "INT96"])
def test_footers_equal_a_scan(spark, tmp_path, stamps):
    """INT96 has no bounds in a footer, so those files are scanned."""
    spark.conf.set("spark.sql.parquet.outputTimestampType", stamps)
    df = numbers(spark)
    df.repartition(3).write.parquet(f"file://{tmp_path}/t")
    spark.conf.unset("spark.sql.parquet.outputTimestampType")
    files = spark.read.parquet(f"file://{tmp_path}/t").inputFiles()
    told = [footers._footer(f, COLUMNS) for f in files]
    assert all(t is None for t in told) or stamps != "INT96" and any(t is None for t in told)  # NaN among the bounds
    told = [footers._footer(f, [c for c in COLUMNS if c != "d"]) for f in files]
    assert all((t is None) == (stamps == "INT96") for t in told)
    got = footers.total_stats(footers.footer_stats(spark, files, FIELDS, COLUMNS, per_task=2), COLUMNS).first()
    assert tuple(got) == tuple(expected(df))


def test_files_without_statistics_or_a_column(spark, tmp_path):
    pq.write_table(pa.table({"i": [5, None, 7]}), f"{tmp_path}/a.parquet", write_statistics=False)
    pq.write_table(pa.table({"i": pa.array([None, None], pa.int64())}), f"{tmp_path}/b.parquet")
    pq.write_table(pa.table({"i": [1, 2, 9], "late": pa.array([4, None, 3], pa.int32())}), f"{tmp_path}/c.parquet", row_group_size=1)
    files = [f"file://{tmp_path}/{n}.parquet" for n in "abc"]
    schema = StructType().add("i", "long").add("late", "integer")
    got = footers.total_stats(footers.footer_stats(spark, files, schema, ["i", "late"]), ["i", "late"]).first()
    assert tuple(got) == (8, 1, 9, 3, 3, 4, 6)
    with pytest.raises(ValueError):
        footers.footer_stats(spark, files, StructType().add("b", "binary"), ["b"])


def test_partition_stats(spark, tmp_path):
    schema = StructType().add("day", "string").add("v", "integer")
    t = Table(spark, f"file://{tmp_path}/t", schema, "day")
    assert footers.partition_stats(t, ["v"]).count() == 0
    t.append(spark.createDataFrame([("a b", 1), ("a b", 5), ("c", None), ("d", 3)], schema))
    assert {r.partition: tuple(r)[1:] for r in footers.partition_stats(t, ["v"]).collect()} == {"a b": (2, 1, 5, 0), "c": (1, None, None, 1), "d": (1, 3, 3, 0)}
    assert {r.partition for r in footers.partition_stats(t, ["v"], low="b", high="c").collect()} == {"c"}
