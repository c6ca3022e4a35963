"""Versions of tables, writes of several tables as a unit, and the table faults that were mended with them."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from velora.operators import unit_write
from velora.operators.cleanse import GateError
from velora.operators.quality import Check, QualityError
from velora.sources.objects import ObjectStore
from velora.sources.tables import IncompatibleSpec, Table
from velora.sources.versions import Conflict, VersionedTable

SCHEMA = StructType().add("day", "string").add("v", "integer")
T0 = datetime(2026, 1, 1)


def content(df):
    return sorted((r.day, r.v) for r in df.collect())


def test_versions(spark, tmp_path):
    t = VersionedTable(spark, f"file://{tmp_path}/t", SCHEMA, "day")
    rows = lambda *r: spark.createDataFrame(list(r), SCHEMA)
    assert t.read().count() == 0 and t.current() is None
    first = [("a/b", 1), ("b", 2), ("c", 3)]
    assert t.replace_all(rows(*first), T0) == 0
    assert t.replace_partitions(rows(("b", 20)), ["b", "c"], T0 + timedelta(days=1)) == 1
    assert t.replace_range(rows(("d", 4)), "c", "e", T0 + timedelta(days=2)) == 2
    assert content(t.read()) == [("a/b", 1), ("b", 20), ("d", 4)] and content(t.read(0)) == first and content(t.read(1)) == [("a/b", 1), ("b", 20)]
    assert t.as_of(T0 + timedelta(hours=30)) == 1 and t.as_of(T0 - timedelta(days=1)) is None
    assert t.restore(0, T0 + timedelta(days=3)) == 3 and content(t.read()) == first
    with pytest.raises(ValueError):
        t.replace_partitions(rows(("z", 1)), ["b"], T0)
    assert t.current() == 3 and content(t.read()) == first
    with pytest.raises(Conflict):
        t._commit(2, {}, T0, "late")
    plan = t.read(where=F.col("day") == "b")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_expiry_and_orphans(spark, tmp_path):
    t = VersionedTable(spark, f"file://{tmp_path}/t", SCHEMA, "day")
    for n in range(6):
        t.replace_partitions(spark.createDataFrame([("a", n), ("b", n)] if n == 0 else [("a", n)], SCHEMA), ["a", "b"] if n == 0 else ["a"], T0 + timedelta(days=n))
    assert t.expire(T0 + timedelta(days=9)) == [0, 1]  # older than seven days
    assert t.expire(T0 + timedelta(days=99)) == [2]  # the last three stay
    assert [content(t.read(v)) for v in (3, 4, 5)] == [[("a", v), ("b", 0)] for v in (3, 4, 5)]
    with pytest.raises(KeyError):
        t.read(1)
    assert len(list((tmp_path / "t" / "day=a").iterdir())) == 3 and len(list((tmp_path / "t" / "day=b").iterdir())) == 1
    t._written(spark.createDataFrame([("c", 9)], SCHEMA))  # a write that stopped before its commit
    assert content(t.read()) == [("a", 5), ("b", 0)]
    assert t.remove_orphans(datetime.now()) == 0 and t.remove_orphans(datetime.now() + timedelta(days=4)) == 1
    assert content(t.read()) == [("a", 5), ("b", 0)]


def test_compaction_by_size(spark, tmp_path):
    for kind in (Table, VersionedTable):
        t = kind(spark, f"file://{tmp_path}/{kind.__name__}", SCHEMA, "day")
        df = spark.range(40_000).select(F.when(F.col("id") % 4 == 0, "big").otherwise("small").alias("day"), F.hash("id").alias("v"))
        df = df.where("day = 'big' OR id < 40").repartition(8)
        if kind is Table:
            t.append(df)
        else:
            t.replace_all(df, T0)
            for v in ("big", "small"):  # as eight appends would leave them
                run = t.describe(0)["folders"][v]
                df.where(F.col("day") == v).drop("day").write.mode("overwrite").parquet(f"{t.root}/day={v}/__version={run}")
        before = content(t.read())
        again = t.compact(file_bytes=15_000) if kind is Table else t.compact(T0, file_bytes=15_000)
        assert again == (2 if kind is Table else 1) and content(t.read()) == before
        files = lambda v: len([f for f in t.read(where=F.col("day") == v).inputFiles() if f"day={v}" in f])
        assert files("small") == 1 and 2 <= files("big") <= 5
        assert not (t.compact(file_bytes=15_000) if kind is Table else t.compact(T0, file_bytes=1 << 30)) or kind is VersionedTable


# units


class Crash(RuntimeError):
    pass


def unit(spark, root):
    main = Table(spark, f"{root}/main", SCHEMA, "day")
    bad = Table(spark, f"{root}/bad", StructType([*SCHEMA.fields, StructType().add("quarantine_reason", "string").fields[0]]), "day")
    store = ObjectStore(spark, f"{root}/notes")
    return unit_write.UnitWrite(store, "rental", [main, bad]), main, bad, store


def chunk(spark, u, main, bad, values, **more):
    df = spark.createDataFrame(values, SCHEMA)
    return unit_write.write_chunk(u, main, bad, df, {"negative": F.col("v") < 0}, "d1", "d2", ("markers/d.json", {"status": "COMPLETE"}), **({"most": 0.6} | more))


def test_unit_writes_both_tables_and_the_marker(spark, tmp_path):
    u, main, bad, store = unit(spark, f"file://{tmp_path}")
    for _ in range(2):
        assert chunk(spark, u, main, bad, [("d1", 1), ("d2", -2), ("d2", 3)]) == {"rows": 2, "quarantined": 1}
        assert content(main.read()) == [("d1", 1), ("d2", 3)] and content(bad.read()) == [("d2", -2)]
    assert store.get_json("markers/d.json") == {"status": "COMPLETE", "rows": 2, "quarantined": 1}
    chunk(spark, u, main, bad, [("d1", 5)])  # without broken rows the quarantine of the range is emptied
    assert content(main.read()) == [("d1", 5)] and content(bad.read()) == []


def test_a_failed_gate_writes_nothing(spark, tmp_path):
    u, main, bad, store = unit(spark, f"file://{tmp_path}")
    chunk(spark, u, main, bad, [("d1", 1)])
    before = (content(main.read()), content(bad.read()), store.get_json("markers/d.json"))
    with pytest.raises(GateError):
        chunk(spark, u, main, bad, [("d1", -1), ("d1", 2)], most=0.01)
    with pytest.raises(QualityError):
        chunk(spark, u, main, bad, [("d1", 2)], check=Check("rows").min_rows(9))
    with pytest.raises(ValueError):
        chunk(spark, u, main, bad, [("d9", 2), ("d1", 1)])  # quarantine is staged by then
    assert (content(main.read()), content(bad.read()), store.get_json("markers/d.json")) == before
    assert not [k for t in (main, bad) for k in t.store.keys() if k.startswith(".")]


def test_a_crash_at_every_step_gives_all_or_nothing(spark, tmp_path, monkeypatch):
    """Every call that changes a file system fails in turn; then the tables are opened again as a new run does."""
    new, old = [("d1", 7), ("d2", -8)], [("d1", 1), ("d2", -2), ("d3", 0)]
    wrote = False
    for step in range(60):
        root = f"file://{tmp_path}/{step}"
        u, main, bad, store = unit(spark, root)
        for t, rows in ((main, [r for r in old if r[1] >= 0]), (bad, [(*r, "negative") for r in old if r[1] < 0])):
            t.append(spark.createDataFrame(rows, t.schema))
        calls = []

        def failing(name, step=step, calls=calls):
            real = getattr(ObjectStore, name)

            def call(self, *args):
                calls.append(name)
                if len(calls) == step + 1:
                    raise Crash(name)
                return real(self, *args)

            return call

        with monkeypatch.context() as m:
            for name in ("put_text", "rename", "delete"):
                m.setattr(ObjectStore, name, failing(name))
            try:
                chunk(spark, u, main, bad, new)
                finished = True
            except Crash:
                finished = False
        u, main, bad, store = unit(spark, root)
        decided = u.recover()
        got = (content(main.read()), content(bad.read()))
        done = got == ([("d1", 7), ("d3", 0)], [("d2", -8)]) and store.get_json("markers/d.json") is not None
        nothing = got == ([("d1", 1), ("d3", 0)], [("d2", -2)]) and store.get_json("markers/d.json") is None
        assert (done or nothing) and (done or not (finished or decided)), step
        assert not [k for t in (main, bad) for k in t.store.keys() if k.startswith(".staging")]
        assert done >= wrote  # once the intent stands, every later crash ends with all
        wrote = done
        if finished:
            break
    assert finished and step > 8


# table faults


def test_added_columns_are_noted(spark, tmp_path):
    t = Table(spark, f"file://{tmp_path}/t", SCHEMA, "day")
    t.create()
    t.add_columns(StructType().add("more", "string"))
    with pytest.raises(IncompatibleSpec):
        Table(spark, t.root, StructType([*SCHEMA.fields, StructType().add("more", "integer").fields[0]]), "day").create()
    assert not Table(spark, t.root, t.schema, "day").create()


def test_insert_new_takes_the_smallest_row(spark, tmp_path):
    t = Table(spark, f"file://{tmp_path}/t", SCHEMA)
    assert t.insert_new(spark.createDataFrame([("a", 3), ("a", 1), ("b", None), ("b", 2)], SCHEMA).repartition(4), "day") == 2
    assert content(t.read()) == [("a", 1), ("b", None)]
    assert t.insert_new(spark.createDataFrame([("a", 0)], SCHEMA), "day") == 0


def test_present_partitions_are_staged(spark, tmp_path):
    """A job that fails leaves every partition as it was."""
    t = Table(spark, f"file://{tmp_path}/t", SCHEMA, "day")
    t.append(spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], SCHEMA))
    broken = spark.createDataFrame([("a", 9), ("b", 0)], SCHEMA).withColumn("v", F.when(F.col("v") == 0, F.raise_error(F.lit("no")).cast("int")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="no"):
        t.replace_present(broken)
    assert content(t.read()) == [("a", 1), ("b", 2), ("c", 3)]
    t.replace_present(spark.createDataFrame([("a", 9), ("x", 0)], SCHEMA))
    assert content(t.read()) == [("a", 9), ("b", 2), ("c", 3), ("x", 0)]
