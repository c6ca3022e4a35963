"""Sources, sinks, state, policy, models and streams on temporary folders."""

import json
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from velora.operators import model, policy, state
from velora.sources import files, rest
from velora.sources.objects import ObjectStore
from velora.sources.tables import Table
from velora.streaming.events import daily_counts, keep_state

SCHEMA = StructType().add("day", "string").add("v", "integer")


@pytest.fixture
def days(spark, tmp_path):
    t = Table(spark, f"file://{tmp_path}/t", SCHEMA, "day")
    t.append(spark.createDataFrame([(f"2026-01-{d:02}", d) for d in range(1, 11)], SCHEMA))
    return t


def content(t):
    return sorted((r.day, r.v) for r in t.read().collect())


def test_replace_range(spark, days):
    rows = spark.createDataFrame([("2026-01-03", 33), ("2026-01-05", 55)], SCHEMA)
    for _ in range(2):  # again changes nothing
        days.replace_range(rows, "2026-01-03", "2026-01-06")
        assert content(days) == [(f"2026-01-{d:02}", d) for d in (1, 2)] + [("2026-01-03", 33), ("2026-01-05", 55)] + [(f"2026-01-{d:02}", d) for d in range(7, 11)]
    with pytest.raises(ValueError):
        days.replace_range(rows, "2026-01-04", "2026-01-06")
    days.replace_range(rows.limit(0), "2026-01-01", "2026-01-09")
    assert content(days) == [("2026-01-10", 10)]


def test_replace_partitions_and_all(spark, days):
    days.replace_partitions(spark.createDataFrame([("2026-01-02", 9)], SCHEMA), ["2026-01-02", "2026-01-04"])
    assert len(content(days)) == 9 and ("2026-01-02", 9) in content(days)
    assert (days.min_partition(), days.max_partition()) == ("2026-01-01", "2026-01-10")
    assert days.latest_with(F.col("v") < 9) == "2026-01-08"
    days.replace_present(spark.createDataFrame([("2026-01-01", 7)], SCHEMA))
    assert ("2026-01-01", 7) in content(days) and len(content(days)) == 9
    days.compact()
    assert len(content(days)) == 9
    days.replace_all(spark.createDataFrame([("x", 1)], SCHEMA))
    assert content(days) == [("x", 1)]


def test_insert_new_and_columns(spark, days):
    assert days.insert_new(spark.createDataFrame([("2026-01-01", 1), ("2027-01-01", 1), ("2027-01-01", 1)], SCHEMA), "day") == 1
    days.add_columns(StructType().add("more", "string"))
    assert days.read().where("more IS NULL").count() == 11


def test_pruned_scan(days):
    plan = days.read(F.col("day") == "2026-01-03", ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_objects_and_watermark(spark, tmp_path):
    store = ObjectStore(spark, f"file://{tmp_path}/s")
    assert store.get_json("a/w.json") is None
    assert state.read_watermark(store, "a/w.json", date(2026, 1, 1)) == date(2025, 12, 31)
    state.write_watermark(store, "a/w.json", date(2026, 1, 5))
    assert state.read_watermark(store, "a/w.json", date(2026, 1, 1)) == date(2026, 1, 5)
    store.put_json("a/w.json", {"last_date": "2026-01-07"})
    assert state.read_watermark(store, "a/w.json", date(2026, 1, 1)) == date(2026, 1, 7)
    assert store.keys("a") == ["w.json"]


def test_ranges():
    d = date(2026, 1, 1)
    day = lambda n: d + timedelta(days=n)
    assert state.contiguous_until([day(1), day(2), day(4)], d, day(9)) == day(2)
    assert state.confirmed_range(d, day(100)) == (day(1), day(70)) and state.confirmed_range(d, d) is None
    backlog, window = state.sliding_ranges(d, day(60), day(60))
    assert window == (day(30), day(60)) and backlog == (day(1), day(29))
    assert [len(c) for c in state.batches(range(7), 3)] == [3, 3, 1]
    parts = state.chunks(d, day(69))
    assert len(parts) == 3 and state.advance_over(parts, parts[:1], d) == (day(30), parts[1])
    assert state.open_chunks(d, day(69), parts[:2]) == parts[2:]
    assert state.is_stale(d, day(4)) and not state.is_stale(d, day(3)) and state.is_ready(d, day(1), 1)


def test_policy():
    day, now = date(2026, 8, 1), datetime(2026, 8, 1, 6)
    c = lambda kind, age, **k: policy.Candidate(**({"day": day, "kind": kind, "cutoff": now, "collected_at": now - timedelta(minutes=age), "hours": 6} | k))
    pick = lambda *cs: policy.choose(list(cs), day, now, now).reason
    assert pick() == "NO_CANDIDATE"
    assert pick(c("FINAL", 5, has_payload=False)) == "PAYLOAD_MISSING"
    assert pick(c("PRELIMINARY", 5), c("FINAL", 500)) == "FINAL_SELECTED"
    assert pick(c("PRELIMINARY", 5)) == "PRELIMINARY_SELECTED"
    assert pick(c("PRELIMINARY", 121)) == "PRELIMINARY_STALE"
    assert pick(c("FINAL", 5, cutoff=now - timedelta(days=1))) == "FINAL_CUTOFF_MISMATCH"
    assert policy.collection_windows(date(2026, 7, 30), now)[-1] == (day, [0, 1, 2, 3, 4, 5])
    assert [policy.completion_status(*x) for x in ((5, 5), (0, 0), (None, None))] == ["COMPLETE", "COMPLETE_EMPTY", "FAILED"]


def test_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,\n2,b\n")
    assert [tuple(r) for r in files.read_csv(spark, f"file://{tmp_path}/a.csv").collect()] == [("1", ""), ("2", "b")]
    (tmp_path / "k.txt").write_bytes("따릉이\n서울".encode("euc-kr"))
    assert [r.line for r in files.read_encoded_lines(spark, f"file://{tmp_path}/k.txt").collect()] == ["따릉이", "서울"]
    with pytest.raises(files.EncodingMismatch):
        files.decode_lossy(b"\xff\xff\xff" * 9 + b"ab")
    (tmp_path / "p.json").write_text(json.dumps({"rows": [{"a": "1"}, {"a": "2", "b": "x"}]}))
    assert [tuple(r) for r in files.read_payload(spark, f"file://{tmp_path}/p.json", "a:string,b:string").collect()] == [("1", None), ("2", "x")]
    assert files.union_of_keys([{"a": 1}, {"b": 2, "a": 3}]) == ["a", "b"]
    import zipfile

    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("b.csv", "2")
        z.writestr("a.csv", "1")
    got = files.read_archives(spark, f"file://{tmp_path}/z.zip").collect()
    assert [(r.member, bytes(r.content)) for r in got] == [("a.csv", b"1"), ("b.csv", b"2")]
    geo = {"features": [{"properties": {"name": "A"}, "geometry": {"type": "MultiPolygon", "coordinates": [[[[0, 0], [1, 1]]], [[[5, 5], [6, 6], [7, 7]]]]}}, {"properties": {"name": "B"}, "geometry": {"type": "Polygon", "coordinates": [[[1, 2], [3, 4]]]}}]}
    (tmp_path / "g.json").write_text(json.dumps(geo))
    got = sorted(tuple(r) for r in files.read_regions(spark, f"file://{tmp_path}/g.json").collect())
    assert got == [("A", 0, 5.0, 5.0), ("A", 1, 6.0, 6.0), ("A", 2, 7.0, 7.0), ("B", 0, 1.0, 2.0), ("B", 1, 3.0, 4.0)]


def test_mart_csv(spark, tmp_path):
    (tmp_path / "m.csv").write_text("bike,score,history\nA,1.5,\"['x', 'y']\"\nB,,\n")
    schema = StructType().add("bike", "string").add("score", "double").add("history", ArrayType(StringType()))
    assert [tuple(r) for r in files.read_mart_csv(spark, f"file://{tmp_path}/m.csv", schema, ["history"]).collect()] == [("A", 1.5, ["x", "y"]), ("B", None, None)]


def test_paging_and_retry():
    data = [{"i": i} for i in range(25)]
    assert list(rest.pages(lambda a, b: data[a - 1 : b], 10)) == data
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise rest.TransientError("again")
        return {"ok": True}

    assert rest.with_retry(flaky, sleep=lambda _: None) == {"ok": True} and len(calls) == 3


def test_model_and_registry(spark, tmp_path):
    rows = [(float(i), float(i % 7), 0, i % 3, 10, 1, 1.0, int(i > 50)) for i in range(100)]
    df = spark.createDataFrame(rows, [*model.FEATURES, "label"])
    fitted = model.candidates()["logreg"].fit(df)
    out = model.risk_scores(model.score(fitted, df)).orderBy("trips").collect()
    assert out[0].risk_score < 5 < 95 < out[-1].risk_score
    assert set(model.importances(fitted)) == set(model.FEATURES)
    r = model.Registry(ObjectStore(spark, f"file://{tmp_path}/r"))
    r.register("v1", fitted, {"capture_at_k": 1.0})
    r.register("v2", None, {"capture_at_k": 2.0})
    r.promote("v1")
    r.promote("v2")
    assert r.champion()["version"] == "v2" and r.champion()["history"][0]["version"] == "v1"
    assert r.load("v1").stages


def test_stream_counts_late_events_once(spark, tmp_path):
    schema = "bike_id string, event_type string, occurred_at timestamp"
    t = lambda d, h: datetime(2026, 1, d, h)
    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(f"file://{tmp_path}/in")
    q = daily_counts(stream).writeStream.format("memory").queryName("daily").outputMode("append").option("checkpointLocation", f"file://{tmp_path}/c").start()
    for n, part in enumerate(([("a", "COLLECT", t(1, 9)), ("a", "COLLECT", t(1, 9))], [("a", "COLLECT", t(3, 9)), ("a", "COLLECT", t(1, 10))], [("b", "DEPLOY", t(20, 9))], [("b", "DEPLOY", t(2, 9))])):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(f"file://{tmp_path}/in/{n}")
        q.processAllAvailable()
    q.stop()
    got = {(str(r.day), r.bike_id): r.events for r in spark.table("daily").collect()}
    assert got[("2026-01-01", "a")] == 2 and ("2026-01-02", "b") not in got


def test_state_keeps_the_newest(spark, tmp_path):
    schema = StructType().add("k", "string").add("v", "string").add("at", "integer")
    t = Table(spark, f"file://{tmp_path}/s", schema)
    keep = keep_state(t, "k", "at", ["v"])
    keep(spark.createDataFrame([("a", "x", 1), ("a", "y", 2)], schema), 0)
    for _ in range(2):
        keep(spark.createDataFrame([("a", "old", 1), ("b", "z", 1)], schema), 1)
    assert sorted(tuple(r) for r in t.read().collect()) == [("a", "y", 2), ("b", "z", 1)]


def test_stream_state_in_buckets(spark, tmp_path):
    """Only the buckets of a batch's keys are written again."""
    schema = StructType().add("k", "string").add("v", "string").add("at", "integer").add("bucket", "integer")
    t = Table(spark, f"file://{tmp_path}/state", schema, "bucket")
    keep = keep_state(t, "k", "at", ["v"], buckets=8)
    rows = lambda *r: spark.createDataFrame(list(r), "k string, v string, at integer")
    keep(rows(*((f"k{i}", "x", 1) for i in range(40))), 0)
    before = {p.name for p in (tmp_path / "state").rglob("*.parquet")}
    keep(rows(("k3", "y", 2), ("k5", "old", 0)), 1)
    after = {p.name for p in (tmp_path / "state").rglob("*.parquet")}
    got = {r.k: (r.v, r["at"]) for r in t.read().collect()}
    assert len(got) == 40 and got["k3"] == ("y", 2) and got["k5"] == ("x", 1) and len(before & after) >= len(before) - 2
