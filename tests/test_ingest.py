"""Crashes in table swaps, pruned and unskewed plans, collection, policy, settings and training inputs."""

import http.server
import json
import threading
from datetime import date, datetime
from urllib.parse import parse_qs, urlparse

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from velora.config import Config, load_config, parse_config
from velora.functions.dates import date_partition, kst_cutoff
from velora.operators import check_sets, cleanse, decide, policy, quality, range_features, ranking, same_day, state, training
from velora.plans import inputs
from velora.sources import files, rest
from velora.sources.objects import ObjectStore
from velora.sources.tables import IncompatibleSpec, Table, digest, read_jdbc_day, sync_day, sync_matches

SCHEMA = StructType().add("day", "string").add("v", "integer")


def content(t):
    return sorted((r.day, r.v) for r in t.read().collect())


class Stopped(Exception):
    pass


@pytest.mark.parametrize("after", range(7))
def test_a_swap_survives_a_crash(spark, tmp_path, monkeypatch, after):
    """The writer dies after so many renames and deletions; the next one that opens the table finishes the swap."""
    t = Table(spark, f"file://{tmp_path}/t", SCHEMA, "day")
    t.append(spark.createDataFrame([("2026-01-01", 1), ("2026-01-02", 2), ("2026-01-03", 3)], SCHEMA))
    left = [after]
    rename, delete = ObjectStore.rename, ObjectStore.delete

    def limited(f):
        def run(*args):
            if not left[0]:
                raise Stopped
            left[0] -= 1
            return f(*args)

        return run

    monkeypatch.setattr(ObjectStore, "rename", limited(rename))
    monkeypatch.setattr(ObjectStore, "delete", limited(delete))
    new = spark.createDataFrame([("2026-01-02", 22), ("2026-01-04", 44)], SCHEMA)
    try:
        t.replace_range(new, "2026-01-02", "2026-01-04")
    except Stopped:
        pass
    monkeypatch.undo()
    again = Table(spark, t.root, SCHEMA, "day")
    assert content(again) == [("2026-01-01", 1), ("2026-01-02", 22), ("2026-01-04", 44)]
    assert not again.recover() and not again.store.exists("_swap.json")


def test_rows_outside_leave_the_table(spark, tmp_path):
    t = Table(spark, f"file://{tmp_path}/t", SCHEMA, "day")
    t.append(spark.createDataFrame([("a", 1)], SCHEMA))
    for rows in ([("b", 1)], [(None, 1)], [("a", 5), ("b", 5)]):
        with pytest.raises(ValueError, match="outside"):
            t.replace_partitions(spark.createDataFrame(rows, SCHEMA), ["a"])
    assert content(t) == [("a", 1)] and [k for k in t.store.keys() if k.startswith(".staging")] == []


def test_documents_are_never_absent(spark, tmp_path):
    store = ObjectStore(spark, f"file://{tmp_path}/s")
    for key in ("a/w.json", "top.json"):
        for n in range(3):
            store.put_json(key, {"n": n})
            assert store.get_json(key) == {"n": n}
    assert store.keys("a") == ["w.json"] and "top.json" in store.keys()


def test_specs(spark, tmp_path):
    t = Table(spark, f"file://{tmp_path}/t", SCHEMA, "day")
    assert t.create() and not t.create()
    with pytest.raises(IncompatibleSpec):
        Table(spark, t.root, SCHEMA, "v").create()
    with pytest.raises(IncompatibleSpec):
        Table(spark, t.root, StructType().add("day", "string").add("v", "string"), "day").create()


def plan(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "2000")
    return df._jdf.queryExecution().executedPlan().toString()


def test_windows_reach_the_scan(spark, sf_dir):
    trips = inputs.trips(spark, sf_dir)
    got = plan(range_features.usage_of(trips, inputs.ANCHORS, 14))
    pushed = next(x for x in got.splitlines() if "PushedFilters" in x)
    assert "GreaterThanOrEqual(ts,2024-01-08" in pushed and "LessThan(ts,2024-01-29" in pushed
    assert range_features.usage_of(trips, inputs.ANCHORS, 14).count() == range_features.usage_features(range_features.daily_rollup(trips), inputs.ANCHORS, 14).count()


def test_grades_without_one_task(spark, sf_dir):
    scores = inputs.scores(spark, sf_dir)
    assert "SinglePartition" not in plan(decide.graded(scores, "risk_score", 0.9, 0.97))


@pytest.mark.parametrize("most", [5, 100_000])
def test_exact_percentiles(spark, most):
    rng = np.random.default_rng(1)
    for values in (rng.normal(size=1000).round(2), np.ones(50), np.concatenate([np.zeros(900), rng.exponential(1e6, 100)]), rng.integers(0, 4, 77).astype(float), np.array([3.5])):
        df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
        shares = [0.0, 0.25, 0.97, 0.99, 1.0]
        assert np.allclose(decide.exact_percentiles(df, "v", shares, cells=8, most=most), np.quantile(values, shares))
    assert decide.exact_percentiles(df.limit(0), "v", [0.5]) == [None]


def test_capacity_is_a_pruned_top_n(spark):
    df = spark.createDataFrame([(i, "ab"[i % 3 == 0], float(i * 7919 % 101)) for i in range(400)], "bike_id long, region string, score double")
    got = ranking.within_capacity(df, "region", F.when(F.col("region") == "a", 3.4).otherwise(1.5), "score", "bike_id")
    assert "WindowGroupLimit" in plan(got)
    want = {r: [x.bike_id for x in df.where(f"region = '{r}'").orderBy(F.desc("score"), "bike_id").limit(n).collect()] for r, n in (("a", 3), ("b", 2))}
    assert sorted(x.bike_id for x in got.where("in_capacity").collect()) == sorted(want["a"] + want["b"]) and got.count() == 400
    assert ranking.within_capacity(df, "region", F.lit(-2.0), "score", "bike_id").where("in_capacity").count() == 0


def test_vehicles_without_station_need_no_window(spark):
    risk = spark.createDataFrame([(1, 9.0, "Critical"), (2, 8.0, "Warning"), (3, 7.0, "Warning"), (4, 6.0, "Warning")], "bike_id long, risk_score double, risk_grade string")
    location = spark.createDataFrame([(1, None), (2, None), (3, "s"), (4, "s")], "bike_id long, last_station_id string")
    inventory = spark.createDataFrame([("s", 3, 2)], "station_id string, bike_cnt int, target_bike_cnt int")
    got = {r.bike_id: r.action for r in decide.decisions(risk, location, inventory).collect()}
    assert got == {1: "suspend", 2: "hold", 3: "suspend", 4: "hold"}


def test_average_precision_of_skewed_scores(spark):
    rng = np.random.default_rng(2)
    score, label = rng.exponential(1e-4, 500).round(5), rng.integers(0, 2, 500)
    order = np.argsort(-score, kind="stable")
    tp = n = out = 0
    for v in np.unique(score)[::-1]:
        mine = label[score == v]
        tp, n = tp + mine.sum(), n + len(mine)
        out += mine.sum() * tp / n
    df = spark.createDataFrame([(float(s), int(x)) for s, x in zip(score[order], label[order], strict=True)], "score double, label int")
    assert abs(ranking.average_precision(df).first().average_precision - out / label.sum()) < 1e-12


def test_trips_stations_and_dates(spark):
    raw = spark.createDataFrame([(" b 1", "2026-01-02 10:00:00", "2026-01-02 10:30:30", "5", "a", "b"), (None, "2026-01-02 10:00:00", None, "x", "a", "b"), ("B2", "2025-01-01 00:00:00", None, None, None, None)], "k string, s string, e string, m string, f string, t string")
    names = {"bike_id": "k", "rent_at": "s", "return_at": "e", "dist_m": "m", "rent_station": "f", "return_station": "t"}
    got = [(r.bike_id, r.dur_min) for r in cleanse.standard_trips(raw.withColumn("m", F.col("m").try_cast("double")), names, "2026-01-01").collect()]
    assert got == [("B1", 30.5)]
    assert cleanse.without_paging(raw.withColumn("RNUM", F.lit(1))).columns == raw.columns
    days = {r.x: r.d for r in spark.createDataFrame([("2026.01.02 x",), ("2026",), (None,)], "x string").select("x", date_partition(F.col("x")).alias("d")).collect()}
    assert days == {"2026.01.02 x": "2026-01-02", "2026": "", None: ""}
    assert kst_cutoff("2026-01-01T20:00:00.123456+00:00").isoformat() == "2026-01-02T05:00:00+09:00"
    with pytest.raises(ValueError, match="time zone"):
        kst_cutoff("2026-01-01T20:00:00")
    assert cleanse.recognised(["BIKE_ID", "x"], {"bike_id": ("bike_id", "BIKE_ID"), "rent": ("rent",)}, 1)
    assert not cleanse.recognised(["x"], {"bike_id": ("bike_id",)}, 1)


class Service(http.server.BaseHTTPRequestHandler):
    failing: set = set()

    def do_GET(self):  # noqa: N802
        q = parse_qs(urlparse(self.path).query)
        first, last, key = int(q["first"][0]), int(q["last"][0]), q["key"][0]
        if key in self.failing:
            self.failing.discard(key)  # once
            self.send_error(503)
            return
        body = json.dumps({"row": [{"n": i, "key": key, "none": None} for i in range(first, min(last, 5) + 1)]}).encode()
        self.send_response(200)
        self.end_headers()
        self.wfile.write(body)

    def log_message(self, *args):
        pass


def test_paged_source(spark):
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Service)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    Service.failing = {"h2"}
    try:
        spark.dataSource.register(rest.PagedSource)
        url = f"http://127.0.0.1:{server.server_port}/?first={{first}}&last={{last}}&key={{key}}"
        df = spark.read.format("paged_rest").schema("n string, key string, none string, missing string").options(url=url, keys="h1,h2", pagesize=2).load()
        assert sorted((r.key, r.n, r.none, r.missing) for r in df.collect()) == [(k, str(n), None, None) for k in ("h1", "h2") for n in range(1, 6)]
    finally:
        server.shutdown()
    assert rest.endpoint("rentals", "http://x/").format(first=1, last=2, key="k") == "http://x/rentHist/1/2/k"
    assert rest.report_days(date(2026, 1, 1)) == ["2025-12-31", "2026-01-01"]


def test_hours_in_order_and_partial(spark, tmp_path):
    store = ObjectStore(spark, f"file://{tmp_path}/raw")

    def fetch(hour):
        if hour == 2:
            raise OSError("gone")
        return [{"hour": hour, "n": n} for n in range(2)]

    doc = rest.collect_hours(store, "raw/x/2026-01-01/a", date(2026, 1, 1), [3, 1, 2], fetch, {"snapshot_type": "FINAL", "cutoff": "2026-01-02T00:00:00", "collected_at": "2026-01-02T00:10:00"})
    assert doc["status"] == "PARTIAL" and doc["hours"] == [1, 3] and doc["failed"] == [2]
    assert [r["hour"] for r in store.get_json("raw/x/2026-01-01/a/payload.json")["rows"]] == [1, 1, 3, 3]
    assert policy.listed_candidates(store, "x", date(2026, 1, 1)) == []  # not complete
    rest.collect_hours(store, "raw/x/2026-01-01/b", date(2026, 1, 1), [1, 3], fetch, {"snapshot_type": "FINAL", "cutoff": "2026-01-02T00:00:00", "collected_at": "2026-01-02T00:20:00"})
    found = policy.listed_candidates(store, "x", date(2026, 1, 1))
    assert [(c.kind, c.hours, c.has_payload) for c in found] == [("FINAL", 2, True)]
    assert policy.manifest_problem({"target_date": "2026-01-01", "snapshot_type": "FINAL", "status": "COMPLETE", "hours": [1], "rows": -1}, date(2026, 1, 1), "FINAL", [1]) == "ROWS_INVALID"
    chosen = policy.choose_all([date(2026, 1, 1), date(2025, 12, 31)], found, datetime(2026, 1, 2), datetime(2026, 1, 2, 1))
    assert not chosen.complete and chosen.missing == {date(2025, 12, 31): "NO_CANDIDATE"} and chosen.mode == "NORMAL"


def test_same_day(spark, tmp_path):
    t = Table(spark, f"file://{tmp_path}/t", SCHEMA, "day")
    rows = spark.createDataFrame([("2026-01-02", 1)], SCHEMA)
    run = {"status": "COMPLETE", "same_day": True, "run_date": "2026-01-02", "promotion_id": "p", "mode": "DEGRADED", "snapshots": [{"target_date": "2026-01-02", "snapshot_type": "FINAL"}]}
    doc = same_day.process_same_day(t, rows, run, date(2026, 1, 1), datetime(2026, 1, 2))
    assert (doc["mode"], doc["rows"], doc["confirmed_through"]) == ("DEGRADED", 1, "2026-01-01")
    assert same_day.process_same_day(t, rows, run | {"same_day": False}, date(2026, 1, 1), datetime(2026, 1, 2)) is None
    for wrong in ({"status": "FAILED"}, {"snapshots": []}):
        with pytest.raises(ValueError):
            same_day.process_same_day(t, rows, run | wrong, date(2026, 1, 1), datetime(2026, 1, 2))


def test_watermarks_begin_once(spark, tmp_path):
    store = ObjectStore(spark, f"file://{tmp_path}/s")
    state.bootstrap_watermark(store, "w.json", date(2026, 1, 1))
    state.require_watermark(store, "w.json", date(2026, 1, 1))
    with pytest.raises(ValueError):
        state.bootstrap_watermark(store, "w.json", date(2026, 1, 2))
    with pytest.raises(ValueError):
        state.require_watermark(store, "w.json", date(2026, 1, 2))


def test_settings(tmp_path):
    c = parse_config('{"run": {"window": 14, "min_rent_date": null}, "k": [1]}')
    assert c.get_path("run.window") == 14 and c.get_path("run.none.deep", 3) == 3 and c.merged({"run": {"x": 1}}).get_path("run.window") == 14
    with pytest.raises(ValueError):
        c.require("run.min_rent_date")
    (tmp_path / "a.json").write_text(json.dumps({"run": {"window": 14}}))
    assert load_config(str(tmp_path / "a.json"), env={"VELORA__RUN__WINDOW": "7", "OTHER": "1"}) == Config({"run": {"window": "7"}})


def test_check_sets(spark):
    bad = spark.createDataFrame([("s", None, -1), ("s", "west", 3)], "station_id string, region string, hold_num int")
    assert {r.name: r.status for r in check_sets.check_table("stations", bad)} == {"complete(station_id)": "PASS", "complete(region)": "FAIL", "non_negative(hold_num)": "FAIL", "uniqueness(station_id)": "FAIL"}
    with pytest.raises(quality.QualityError):
        check_sets.check_table("decisions", spark.createDataFrame([("b", "other")], "bike_id string, action string"))


def test_training_inputs(spark):
    assert training.input_problems(date(2026, 2, 1), 14, ["2026-01"], ["2026-01"], date(2026, 2, 1)) == []
    assert len(training.input_problems(date(2026, 2, 2), 3, ["2026-01", "2026-02"], ["2026-01"], date(2026, 2, 1))) == 3
    days = [date(2026, 1, d) for d in (1, 2, 3)]
    rows = [(d, f"B{i}", float(i), int(i < 3), False) for d in days for i in range(10)]
    samples = spark.createDataFrame(rows, "snapshot_date date, bike_id string, trips double, label int, excluded boolean")
    fit = lambda train: lambda df: df.withColumn("score", -F.col("trips"))
    got = training.walk_forward(samples, [(days[:1], days[1:2]), (days[:2], days[2:])], fit, 3)
    assert [r["capture_at_k"] for r in got] == [100.0, 100.0]
    with pytest.raises(ValueError):
        training.walk_forward(samples, [(days[1:], days[:1])], fit, 3)


def test_copies_are_compared_by_content(spark):
    a = spark.createDataFrame([(1, "x"), (2, None)], "k long, v string")
    assert sync_matches(a, a.orderBy(F.desc("k"))) and not sync_matches(a, a.withColumn("v", F.lit("x"))) and digest(a.limit(0)).first().rows == 0


def test_input_files(spark, tmp_path):
    import zipfile

    (tmp_path / "b.csv").write_text("a,b\n1,2\n")
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("y.csv", "1")
        z.writestr("x.csv", "12")
    got = [(r.path.rsplit("/", 1)[1], r.member, r.bytes) for r in files.input_files(spark, str(tmp_path)).collect()]
    assert got == [("a.zip", "x.csv", 2), ("a.zip", "y.csv", 1), ("b.csv", "", 8)]


def test_days_in_a_database(spark):
    """Derby, which Spark brings along, stands in for the serving database."""
    url, properties = "jdbc:derby:memory:velora;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}

    def execute(statements):
        c = spark._jvm.java.sql.DriverManager.getConnection(url)
        c.setAutoCommit(False)
        for x in statements:
            c.createStatement().execute(x)
        c.commit()
        c.close()

    schema = "k int, snapshot_date date, v double"
    spark.createDataFrame([(1, date(2026, 1, 1), 1.0), (2, date(2026, 1, 2), 2.0)], schema).write.jdbc(url, "mart", properties=properties)
    mart = spark.createDataFrame([(3, date(2026, 1, 2), 3.5), (4, date(2026, 1, 2), None)], schema)
    for _ in range(2):
        sync_day(mart, url, "mart", "snapshot_date", "2026-01-02", "2026-01-03", execute, properties)
        rows = read_jdbc_day(spark, url, "mart", "snapshot_date", "2026-01-01", "2026-01-03", properties).collect()
        assert sorted((r[0], r[2]) for r in rows) == [(1, 1.0), (3, 3.5), (4, None)] or sorted((r[0], str(r[2])) for r in rows) == [(1, "1.0"), (3, "3.5"), (4, "None")]
    with pytest.raises(ValueError, match="does not hold"):
        sync_day(mart, url, "mart", "snapshot_date", "2026-01-02", "2026-01-02", execute, properties)
