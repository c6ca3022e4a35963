"""Golden cases of the operators: ties, NULLs, gates and boundaries."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from velora.functions import dates, values
from velora.operators import cleanse, decide, latest, marts, quality, range_features, ranking


def one(df):
    return [tuple(r) for r in df.collect()]


def test_date_formats(spark):
    df = spark.createDataFrame([("2026-08-21 18:12:03",), ("20260821181203",), ("2026-08-21",), ("20260821",), ("",), (None,), ("8월 21일",)], "t string")
    got = df.select(F.date_format(dates.parse_datetime(F.col("t")), "yyyy-MM-dd HH:mm:ss"), dates.parse_failed(F.col("t"), dates.parse_datetime(F.col("t")))).collect()
    assert [r[0] for r in got] == ["2026-08-21 18:12:03", "2026-08-21 18:12:03", "2026-08-21 00:00:00", "2026-08-21 00:00:00", None, None, None]
    assert [r[1] for r in got] == [False] * 6 + [True]


def bronze(spark, *rows):
    return spark.createDataFrame(list(rows), "bike_id string, rent_dt string, return_dt string, use_distance_m string, rent_station_id string, return_station_id string, rent_date_partition string, source_file string, ingested_at string")


def test_dedupe_order(spark):
    at = "2026-08-21 10:00:00"
    rows = [("A", at, None, "1", "S1", "R1", "p", "f", "i"), ("A", at, "2026-08-21 11:00:00", "1", "S1", "R1", "p", "f", "i"), ("A", at, "2026-08-21 10:30:00", "x", "S1", "R2", "p", "f", "i"), ("A", at, "2026-08-21 10:30:00", "2", None, "R3", "p", "f", "i"), (None, at, at, "1", "S", "R", "p", "f", "i")]
    for order in (rows, rows[::-1]):
        got = cleanse.silver_trips(bronze(spark, *order)).collect()
        assert len(got) == 1 and got[0].return_station_id == "R3"


def test_unknown_date_stops_the_batch(spark):
    with pytest.raises(cleanse.GateError):
        cleanse.silver_trips(bronze(spark, ("A", "8월 21일", "", "1", "S", "R", "p", "f", "i")))


def test_quarantine_gate():
    cleanse.quarantine_gate(12, 185_956)
    with pytest.raises(cleanse.GateError):
        cleanse.quarantine_gate(2, 100)


def test_aliases(spark):
    df = spark.createDataFrame([("1", None)], "`BIKE_ID` string, extra string")
    assert one(cleanse.alias_select(df, {"bike_id": ("bike_id", "BIKE_ID"), "other": ("x",)})) == [("1", None)]
    with pytest.raises(cleanse.GateError):
        cleanse.alias_select(df, {"other": ("x",)}, required=["other"])


def test_null_distance_or_duration_drops_a_trip(spark):
    df = spark.createDataFrame([(1, 1000.0, 30.0), (2, None, 30.0), (3, 1000.0, None), (4, 6000.0, 0.0), (5, 100.0, 0.0), (6, 60000.0, 300.0), (7, 30000.0, 6.0)], "id int, dist_m double, dur_min double")
    assert sorted(r.id for r in range_features.trip_filters(df).collect()) == [1, 5]


def test_merge_state(spark):
    b = spark.createDataFrame([("A", "S1", 5), ("B", "S2", 5), ("C", "S3", 5), ("D", "S4", None)], "k string, s string, at int")
    d = spark.createDataFrame([("A", None, 6), ("B", "X", 5), ("E", "S9", 1), ("D", "S5", 1)], "k string, s string, at int")
    got = {r.k: (r.s, r["at"]) for r in latest.merge_state(b, d, "k", "at", ["s"]).collect()}
    assert got == {"A": (None, 6), "B": ("S2", 5), "C": ("S3", 5), "D": ("S5", 1), "E": ("S9", 1)}


def decision(spark, risk, inventory):
    r = spark.createDataFrame(risk, "bike_id string, risk_score double, risk_grade string")
    loc = r.select("bike_id", F.lit("S").alias("last_station_id"))
    inv = spark.createDataFrame(inventory, "station_id string, bike_cnt int, target_bike_cnt int")
    return {x.bike_id: x.action for x in decide.decisions(r, loc, inv).collect()}


def test_decisions(spark):
    assert decision(spark, [("a", 9.0, "Critical")], [("S", 5, 5)]) == {"a": "suspend"}
    assert decision(spark, [("a", 9.0, "Warning"), ("b", 8.0, "Warning")], [("S", 6, 5)]) == {"a": "suspend", "b": "hold"}
    assert decision(spark, [("a", 9.0, "Warning"), ("b", 1.0, "Normal")], []) == {"a": "hold", "b": "hold"}
    # a Critical vehicle takes a place from the surplus and a rank as well
    assert decision(spark, [("c", 9.0, "Critical"), ("a", 8.0, "Warning"), ("b", 7.0, "Warning")], [("S", 8, 5)]) == {"c": "suspend", "a": "suspend", "b": "hold"}


def test_grades(spark):
    df = spark.createDataFrame([(str(i), float(i)) for i in range(1, 101)], "bike_id string, risk_score double")
    for w, c, want in ((0.97, 0.99, (1, 2, 97)), (0.90, 0.95, (5, 5, 90)), (0.80, 0.90, (10, 10, 80))):
        got = {r.risk_grade: r["count"] for r in decide.graded(df, "risk_score", w, c).groupBy("risk_grade").count().collect()}
        assert (got["Critical"], got["Warning"], got["Normal"]) == want
    assert decide.graded(df.limit(0)).count() == 0


def test_station_health(spark):
    risk = spark.createDataFrame([("a", "Normal"), ("b", "Warning"), ("c", "Critical"), ("d", "Normal")], "bike_id string, risk_grade string")
    at = spark.createDataFrame([("a", "S"), ("b", "S"), ("c", "S"), ("d", None)], "bike_id string, last_station_id string")
    assert one(decide.station_health(risk, at)) == [("S", 2, 33.3)]


def test_start_years(spark):
    rows = [("100", 2015), ("15000", 2017), ("25000", 2019), ("36000", 2021), ("45000", 2020), ("55000", 2022), ("75000", 2024), ("85000", 2020), ("none", 2021)]
    df = spark.createDataFrame([(n,) for n, _ in rows], "n string")
    got = df.select(values.start_year(F.concat(F.lit("SPB-"), "n"), F.lit(date(2021, 5, 1)))).collect()
    assert [r[0] for r in got] == [y for _, y in rows]


def test_values(spark):
    df = spark.createDataFrame([("00108",), ("000",), ("A01",), ("0",)], "c string")
    assert [r[0] for r in df.select(values.without_zero_pad(F.col("c"))).collect()] == ["108", "0", "A01", "0"]
    assert [r[0] for r in df.select(values.falsy_to_null(F.col("c"))).collect()] == ["00108", None, "A01", None]
    assert spark.range(1).select(dates.rounded_int(F.lit("12.7")), dates.rounded_int(F.lit("")), values.half_even(F.lit("0.0025").cast("decimal(9,4)"), 3)).first()[:2] == (13, None)


def test_event_uuid(spark):
    import uuid

    ns = uuid.uuid5(uuid.NAMESPACE_URL, "x")
    names = ["a:COLLECT:2026-01-01", "자전거", ""]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r[0] for r in df.select(values.event_uuid(F.col("n"), ns)).collect()] == [str(uuid.uuid5(ns, n)) for n in names]


def test_event_reasons(spark):
    now = datetime(2026, 8, 1)
    rows = [("b", "COLLECT", datetime(2026, 7, 2, 4, 2), datetime(2026, 7, 2, 4, 1)), ("", "", None, None), ("b", "MOVE", datetime(2026, 6, 1), None), ("b", "DEPLOY", datetime(2026, 7, 1), None)]
    df = spark.createDataFrame(rows, "bike_id string, event_type string, occurred_at timestamp, received_at timestamp")
    got = [r.quarantine_reason for r in cleanse.classify_events(df, now, date(2026, 6, 30), ("COLLECT", "DEPLOY")).collect()]
    assert got == ["occurred_after_received", "null_bike_id,null_event_type,null_occurred_at", "invalid_event_type:MOVE,occurred_before_service_start", None]


def test_recent_list(spark):
    df = spark.createDataFrame([("a", i) for i in range(1, 8)], "k string, d int")
    assert latest.recent_list(df, "k", "d", F.col("d").cast("string"), 5, []).first().entries == ["7", "6", "5", "4", "3"]


def test_deploy_targets_collect_wins_a_tie(spark):
    at = datetime(2026, 1, 1, 9)
    df = spark.createDataFrame([("a", "DEPLOY", at, "S1"), ("a", "COLLECT", at, "S2"), ("b", "COLLECT", datetime(2025, 12, 30), "S"), ("c", "COLLECT", datetime(2026, 1, 2), "S")], "bike_id string, event_type string, occurred_at timestamp, station_id string")
    assert one(marts.deploy_targets(df, date(2026, 1, 2))) == [("a", "S2")]


def test_quality(spark):
    df = spark.createDataFrame([("A", 1), ("A", None), ("A", -1), ("B", 2)], "k string, v int")
    c = quality.Check("t").complete("v").contained("k", ["A"]).non_negative("v").satisfies(F.col("v") > 0, "positive").uniqueness(["k"], 0.25).min_rows(5)
    assert [(r.name, r.status, r.violations) for r in c.run(df)] == [("complete(v)", "FAIL", 1), ("contained(k)", "FAIL", 1), ("non_negative(v)", "FAIL", 1), ("satisfies(positive)", "FAIL", 2), ("min_rows(5)", "FAIL", 1), ("uniqueness(k)", "PASS", 3)]
    assert quality.uniqueness_ratio(df, ["k"]).first().uniqueness == 0.25
    empty = df.limit(0)
    assert all(r.status == "PASS" for r in quality.Check("t").complete("v").uniqueness(["k"]).run(empty))
    with pytest.raises(quality.QualityError):
        quality.Check("t").min_rows(1).require(empty)


def test_average_precision(spark):
    rows = [(1, 0.9), (0, 0.8), (1, 0.8), (0, 0.5), (1, 0.1)]
    df = spark.createDataFrame(rows, "label int, score double")
    want = (1 / 3) * 1 + (1 / 3) * (2 / 3) + (1 / 3) * (3 / 5)
    assert abs(ranking.average_precision(df).first()[0] - want) < 1e-12


def test_rescale(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 3.0), ("c", 5.0)], "k string, capacity double")
    assert {r.k: r.capacity for r in ranking.rescaled(df, F.col("k") != "c", 8.0).collect()} == {"a": 2.0, "b": 6.0, "c": 5.0}
    zero = df.withColumn("capacity", F.lit(0.0))
    assert {r.capacity for r in ranking.rescaled(zero, F.lit(True), 6.0).collect()} == {2.0}


def test_anchor_calendar():
    c = range_features.anchor_calendar(date(2026, 3, 1), 14)
    assert len(c["holdout"]) == 60 and (c["holdout"][0] - c["train"][-1]).days == 14
    assert range_features.label_ready_until(date(2026, 3, 1), date(2026, 3, 10), 14) == date(2026, 2, 24)


def test_gate_and_best():
    assert ranking.gate(4.0, None)["passed"] and ranking.gate(4.0, 5.0)["passed"] and not ranking.gate(2.0, 5.0)["passed"]
    assert ranking.select_best({"a": {"capture_at_k": 1}, "b": {"capture_at_k": 1}}, "b") == "b"


def test_decisions_of_a_hot_station(spark):
    """Only the rows within the largest capacity are ranked, and the answers are those of a plain ranking."""
    import random

    rng = random.Random(5)
    risk = [(i, float(rng.randrange(300)), rng.choice(["Critical", "Warning", "Warning", "Normal"])) for i in range(900)]
    place = {i: "hot" if i % 3 else f"s{i % 7}" for i, _, _ in risk}
    free = {"hot": (400, 120), "s0": (60, 50), "s1": (10, 50), "s3": (None, 5)}
    df = spark.createDataFrame(risk, "bike_id long, risk_score double, risk_grade string")
    loc = spark.createDataFrame(list(place.items()), "bike_id long, last_station_id string")
    inv = spark.createDataFrame([(s, b, t) for s, (b, t) in free.items()], "station_id string, bike_cnt int, target_bike_cnt int")
    want = {}
    for s in set(place.values()):
        mine = sorted((r for r in risk if place[r[0]] == s), key=lambda r: (-r[1], r[0]))
        b, t = free.get(s, (None, None))
        room = max(0, max(0, b - t) - sum(g == "Critical" for _, _, g in mine)) if b is not None else 0
        want |= {i: "suspend" if g == "Critical" or (g == "Warning" and n <= room) else "hold" for n, (i, _, g) in enumerate(mine, 1)}
    out = decide.decisions(df, loc, inv)
    assert {r.bike_id: r.action for r in out.collect()} == want and "suspend" in want.values()
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


def test_absent_scores_come_last(spark):
    df = spark.createDataFrame([(0.9, 1), (0.5, 0), (None, 1), (0.5, 1)], "score double, label int")
    assert abs(ranking.average_precision(df).first().average_precision - (1 + 2 / 3 + 3 / 4) / 3) < 1e-12
