"""Features by anchor come finished from one pass over a vehicle's days: nothing is grouped, joined or shuffled by anchor."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from velora.operators import range_features as rf

DAY0 = date(2024, 1, 1)
ANCHORS = [DAY0 + timedelta(days=x) for x in (*range(20, 50), 57, 64, 71)]


def behind_anchors(df) -> str:
    """What the plan does with rows after they were made for anchors."""
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "Generate explode" in text
    return text[: text.index("Generate explode")]


def tables(spark, seed=3):
    rng = random.Random(seed)
    trips = [(b, DAY0 + timedelta(days=rng.randrange(90)), rng.choice([None, 5.0, 900.0]), float(rng.randrange(9)), "A", rng.choice("AB")) for b in "abcd" for _ in range(25)]
    faults = {(b, DAY0 + timedelta(days=rng.randrange(95))) for b in "abcx" for _ in range(12)}
    made = spark.createDataFrame(trips, "bike_id string, rent_at date, dist_m double, dur_min double, rent_station string, return_station string")
    return made, spark.createDataFrame(sorted(faults), "bike_id string, reg_date date"), trips, faults


def test_nothing_is_grouped_by_anchor(spark):
    trips, faults, _, _ = tables(spark)
    for df in (rf.fault_features(faults, ANCHORS, 30), rf.usage_of(trips, ANCHORS, 14), rf.samples(trips, faults, ANCHORS, F.lit("normal"))):
        above = behind_anchors(df)
        assert not any(x in above for x in ("Aggregate", "Join", "Exchange", "Sort")), above


@pytest.mark.parametrize("how", [{}, {"include_today": True}, {"lookback": 9, "fail_window": 20}, {"lookback": 40, "fail_window": 20, "include_today": True}, {"exclude_days": 0}, {"lookback": 3, "exclude_days": 25, "horizon": 1}, {"labels": False}])
def test_samples_equal_a_plain_count(spark, how):
    trips, faults, used, reported = tables(spark)
    p = {"window": 14, "horizon": 5, "exclude_days": 6, "fail_window": 30, "lookback": None, "include_today": False, "labels": True} | how
    back = lambda a, n: a - timedelta(days=n)
    want = {}
    for a in ANCHORS:
        for b in "abcdx":
            mine = [t for t in used if t[0] == b and back(a, p["window"]) <= t[1] < a]
            if not mine:
                continue
            known = [d for x, d in reported if x == b and (d < a or (d == a and p["include_today"])) and (p["lookback"] is None or d >= back(a, p["lookback"]))]
            late = sum(t[1] >= back(a, p["window"] // 2) for t in mine)
            soon = any(x == b and a <= d < back(a, -p["horizon"]) for x, d in reported)
            want[a, b] = (len(mine), round(sum(t[2] or 0 for t in mine) / 1000, 9), sum(t[4] == t[5] and t[2] is not None and t[2] <= 10 for t in mine), sum(d >= back(a, p["fail_window"]) for d in known), (a - max(known)).days if known else 9999,
                          (a - max(t[1] for t in mine)).days, round((late + 1) / (len(mine) - late + 1), 9), round(sum(t[3] for t in mine) / 60, 9), int(soon) if p["labels"] else None, any(x == b and back(a, p["exclude_days"]) <= d < a for x, d in reported))
    got = rf.samples(trips, faults, ANCHORS, F.lit("normal"), **p).collect()
    rounded = {(r.snapshot_date, r.bike_id): tuple(round(v, 9) if isinstance(v, float) else v for v in r[2:-1]) for r in got}
    assert len(got) == len(want) and rounded == want
