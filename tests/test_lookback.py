"""Look-back features by running sums against a plain count over every window."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from velora.operators import range_features as rf

DAY0 = date(2024, 1, 1)


def brute(rows, anchors, back, ahead):
    """Per (anchor, vehicle) with a row in the longest window: last day and sums by window."""
    out = {}
    for a in anchors:
        for bike in {b for b, _, _ in rows}:
            held = [[(d, v) for b, d, v in rows if b == bike and d is not None and (w is None or d >= a - timedelta(days=w)) and d < a + timedelta(days=ahead)] for w in back]
            if held[0]:
                out[a, bike] = (max(d for d, _ in held[0]), *(sum(v for _, v in h) for h in held))
    return out


@pytest.mark.parametrize(("back", "ahead"), [([14, 7], 0), ([14, 7], 1), ([None, 30], 0), ([None, 30], 1), ([5], 0), ([1], 1), ([40, 40], 0), ([9, 2, 5], 0)])
def test_anchored_sums(spark, back, ahead):
    """Sparse and dense vehicles, several rows of a day, gaps longer than every window, and rows before and after all anchors."""
    rng = random.Random(str(back))
    rows = [(b, DAY0 + timedelta(days=rng.randrange(0, 120 if b != "dense" else 40)), rng.randrange(1, 9)) for b in ("a", "b", "dense", "gap") for _ in range(40 if b == "dense" else 8)]
    rows += [("gap", DAY0 + timedelta(days=300), 5), ("old", DAY0 - timedelta(days=500), 2), ("none", None, 3)]
    anchors = [DAY0 + timedelta(days=x) for x in [*range(20, 50), 57, 64, 71, 200]]
    df = spark.createDataFrame(rows, "bike_id string, day date, v int")
    got = rf.anchored_sums(df, "day", {"v": F.col("v")}, rng.sample(anchors, len(anchors)), back, ahead).collect()
    assert {(r.as_of, r.bike_id): (r.last_day, *(r[f"v_{i}"] for i in range(len(back)))) for r in got} == brute(rows, anchors, back, ahead)
    assert len(got) == len({(r.as_of, r.bike_id) for r in got})


@pytest.mark.parametrize("days", [1, 5, 30])
def test_reports_before_and_after(spark, days):
    rng = random.Random(days)
    rows = [(b, DAY0 + timedelta(days=rng.randrange(0, 90))) for b in "abc" for _ in range(9)] + [("d", None)]
    anchors = [DAY0 + timedelta(days=x) for x in (*range(10, 40), 60, 88)]
    df = spark.createDataFrame(rows, "bike_id string, reg_date date")
    span = timedelta(days=days)
    recent = {(a, b) for a in anchors for b, d in rows if d and a - span <= d < a}
    soon = {(a, b) for a in anchors for b, d in rows if d and a <= d < a + span}
    for got, want in ((rf.recently_reported(df, anchors, days), recent), (rf.positives(df, anchors, days), soon)):
        pairs = [(r.as_of, r.bike_id) for r in got.collect()]
        assert len(pairs) == len(set(pairs)) and set(pairs) == want


def test_a_row_is_not_repeated_for_its_windows(spark):
    """160 anchors and an open window: rows between scan and aggregation follow vehicles and anchors, not rows and windows."""
    anchors = [DAY0 + timedelta(days=x) for x in range(160)]
    df = spark.range(20_000).select((F.col("id") % 20).alias("bike_id"), F.date_add(F.lit(DAY0), (F.col("id") % 150).cast("int")).alias("reg_date"))
    plan = rf.fault_features(df, anchors, fail_window=30)
    assert plan.count() == sum(len([a for a in anchors if a > DAY0 + timedelta(days=b % 10)]) for b in range(20))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1 and "NestedLoop" not in text and "Cartesian" not in text
