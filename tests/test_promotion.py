import uuid
from datetime import date, datetime

import pytest
from pyspark.sql.types import StructType

from velora.operators import promotion
from velora.operators.events import events_for
from velora.sources.objects import ObjectStore
from velora.sources.tables import Table

SCHEMA = StructType().add("v", "integer").add("day", "string")
AT = datetime(2026, 1, 9)


def test_promotion(spark, tmp_path):
    t, store = Table(spark, f"file://{tmp_path}/t", SCHEMA, "day"), ObjectStore(spark, f"file://{tmp_path}/s")
    payload = lambda *v: spark.createDataFrame([(x,) for x in v], "v int")
    days = [date(2026, 1, d) for d in range(1, 9)]
    assert promotion.catch_up(t, {d: payload(d.day, d.day) for d in days}, store, "x", AT) == 2
    assert promotion.promote(t, {days[0]: payload(7)}, store, "x", AT) == {days[0]: 1}
    assert t.read().count() == 15 and promotion.finished_days(store, "x") == days
    with pytest.raises(ValueError):
        promotion.promote(t, {days[1]: payload(1), days[2]: payload(1).limit(0)}, store, "x", AT)
    assert t.read().count() == 15
    with pytest.raises(ValueError):
        promotion.confirm_empty(store, "x", date(2026, 1, 9), days[-1], {"hours": list(range(23)), "rows": 0}, AT)
    promotion.confirm_empty(store, "x", date(2026, 1, 9), days[-1], {"hours": list(range(24)), "rows": 0}, AT)
    assert promotion.finished_days(store, "x")[-1] == date(2026, 1, 9)
    again = promotion.rebuild(t, "v")
    assert again.partitions() == sorted(str(v) for v in range(2, 9)) and again.read().count() == 15
    assert promotion.collect_stats(again.read(), "day").first().days == 8
    assert not promotion.append_quietly(again, payload(1))
    promotion.write_samples(again.read().withColumnRenamed("day", "snapshot_date"), f"file://{tmp_path}/samples", "train")
    assert spark.read.parquet(f"file://{tmp_path}/samples").where("anchor_type = 'train'").count() == 15


def test_events_repeat(spark):
    targets = spark.createDataFrame([("a", "S1"), ("b", None)], "bike_id string, station_id string")
    ns = uuid.uuid5(uuid.NAMESPACE_URL, "x")
    first, second = (sorted(tuple(r) for r in events_for(targets, "COLLECT", date(2026, 1, 1), ns).collect()) for _ in range(2))
    assert first == second and {r[0] for r in first} == {str(uuid.uuid5(ns, f"{b}:COLLECT:2026-01-01")) for b in "ab"}
