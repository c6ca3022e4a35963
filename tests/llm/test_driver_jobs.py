"""What the driver does for an operator must not follow the number of partitions."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from velora.llm.common import bitmap_of, collect_finished, merge_pieces


@pytest.fixture
def many_partitions(spark):
    names = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def jobs_of(spark, group, run):
    spark.sparkContext.setJobGroup(group, group)
    try:
        return run(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_merged_pieces_come_in_few_jobs(spark, many_partitions):
    """Each of the 40 shuffled partitions was a job of its own, and on check_h each of 211."""
    pieces = spark.range(0, 3000, 1, 6).select((F.col("id") % 100).cast("int").alias("piece"), F.encode((F.col("id") % 7).cast("string"), "utf-8").alias("value"))
    merge = lambda t: str(sum(int(x.as_py()) for x in t.column("value"))).encode()
    got, jobs = jobs_of(spark, "pieces", lambda: list(merge_pieces(pieces, merge, "value")))
    assert {k: int(v) for k, v in got} == {k: sum(i % 7 for i in range(k, 3000, 100)) for k in range(100)} and len(got) == 100
    assert 0 < jobs <= 12


def test_bitmap_has_all_keys_in_few_jobs(spark, many_partitions):
    keys = spark.range(0, 50_000, 1, 6).select((F.col("id") * 7919 - 11).alias("key"))
    bitmap, jobs = jobs_of(spark, "bitmap", lambda: bitmap_of(keys, "key"))
    assert bitmap.has(keys.toArrow().column("key").to_numpy()).all()
    assert 0 < jobs <= 16


@pytest.mark.parametrize("free, collected", [(700, 0), (300, 1)])
def test_garbage_of_finished_queries_is_collected(free, collected):
    calls = []
    heap = SimpleNamespace(totalMemory=lambda: 720, freeMemory=lambda: free, maxMemory=lambda: 750)
    java = SimpleNamespace(Runtime=SimpleNamespace(getRuntime=lambda: heap), System=SimpleNamespace(gc=lambda: calls.append(1)))
    collect_finished(SimpleNamespace(_jvm=SimpleNamespace(java=SimpleNamespace(lang=java))))
    assert len(calls) == collected
