"""Connected components of a link table, by alternating large and small stars (Kiveris et al. 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velora.llm.common import scratch, shared_table


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node with a link to another; ``component`` is the smallest node it reaches.

    Links are rows of two longs in any direction; repeated rows, loops and nulls do no harm.  Every round is two
    aggregations and two joins over the links, written to the shared folder; the driver sees a count and a checksum.
    The number of rounds grows with the logarithm of a component's diameter.
    """
    spark = links.sparkSession
    e = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct()
    with scratch(spark) as keep:
        e, before = shared_table(e, "links"), None
        while True:
            now = e.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
            if now == before or not now.n:
                keep(e)
                break
            before = now
            both = e.select(F.col("u").alias("x"), F.col("v").alias("y")).unionByName(e.select(F.col("v").alias("x"), F.col("u").alias("y")))
            least = both.groupBy("x").agg(F.least(F.min("y"), F.first("x")).alias("m"))
            large = both.where("y > x").join(least, "x").select(F.col("y").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
            low = large.groupBy("u").agg(F.min("v").alias("m"))
            near = large.join(low, "u")
            small = near.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").unionByName(low.select("u", F.col("m").alias("v"))).distinct()
            e = shared_table(small, "links")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
