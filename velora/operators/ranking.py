"""Ranking evaluation and capacity splits."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from velora.operators.running import running
from velora.sources.tables import written


def capture_at_k(scored: DataFrame, positives: DataFrame, k: int, day: str = "as_of", key: str = "bike_id", score: str = "score") -> DataFrame:
    """By day: the share of positives among the k best, in percent; days without positives or rows are left out."""
    rank = F.row_number().over(Window.partitionBy(day).orderBy(F.desc_nulls_last(score), key))
    top = scored.withColumn("__rank", rank).where(F.col("__rank") <= k)
    hits = top.join(positives.select(day, key), [day, key], "left_semi").groupBy(day).agg(F.count(F.lit(1)).alias("hits"))
    sizes = positives.groupBy(day).agg(F.count(F.lit(1)).alias("positives")).join(scored.select(day).distinct(), day, "left_semi")
    share = F.coalesce("hits", F.lit(0)) * 100.0 / F.col("positives")
    return sizes.join(hits, day, "left").select(day, "positives", F.coalesce("hits", F.lit(0)).alias("hits"), F.round(share.cast("double"), 2).alias("capture"))


def capture_summary(capture: DataFrame) -> DataFrame:
    c = F.col("capture")
    return capture.agg(F.round(F.avg(c), 3).alias("capture_at_k"), F.round(F.stddev_samp(c), 3).alias("capture_std"), F.round(F.min(c), 3).alias("capture_min"), F.count(c).alias("eval_days"))


def average_precision(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Precision at each threshold, weighted by the recall that it adds; equal scores are one threshold, absent ones the last.

    Rows are added up by score and written once; the running sums then run over distinct scores, range by range.
    """
    points = scored.groupBy(score).agg(F.sum(label).alias("tp"), F.count(F.lit(1)).alias("n"))
    ordered = written(points.select(F.col(score).isNull().cast("int").alias("absent"), (-F.col(score)).alias("at"), "tp", "n"), "points")
    run = running(ordered, ["absent", "at"], {"r_tp": "tp", "r_n": "n"})
    return run.agg((F.sum(F.col("tp") * F.col("r_tp") / F.col("r_n")) / F.sum("tp")).alias("average_precision"))


def within_capacity(df: DataFrame, group: str, capacity: Column, score: str, key: str) -> DataFrame:
    """``in_capacity``: whether a row is among its group's first round(capacity) by score; never negative.

    Only the rows within the largest capacity are ranked: that is a constant, so every task passes on so many rows of a
    group at most, and a group with a large part of all rows is never sorted in one task.
    """
    room = F.greatest(F.lit(0), F.floor(capacity + 0.5)).cast("long")
    largest = df.agg(F.max(room).alias("n")).first().n or 0
    rank = F.row_number().over(Window.partitionBy(group).orderBy(F.desc(score), key))
    ranked = df.select(key, group, score, room.alias("__room")).withColumn("__rank", rank).where(F.col("__rank") <= int(largest))
    inside = ranked.where("__rank <= __room").select(key, group, score).distinct().withColumn("__in", F.lit(True))  # rows equal in all three share their fate
    same = reduce(lambda x, y: x & y, [F.col(f"d.{c}").eqNullSafe(F.col(f"i.{c}")) for c in (key, group, score)])
    return df.alias("d").join(inside.alias("i"), same, "left").select("d.*", F.coalesce("__in", F.lit(False)).alias("in_capacity"))


def within_total(df: DataFrame, capacity: float, score: str, key: str) -> DataFrame:
    """The same over all rows; only the first round(capacity) rows meet (top-n), not the whole table."""
    top = df.orderBy(F.desc(score), key).limit(max(0, int(capacity + 0.5))).select(key).withColumn("__top", F.lit(True))
    return df.join(top, key, "left").withColumn("in_capacity", F.coalesce("__top", F.lit(False))).drop("__top")


def even_split(keys: DataFrame, total: float) -> DataFrame:
    """The same capacity for every key."""
    n = keys.agg(F.count(F.lit(1)).alias("__n"))
    return keys.join(F.broadcast(n), F.lit(True)).withColumn("capacity", F.lit(float(total)) / F.col("__n")).drop("__n")


def rescaled(capacities: DataFrame, chosen: Column, target: float) -> DataFrame:
    """The chosen keys' capacities in proportion to a new sum; evenly, if their sum is 0; others stay."""
    sums = capacities.where(chosen).agg(F.coalesce(F.sum("capacity"), F.lit(0.0)).alias("__sum"), F.count(F.lit(1)).alias("__n"))
    new = F.when(F.col("__sum") > 0, F.col("capacity") * F.try_divide(F.lit(float(max(0.0, target))), F.col("__sum"))).otherwise(F.try_divide(F.lit(float(max(0.0, target))), F.col("__n")))
    return capacities.join(F.broadcast(sums), F.lit(True)).withColumn("capacity", F.when(chosen, new).otherwise(F.col("capacity"))).drop("__sum", "__n")


def select_best(metrics: Mapping[str, Mapping], primary: str, key: str = "capture_at_k") -> str:
    """The candidate with the largest metric; the primary one wins a tie."""
    known = {n: m[key] for n, m in metrics.items() if m.get(key) is not None}
    if not known:
        raise ValueError("no candidate could be evaluated")
    best = [n for n, v in known.items() if v == max(known.values())]
    return primary if primary in best else best[0]


def gate(new: float, champion: float | None, max_drop: float = 2.0) -> dict:
    """Whether a new model may replace the champion; the first one always may."""
    if champion is None:
        return {"passed": True, "delta": None}
    delta = round(new - champion, 3)
    return {"passed": delta >= -max_drop, "delta": delta}
