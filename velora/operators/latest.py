"""Deterministic choices among the rows of a key: dedupe, latest, top-n, and the merge of a state with what is new."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first n rows of each key in an order with explicit places for NULL.

    Spark prunes to n rows per key before the shuffle (WindowGroupLimit), so a hot key sends n rows per task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).where(F.col("__rank") <= n).drop("__rank")


def latest(df: DataFrame, keys: Sequence[str], at: str, ties: Sequence[str]) -> DataFrame:
    """The newest row of each key; equal times are settled by the tie columns, so every run picks the same row."""
    return first_rows(df, keys, [F.desc_nulls_last(at), *(F.asc_nulls_last(t) for t in ties)])


def latest_values(df: DataFrame, key: str, at: str, values: Sequence[str]) -> DataFrame:
    """``latest`` as an aggregate: only one struct per key and task crosses the shuffle."""
    newest = F.max(F.struct(at, *values)).alias("newest")
    return df.where(F.col(at).isNotNull()).groupBy(key).agg(newest).select(key, f"newest.{at}", *(f"newest.{v}" for v in values))


def merge_state(base: DataFrame, delta: DataFrame, key: str, at: str, values: Sequence[str]) -> DataFrame:
    """Baseline and delta by key; the delta wins only if it is strictly newer, and then with its NULLs."""
    b, d = base.alias("b"), delta.alias("d")
    newer = F.col(f"d.{at}").isNotNull() & (F.col(f"b.{at}").isNull() | (F.col(f"d.{at}") > F.col(f"b.{at}")))
    pick = [F.when(newer, F.col(f"d.{c}")).otherwise(F.col(f"b.{c}")).alias(c) for c in (*values, at)]
    return b.join(d, F.col(f"b.{key}") == F.col(f"d.{key}"), "full").select(F.coalesce(f"b.{key}", f"d.{key}").alias(key), *pick)


def new_keys(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    return df.join(known.select(key), key, "left_anti")


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows of ``child`` whose key ``parent`` lacks."""
    return child.join(parent.select(key).distinct(), key, "left_anti")


def recent_list(df: DataFrame, key: str, at: str, entry: Column, n: int, ties: Sequence[str]) -> DataFrame:
    """The newest n entries of each key as an array, newest first; at most n rows of a key are ever collected."""
    ranked = first_rows(df.withColumn("__entry", entry), [key], [F.desc_nulls_last(at), *(F.asc_nulls_last(t) for t in ties)], n)
    place = F.row_number().over(Window.partitionBy(key).orderBy(F.desc_nulls_last(at), *(F.asc_nulls_last(t) for t in ties)))
    packed = F.array_sort(F.collect_list(F.struct(F.col("__place"), F.col("__entry"))))
    return ranked.withColumn("__place", place).groupBy(key).agg(F.transform(packed, lambda x: x["__entry"]).alias("entries"))
