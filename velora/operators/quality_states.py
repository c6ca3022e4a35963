"""Quality measures that are taken once a partition, stored, and merged for any range of partitions.

A state is one row a partition: rows, violations of each constraint, and sums, bounds and NULLs of number columns, all in
one scan.  A uniqueness constraint needs more, as a key may come back in another partition.  Where the partition column is
part of the key it cannot, and the state holds two numbers (rows, and rows whose key occurs once).  Elsewhere it holds the
keys' counts under 128 bits of hashes, which add up when states are merged.  No merge reads the table again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from velora.operators.quality import COMPARE, Check


@dataclass(frozen=True)
class Measures:
    """What is measured of a table: the constraints of a check, and sums and bounds of ``numbers``."""

    partition: str
    check: Check
    numbers: Sequence[str] = ()

    def _sums(self) -> list[str]:
        return ["rows", *(f"c{i}" for i in range(len(self.check.simple))), *(f"{k}_{c}" for c in self.numbers for k in ("nulls", "sum"))]

    def states(self, df: DataFrame) -> DataFrame:
        """One row a partition; an absent partition has none, and rows without partition are one of their own."""
        broken = [F.count(F.when(b, 1)).alias(f"c{i}") for i, (_, b) in enumerate(self.check.simple)]
        own = [x for c in self.numbers for x in (F.count(F.when(F.col(c).isNull(), 1)).alias(f"nulls_{c}"), F.coalesce(F.sum(c), F.lit(0)).alias(f"sum_{c}"), F.min(c).alias(f"low_{c}"), F.max(c).alias(f"high_{c}"))]
        return df.groupBy(self.partition).agg(F.count(F.lit(1)).alias("rows"), *broken, *own)

    def _merging(self) -> list[tuple[str, Column]]:
        sums = [(c, F.sum(c)) for c in self._sums()]
        return sums + [(f"low_{c}", F.min(f"low_{c}")) for c in self.numbers] + [(f"high_{c}", F.max(f"high_{c}")) for c in self.numbers]

    def merged(self, states: DataFrame) -> DataFrame:
        """One row for all partitions of ``states``; without any, counts are 0 and bounds NULL."""
        return states.agg(*(F.coalesce(e, F.lit(0)).alias(n) if n in self._sums() else e.alias(n) for n, e in self._merging()))

    def windowed(self, states: DataFrame, days: int) -> DataFrame:
        """For each stored day the merged state of the ``days`` days that end with it; ``states`` has a row a day."""
        span = Window.orderBy(F.datediff(F.col(self.partition).cast("date"), F.lit("1970-01-01").cast("date"))).rangeBetween(1 - days, 0)
        return states.select(self.partition, *(e.over(span).alias(n) for n, e in self._merging()))

    # uniqueness

    def _hashed(self, df: DataFrame) -> DataFrame:
        """``partition, u, h1, h2`` for every row and uniqueness constraint, in one pass."""

        def key(columns: Sequence[str]) -> list[Column]:
            parts = [x for c in columns for x in (F.coalesce(F.col(c).cast("string"), F.lit("")), F.col(c).isNull())]
            return [F.xxhash64(*parts).alias("h1"), F.xxhash64(F.lit(1), *parts).alias("h2")]

        each = F.array(*(F.struct(F.lit(u).alias("u"), *key(columns)) for u, (_, columns, _) in enumerate(self.check.unique)))
        return df.select(self.partition, F.explode(each).alias("k")).select(self.partition, "k.*")

    def key_states(self, df: DataFrame) -> DataFrame:
        """``partition, u, h1, h2, n, once``: a row for each key and its rows, or, where keys stay inside a partition, one
        row with NULL hashes that holds all rows and those whose key occurs once."""
        counts = self._hashed(df).groupBy(self.partition, "u", "h1", "h2").agg(F.count(F.lit(1)).alias("n"))
        inside = F.col("u").isin([u for u, (_, columns, _) in enumerate(self.check.unique) if self.partition in columns])
        classes = counts.where(inside).groupBy(self.partition, "u").agg(F.sum("n").alias("n"), F.count(F.when(F.col("n") == 1, 1)).alias("once"))
        none = F.lit(None).cast("long")
        kept = counts.where(~inside).select(self.partition, "u", "h1", "h2", "n", none.alias("once"))
        return kept.unionByName(classes.select(self.partition, "u", none.alias("h1"), none.alias("h2"), "n", "once"))

    def frequencies(self, key_states: DataFrame) -> DataFrame:
        """``u, total, once`` over all given partitions."""
        whole = key_states.where("once IS NOT NULL").groupBy("u").agg(F.sum("n").alias("total"), F.sum("once").alias("once"))
        keys = key_states.where("once IS NULL").groupBy("u", "h1", "h2").agg(F.sum("n").alias("n"))
        return whole.unionByName(keys.groupBy("u").agg(F.sum("n").alias("total"), F.count(F.when(F.col("n") == 1, 1)).alias("once")))

    def table(self, states: DataFrame, key_states: DataFrame | None = None) -> DataFrame:
        """What ``Check.table`` says of the rows behind the states: ``constraint, status, violations, total``."""
        row = lambda name, violations, ok: F.struct(F.lit(name).alias("constraint"), violations.cast("long").alias("violations"), ok.alias("ok"))
        rows = [row(n, F.col(f"c{i}"), F.col(f"c{i}") == 0) for i, (n, _) in enumerate(self.check.simple)]
        if self.check.rows is not None:
            short = F.greatest(F.lit(0), F.lit(self.check.rows) - F.col("rows"))
            rows.append(row(f"min_rows({self.check.rows})", short, short == 0))
        status = F.when(F.col("r.ok"), "PASS").otherwise("FAIL").alias("status")
        columns = ["r.constraint", status, "r.violations", F.col("rows").cast("long").alias("total")]
        out = self.merged(states).select("rows", F.explode(F.array(*rows)).alias("r")).select(*columns) if rows else None
        if self.check.unique:
            found = self.frequencies(key_states)
            named = F.array(*(F.struct(F.lit(u).alias("u"), F.lit(n).alias("name"), F.lit(float(t)).alias("least")) for u, (n, _, t) in enumerate(self.check.unique)))
            all_u = states.agg(F.lit(1)).select(F.explode(named).alias("x")).select("x.*")  # a row a constraint, also without keys
            both = all_u.join(F.broadcast(found), "u", "left").na.fill(0, ["total", "once"])
            ok = (F.col("total") == 0) | (F.col("once") >= F.col("least") * F.col("total"))
            unique = both.select(F.struct(F.col("name").alias("constraint"), (F.col("total") - F.col("once")).alias("violations"), ok.alias("ok")).alias("r"), F.col("total").alias("rows")).select(*columns)
            out = unique if out is None else out.unionByName(unique)
        return out


def table_metrics(df: DataFrame, checks: Sequence[Mapping]) -> list[dict]:
    """Metrics of one table, each an aggregate ``expr`` with an optional ``threshold`` and ``operator``, in one scan.

    A metric that cannot be resolved or is no number is ERROR; one that fails on the rows makes each be computed alone, so
    that the others keep their values.  No rows count as 0, as in ``metric_checks``.
    """

    def resolved(c: Mapping):
        try:
            return df.agg(F.expr(c["expr"]).cast("double").alias("v")) and None
        except PySparkException as e:
            return str(e)[:500]

    errors = {i: resolved(c) for i, c in enumerate(checks)}
    good = [i for i in errors if errors[i] is None]
    values: dict[int, float | None] = {}

    def compute(which: list[int]) -> None:
        first = df.agg(*(F.expr(checks[i]["expr"]).cast("double").alias(f"m{i}") for i in which)).first()
        values.update({i: first[f"m{i}"] for i in which})

    try:
        if good:
            compute(good)
    except PySparkException:
        for i in good:
            try:
                compute([i])
            except PySparkException as e:
                errors[i] = str(e)[:500]
    out = []
    for i, c in enumerate(checks):
        row = {"name": c["name"], "threshold": c.get("threshold"), "value": None}
        if errors[i] is not None:
            row |= {"status": "ERROR", "error": errors[i]}
        else:
            row["value"] = values[i] or 0.0
            known = c.get("threshold") is not None
            row["status"] = ("PASS" if COMPARE[c.get("operator", "lte")](row["value"], c["threshold"]) else "FAIL") if known else "MONITOR"
        out.append(row)
    return out
