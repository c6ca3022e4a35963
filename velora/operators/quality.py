"""Quality checks: all constraints of a table in one aggregation, metric checks by SQL, and training gates."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class QualityError(ValueError):
    """At least one constraint failed."""


@dataclass(frozen=True)
class Result:
    name: str
    status: str
    violations: int
    total: int


@dataclass
class Check:
    """Constraints are collected first and answered by one scan (uniqueness takes one more aggregation each)."""

    name: str
    simple: list[tuple[str, Column]] = field(default_factory=list)
    unique: list[tuple[str, Sequence[str], float]] = field(default_factory=list)
    rows: int | None = None

    def complete(self, column: str) -> Check:
        self.simple.append((f"complete({column})", F.col(column).isNull()))
        return self

    def contained(self, column: str, values: Sequence) -> Check:
        """NULL passes."""
        self.simple.append((f"contained({column})", F.col(column).isNotNull() & ~F.col(column).isin(*values)))
        return self

    def non_negative(self, column: str) -> Check:
        """NULL passes."""
        self.simple.append((f"non_negative({column})", F.col(column) < 0))
        return self

    def satisfies(self, condition: Column, name: str) -> Check:
        """False and NULL both violate."""
        self.simple.append((f"satisfies({name})", ~F.coalesce(condition, F.lit(False))))
        return self

    def uniqueness(self, columns: Sequence[str], threshold: float = 1.0) -> Check:
        """The share of rows whose key occurs once must reach the threshold."""
        self.unique.append((f"uniqueness({','.join(columns)})", columns, threshold))
        return self

    def min_rows(self, n: int) -> Check:
        """The only check that an empty table fails."""
        self.rows = n
        return self

    def table(self, df: DataFrame) -> DataFrame:
        """One row per constraint: ``constraint, status, violations, total``; lazily."""
        sums = [F.count(F.when(broken, 1)).alias(f"c{i}") for i, (_, broken) in enumerate(self.simple)]
        one = df.agg(F.count(F.lit(1)).alias("total"), *sums)
        rows = [F.struct(F.lit(n).alias("constraint"), F.col(f"c{i}").alias("violations"), (F.col(f"c{i}") == 0).alias("ok")) for i, (n, _) in enumerate(self.simple)]
        if self.rows is not None:
            short = F.greatest(F.lit(0).cast("long"), F.lit(self.rows).cast("long") - F.col("total"))
            rows.append(F.struct(F.lit(f"min_rows({self.rows})").alias("constraint"), short.alias("violations"), (short == 0).alias("ok")))
        status = F.when(F.col("ok"), "PASS").otherwise("FAIL")
        out = one.select("total", F.explode(F.array(*rows)).alias("r")).select("r.constraint", "r.violations", "total", "r.ok") if rows else None
        for name, columns, threshold in self.unique:
            once = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count(F.when(F.col("n") == 1, 1)).alias("once"))
            ok = (F.col("total") == 0) | (F.col("once") >= F.lit(threshold) * F.col("total"))
            row = once.select(F.lit(name).alias("constraint"), (F.col("total") - F.col("once")).alias("violations"), "total", ok.alias("ok"))
            out = row if out is None else out.unionByName(row)
        return out.select("constraint", status.alias("status"), "violations", "total")

    def run(self, df: DataFrame) -> list[Result]:
        return [Result(r["constraint"], r.status, r.violations, r.total) for r in self.table(df).collect()]  # one row per constraint

    def require(self, df: DataFrame) -> list[Result]:
        results = self.run(df)
        failed = [r for r in results if r.status == "FAIL"]
        if failed:
            raise QualityError(f"{self.name}: " + "; ".join(f"{r.name}: {r.violations} of {r.total}" for r in failed))
        return results


def uniqueness_ratio(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows whose key occurs once, over all rows."""
    counts = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg((F.count(F.when(F.col("n") == 1, 1)) / F.sum("n")).alias("uniqueness"))


COMPARE = {"lte": lambda v, t: v <= t, "gte": lambda v, t: v >= t, "eq": lambda v, t: v == t}


def metric_checks(spark: SparkSession, checks: Sequence[dict]) -> list[dict]:
    """Each check's ``metric_sql`` against its threshold: PASS, FAIL, MONITOR without one, ERROR for that check alone."""
    out = []
    for c in checks:
        row = {"name": c["name"], "threshold": c.get("threshold"), "value": None}
        try:
            got = spark.sql(c["metric_sql"]).first()
            row["value"] = float(got[0]) if got is not None and got[0] is not None else 0.0
            known = c.get("threshold") is not None
            row["status"] = ("PASS" if COMPARE[c.get("operator", "lte")](row["value"], c["threshold"]) else "FAIL") if known else "MONITOR"
        except (PySparkException, TypeError, ValueError) as e:  # the statement fails, or its value is no number
            row |= {"status": "ERROR", "error": str(e)[:500]}
        out.append(row)
    return out


def history_before(history: DataFrame, day, days: int = 14) -> DataFrame:
    """Earlier results of the look-back window, without the day itself."""
    return history.where((F.col("execution_date") < F.lit(day)) & (F.col("execution_date") >= F.date_sub(F.lit(day), days)))


def training_report(df: DataFrame, features: Sequence[str], anchor: str = "snapshot_date", label: str = "label") -> dict:
    """Rows, anchors, share of positives and NULL shares in one aggregation."""
    nulls = [F.avg(F.col(c).isNull().cast("int")).alias(f"null_{c}") for c in features]
    return df.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct(anchor).alias("anchors"), F.avg(label).alias("positive_rate"), *nulls).first().asDict()


def training_gate(report: dict, min_rows: int, min_anchors: int, rate: tuple[float, float], max_null: float) -> list[str]:
    """What is wrong with a training set; nothing if it may be used."""
    wrong = []
    if report["rows"] < min_rows:
        wrong.append(f"{report['rows']} rows, fewer than {min_rows}")
    if report["anchors"] < min_anchors:
        wrong.append(f"{report['anchors']} anchors, fewer than {min_anchors}")
    if not rate[0] <= (report["positive_rate"] or 0) <= rate[1]:
        wrong.append(f"positive rate {report['positive_rate']}")
    return wrong + [f"{k}: {v}" for k, v in report.items() if k.startswith("null_") and (v or 0) > max_null]
