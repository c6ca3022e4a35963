"""All registered queries and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None, days: tuple[str, ...] = ()) -> Callable[[Query], Query]:
    """Registers a function under its name, with DuckDB SQL for the same rows if SQL can express them.

    The columns in ``days`` are dates; both sides return them as ISO text, as clients differ in how they show a date.
    """

    def keep(f: Query) -> Query:
        QUERIES[f.__name__] = (lambda spark, d: f(spark, d).withColumns({c: F.col(c).cast("string") for c in days})) if days else f
        if sql is not None:
            ORACLE[f.__name__] = f"SELECT * REPLACE ({', '.join(f'CAST(CAST({c} AS DATE) AS VARCHAR) AS {c}' for c in days)}) FROM ({sql})" if days else sql
        return f

    return keep


def _load() -> None:
    from velora.plans import features, ingest, inspection, places, quality, services, serving, storage  # noqa: F401


def queries() -> dict[str, Query]:
    _load()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(ORACLE)
