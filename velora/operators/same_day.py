"""Processing of the current day, whose data are still growing."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velora.operators.policy import inherited_mode
from velora.operators.state import marker
from velora.sources.objects import ObjectStore
from velora.sources.tables import Table


def same_day_key(dataset: str, day: date, promotion_id: str) -> str:
    return f"same-day/{dataset}/{day.isoformat()}/{promotion_id}.json"


def process_same_day(table: Table, rows: DataFrame, promotion: Mapping, confirmed: date, at: datetime) -> dict | None:
    """Replaces the day of a promotion and returns the marker to be stored; None if the promotion does not ask for the day.

    The watermark stays at ``confirmed``, as a later run writes the day again once it is complete.  The marker is stored by
    ``finish_same_day`` after the watermark, so it is always the last thing written.
    """
    if promotion.get("status") != "COMPLETE":
        raise ValueError(f"promotion {promotion.get('promotion_id')} is not complete")
    if promotion.get("same_day") is not True:
        return None
    day = date.fromisoformat(promotion["run_date"])
    mine = [s for s in promotion.get("snapshots", ()) if s["target_date"] == day.isoformat()]
    if not mine:
        raise ValueError(f"the promotion has no snapshot of {day}")
    table.replace_partitions(rows, [day.isoformat()])
    written = table.read(F.col(table.partition).cast("string") == day.isoformat()).count()
    mode = inherited_mode(promotion.get("mode"), mine[0]["snapshot_type"])
    return marker("COMPLETE", day, at, promotion_id=promotion["promotion_id"], mode=mode, snapshot_type=mine[0]["snapshot_type"], rows=written, confirmed_through=confirmed.isoformat())


def finish_same_day(store: ObjectStore, dataset: str, document: Mapping) -> None:
    store.put_json(same_day_key(dataset, date.fromisoformat(document["date"]), document["promotion_id"]), dict(document))
