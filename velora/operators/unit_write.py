"""Several tables and a marker written as one unit.

All rows are staged first; until then the tables are untouched and whatever stops the run is taken back.  Then one intent
is stored that names every swap in order and the marker.  From there the unit is decided: the swaps are made one after
the other, the marker last, and a run that stops in between leaves the intent, from which the next run makes the rest.
Every step may be repeated.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velora.operators.cleanse import quarantine_gate, with_reasons
from velora.operators.quality import Check
from velora.sources.objects import ObjectStore
from velora.sources.tables import Table, written


class Part(NamedTuple):
    """The rows that replace a table's partitions from ``low`` to ``high``."""

    table: Table
    rows: DataFrame
    low: str
    high: str


class UnitWrite:
    """One writer of a fixed set of tables; ``name`` tells its intent from others in the store."""

    def __init__(self, store: ObjectStore, name: str, tables: Sequence[Table]):
        self.store, self.key, self.tables = store, f"intent/{name}.json", {t.root: t for t in tables}

    def recover(self) -> bool:
        """Makes the rest of a stored intent, or takes back what was staged without one; whether there was an intent."""
        intent = self.store.get_json(self.key)
        if intent is None:
            for t in self.tables.values():
                t.recover()
                t.discard_stages()
            return False
        self._finish(intent)
        return True

    def _finish(self, intent: dict) -> None:
        for root, note in intent["swaps"]:
            self.tables[root].recover()
            self.tables[root].apply(note)
        if intent["marker"]:
            key, doc = intent["marker"]
            self.store.put_json(key, doc)
        self.store.delete(self.key)

    def write(self, parts: Sequence[Part], marker: tuple[str, Mapping] | None = None) -> None:
        """Replaces the ranges of all parts in their order, then stores the marker; all of it or nothing.

        Rows outside a part's range stop the unit before any table is touched.
        """
        self.recover()
        swaps = []
        try:
            for p in parts:
                note = p.table.prepare(p.rows, lambda v, p=p: p.low <= v <= p.high, f"range {p.low} to {p.high}")
                swaps.append((p.table.root, note))
        except BaseException:
            for root, note in swaps:
                self.tables[root].store.delete(note["stage"])
            raise
        intent = {"swaps": swaps, "marker": [marker[0], dict(marker[1])] if marker else None}
        self.store.put_json(self.key, intent)
        self._finish(intent)


def write_chunk(unit: UnitWrite, main: Table, quarantine: Table, rows: DataFrame, rules: Mapping[str, Column], low: str, high: str, marker: tuple[str, Mapping], check: Check | None = None, most: float = 0.01) -> dict[str, int]:
    """A cleansed range goes into two tables: broken rows with their reasons into ``quarantine``, the others into ``main``;
    the marker follows them and tells both counts.

    Too large a share of broken rows, or a failed check of the others, writes nothing.  Both ranges are replaced even where
    no row is broken, so a repeated run gives the same tables.
    """
    judged = written(with_reasons(rows, rules), "judged")
    counts = judged.agg(F.count(F.lit(1)).alias("total"), F.count("quarantine_reason").alias("broken")).first()
    quarantine_gate(counts.broken, counts.total, most)
    good = judged.where("quarantine_reason IS NULL").drop("quarantine_reason")
    if check is not None and counts.total:
        check.require(good)
    out = {"rows": counts.total - counts.broken, "quarantined": counts.broken}
    unit.write([Part(quarantine, judged.where("quarantine_reason IS NOT NULL"), low, high), Part(main, good, low, high)], (marker[0], dict(marker[1]) | out))
    return out
