"""Late field events as a stream: hours of days, the last days of which are read again by every batch.

The service keeps events by day and hour and adds late ones to hours that are long over.  An offset says how far the
newest hour has come and how many objects the days of the look-back hold, so a late object alone starts a batch too.  A
batch reads whole days: all since the last offset and those of the look-back before it, one task a day.  Whole days can be
replaced, so a batch that runs twice, or that finds more than its offset told, ends in the same table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import date, timedelta

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from velora.sources.objects import ObjectStore
from velora.sources.tables import Table, written

#: Fixed value: days that every run reads again.
LOOKBACK_DAYS = 3


class DayObjects(InputPartition):
    def __init__(self, day: str, objects: list[str]):
        super().__init__((day, objects))


class EventHoursReader(DataSourceStreamReader):
    def __init__(self, schema: StructType, options: dict):
        self.schema, self.root = schema, options["root"].rstrip("/")
        self.lookback = int(options.get("lookback", LOOKBACK_DAYS))

    def _objects(self) -> dict[tuple[str, int], list[str]]:
        """The service's objects by day and hour; hidden and unfinished ones are not there yet."""
        from pyarrow import fs

        where, top = fs.FileSystem.from_uri(self.root)
        out: dict[tuple[str, int], list[str]] = {}
        for f in where.get_file_info(fs.FileSelector(top, recursive=True, allow_not_found=True)):
            part = f.path[len(top) :].strip("/").split("/")
            if f.type == fs.FileType.File and len(part) == 3 and part[0].startswith("day=") and part[1].startswith("hour=") and part[2][0] not in "._":
                out.setdefault((part[0][4:], int(part[1][5:])), []).append(f.path)
        return out

    def _first(self, day: str) -> str:
        return (date.fromisoformat(day) - timedelta(days=self.lookback - 1)).isoformat() if day else ""

    def initialOffset(self) -> dict:
        return {"day": "", "hour": -1, "objects": 0}

    def latestOffset(self) -> dict:
        found = self._objects()
        if not found:
            return self.initialOffset()
        day, hour = max(found)
        return {"day": day, "hour": hour, "objects": sum(len(v) for (d, _), v in found.items() if d >= self._first(day))}

    def partitions(self, start: dict, end: dict) -> list[DayObjects]:
        if start == end:
            return []
        days: dict[str, list[str]] = {}
        for key, objects in sorted(self._objects().items()):
            if key[0] >= self._first(start["day"]) and key <= (end["day"], end["hour"]):
                days.setdefault(key[0], []).extend(sorted(objects))
        return [DayObjects(d, objects) for d, objects in days.items()]

    def read(self, partition: DayObjects) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq
        from pyarrow import fs

        arrow, (where, _) = to_arrow_schema(self.schema), fs.FileSystem.from_uri(self.root)
        for path in partition.value[1]:
            with where.open_input_file(path) as f:
                for b in pq.ParquetFile(f).iter_batches(columns=arrow.names):
                    # a writer that deals rows out by day leaves the day to the folder's name; other absent columns are NULL
                    absent = lambda name, n=b.num_rows: pa.array([partition.value[0] if name == "day" else None] * n)
                    columns = [b.column(c.name) if c.name in b.schema.names else absent(c.name) for c in arrow]
                    yield pa.RecordBatch.from_arrays([x.cast(c.type) for x, c in zip(columns, arrow, strict=True)], schema=arrow)


class EventHours(DataSource):
    """Options: ``root`` with objects under day=YYYY-MM-DD/hour=HH; ``lookback`` days."""

    @classmethod
    def name(cls) -> str:
        return "event_hours"

    def schema(self) -> str:
        raise ValueError("give the columns by .schema(...)")

    def streamReader(self, schema: StructType) -> EventHoursReader:
        return EventHoursReader(schema, dict(self.options))


def replace_days(table: Table, store: ObjectStore, stream: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that replaces the days of a batch, once a batch.

    The batch's number is noted after the swap: a batch that comes again after its note is left out, and one that was cut
    off before it replaces the same days by the same rows.  A day without rows stays as it is.
    """

    def write(batch: DataFrame, number: int) -> None:
        key = f"stream/{stream}/{number:09}.json"
        if store.get_json(key) is not None:
            return
        rows = written(batch, "batch")
        days = {r[0]: r.n for r in rows.groupBy(F.col(table.partition).cast("string")).agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a day
        if days:
            table.replace_partitions(rows, list(days))
        store.put_json(key, {"batch": number, "days": days})

    return write
