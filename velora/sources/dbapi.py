"""A database with a Python driver as a data source: transactional replacement of a day, and reads by ranges of a key.

Every task puts its rows into a staging table and reports them under a token of its own.  It makes a block of rows ready
first and inserts it in a short transaction, so that tasks wait for one another only while the database works.  When all
tasks are done the driver moves the rows of the reported tokens in one more transaction, by one scan.  Rows of failed,
repeated or speculative attempts have tokens that nobody reports, and go with the run.
"""

from __future__ import annotations

import importlib
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import date, datetime
from itertools import islice

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Rows of one insert and of one read, and tokens of one statement.
BLOCK, TOKENS = 20_000, 500
#: Types that a driver gives as Arrow takes them.
PLAIN = {"string", "double", "float", "byte", "short", "integer", "long"}
KINDS = {"string": "TEXT", "double": "DOUBLE PRECISION", "float": "DOUBLE PRECISION", "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP"}


class Database:
    """``module`` is a DB-API 2.0 driver and ``dsn`` what its connect function takes."""

    def __init__(self, options: dict):
        self.module, self.dsn, self.table = options["module"], options["dsn"], options["table"]

    @contextmanager
    def transaction(self) -> Iterator:
        driver = importlib.import_module(self.module)
        c = driver.connect(self.dsn, **({"timeout": 120} if self.module == "sqlite3" else {}))
        try:
            yield c.cursor()
            c.commit()
        except BaseException:
            c.rollback()
            raise
        finally:
            c.close()

    def sign(self) -> str:
        return "?" if importlib.import_module(self.module).paramstyle == "qmark" else "%s"

    def value(self, v):
        if isinstance(v, datetime) and v.tzinfo is not None:
            v = v.astimezone().replace(tzinfo=None)
        return v.isoformat(" ") if self.module == "sqlite3" and isinstance(v, datetime) else v.isoformat() if self.module == "sqlite3" and isinstance(v, date) else v


class Written(WriterCommitMessage):
    def __init__(self, token: int, rows: int):
        self.token, self.rows = token, rows


class DayWriter(DataSourceWriter):
    def __init__(self, schema: StructType, options: dict):
        self.db, self.schema, self.options, self.run = Database(options), schema, options, uuid.uuid4().hex
        self.stage = f"{self.db.table}_stage_{self.run[:12]}"
        with self.db.transaction() as c:
            columns = ", ".join(f'"{f.name}" {KINDS.get(f.dataType.typeName(), "BIGINT")}' for f in schema)
            c.execute(f"CREATE TABLE {self.stage} (token__ BIGINT, {columns})")

    def write(self, iterator: Iterator) -> Written:
        return self.stored([self.db.value(v) for v in r] for r in iterator)

    def stored(self, rows: Iterator) -> Written:
        token, sign, n = uuid.uuid4().int >> 65, self.db.sign(), 0
        text = f"INSERT INTO {self.stage} VALUES ({', '.join([sign] * (len(self.schema) + 1))})"
        while block := [(token, *r) for r in islice(rows, BLOCK)]:
            with self.db.transaction() as c:
                c.executemany(text, block)
            n += len(block)
        return Written(token, n)

    def commit(self, messages: list[Written | None]) -> None:
        """Old day out, reported rows in, together."""
        sign, columns = self.db.sign(), ", ".join(f'"{f.name}"' for f in self.schema)
        with self.db.transaction() as c:
            c.execute(f'DELETE FROM {self.db.table} WHERE "{self.options["column"]}" = {sign}', (self.options["day"],))
            tokens = [m.token for m in messages if m is not None and m.rows]
            for at in range(0, len(tokens), TOKENS):
                some = tokens[at : at + TOKENS]
                c.execute(f"INSERT INTO {self.db.table} ({columns}) SELECT {columns} FROM {self.stage} WHERE token__ IN ({', '.join([sign] * len(some))})", some)
            c.execute(f"DROP TABLE {self.stage}")

    def abort(self, messages: list[Written | None]) -> None:
        with self.db.transaction() as c:
            c.execute(f"DROP TABLE {self.stage}")


class BatchDayWriter(DayWriter, DataSourceArrowWriter):
    """The same from Arrow batches, as Spark has them."""

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        as_is = [f.dataType.typeName() in PLAIN for f in self.schema]
        columns = lambda b: [c.to_pylist() if plain else [self.db.value(v) for v in c.to_pylist()] for c, plain in zip(b.columns, as_is, strict=True)]
        return self.stored(r for b in iterator for r in zip(*columns(b), strict=True))


class KeyRange(InputPartition):
    def __init__(self, low, high, last: bool):
        super().__init__((low, high, last))


class RangeReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.db, self.schema, self.options = Database(options), schema, options

    def partitions(self) -> list[KeyRange]:
        """Ranges of a whole-number key of about equal width; NULL keys come with the first."""
        key, parts = self.options["key"], int(self.options.get("parts", "8"))
        with self.db.transaction() as c:
            c.execute(f'SELECT min("{key}"), max("{key}") FROM {self.db.table}')
            low, high = c.fetchone()
        if low is None:
            return [KeyRange(None, None, True)]
        edges = sorted({low + (high - low) * i // parts for i in range(parts)} | {low})
        return [KeyRange(None if i == 0 else a, edges[i + 1] if i + 1 < len(edges) else None, False) for i, a in enumerate(edges)]

    def read(self, partition: KeyRange) -> Iterator[tuple | pa.RecordBatch]:
        low, high, _ = partition.value
        key, sign, kinds = self.options["key"], self.db.sign(), [f.dataType.typeName() for f in self.schema]
        where, values = [], []
        if low is not None:
            where.append(f'"{key}" >= {sign}')
            values.append(low)
        if high is not None:
            where.append(f'("{key}" < {sign}{" OR " + chr(34) + key + chr(34) + " IS NULL" if low is None else ""})')
            values.append(high)
        columns = ", ".join(f'"{f.name}"' for f in self.schema)
        with self.db.transaction() as c:
            c.execute(f"SELECT {columns} FROM {self.db.table}{' WHERE ' + ' AND '.join(where) if where else ''}", values)
            arrow = to_arrow_schema(self.schema) if set(kinds) <= PLAIN else None
            while rows := c.fetchmany(BLOCK):
                if arrow is not None:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), arrow.types, strict=True)], schema=arrow)
                    continue
                for r in rows:
                    yield tuple(self._typed(v, k) for v, k in zip(r, kinds, strict=True))

    @staticmethod
    def _typed(v, kind: str):
        if isinstance(v, str) and kind == "date":
            return date.fromisoformat(v)
        if isinstance(v, str) and kind.startswith("timestamp"):
            return datetime.fromisoformat(v)
        return bool(v) if kind == "boolean" and v is not None else v


class DatabaseDays(DataSource):
    """Options: ``module``, ``dsn``, ``table``; to write ``column`` and ``day``; to read ``key`` and ``parts``."""

    @classmethod
    def name(cls) -> str:
        return "database_day"

    def schema(self) -> str:
        raise ValueError("give the columns by .schema(...)")

    def reader(self, schema: StructType) -> RangeReader:
        return RangeReader(schema, dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> DayWriter:
        return BatchDayWriter(schema, dict(self.options))
