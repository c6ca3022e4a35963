"""Helpers shared by the text operators: shared tables, word hashing, bounded bitmaps and checked inputs."""

from __future__ import annotations

import ctypes
import math
import sys
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress

import numpy as np
import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from velora.session import workers_find_package
from velora.sources.objects import shared_root

#: ASCII white space, as the contracts name it.
SPACE = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


_SCOPES = threading.local()


def _delete(spark: SparkSession, path: str, at_end: bool = False) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.deleteOnExit(where) if at_end else fs.delete(where, True)


def collect_finished(spark: SparkSession) -> None:
    """Has the driver's JVM collect its garbage once a third of its heap is in use, or a fifth of one grown past its half.

    Spark removes the shuffle files and broadcasts of finished queries only after that, and a heap that is left alone
    grows to its limit before it collects them; operators with many short queries would take all of it.  A heap that has
    grown for a moment shrinks again only by a collection.
    """
    heap = spark._jvm.java.lang.Runtime.getRuntime()
    most, total = heap.maxMemory(), heap.totalMemory()
    used = total - heap.freeMemory()
    if 3 * used > most or 2 * total > most and 5 * used > most:
        spark._jvm.java.lang.System.gc()


def trim_driver(spark: SparkSession) -> None:
    """Hands memory that the driver's JVM has freed outside its heap back to the system.

    Planning, compiling and sending many short queries takes such memory in hundreds of threads, and glibc keeps what
    each has freed; without this it grows through all queries of a session.  JVMs before 17 and other systems lack it.
    """
    java, beans = spark._jvm.java.lang, spark._jvm.javax.management
    with suppress(Py4JError):
        call = next(m for m in java.Class.forName("javax.management.MBeanServerConnection").getMethods() if m.getName() == "invoke")  # the server's own class is closed to Py4J
        args = spark.sparkContext._gateway.new_array(java.Object, 4)
        args[0], args[1] = beans.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        call.invoke(java.management.ManagementFactory.getPlatformMBeanServer(), args)


def shared_table(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and return the table read back.

    Cuts the lineage, so a lost executor costs a re-read and never a recomputation of what stands before.
    The files go at the end of the ``scratch`` block that they were written in, or else when the driver's JVM ends.
    """
    spark = df.sparkSession
    path = f"{shared_root(spark)}/velora-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    collect_finished(spark)
    trim_driver(spark)
    _delete(spark, path, at_end=True)
    out = spark.read.schema(df.schema).parquet(path)
    out.shared_path = path
    for own in getattr(_SCOPES, "open", [])[-1:]:
        own.append(path)
    return out


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Deletes the shared tables written inside at its end, but for those that are handed to the function it gives.

    Whatever is read later must be handed over: only tables whose readers have all been written themselves may go.
    """
    own: list[str] = []
    scopes = _SCOPES.open = [*getattr(_SCOPES, "open", []), own]

    def keep(df: DataFrame) -> DataFrame:
        own.remove(df.shared_path)
        for outer in scopes[-2:-1]:
            outer.append(df.shared_path)
        return df

    try:
        yield keep
    finally:
        _SCOPES.open = scopes[:-1]
        for path in own:
            _delete(spark, path)


def small_batches(spark: SparkSession, rows: int = 1000, size: int = 64 << 20) -> None:
    """Lets Arrow batches hold so many rows and bytes at most: a batch of whole texts must fit beside a worker's tables.

    Every operator with Python code begins with it, so it also sees to it that workers find this package.  Smaller limits
    of the session stay.  The limits hold for the session from then on, as results are computed after the call.
    """
    workers_find_package(spark)
    for name, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", rows), ("spark.sql.execution.arrow.maxBytesPerBatch", size)):
        found = spark.conf.get(name, None)
        if found is None or not (found.isdigit() and 0 < int(found) <= most):
            spark.conf.set(name, str(most))


def give_back() -> None:
    """Hands memory that a task has freed back to the system, as the worker lives on beside the executor's other work."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        getattr(ctypes.CDLL(None), "malloc_trim", lambda _: 0)(0)  # only glibc has it


def fold(id_col: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % modulus


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (the finaliser of SplitMix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
KEPT_POWERS = 1 << 19
_POWERS: list[np.ndarray] = []


def span_hashes(raw: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """A function of starts and ends that hashes any spans of the bytes to 64 bits, all at once.

    A span's hash is a difference of running sums of bytes times powers of an odd number, modulo 2**64, divided by the
    power of its start and scrambled, so it does not depend on where the span stands.
    """
    n = len(raw) + 1
    up, down = _POWERS or (np.ones(1, np.uint64),) * 2
    if len(up) < n:
        up, down = (np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(max(n, KEPT_POWERS) - 1, b, np.uint64)]), dtype=np.uint64) for b in (BASE, INVERSE))
        if len(up) == KEPT_POWERS:  # a very long text's are not kept, so that a worker's memory stays small
            _POWERS[:] = [up, down]
    sums = np.zeros(n, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: n - 1], out=sums[1:])
    return lambda starts, ends: mixed((sums[ends] - sums[starts]) * down[starts])


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` items, by position; empty if there are fewer."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    g = np.full(n, k, np.uint64)
    for i in range(k):
        g = mixed(g * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n])
    return g


SPACE_BYTES = np.zeros(256, bool)
SPACE_BYTES[list(b" \t\n\v\f\r")] = True


def text_groups(texts: pa.Array, chars: int = 250_000) -> Iterator[tuple[int, list[str | None]]]:
    """Runs of texts of about so many characters, with the place of the first."""
    part, at, size = [], 0, 0
    for i, t in enumerate(texts):
        part.append(t.as_py())
        size += len(part[-1] or "")
        if size >= chars:
            yield at, part
            part, at, size = [], i + 1, 0
    if part:
        yield at, part


def text_words(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the words (runs without ASCII white space) of all texts one after the other, and each text's number of words."""
    raw = np.frombuffer(b" ".join([*raws, b""]), np.uint8)
    edge = np.flatnonzero(np.diff(~SPACE_BYTES[raw], prepend=False, append=False))
    starts, ends = edge[::2], edge[1::2]
    owner = np.searchsorted(np.cumsum([len(r) + 1 for r in raws]), starts, "right")
    return span_hashes(raw)(starts, ends), np.bincount(owner, minlength=len(raws))


def text_grams(raws: list[bytes], k: int) -> list[np.ndarray]:
    """Per text the hashes of all runs of ``k`` words in order; of the whole sequence if it is shorter; none without words."""
    h, counts = text_words(raws)
    ends = np.cumsum(counts)
    grams = gram_hashes(h, k)
    owner = np.repeat(np.arange(len(raws)), counts)
    inside = grams[owner[: len(grams)] == owner[len(owner) - len(grams) :]]
    sizes = np.maximum(counts - k + 1, 0)
    out = np.split(inside, np.cumsum(sizes)[:-1])
    for i in np.flatnonzero((counts > 0) & (counts < k)).tolist():
        out[i] = gram_hashes(h[ends[i] - counts[i] : ends[i]], int(counts[i]))
    return out


class Bitmap:
    """A set of 64-bit keys folded to a fixed number of bits: no key that was put in is missed, others may be found.

    Its size is a parameter and never follows the data, so it can be sent to every executor.  A test is a
    pre-filter only: the exact join or comparison comes after it.
    """

    def __init__(self, bits: int, data: np.ndarray):
        self.bits, self.data = bits, data

    def has(self, keys: np.ndarray) -> np.ndarray:
        at = mixed(keys.astype(np.uint64, copy=False)) & np.uint64((1 << self.bits) - 1)
        return (self.data[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


#: Tasks' pieces of one number are merged in so many groups first, so that no worker holds the pieces of all tasks.
FAN = 64
#: The driver fetches merged pieces in so many jobs, whatever the number of partitions.
FETCHES = 8


def merge_pieces(pieces: DataFrame, merge: Callable[[pa.Table], bytes], value: str, last: Callable[[bytes], bytes] = bytes) -> Iterator[tuple[int, bytes]]:
    """Merges rows of ``piece int`` and a binary value, by number, in two rounds; the driver gets one row a piece, as ``last`` makes it.

    An iterator over rows is a job for each partition, all of which the driver keeps books on, so the merged rows, whose
    size is bounded, are dealt to ``FETCHES`` even partitions first; the driver holds one of them at a time.
    """

    def merged(t: pa.Table) -> pa.Table:
        return pa.table({"piece": t.column("piece")[:1], value: pa.array([merge(t)], pa.binary())})

    def finished(t: pa.Table) -> pa.Table:
        return pa.table({"piece": t.column("piece")[:1], value: pa.array([last(merge(t))], pa.binary())})

    schema = f"piece int, {value} binary"
    once = pieces.withColumn("part", F.spark_partition_id() % FAN).groupBy("piece", "part").applyInArrow(merged, schema)
    for r in once.groupBy("piece").applyInArrow(finished, schema).repartition(FETCHES).toLocalIterator():
        yield r[0], r[1]


def bitmap_bits(keys: int) -> int:
    """Sixteen bits a key, 2**29 (64 MB) at most; beyond 30 million keys more rows pass, and none is missed."""
    return int(np.clip(math.ceil(math.log2(16 * keys + 1)), 16, 29))


def bitmap_of(df: DataFrame, key: str, bits: int | None = None) -> Bitmap:
    """The bitmap of a long column, of a size that follows the number of rows unless ``bits`` is given.  Each task folds
    its keys to pieces of 8 KB, which are OR-ed in a shuffle."""
    bits, piece = bits or bitmap_bits(df.count()), 16  # 2**16 bits

    def pieces(batches):
        own = np.zeros(1 << (bits - 3), np.uint8)
        for b in batches:
            k = b.column(0).drop_null().to_numpy(zero_copy_only=False).view(np.uint64)
            at = mixed(k) & np.uint64((1 << bits) - 1)
            np.bitwise_or.at(own, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
        own = own.reshape(-1, 1 << (piece - 3))
        full = np.flatnonzero(own.any(axis=1))
        yield pa.RecordBatch.from_pydict({"piece": full.astype(np.int32), "bits": [own[i].tobytes() for i in full]}, schema=pa.schema([("piece", pa.int32()), ("bits", pa.binary())]))

    if bits < piece:
        raise ValueError(f"bits must be {piece} or more")
    out = np.zeros((1 << (bits - piece), 1 << (piece - 3)), np.uint8)
    either = lambda t: np.bitwise_or.reduce([np.frombuffer(x.as_py(), np.uint8) for x in t.column("bits")]).tobytes()
    for i, data in merge_pieces(df.select(F.col(key).cast("long").alias("key")).mapInArrow(pieces, "piece int, bits binary"), either, "bits"):
        out[i] = np.frombuffer(data, np.uint8)
    return Bitmap(bits, out.reshape(-1))


def join_classes(rows: DataFrame, classes: DataFrame, keys: list[str], size: str, parts: int = 1000) -> DataFrame:
    """Rows with the columns of their class, where ``classes`` has one row for each key and ``size`` counts its rows.

    A class with more than one of ``parts`` of all rows comes by broadcast: there are fewer than ``parts`` of them,
    whatever the data are.  All other keys are small, so no task of the shuffled join gets a large share of the rows.
    """
    total = classes.agg(F.coalesce(F.sum(size), F.lit(0)).alias("n")).first().n
    big = F.col(size) * parts > total
    few = F.broadcast(classes.where(big))
    rest = rows.join(F.broadcast(classes.where(big).select(*keys)), keys, "left_anti")
    return rows.join(few, keys).unionByName(rest.join(classes.where(~big), keys))


def by_key(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """The groups of rows that are sorted by their first ``keys`` columns, one table each."""
    rest: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        cols = [b.column(i).to_numpy(zero_copy_only=False) for i in range(keys)]
        new = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols], axis=0)) + 1
        edges = [0, *new.tolist(), b.num_rows]
        for s, e in zip(edges, edges[1:]):
            key = tuple(c[s] for c in cols)
            if last is not None and key != last:
                yield pa.Table.from_batches(rest)
                rest = []
            rest.append(b.slice(s, e - s))
            last = key
    if rest:
        yield pa.Table.from_batches(rest)
