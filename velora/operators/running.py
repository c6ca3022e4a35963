"""Running totals over the total order of a table, and chunks of ordered items under a size bound.

A table is dealt into ranges of its order and written with the number of each range; the ranges' own totals are few rows,
from which each range learns what stands before it.  Inside a range a window adds up its rows.  No task sees more than a
range, and nothing is collected.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from velora.session import workers_find_package
from velora.sources.tables import written


def running(df: DataFrame, order: Sequence[str], sums: Mapping[str, str] | None = None, maxes: Mapping[str, str] | None = None) -> DataFrame:
    """``df`` with running sums and maxima (name: column), each up to and with its row.

    The order must be total: with equal rows in it, their totals follow any order among them.  A sum counts NULL as 0.
    """
    how = [(n, c, F.sum) for n, c in (sums or {}).items()] + [(n, c, F.max) for n, c in (maxes or {}).items()]
    parts = written(df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()), "ranges")
    own = parts.groupBy("__part").agg(*(f(c).alias(f"__{n}") for n, c, f in how))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    carry = own.select("__part", *(f(f"__{n}").over(before).alias(f"__{n}") for n, _, f in how))
    inside = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def total(n: str, c: str, f):
        if f is F.max:
            return F.greatest(F.max(c).over(inside), F.col(f"__{n}")).alias(n)
        return (F.coalesce(F.sum(c).over(inside), F.lit(0)) + F.coalesce(f"__{n}", F.lit(0))).alias(n)

    return parts.join(F.broadcast(carry), "__part").select(*df.columns, *(total(*x) for x in how))


def size_chunks(items: DataFrame, order: Sequence[str], size: str, max_items: int, max_size: int, block: int = 1 << 16) -> DataFrame:
    """``items`` in their order cut into chunks as a greedy pass cuts them, with ``chunk long`` from 0.

    A chunk ends before the item that would be one too many or would carry its size over the bound; a single item beyond
    the bound is a chunk of its own.  ``order`` must be total, and sizes are whole numbers; NULL counts as 0 and negative
    ones are an error.  Extra columns are kept; an empty table gives an empty result.

    Every item knows where the next chunk would start if one started with it: the running sum of sizes is merged with
    itself, moved by the bound.  The starts that the first item leads to are found by blocks of ``block`` items: a block
    tells for each item that a chunk from before may end at (its first ``max_items`` ones) where the starts from there leave
    the block.  Doubling over these few entries (step k jumps over 2**k blocks) finds the entry of each block, and then each
    block marks its own starts.  All items are shuffled a fixed number of times, however many chunks there are.
    """
    if max_items < 1 or max_size < 1:
        raise ValueError("a chunk holds one item and one unit of size at least")
    weight = F.coalesce(F.col(size), F.lit(0)).cast("long")
    checked = F.when(weight < 0, F.raise_error(F.lit("negative size")).cast("long")).otherwise(weight)
    sized = items.withColumns({"__w": checked, "__one": F.lit(1).cast("long")})
    placed = written(running(sized, order, {"__i": "__one", "__end": "__w"}).withColumn("__i", F.col("__i") - 1).drop("__one"), "placed")
    ends = placed.select(F.col("__end").alias("at"), F.lit(0).alias("kind"), "__i", (F.col("__i") + 1).alias("fits"))
    starts = placed.select((F.col("__end") - F.col("__w") + max_size).alias("at"), F.lit(1).alias("kind"), "__i", F.lit(None).cast("long").alias("fits"))
    merged = running(ends.unionByName(starts), ["at", "kind", "__i"], maxes={"reach": "fits"}).where("kind = 1")
    following = F.least(F.greatest(F.coalesce("reach", F.lit(0)), F.col("__i") + 1), F.col("__i") + max_items)
    total = placed.count()
    jumps = written(merged.select("__i", following.alias("to")).where(F.col("to") < total), "jumps")
    workers_find_package(items.sparkSession)
    blocks = jumps.select(F.floor(F.col("__i") / block).cast("long").alias("block"), F.col("__i").alias("i"), "to")

    def left(t: pa.Table) -> pa.Table:
        """Of a block's first items the starts that lie behind it; those that nothing follows are absent."""
        i, out = _leaps(t)
        live = np.arange(len(i))
        while len(live := live[out[live] <= i[-1]]):  # all the way by doubling; items are without gaps
            out[live] = out[out[live] - i[0]]
        few = i % block < max_items
        return pa.table({"__i": i[few], "to": out[few]})

    def own(key: tuple, entries: pa.Table, t: pa.Table) -> pa.Table:
        """The starts of a block from its entry on; beside the entry only the very last start may be known already."""
        found = sorted(entries.column("__i").to_pylist())[:1] if entries.num_rows else []
        if found and t.num_rows:
            i, leaps = _leaps(t)
            while found[-1] <= i[-1] and (to := int(leaps[found[-1] - i[0]])) // block == key[0].as_py():
                found.append(to)
        return pa.table({"__i": pa.array(found, pa.int64())})

    jumps = written(blocks.groupBy("block").applyInArrow(left, "__i long, to long"), "jumps")
    found = placed.where("__i = 0").select("__i")
    known = found.count()
    while True:
        found = written(found.unionByName(found.join(jumps, "__i").select(F.col("to").alias("__i"))).distinct(), "starts")
        now = found.count()
        if now == known:
            break
        known = now
        jumps = written(jumps.join(jumps.select(F.col("__i").alias("to"), F.col("to").alias("__then")), "to").select("__i", F.col("__then").alias("to")), "jumps")
    entries = found.withColumn("block", F.floor(F.col("__i") / block).cast("long"))
    found = entries.groupBy("block").cogroup(blocks.groupBy("block")).applyInArrow(own, "__i long")
    marked = placed.join(found.withColumn("__first", F.lit(1).cast("long")), "__i", "left")
    return running(marked, ["__i"], {"__chunk": "__first"}).select(*items.columns, (F.col("__chunk") - 1).alias("chunk"))


def _leaps(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Items in order without gaps, and the start that follows each; the last items of a table have none and are absent."""
    i, to = (t.column(c).to_numpy().astype(np.int64) for c in ("i", "to"))
    by = np.argsort(i)
    return i[by], to[by]
