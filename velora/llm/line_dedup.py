"""Line dedup over hashes of lines, in DataFrame functions only.

A line's key is the line without ASCII white space at its ends, A-Z lower-cased.  Keys that are long enough become two
64-bit hashes; text never goes through the shuffle of the lines.  The hashes are range-partitioned and sorted inside a
partition by hash, document (largest first) and position, so a key's first run of rows is the document that keeps the key
and every later one is a repeat.  The repeats come back as one compressed bitmap a document: the runs of kept lines.

A range partitioner cannot cut a single hash in two, so keys with more than a thousandth of all lines (fewer than a
thousand keys, whatever the data are) are judged beside it: their documents are counted with map-side combining and the
few results come to their lines by broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from velora.llm.common import LOWER, UPPER, scratch, shared_table

ASCII_SPACE = " \t\n\v\f\r"
KEY = ["h1", "h2"]
ROW = ["__r1", "__r2"]
#: A key with more than one of so many lines is hot.
PARTS = 1000


def _row(id_col: Column, text: Column) -> list[Column]:
    """128 bits that are equal for rows with the same id and text."""
    own = [F.coalesce(id_col.cast("string"), F.lit("none")), F.coalesce(text, F.lit(""))]
    return [F.xxhash64(*own).alias(ROW[0]), F.xxhash64(F.lit(1), *own).alias(ROW[1])]


def long_lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """``doc_id, __r1, __r2, pos, h1, h2`` of the lines whose key has at least ``min_chars`` code points."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    # hashed before the lines are made: beside the generator the whole text would be hashed again for each of them
    whole = docs.select(F.col(id_col).cast("long").alias("doc_id"), *_row(F.col(id_col), text), F.split(F.translate(text, UPPER, LOWER), "\n").alias("lines"))
    each = whole.select("doc_id", *ROW, F.posexplode("lines").alias("pos", "line"))
    keyed = each.select("doc_id", *ROW, "pos", F.btrim("line", F.lit(ASCII_SPACE)).alias("key")).where(F.length("key") >= min_chars)
    return keyed.select("doc_id", *ROW, "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


def repeats(lines: DataFrame, min_docs: int) -> DataFrame:
    """The lines to drop: ``__r1, __r2, pos`` of keys in at least ``min_docs`` documents, but for the largest id's."""
    total = lines.count()
    counts = lines.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"))
    hot = shared_table(counts.where(F.col("n") * PARTS > total).select(*KEY), "hot-lines")
    first = F.col("doc_id").desc_nulls_last()
    # the range partitioning clusters a hash already, and the sort is the window's own: neither comes a second time
    sorted_lines = lines.join(F.broadcast(hot), KEY, "left_anti").repartitionByRange(*KEY).sortWithinPartitions(*KEY, first, "pos")
    nth = F.dense_rank().over(Window.partitionBy(*KEY).orderBy(first))
    stream = sorted_lines.withColumn("nth", nth).withColumn("docs", F.max("nth").over(Window.partitionBy(*KEY)))
    rest = stream.where((F.col("docs") >= min_docs) & (F.col("nth") > 1)).select(*ROW, "pos")
    on_hot = lines.join(F.broadcast(hot), KEY)
    judged = on_hot.groupBy(*KEY, "doc_id").agg(F.lit(1).alias("one")).groupBy(*KEY).agg(F.count("one").alias("docs"), F.max("doc_id").alias("last")).where(F.col("docs") >= min_docs)
    return rest.unionByName(on_hot.join(F.broadcast(judged), KEY).where(~F.col("doc_id").eqNullSafe(F.col("last"))).select(*ROW, "pos"))


def dropped_runs(dropped: DataFrame) -> DataFrame:
    """Per text with a dropped line: ``__r1, __r2, __n`` and ``__runs``, its runs (start, size) of dropped lines in order.

    Copies of a row give the same places, which combine before the shuffle; a group is one text's places.
    """
    island = F.col("pos") - F.row_number().over(Window.partitionBy(*ROW).orderBy("pos"))
    runs = dropped.distinct().withColumn("island", island).groupBy(*ROW, "island").agg(F.min("pos").alias("start"), F.count(F.lit(1)).cast("int").alias("size"))
    return runs.groupBy(*ROW).agg(F.sum("size").alias("__n"), F.array_sort(F.collect_list(F.struct("start", "size"))).alias("__runs"))


def _kept_runs(runs: Column, lines: Column) -> Column:
    """The runs between dropped runs; those of no length go."""
    start = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.get(runs, i - 1)["start"] + F.get(runs, i - 1)["size"])
    end = lambda i: F.coalesce(F.get(runs, i)["start"], lines)
    between = F.transform(F.sequence(F.lit(0), F.size(runs)), lambda i: F.struct(start(i).alias("start"), (end(i) - start(i)).alias("size")))
    return F.when(runs.isNotNull(), F.filter(between, lambda r: r["size"] > 0)).otherwise(F.array(F.struct(F.lit(0).alias("start"), lines.alias("size"))))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """Per row: ``doc_id, n_lines, n_dropped, keep`` and the text as ``__text``; ``keep`` is the bitmap of kept lines as
    runs (start, size), and ``kept_text`` applies it.

    A null or empty text is one empty line.  Rows that share an id are one document, and all rows without id are one that
    comes last, so it keeps a key only if no row with an id holds it.  A key's lines inside the document that keeps it all
    stay; in any other all go.  Repeated rows keep a row each.  An empty table gives an empty result; other columns of
    ``docs`` are not read.  Keys and rows are told apart by 128 bits of hashes.
    """
    with scratch(docs.sparkSession) as keep:
        lines = shared_table(long_lines(docs, id_col, text_col, min_chars), "lines")
        runs = keep(shared_table(dropped_runs(repeats(lines, min_docs)), "line-runs"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), *_row(F.col(id_col), text), text.alias("__text"))
    count = (F.length("__text") - F.length(F.replace("__text", F.lit("\n"), F.lit(""))) + 1).cast("int")
    joined = rows.join(runs, ROW, "left").withColumn("__lines", count)
    return joined.select("doc_id", F.col("__lines").cast("long").alias("n_lines"), F.coalesce("__n", F.lit(0).cast("long")).alias("n_dropped"), _kept_runs(F.col("__runs"), F.col("__lines")).alias("keep"), "__text")


def kept_text(text: Column, keep: Column, n_dropped: Column) -> Column:
    """The kept lines, joined; each run is one slice, so the cost is that of the text."""
    joined = lambda lines: F.array_join(F.flatten(F.transform(keep, lambda r: F.slice(lines, r["start"] + 1, r["size"]))), "\n")
    # an array of one array binds the lines, which are split once and not for every run
    return F.when(n_dropped == 0, text).otherwise(F.transform(F.array(F.split(text, "\n")), joined)[0])
