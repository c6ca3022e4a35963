"""Exact deduplication by deterministic block naming (Karp, Miller and Rosenberg 1972), in DataFrame functions only.

A normalised text is cut into blocks of a fixed number of bytes.  Blocks are sorted in buckets of a 44-bit hash;
a block's name is the integer (bucket, rank among the different blocks of its bucket), so two blocks have one name
only if they are equal byte for byte.  Adjacent pairs of names are named in the same way, level by level, until each
document has one name; equal names at the same level mean equal texts.

Names do not depend on the partitioning or on the order of rows, so a recomputed task gives the same names.
The different blocks are found with map-side combining: a block in a third of all rows is one row per task before the
shuffle.  Nothing is ever grouped by document.  Buckets of several blocks occur in n**2 / 2**45 cases for n different
blocks: none in a few gigabytes, some 25 at 30 GB, and at 100 TB (10**11 blocks) about one bucket in 300.  Only the texts
that hold a block of such a bucket are cut again; the others are told by their names alone and keep them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from velora.llm.common import SPACE, join_classes, scratch, shared_table

#: Bits of a name that hold the rank in the bucket.
RANK_BITS = 19


def normalised(text: Column) -> Column:
    """Each run of ASCII white space becomes one space; null becomes the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def _bucket(keys: list[Column], bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*keys), 64 - bits)


def _blocks(norm: Column, size: int) -> Column:
    raw = norm.cast("binary")
    count = F.greatest(F.lit(1), F.ceil(F.length(raw) / size)).cast("int")
    return F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.substring(raw, i * size + 1, F.lit(size)))


#: Texts with a crowded bucket up to which they are sent to all executors (some 20 MB of digests); more are joined by a shuffle.
FEW_TEXTS = 100_000


def _crowded(distinct: DataFrame) -> DataFrame:
    """Buckets with several different keys."""
    return distinct.groupBy("bucket").agg(F.count(F.lit(1)).alias("keys")).where("keys > 1").select("bucket")


def _few(texts: DataFrame, count: int) -> DataFrame:
    return F.broadcast(texts) if count <= FEW_TEXTS else texts


def _ranked_names(each: DataFrame, crowded: DataFrame, keys: list[str]) -> DataFrame:
    """``sha, ats`` (pos, name) of texts with ``sha, pos, bucket`` and keys: names with the rank in their bucket."""
    own = each.join(crowded, "bucket", "left_semi").select("bucket", *keys).distinct()
    rank = F.row_number().over(Window.partitionBy("bucket").orderBy(*keys)) - 1
    fits = F.when(rank < (1 << RANK_BITS), rank.cast("long")).otherwise(F.raise_error(F.lit("a bucket holds too many blocks; take more bucket bits")).cast("long"))
    each = each.join(own.withColumn("rank", fits), ["bucket", *keys], "left")
    name = F.shiftleft("bucket", RANK_BITS) + F.coalesce("rank", F.lit(0))
    return each.groupBy("sha").agg(F.array_sort(F.collect_list(F.struct("pos", name.alias("name")))).alias("ats"))


def block_identities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = 1024, bucket_bits: int = 44) -> DataFrame:
    """One row per input row: ``doc_id, sha, level, name``; (level, name) is equal exactly for equal normalised texts.

    Null and empty texts are one block without bytes.  Rows that repeat an id keep a row each.
    """
    norm = docs.select(F.col(id_col).cast("long").alias("doc_id"), normalised(F.col(text_col)).alias("norm"))
    blocks = norm.select("doc_id", F.sha2(F.col("norm"), 256).alias("sha"), _blocks(F.col("norm"), block_bytes).alias("blocks"))
    named = lambda key: F.shiftleft(_bucket([key], bucket_bits), RANK_BITS)

    with scratch(docs.sparkSession) as keep:
        rows = shared_table(blocks.select("doc_id", "sha", F.transform("blocks", named).alias("names")), "blocks")
        # cut after the explode: inside a transform the text would be normalised again for every block
        raw = norm.select("doc_id", F.sha2(F.col("norm"), 256).alias("sha"), F.col("norm").cast("binary").alias("raw"))
        cuts = raw.select("doc_id", "sha", "raw", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(1), F.ceil(F.length("raw") / block_bytes)).cast("int") - 1)).alias("i"))
        block = F.substring("raw", F.col("i") * block_bytes + 1, F.lit(block_bytes))
        distinct = cuts.select(block.alias("block")).select(_bucket([F.col("block")], bucket_bits).alias("bucket"), "block").distinct()
        crowded = shared_table(_crowded(distinct), "crowded")
        if not crowded.isEmpty():
            touched = shared_table(rows.select("sha", F.explode("names").alias("name")).select("sha", F.shiftrightunsigned("name", RANK_BITS).alias("bucket")).join(crowded, "bucket", "left_semi").select("sha").distinct(), "touched")
            count = touched.count()
            again = raw.join(_few(touched, count), "sha", "left_semi").select("sha", "raw", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(1), F.ceil(F.length("raw") / block_bytes)).cast("int") - 1)).alias("i"))
            each = shared_table(again.select("sha", F.col("i").alias("pos"), block.alias("block")).distinct().withColumn("bucket", _bucket([F.col("block")], bucket_bits)), "each")
            whole = shared_table(_ranked_names(each, crowded, ["block"]), "whole")
            rows = shared_table(rows.join(_few(whole, count), "sha", "left").select("doc_id", "sha", F.coalesce(F.col("ats.name"), F.col("names")).alias("names")), "blocks")

        done, level = [], 0
        while True:
            done.append(keep(rows).where(F.size("names") == 1).select("doc_id", "sha", F.lit(level).alias("level"), F.col("names")[0].alias("name")))
            rest = rows.where(F.size("names") > 1)
            if rest.isEmpty():
                break
            level += 1
            pairs = F.transform(F.sequence(F.lit(0), F.ceil(F.size("names") / 2).cast("int") - 1), lambda i: F.struct(F.get("names", i * 2).alias("a"), F.coalesce(F.get("names", i * 2 + 1), F.lit(-1)).alias("b")))
            paired = rest.select("doc_id", "sha", pairs.alias("pairs"))
            key = lambda p: _bucket([p["a"], p["b"]], bucket_bits)
            distinct = paired.select(F.explode("pairs").alias("p")).select(key(F.col("p")).alias("bucket"), "p.a", "p.b").distinct()
            crowded = shared_table(_crowded(distinct), "crowded")
            following = paired.select("doc_id", "sha", F.transform("pairs", lambda p: F.shiftleft(key(p), RANK_BITS)).alias("names"))
            if not crowded.isEmpty():
                touched = shared_table(paired.select("sha", F.explode("pairs").alias("p")).select("sha", key(F.col("p")).alias("bucket")).join(crowded, "bucket", "left_semi").select("sha").distinct(), "touched")
                count = touched.count()
                again = paired.join(_few(touched, count), "sha", "left_semi").dropDuplicates(["sha"]).select("sha", F.posexplode("pairs").alias("pos", "p"))
                each = shared_table(again.select("sha", "pos", "p.a", "p.b", key(F.col("p")).alias("bucket")), "each")
                whole = shared_table(_ranked_names(each, crowded, ["a", "b"]), "whole")
                following = following.join(_few(whole, count), "sha", "left").select("doc_id", "sha", F.coalesce(F.col("ats.name"), F.col("names")).alias("names"))
            rows = shared_table(following, "names")
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = 1024, bucket_bits: int = 44) -> DataFrame:
    """Per row: ``doc_id, keep_id, group_size, kept, text_sha256``; of equal texts the row with the smallest id stays.

    Null and empty texts are equal to each other (a text of white space alone is one space, and so differs).  Repeated
    rows count in ``group_size`` and share their id's fate.  Rows without id are kept only if their whole group has none.
    An empty table gives an empty result; other columns of ``docs`` are not read.
    """
    ids = block_identities(docs, id_col, text_col, block_bytes, bucket_bits)
    groups = shared_table(ids.groupBy("level", "name").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "groups")
    return join_classes(ids, groups, ["level", "name"], "group_size").select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("sha").alias("text_sha256"))
