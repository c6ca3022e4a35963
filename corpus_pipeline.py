"""A corpus pipeline over ``documents``: each stage works on all rows that its predecessor kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from velora.llm.common import scratch, shared_table
from velora.llm.decontaminate import decontaminate
from velora.llm.exact_dedup import exact_dedup, normalised
from velora.llm.jaccard_join import jaccard_components, row_key
from velora.llm.packing import pack_documents
from velora.llm.toxicity import drop_toxic, train_toxicity


def unused(docs: DataFrame, name: str) -> str:
    """A column name that the documents do not have."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name = f"_{name}"
    return name


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, trained on the labelled rows of this stage's input, does not reject.

    Null and empty texts and rows without id are judged as all others, and so is each of several rows with one id.
    """
    return drop_toxic(docs, train_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, one row with the smallest id; rows with one id and different texts are no copies.

    Null and empty texts are equal to each other.  A row without id stays, once, if no row with an id has its text.  Of
    rows that share id and text the first by all columns stays.
    """
    sha, rows, nth = (unused(docs, n) for n in ("sha", "rows", "nth"))
    kept = exact_dedup(docs).where("kept").groupBy("doc_id", "text_sha256").agg(F.count(F.lit(1)).alias(rows))
    keyed = docs.withColumn(sha, F.sha2(normalised(F.col("text")), 256))
    same = F.col("d.doc_id").cast("long").eqNullSafe(F.col("k.doc_id")) & (F.col(sha) == F.col("k.text_sha256"))
    joined = keyed.alias("d").join(kept.alias("k"), same).select("d.*", rows)
    order = Window.partitionBy("doc_id", sha).orderBy(*docs.columns)
    repeated = joined.where(F.col(rows) > 1).withColumn(nth, F.row_number().over(order)).where(F.col(nth) == 1)
    return joined.where(F.col(rows) == 1).select(docs.columns).unionByName(repeated.select(docs.columns))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of documents with a Jaccard similarity of 0.8 in 5-word shingles, the one with the smallest id.

    Documents without words and rows without id are linked with nothing and stay.  Rows with one id and different texts
    are documents of their own; if they are linked with each other, one of them stays.
    """
    key = unused(docs, "key")
    first = jaccard_components(docs, words=5, percent=80, with_keys=True).where("row_key = leader_key").select("row_key").distinct()
    keyed = docs.withColumn(key, row_key(F.col("doc_id"), F.col("text")))
    return keyed.join(first.withColumnRenamed("row_key", key), key, "left_semi").select(docs.columns)


def without_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark.

    A row is judged by its text alone, so rows without id or with a repeated one go or stay as any other; null and empty
    texts hold nothing and stay.
    """
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all pieces of the documents in sequences of 2048 tokens.

    A null or empty text is its end token; a row without id is packed under a null id, and every repeated row is packed.
    """
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", without_toxic),
    ("exact_dedup", without_copies),
    ("ngram_jaccard", without_near_copies),
    ("decontamination", without_test_items),
    ("packing", packed),
]

#: No stage's model or packing can be expressed in SQL; the tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage has written for itself goes when its result is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        with scratch(spark) as keep:
            docs = keep(shared_table(stage(spark, docs, sf_dir), name))
    return STAGES[-1][1](spark, docs, sf_dir)
