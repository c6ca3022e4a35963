"""License scan by diagonal voting, in DataFrame functions only.

All rolling 3-grams of a document's words are joined with the 3-gram positions of the license templates (a constant
table of some thousand rows, broadcast).  A hit at word p of template position t, the same word for word, votes for the
diagonal p - t.  A phrase occurs where one diagonal has all its votes; neighbouring diagonals (a word put in or left out)
are merged into a span, and a span is verified word by word: the words of the template that stand there in order must be
a large enough share of the template, and of the span too, so that scattered hits make none.  Only hits are shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from velora.llm.common import LOWER, UPPER
from velora.llm.license_texts import FULL_TEXTS

K = 3
#: Phrases whose word-for-word places are counted, and their labels.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
#: Further templates of the method, matched with gaps: short notices, and whole texts.
TEMPLATES = FULL_TEXTS | {
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "released under the terms of the mit license": "mit",
    "licensed under the apache license version 2 0 you may not use this file except in compliance": "apache-2",
    "this work is licensed under the gnu general public license version 3": "gpl-3",
    "this program is free software you can redistribute it under the gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "this source code form is subject to the terms of the mozilla public license": "mpl-2",
    "licensed under a creative commons attribution 4 0 international license": "cc-by",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "licensed under cc by sa 4 0": "cc-by-sa",
    "this is free and unencumbered software released into the public domain": "unlicense",
}


def license_words(text: Column) -> Column:
    """Lower-cased (A-Z alone) runs of letters, digits and characters beyond ASCII; null has none."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def template_grams(spark: SparkSession, base: dict[str, str], templates: dict[str, str]) -> DataFrame:
    """The 3-grams of all phrases and templates, whose words are cut as those of documents are."""
    texts = spark.createDataFrame([(n, text, label, n < len(base)) for n, (text, label) in enumerate([*base.items(), *templates.items()])], "template int, text string, label string, base boolean")
    words = texts.select("template", "label", "base", license_words(F.col("text")).alias("t")).where(F.size("t") >= K)
    grams = words.select("template", "label", "base", "t", (F.size("t") - K + 1).alias("grams"), F.explode(F.sequence(F.lit(0), F.size("t") - K)).alias("at"))
    return grams.select("template", "label", "base", "grams", "at", *(F.get("t", F.col("at") + i).alias(c) for i, c in enumerate("abc"))).withColumn("gram", F.xxhash64("a", "b", "c"))


def license_spans(words: DataFrame, base: dict[str, str], templates: dict[str, str], coverage: float, drift: int) -> DataFrame:
    """Of rows with ``doc_id, row, words``: ``doc_id, row, template, label, base, places, first, last, start, end, score``.

    A span goes from word ``start`` to ``end`` (excluded); ``score`` is the share of the template that stands there, null if it
    is too small.  Of a base phrase ``places`` counts its whole occurrences, from word ``first`` to word ``last``.
    """
    at = words.where(F.size("words") >= K).select("doc_id", "row", "words", F.explode(F.sequence(F.lit(0), F.size("words") - K)).alias("pos"))
    parts = [F.get("words", F.col("pos") + i) for i in range(K)]
    votes = at.select("doc_id", "row", "pos", *(p.alias(f"w{i}") for i, p in enumerate(parts)), F.xxhash64(*parts).alias("gram"))
    grams = F.broadcast(template_grams(words.sparkSession, base, templates))
    same = reduce(lambda x, y: x & y, [F.col(f"w{i}") == F.col(c) for i, c in enumerate("abc")])  # a shared hash is no vote
    hits = votes.join(grams, "gram").where(same)
    lines = hits.groupBy("doc_id", "row", "template", "label", "base", "grams", (F.col("pos") - F.col("at")).alias("diagonal")).agg(F.collect_set("at").alias("ats"))
    order = Window.partitionBy("doc_id", "row", "template").orderBy("diagonal")
    apart = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(order) > drift).cast("int"), F.lit(1))
    spans = lines.withColumn("apart", apart).withColumn("span", F.sum("apart").over(order))
    full = F.col("base") & (F.size("ats") == F.col("grams"))
    whole = F.flatten(F.collect_list("ats"))
    merged = spans.groupBy("doc_id", "row", "template", "label", "base", "grams", "span").agg(
        F.count(F.when(full, 1)).alias("places"),
        F.min(F.when(full, F.col("diagonal"))).alias("first"),
        F.max(F.when(full, F.col("diagonal"))).alias("last"),
        F.min(F.col("diagonal") + F.array_min("ats")).alias("start"),
        (F.max(F.col("diagonal") + F.array_max("ats")) + K).alias("end"),
        F.array_distinct(F.flatten(F.transform(whole, lambda t: F.sequence(t, t + (K - 1))))).alias("covered"),
    )
    words_there, size = F.size("covered"), F.col("grams") + (K - 1)
    verified = (words_there >= coverage * size) & (words_there >= coverage * F.least(F.col("end") - F.col("start"), size))
    score = F.when(F.col("base"), F.when(F.col("places") > 0, 1.0)).otherwise(F.when(verified, words_there / size))
    return merged.select("doc_id", "row", "template", "label", "base", "places", "first", "last", "start", "end", score.alias("score"))


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", base: dict[str, str] = BASE_PHRASES, templates: dict[str, str] = TEMPLATES, coverage: float = 0.7, drift: int = 2) -> DataFrame:
    """Per row: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``.

    ``n_base`` counts the places of the base phrases, ``labels`` adds those of merged spans that cover ``coverage`` of
    a template; ``score`` is the best coverage, 1 with a base phrase and 0 without any label.  Null, empty and short
    texts have no places; texts of any length are read whole.  Repeated rows get equal results, rows without id are
    scanned as all others, and rows that share an id with different texts are told apart.  Equal coverages of two labels
    are both listed.  An empty table gives an empty result; other columns are not read.
    """
    words = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("row"), license_words(F.col(text_col)).alias("words"))
    found = license_spans(words, base, templates, coverage, drift)
    result = found.where("score IS NOT NULL").groupBy("doc_id", "row").agg(
        F.sum("places").alias("n_base"),
        F.min("first").cast("long").alias("first_word"),
        F.max("last").cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("base"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max("score").alias("score"),
    )
    every = words.select("doc_id", "row", F.size("words").cast("long").alias("n_words")).alias("d")
    joined = every.join(result.alias("r"), F.col("d.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("d.row") == F.col("r.row")), "left")
    return joined.select("d.doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word", F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))
