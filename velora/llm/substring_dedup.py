"""Substring deduplication with a compressed FM-index per shard.

A window is a run of ``length`` words; a word goes if a window that covers it starts at another place too.

1. Every window has a minimizer: its 8-word run with the smallest hash.  Equal windows have equal minimizers, so only
   runs of windows whose minimizer occurs more than once ("segments") can hold repeats; the rest is never shipped.
2. Equal segments are folded into one with a count; where it is two or more, all its places match over a whole window.
3. Segments are dealt by minimizer into shards of bounded size.  Each shard builds an FM-index of its segments
   (Burrows-Wheeler transform, wavelet matrix).  The segments' words are streamed through backward search, which gives the
   matching statistics of every place (how many words up to it stand elsewhere too, up to a window's length), and the
   runs of places that reach the window's length are reported as intervals.  Equal windows are in one shard, so no place
   of a window is missed.
4. Minimizers with too many segments for a shard (a passage in a large part of all documents) are counted window by
   window in a shuffle instead, with map-side combining: the exact way for the rest.

The intervals return to their documents, those of a segment in many documents by broadcast, and only documents with
intervals are joined with them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velora.llm.common import Bitmap, bitmap_of, by_key, gram_hashes, join_classes, scratch, shared_table, small_batches, text_groups, text_words
from velora.llm.fm_index import FMIndex

GRAM, RUN = 8, 256
#: Words of a shard, and words under one minimizer beyond which it is counted window by window.
SHARD_WORDS, HOT_WORDS = 400_000, 2_500_000


def _slide(x: np.ndarray, n: int, pick: np.ufunc) -> np.ndarray:
    """Smallest or largest of every n neighbours."""
    out, span = x, 1
    while span * 2 <= n:
        out, span = pick(out[:-span], out[span:]), span * 2
    return pick(out[: len(x) - n + 1], out[n - span : n - span + len(x) - n + 1]) if span < n else out


def minimizers(words: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The 8-word hashes by place, and each window's smallest one; empty for fewer words (hashes) than a window."""
    if len(words) < length:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    grams = gram_hashes(words, GRAM)
    return grams, _slide(grams, length - GRAM + 1, np.minimum)


def minimizer_places(words: np.ndarray, length: int) -> np.ndarray:
    """The hashes of all places that are the minimizer of some window, one for each place."""
    grams, least = minimizers(words, length)
    if not len(least):
        return grams
    span = length - GRAM + 1
    padded = np.concatenate([np.zeros(span - 1, np.uint64), least, np.zeros(span - 1, np.uint64)])
    return grams[_slide(padded, span, np.maximum) == grams]


def _hashed(texts: pa.Array) -> Iterator[tuple[int, bytes, np.ndarray]]:
    """Each text's place, bytes and word hashes."""
    for at, part in text_groups(texts):
        raws = [(t or "").encode() for t in part]
        h, counts = text_words(raws)
        for i, (raw, words) in enumerate(zip(raws, np.split(h, np.cumsum(counts)[:-1]), strict=True)):
            yield at + i, raw, words


SEGMENTS = "doc long, row long, start int, windows int, m long, d1 long, d2 long, text binary"


def segments(docs: DataFrame, repeated: Bitmap, length: int) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: dict[str, list] = {k: [] for k in ("doc", "row", "start", "windows", "m", "d1", "d2", "text")}
            ids, keys = b.column(0).to_pylist(), b.column(1).to_pylist()
            for at_row, raw, hashes in _hashed(b.column(2)):
                _, least = minimizers(hashes, length)
                hit = repeated.has(least)
                if not hit.any():
                    continue
                doc, row, words = ids[at_row], keys[at_row], raw.split()
                edges = np.flatnonzero(np.concatenate([[True], (least[1:] != least[:-1]) | (hit[1:] != hit[:-1]), [True]]))
                for s, e in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                    if not hit[s]:
                        continue
                    for at in range(s, e, RUN):
                        n = min(RUN, e - at)
                        text = b" ".join(words[at : at + n + length - 1])
                        d = np.frombuffer(xxhash.xxh3_128_digest(text), np.int64)
                        for k, v in zip(out, (doc, row, at, n, least[s].view(np.int64), d[0], d[1], text), strict=True):
                            out[k].append(v)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("doc", pa.int64()), ("row", pa.int64()), ("start", pa.int32()), ("windows", pa.int32()), *((k, pa.int64()) for k in ("m", "d1", "d2")), ("text", pa.binary())]))

    return docs.mapInArrow(rows, SEGMENTS)


FOUND = pa.schema([("d1", pa.int64()), ("d2", pa.int64()), ("copies", pa.int64()), ("at", pa.int32()), ("windows", pa.int32())])
FOUND_COLUMNS = "d1 long, d2 long, copies long, at int, windows int"


def shard_matches(texts: list[bytes], copies: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment, first window, windows) of the repeated windows of a shard's different segments."""
    words = (b" \n ".join(texts) + b" \n").split(b" ")  # no word is a line break: it stands between segments
    ids = {w: i for i, w in enumerate(dict.fromkeys([b"\n", *words]))}
    text = np.fromiter(map(ids.__getitem__, words), np.int64, len(words))
    ends = np.flatnonzero(text == 0)
    begins = np.concatenate([[0], ends[:-1] + 1])
    windows = ends - begins - length + 1
    twice = copies > 1
    whole = np.flatnonzero(twice)
    parts = [(whole, np.zeros(len(whole), np.int64), windows[whole])]
    once = np.flatnonzero(~twice)
    if len(once):
        owner = np.repeat(once, windows[once])
        at = np.arange(len(owner)) - np.repeat(np.cumsum(windows[once]) - windows[once], windows[once])
        hit = FMIndex(text, length).matching_statistics(text, begins[owner] + at + (length - 1), length) == length
        new = np.concatenate([[True], (owner[1:] != owner[:-1]) | ~hit[:-1]]) & hit
        last = np.concatenate([(owner[1:] != owner[:-1]) | ~hit[1:], [True]]) & hit
        first, final = np.flatnonzero(new), np.flatnonzero(last)
        parts.append((owner[first], at[first], final - first + 1))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _shard_intervals(distinct: DataFrame, length: int) -> DataFrame:
    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in by_key(batches, 1):
            k, at, windows = shard_matches(t.column("text").to_pylist(), t.column("copies").to_numpy(), length)
            if len(k):
                yield pa.RecordBatch.from_arrays([*(pa.array(t.column(c).to_numpy()[k]) for c in ("d1", "d2", "copies")), pa.array(at, pa.int32()), pa.array(windows, pa.int32())], schema=FOUND)

    return distinct.select("shard", "d1", "d2", "copies", "text").repartition("shard").sortWithinPartitions("shard").mapInArrow(match, FOUND_COLUMNS)


def _window_intervals(distinct: DataFrame, length: int) -> DataFrame:
    """The same for hot minimizers: every window's hash is counted over all segments."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for d1, d2, copies, t in zip(*(b.column(c).to_pylist() for c in ("d1", "d2", "copies", "text")), strict=True):
                words = t.split(b" ")
                n = len(words) - length + 1
                w = np.frombuffer(b"".join(xxhash.xxh3_128_digest(b" ".join(words[i : i + length])) for i in range(n)), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(w[:, 0].copy()), pa.array(w[:, 1].copy()), pa.array([d1] * n, pa.int64()), pa.array([d2] * n, pa.int64()), pa.array(np.arange(n, dtype=np.int32)), pa.array([copies] * n, pa.int64())], names=["w1", "w2", "d1", "d2", "at", "copies"])

    each = distinct.select("d1", "d2", "copies", "text").mapInArrow(windows, "w1 long, w2 long, d1 long, d2 long, at int, copies long")
    often = each.groupBy("w1", "w2").agg(F.sum("copies").alias("n")).where("n > 1")
    return join_classes(each, shared_table(often, "often"), ["w1", "w2"], "n").select("d1", "d2", "copies", "at", F.lit(1).alias("windows"))


def repeated_intervals(docs: DataFrame, length: int) -> DataFrame:
    """``doc, row, intervals`` (start word, end word) of the documents that hold repeated windows."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [minimizer_places(words, length) for _, _, words in _hashed(b.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([*found, np.empty(0, np.uint64)]).view(np.int64))], names=["m"])

    often = docs.select("text").mapInArrow(places, "m long").groupBy("m").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("m")
    cut = shared_table(segments(docs, bitmap_of(shared_table(often, "often"), "m"), length), "segments")

    distinct = cut.groupBy("m", "d1", "d2", "windows", "text").agg(F.count(F.lit(1)).alias("copies"))
    distinct = shared_table(distinct, "distinct")
    size = F.sum(F.col("windows") + (length - 1)).alias("words")
    by_m = distinct.groupBy("m").agg(size)
    hot = shared_table(by_m.where(F.col("words") > HOT_WORDS).select("m"), "hot")
    total = distinct.agg(size).first().words or 0
    shards = max(1, -(-total // SHARD_WORDS))
    dealt = distinct.withColumn("shard", F.pmod(F.xxhash64("m"), F.lit(shards)))
    if hot.isEmpty():
        found = _shard_intervals(dealt, length)
    else:
        found = _shard_intervals(dealt.join(hot, "m", "left_anti"), length).unionByName(_window_intervals(distinct.join(hot, "m", "left_semi"), length))
    spans = found.groupBy("d1", "d2").agg(F.max("copies").alias("copies"), F.collect_set(F.struct("at", "windows")).alias("spans"))  # of RUN windows at most
    at = join_classes(cut.select("doc", "row", "start", "d1", "d2"), shared_table(spans, "spans"), ["d1", "d2"], "copies")
    first = lambda x: F.col("start") + x["at"]
    placed = F.transform("spans", lambda x: F.struct(first(x).alias("s"), (first(x) + x["windows"] + (length - 1)).alias("e")))
    # a set: rows that repeat an id and a text give the same lists, which already fall together in the tasks before the shuffle
    return at.select("doc", "row", placed.alias("i")).groupBy("doc", "row").agg(F.array_distinct(F.flatten(F.collect_set("i"))).alias("intervals"))


KEPT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 35, with_text: bool = False) -> DataFrame:
    """Per row: ``doc_id, n_words, n_removed, kept_sha256`` (and ``kept_text`` on request, the kept words joined by one space).

    Words are runs without ASCII white space, unchanged.  Windows are judged on the input.  Null texts, texts without
    words and texts shorter than a window keep all they have.  Repeated rows are places of their own, so all their
    windows go; rows that share an id with different texts are told apart; a null id is carried through.  Texts of any
    length are read whole.  An empty table gives an empty result; other columns are not read.
    """
    small_batches(docs.sparkSession)
    inputs = docs.select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(F.col(text_col)).alias("row"), F.col(text_col).alias("text"))
    with scratch(docs.sparkSession) as keep:
        intervals = keep(shared_table(repeated_intervals(inputs, length), "intervals"))
    touched = bitmap_of(intervals, "row")

    def split(hit: bool):
        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                b = b.filter(pa.array(touched.has(b.column(1).to_numpy()) == hit))
                yield from kept([b.append_column("intervals", pa.nulls(b.num_rows, pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))))]) if not hit else [b]

        return rows

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: dict[str, list] = {k: [] for k in ("doc_id", "n_words", "n_removed", "kept_sha256", "kept_text")}
            for doc, t, spans in zip(b.column("doc").to_pylist(), b.column("text"), b.column("intervals"), strict=True):
                words, stay = (t.as_py() or "").encode().split(), None
                n = len(words)
                if spans.is_valid:
                    change = np.zeros(n + 1, np.int64)
                    for i in spans.as_py():
                        change[i["s"]] += 1
                        change[i["e"]] -= 1
                    stay = np.cumsum(change[:n]) == 0
                    words = [w for w, s in zip(words, stay.tolist(), strict=True) if s]
                text = b" ".join(words)
                for k, v in zip(out, (doc, n, n - len(words), hashlib.sha256(text).hexdigest(), text.decode() if with_text else None), strict=True):
                    out[k].append(v)
            if not with_text:
                del out["kept_text"]
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), *([("kept_text", pa.string())] * with_text)]))

    result = KEPT + ", kept_text string" * with_text
    clean = inputs.mapInArrow(split(False), result)
    some = inputs.mapInArrow(split(True), "doc long, row long, text string").alias("d")
    both = some.join(intervals.alias("i"), F.col("d.doc").eqNullSafe(F.col("i.doc")) & (F.col("d.row") == F.col("i.row")), "left")
    return clean.unionByName(both.select("d.doc", "d.text", "intervals").mapInArrow(kept, result))
