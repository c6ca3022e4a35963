"""Best-fit packing of token sequences by minimum bin slack (Gupta and Ho 1999) over the histogram of piece lengths.

A piece's length is at most the capacity, so the whole packing problem is a histogram of ``capacity`` counts, whatever
the number of documents.  The driver fills bin after bin from it: a bitset of reachable sums (one big integer, a bit a
sum) finds the fullest combination of available lengths, which is removed as many times as the counts allow.  The plan
is a list of segments (length, first rank, last rank, bins, offset); pieces look their place up by their rank among
the pieces of their length.  Ranks are dealt over (length, shard), so no length is gathered in one task.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from velora.llm.common import give_back, shared_table, small_batches

CAPACITY = 2048
_ENCODERS: dict[str, WordTokens] = {}


def byte_letters() -> dict[int, str]:
    """The letters that byte-level vocabularies write for bytes: printable bytes are themselves, the others follow from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


BYTE_LETTERS = byte_letters()


def _bytes(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def plain_word(word: str) -> bool:
    """Latin letters alone, composed and in lower case: the vocabulary's normaliser and splitter leave such a word as it is."""
    return word.isalpha() and (word.isascii() or (max(word) < "\u0250" and word == word.lower()))


class WordTokens(dict):
    """Little-endian token ids by word, for a vocabulary that never joins tokens over white space.

    The vocabulary's own rules cut a text at white space before anything else, so a text's ids are its words' ids in
    order.  Lower-casing A-Z first changes nothing for ordinary words, as the vocabulary lower-cases; the vocabulary's
    added tokens stand for themselves in the raw text alone, so a word that might hold one, in any case, keeps its case.
    Holds ``limit`` words at most, some 30 MB, as a worker keeps them while it serves other stages; the others, mostly words
    that hardly recur, are encoded again where they occur.
    """

    def __init__(self, path: str, limit: int = 200_000):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer, self.limit = Tokenizer.from_file(path), limit
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        if any(len(a.split()) != 1 for a in self.added):
            raise ValueError("an added token holds white space, so texts cannot be cut there")

    def words(self, text: str | None) -> list[bytes]:
        raw = (text or "").encode()
        low = raw.lower()
        if not any(a.lower() in low for a in self.added):
            return low.split()
        return [w if any(a.lower() in w.lower() for a in self.added) else w.lower() for w in raw.split()]

    def learn(self, words: set[bytes]) -> dict[bytes, bytes]:
        """The ids of words that are not held, all encoded at once; a closing mark after a letter is a token run of its own."""
        own: dict[bytes, bytes] = {}
        merge = self.tokenizer.model.tokenize
        marks = (b".", b",", b"!", b"?", b";", b":")
        split = {w: (w[:-1], w[-1:]) for w in words if w.endswith(marks) and w[-2:-1].isalpha()}
        need = list({x for w in words for x in split.get(w, (w,)) if x not in self})
        rest = []
        for w in need:
            text = w.decode()
            if plain_word(text):
                own[w] = _bytes([t.id for t in merge(w.decode("latin-1").translate(BYTE_LETTERS))])
            else:
                rest.append(w)
        for start in range(0, len(rest), 20_000):
            part = rest[start : start + 20_000]
            for w, e in zip(part, self.tokenizer.encode_batch_fast([w.decode() for w in part], add_special_tokens=False), strict=True):
                own[w] = _bytes(e.ids)
        for w, (stem, mark) in split.items():
            own[w] = b"".join(own[x] if x in own else self[x] for x in (stem, mark))
        if len(self) + len(own) <= self.limit:
            self.update(own)
        return own

    def encode(self, words: list[bytes], own: dict[bytes, bytes]) -> bytes:
        return b"".join([self[w] if w in self else own[w] for w in words]) if own else b"".join(map(self.__getitem__, words))


def encoder(path: str) -> WordTokens:
    """One per Python worker, so that words stay known from task to task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordTokens(path)
    return _ENCODERS[path]


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def batch_pieces(tokens: WordTokens, batch: pa.RecordBatch, capacity: int, end: bytes) -> pa.RecordBatch:
    """The pieces of a batch of ids and texts."""
    ids, texts = batch.column(0).to_pylist(), batch.column(1)
    out = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32")}
    at = 0
    while at < len(ids):  # so many documents at a time that their words stay small
        stop, size = at, 0
        while stop < len(ids) and (size < 1_000_000 or stop == at):
            size += len(texts[stop].as_py() or "")
            stop += 1
        words = [tokens.words(t.as_py()) for t in texts[at:stop]]
        own = tokens.learn(set().union(*words) - tokens.keys())
        for i, w in zip(ids[at:stop], words, strict=True):
            raw = tokens.encode(w, own) + end
            for piece, start in enumerate(range(0, len(raw), 4 * capacity)):
                part = raw[start : start + 4 * capacity]
                for k, v in zip(out, (i, piece, start // 4, len(part) // 4, zlib.crc32(part)), strict=True):
                    out[k].append(v)
        at = stop
    return pa.RecordBatch.from_pydict(out, schema=pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), *((k, pa.int64()) for k in ("start", "length", "ids_crc32"))]))


def token_pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """One row per piece of at most ``capacity`` ids; every document ends with ``end_id``, so an empty one has one piece."""
    small_batches(docs.sparkSession)
    end = _bytes([end_id])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(tokenizer_path)
        yield from (batch_pieces(tokens, b, capacity, end) for b in batches)
        give_back()

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(cut, PIECES)


def fullest(counts: dict[int, int], capacity: int) -> list[tuple[int, int]]:
    """The longest length and the combination (length, how many) of the rest that fills the bin best.

    Every bin takes the longest piece that is left (the variant MBS' of Fleszar and Hindi 2002), so long pieces do not
    pile up at the end.  ``reach`` has bit s if some of the lengths seen so far sum to s.  Each length enters in powers
    of two of its count, and the sums before each entry are kept to trace the combination back; long ones come first.
    """
    longest = max(counts)
    room = capacity - longest
    mask, reach, steps = (1 << (room + 1)) - 1, 1, []
    for length in sorted(counts, reverse=True):
        left, many = min(counts[length] - (length == longest), room // length), 1
        while left > 0:
            take = min(many, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            left, many = left - take, many * 2
        if reach >> room:
            break
    total, chosen = reach.bit_length() - 1, {longest: 1}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            total -= length * take
            chosen[length] = chosen.get(length, 0) + take
    return sorted(chosen.items(), reverse=True)


def bin_plan(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[np.ndarray, int]:
    """Segments (length, first rank, end rank, per bin, first bin, offset) and the number of bins.

    Every step removes one combination as often as it fits, and so uses up a length or leaves fewer of it than the
    combination has: there are at most ``capacity`` * log2(capacity) steps, whatever the counts are.
    """
    left, used, bins, out = {k: v for k, v in histogram.items() if v}, dict.fromkeys(histogram, 0), 0, []
    while left:
        chosen = fullest(left, capacity)
        times, offset = min(left[length] // n for length, n in chosen), 0
        for length, n in chosen:
            out.append((length, used[length], used[length] + n * times, n, bins, offset))
            used[length] += n * times
            left[length] -= n * times
            offset += n * length
            if not left[length]:
                del left[length]
        bins += times
    return np.array(sorted(out), np.int64).reshape(-1, 6), bins


def pack(pieces: DataFrame, capacity: int = CAPACITY, shard_rows: int = 2_000_000) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces with ``doc_id, piece, length``.

    The order of equal lengths is by (shard, doc_id, piece, start, ids_crc32), so the result is the same on every run; rows that are equal in
    all of them are interchangeable.  An empty table gives an empty result.
    """
    small_batches(pieces.sparkSession)
    pieces = shared_table(pieces, "pieces")
    shards = max(64, -(-pieces.count() // shard_rows))
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32"), F.lit(shards)).cast("int"))
    counts = dealt.groupBy("length", "shard").agg(F.count(F.lit(1)).alias("rows"))
    histogram = {r.length: r["rows"] for r in counts.groupBy("length").agg(F.sum("rows").alias("rows")).collect()}  # capacity rows at most
    segments, _ = bin_plan(histogram, capacity)
    before = F.sum("rows").over(Window.partitionBy("length").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("length", "shard", F.coalesce(before, F.lit(0)).alias("before"))
    rank = F.row_number().over(Window.partitionBy("length", "shard").orderBy("doc_id", "piece", "start", "ids_crc32")) - 1
    ranked = dealt.withColumn("rank", rank).join(starts, ["length", "shard"]).withColumn("rank", F.col("rank") + F.col("before"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            # segments are sorted by length and first rank; a length's ranks are gapless
            wide = int(max(segments[:, 2].max(initial=0), rank.max(initial=0))) + 1
            at = np.searchsorted(segments[:, 0] * wide + segments[:, 1], length * wide + rank, "right") - 1
            s, i = segments[at], rank - segments[at, 1]
            cols = [b.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(s[:, 4] + i // s[:, 3]), pa.array(s[:, 5] + i % s[:, 3] * length)], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(place, PIECES + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Tokenise, cut and pack: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    A null text counts as empty and is the end token alone.  Repeated rows are packed as often as they occur.  Other
    columns of ``docs`` are not read.
    """
    return pack(token_pieces(docs, tokenizer_path, id_col, text_col, capacity), capacity)
