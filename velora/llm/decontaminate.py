"""Benchmark decontamination: a BM25 index of the test items, searched with every passage by block-max WAND.

The test items are indexed, not the corpus.  Items come to the driver in shards of bounded size; a shard's inverted
index (term, item, impact) is sparse, and the indexes of ``SHARDS`` shards are broadcast together, so a larger benchmark
costs more scans and never more memory.  The executors stream all documents past it.  A passage of a document (two
neighbouring cells of words) is the query, and the passages of many documents are searched at once:

1. WAND bound: the sum of its terms' largest impacts anywhere; below the threshold the passage is skipped.
2. Block-max bound: the same for each block of items; only blocks that reach the threshold are opened.
3. Only the postings of open blocks are added up, and every item whose exact score reaches the threshold is retrieved
   (Ding and Suel 2011).  Bounds are taken for all passages together and not by moving a pivot through posting lists.

Impacts are divided by the item's score against itself, so one threshold fits short and long items.  A retrieved item
counts as leaked if enough of its question's and of its answer's word 3-grams stand in the document.  Question and
answer are pieces of their own, so an item is found by either half, however far apart the two stand.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velora.llm.common import shared_table, small_batches, span_hashes

WORD = re.compile(r"\w+")
SPACE = re.compile(r"\s")
#: Characters beyond ASCII that are no letters or digits.
OTHER = re.compile(r"[^\w\x00-\x7F]+")
#: Bytes of words: letters, digits, the underscore and everything beyond ASCII.
INSIDE = np.zeros(256, bool)
INSIDE[list(b"abcdefghijklmnopqrstuvwxyz0123456789_")] = True
INSIDE[128:] = True
K1, B = 1.2, 0.75
BLOCK, SHARDS = 8, 8
#: Cells of passages times pieces of items that are scored at once, as 64-bit numbers.
DENSE = 8_000_000


def item_words(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def stretches(text: str, chars: int) -> Iterator[str]:
    """A text in parts of about so many characters, cut before white space, where no word goes on."""
    start = 0
    while len(text) - start > chars and (gap := SPACE.search(text, start + chars)):
        yield text[start : gap.start()]
        start = gap.start()
    yield text[start:]


def word_hashes(texts: list[str | None], chars: int = 300_000) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the words (as ``item_words`` cuts them) of all texts one after the other, and each text's number of words.

    About ``chars`` characters are hashed at once, whatever the length of a text.
    """
    counts = np.zeros(len(texts), np.int64)
    out, part, owners, size = [], [], [], 0

    def flush() -> None:
        raws = [(t if t.isascii() else OTHER.sub(" ", t)).encode() for t in part]
        raw = np.frombuffer(b" ".join([*raws, b""]), np.uint8)
        inside = INSIDE[raw]
        edge = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0, append=0))
        starts, ends = edge[::2], edge[1::2]
        owner = np.searchsorted(np.cumsum([len(r) + 1 for r in raws]), starts, "right")
        np.add.at(counts, owners, np.bincount(owner, minlength=len(part)))
        out.append(span_hashes(raw)(starts, ends))

    for n, t in enumerate(texts):
        for stretch in stretches((t or "").lower(), chars):
            if part and size + len(stretch) > chars:
                flush()
                part, owners, size = [], [], 0
            part.append(stretch)
            owners.append(n)
            size += len(stretch)
    if part:
        flush()
    return np.concatenate([*out, np.empty(0, np.uint64)]), counts


def grams_within(text: str, wanted: set[tuple[str, ...]], chars: int = 300_000) -> set[tuple[str, ...]]:
    """Those of the wanted grams of one to three words that stand in the text, whose words are read part by part."""
    own: set[tuple[str, ...]] = set()
    words: list[str] = []
    for stretch in stretches(text.lower(), chars):
        words = [*words[-2:], *WORD.findall(stretch)]
        for n in {len(g) for g in wanted}:
            own.update(wanted.intersection(zip(*(words[i:] for i in range(n)), strict=False)))
    return own


def grams(words: list[str], n: int = 3) -> set[tuple[str, ...]]:
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def spread_out(start: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows of a sparse table: which of ``at`` each entry belongs to, and the entries."""
    size = start[at + 1] - start[at]
    owner = np.repeat(np.arange(len(at)), size)
    return owner, np.arange(len(owner)) + np.repeat(start[at] - (np.cumsum(size) - size), size)


class ItemIndex:
    """BM25 impacts of the pieces of test items (``piece`` words at most, so that each lies whole in some passage), with
    the largest impact by term and by term and block, all sparse."""

    def __init__(self, items: list[tuple[int, str]], piece: int = 32):
        self.ids: list[int] = []
        self.halves: list[tuple[set, set]] = []
        self.owner: list[int] = []
        pieces: list[list[str]] = []
        for item, text in items:
            words = item_words(text)
            if not words:
                continue
            middle = len(words) // 2
            halves = (words[:middle], words[middle:]) if len(words) >= 6 else (words, words)
            self.ids.append(item)
            self.halves.append((grams(halves[0]), grams(halves[1])))
            for own in halves if len(words) >= 6 else (words,):
                parts = -(-len(own) // piece)
                for k in range(parts):
                    pieces.append(own[len(own) * k // parts : len(own) * (k + 1) // parts])
                    self.owner.append(len(self.ids) - 1)
        # pieces with the same commonest words stand together, so that a block's largest impacts belong to few vocabularies
        spread: dict[str, int] = {}
        for p in pieces:
            for t in set(p):
                spread[t] = spread.get(t, 0) + 1
        order = sorted(range(len(pieces)), key=lambda n: (sorted(set(pieces[n]), key=lambda t: (-spread[t], t))[:4], n))
        pieces, self.owner = [pieces[n] for n in order], [self.owner[n] for n in order]
        hashes, _ = word_hashes([" ".join(spread)])
        by = dict(zip(spread, hashes.tolist(), strict=True))
        self.terms = {t: i + 1 for i, t in enumerate(sorted(spread, key=by.__getitem__))}  # by hash; 0: not in any item
        self.hashes = np.sort(hashes)
        self.blocks = -(-len(pieces) // BLOCK)
        mean = sum(map(len, pieces)) / max(len(pieces), 1)
        counts = [dict(zip(*np.unique([self.terms[t] for t in p], return_counts=True), strict=True)) for p in pieces]
        docs = np.bincount([t for c in counts for t in c], minlength=len(self.terms) + 1)
        idf = np.log(1 + (len(pieces) - docs + 0.5) / (docs + 0.5))
        rows = []
        for n, (p, c) in enumerate(zip(pieces, counts, strict=True)):
            weight = {t: idf[t] * f * (K1 + 1) / (f + K1 * (1 - B + B * len(p) / mean)) for t, f in c.items()}
            whole = sum(weight.values())
            rows += [(t, n, w / whole) for t, w in weight.items()]
        rows.sort()
        term, self.post_item = (np.array([r[i] for r in rows], np.int64) for i in (0, 1))
        self.post_impact = np.array([r[2] for r in rows], np.float64)
        self.post_start = np.searchsorted(term, np.arange(len(self.terms) + 2))
        # entries by term and block: where their postings start, and their largest impact
        new = np.flatnonzero(np.concatenate([[True], (term[1:] != term[:-1]) | (self.post_item[1:] // BLOCK != self.post_item[:-1] // BLOCK)])) if rows else np.empty(0, np.int64)
        self.entry_posts = np.append(new, len(rows))
        self.entry_block = self.post_item[new] // BLOCK
        self.entry_max = np.maximum.reduceat(self.post_impact, new) if rows else np.empty(0)
        self.entry_start = np.searchsorted(term[new], np.arange(len(self.terms) + 2))
        self.term_max = np.zeros(len(self.terms) + 1)
        np.maximum.at(self.term_max, term, self.post_impact)

    def numbers(self, h: np.ndarray) -> np.ndarray:
        """Terms by hash."""
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, at + 1, 0)

    def search(self, docs: list[np.ndarray], half: int, threshold: float) -> list[dict[int, float]]:
        """For each document the items with a score of ``threshold`` or more for some passage, with their best scores.

        A long document is searched in stretches that share a cell, so every passage lies whole in one of them; the cell
        that ends a stretch is a passage alone too, which scores no more than with its neighbour.
        """
        found: list[dict[int, float]] = [{} for _ in docs]
        most = max(2, DENSE // max(len(self.owner), 1))
        part: list[np.ndarray] = []
        owners: list[int] = []
        cells = 0

        def flush() -> None:
            for n, got in zip(owners, self._search(part, half, threshold), strict=True):
                for item, x in got.items():
                    found[n][item] = max(found[n].get(item, 0.0), x)

        for n, terms in enumerate(docs):
            for start in range(0, max(len(terms) - half, min(len(terms), 1)), (most - 1) * half):
                stretch = terms[start : start + most * half]
                size = -(-len(stretch) // half)
                if part and cells + size > most:
                    flush()
                    part, owners, cells = [], [], 0
                part.append(stretch)
                owners.append(n)
                cells += size
        if part:
            flush()
        return found

    def _search(self, docs: list[np.ndarray], half: int, threshold: float) -> list[dict[int, float]]:
        """The same for documents of ``DENSE`` cells times pieces together.

        Passages are two neighbouring cells of ``half`` words; the bounds of all passages of all the documents are sums
        over cells, taken at once.
        """
        found: list[dict[int, float]] = [{} for _ in docs]
        counts = np.array([-(-len(t) // half) for t in docs], np.int64)
        first = np.cumsum(counts) - counts
        sizes = np.array([len(t) for t in docs], np.int64)
        own = np.concatenate([*docs, np.empty(0, np.int64)])
        cell = np.repeat(first, sizes) + (np.arange(len(own)) - np.repeat(np.cumsum(sizes) - sizes, sizes)) // half
        cell, own = cell[own > 0], own[own > 0]
        if not len(own):
            return found
        cells = int(counts.sum())
        ends_doc = np.zeros(cells, bool)
        ends_doc[(first + counts - 1)[counts > 0]] = True
        slack = threshold - 1e-9  # sums in another order may fall short of the exact ones

        goes_on = ~ends_doc[:-1]

        def passages(sums: np.ndarray) -> np.ndarray:
            """Each cell with the next one of its document."""
            out = sums.copy()
            out[:-1] += sums[1:] * (goes_on if sums.ndim == 1 else goes_on[:, None])
            return out

        def members(open_: np.ndarray) -> np.ndarray:
            """Cells of these passages."""
            out = open_.copy()
            out[1:] |= open_[:-1] & (goes_on if open_.ndim == 1 else goes_on[:, None])
            return out

        alive = passages(np.bincount(cell, weights=self.term_max[own], minlength=cells)) >= slack
        keep = members(alive)[cell]
        once = cell[keep] * (len(self.terms) + 1) + own[keep]
        once.sort()
        once = once[np.concatenate([[True], once[1:] != once[:-1]])] if len(once) else once  # a term counts once in a cell
        cell, own = once // (len(self.terms) + 1), once % (len(self.terms) + 1)
        owner, entry = spread_out(self.entry_start, own)
        key = cell[owner] * self.blocks + self.entry_block[entry]
        sums = np.bincount(key, weights=self.entry_max[entry], minlength=cells * self.blocks).reshape(cells, self.blocks)
        open_ = passages(sums) >= slack
        open_[~alive] = False
        keep = members(open_).reshape(-1)[key]
        owner, entry = owner[keep], entry[keep]
        which, post = spread_out(self.entry_posts, entry)
        pieces = len(self.owner)
        key = cell[owner[which]] * pieces + self.post_item[post]
        score = np.bincount(key, weights=self.post_impact[post], minlength=cells * pieces)
        # one of a passage's two cells has half of the score; a word of both cells counts once
        strong = np.flatnonzero(score >= slack / 2)
        before = strong[strong >= pieces] - pieces
        tried = np.unique(np.concatenate([strong, before[~ends_doc[before // pieces]]]))
        last = ends_doc[tried // pieces]
        bound = score[tried] + np.where(last, 0.0, score[np.where(last, tried, tried + pieces)])
        key, bound = tried[bound >= slack], bound[bound >= slack]
        if not len(key):
            return found
        width = len(self.terms) + 1
        twice = once[np.isin(once + width, once, assume_unique=True) & ~ends_doc[cell]]
        owner, post = spread_out(self.post_start, twice % width)
        both = twice[owner] // width * pieces + self.post_item[post]
        at = np.minimum(np.searchsorted(key, both), len(key) - 1)
        same = key[at] == both
        exact = bound - np.bincount(at[same], weights=self.post_impact[post[same]], minlength=len(key))
        passed = np.flatnonzero(exact >= threshold)
        for doc, piece, x in zip(np.searchsorted(first + counts, key[passed] // pieces, "right").tolist(), (key[passed] % pieces).tolist(), exact[passed].tolist(), strict=True):
            item = self.owner[piece]
            found[doc][item] = max(found[doc].get(item, 0.0), x)
        return found


def shards(items: DataFrame, id_col: str, text_col: str, chars: int) -> Iterator[list[tuple[int, str]]]:
    """The items in order of their id, in lists of about ``chars`` characters; one list is in memory at a time."""
    part, size = [], 0
    for r in items.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).orderBy("id", "text").toLocalIterator():
        part.append((r.id, r.text))
        size += len(r.text)
        if size >= chars:
            yield part
            part, size = [], 0
    if part:
        yield part


LEAKS = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", passage: int = 64, threshold: float = 0.45, overlap: float = 0.6, shard_chars: int = 500_000) -> DataFrame:
    """One row per document and test item that it holds: ``doc_id, item_id, score, question_overlap, answer_overlap``.

    Words are runs of letters, digits and underscores in lower case, so case, punctuation and line breaks do not hide a
    leak.  The question is the first half of an item's words, the answer the second; an item of fewer than six words
    is both.  Null and empty texts hold nothing, null and empty items are nowhere.  Texts of any length are searched whole.
    Repeated rows give equal rows, rows without id are reported with a null id; an item id that occurs twice may be
    reported once per text; without documents or items the result is empty, and other columns are not read.
    """
    return leaked(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), "doc_id long", items, item_id_col, item_text_col, passage, threshold, overlap, shard_chars)


def leaked(rows: DataFrame, key: str, items: DataFrame, item_id_col: str, item_text_col: str, passage: int, threshold: float, overlap: float, shard_chars: int) -> DataFrame:
    """The leaks of rows with a long key and a text; ``key`` is the key's name and type."""
    spark, name = rows.sparkSession, key.split()[0]
    small_batches(spark)
    schema = f"{key}, {LEAKS.split(', ', 1)[1]}"
    out = spark.createDataFrame([], schema)
    parts = shards(items, item_id_col, item_text_col, shard_chars)
    while group := [ItemIndex(part, passage // 2) for _, part in zip(range(SHARDS), parts)]:
        sent = spark.sparkContext.broadcast([index for index in group if index.blocks])

        def searched(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            most = min(50_000, max(10_000, 32_000_000 // max([1, *(index.blocks for index in sent.value)])))  # words at a time

            def verified(ids: list[int | None], texts: list[str | None]) -> Iterator[tuple]:
                h, sizes = word_hashes(texts)
                ends = np.cumsum(sizes)
                for index in sent.value:
                    for i, text, found in zip(ids, texts, index.search(np.split(index.numbers(h), ends[:-1]), passage // 2, threshold), strict=True):
                        if not found:
                            continue
                        own = grams_within(text, set().union(*(half for item in found for half in index.halves[item])))
                        for item, score in sorted(found.items()):
                            shares = [len(g & own) / len(g) for g in index.halves[item]]
                            if min(shares) >= overlap:
                                yield (i, index.ids[item], score, *shares)

            for b in batches:
                got, ids, texts, size = [], [], [], 0
                for i, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                    ids.append(i)
                    texts.append(t.as_py())
                    size += len(texts[-1] or "")
                    if size >= 6 * most:
                        got += verified(ids, texts)
                        ids, texts, size = [], [], 0
                if ids:
                    got += verified(ids, texts)
                if got:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*got, strict=True), (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()), strict=True)], names=[name, "item_id", "score", "question_overlap", "answer_overlap"])

        out = out.unionByName(rows.mapInArrow(searched, schema))
    return out


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", passage: int = 64, threshold: float = 0.45, overlap: float = 0.6, shard_chars: int = 500_000) -> DataFrame:
    """The rows without those that hold a test item; all columns stay.

    A row is judged by its text alone, so rows with the same id or none are told apart.
    """
    key = F.xxhash64(F.col(text_col))
    found = leaked(docs.select(key.alias("key"), F.col(text_col).alias("text")), "key long", items, item_id_col, item_text_col, passage, threshold, overlap, shard_chars)
    found = shared_table(found.select("key").distinct(), "leaked")
    return docs.withColumn("__key", key).join(found.withColumnRenamed("key", "__key"), "__key", "left_anti").drop("__key")
