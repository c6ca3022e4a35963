"""Toxicity by a factorization machine over hashed terms (Rendle 2010).

Terms are a text's different words, without marks at their edges, and their beginnings of 3 to 5 bytes.  Every term is
hashed to one of 2**18 cells, whatever its frequency or label: no term is selected or left out.  A cell has a weight and
``factors`` numbers: weights add up, and factors score every pair of terms, all in time linear in the number of terms.
The model is fitted in one task from ``train_rows`` labelled rows at most (the ones with the smallest hash of the id; a
documented bound), so its cost and memory do not depend on the size of the corpus; scoring is one scan without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velora.llm.common import fold, mixed, shared_table, small_batches, span_hashes

CELL_BITS, BEGINNINGS = 18, (3, 4, 5)
#: What may stand around a word, and white space (with the zero byte between texts).
EDGE = np.zeros(256, bool)
EDGE[list(b".,;:!?\"'()[]{}*#$%&|<>-_")] = True
SPACE = np.zeros(256, bool)
SPACE[list(b" \t\n\v\f\r\0")] = True


def term_cells(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The different cells of each text's terms one after the other, in order, and how many each text has."""
    raws = [(t or "").lower().encode() for t in texts]
    raw = np.frombuffer(b"\0".join([*raws, b""]), np.uint8)
    sizes = np.zeros(len(texts), np.int64)
    if not len(raw):
        return np.empty(0, np.int64), sizes
    text_ends = np.cumsum([len(r) + 1 for r in raws])
    space = SPACE[raw]
    inside = ~(space | EDGE[raw])
    words = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    ends = np.flatnonzero(~space & np.concatenate([space[1:], [True]])) + 1
    if not len(words):
        return np.empty(0, np.int64), sizes
    places = np.arange(len(raw))
    first = np.minimum.reduceat(np.where(inside, places, len(raw)), words)  # over the word and the space behind it
    last = np.maximum.reduceat(np.where(inside, places, -1), words) + 1
    keep = first < ends
    first, last = first[keep], last[keep]
    owner = np.searchsorted(text_ends, first, "right")
    hashed = span_hashes(raw)
    parts = [(owner, hashed(first, last))]
    for n in BEGINNINGS:
        long = last - first > n
        parts.append((owner[long], mixed(hashed(first[long], first[long] + n))))  # scrambled again: a beginning is no word
    keys = np.concatenate([(o.astype(np.uint64) << np.uint64(CELL_BITS)) | (h >> np.uint64(64 - CELL_BITS)) for o, h in parts])
    keys.sort()
    keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])] if len(keys) else keys
    sizes = np.bincount((keys >> np.uint64(CELL_BITS)).astype(np.int64), minlength=len(texts))
    return (keys & np.uint64((1 << CELL_BITS) - 1)).astype(np.int64), sizes


class FactorizationMachine:
    """The bias, and the weights and factors of the cells."""

    def __init__(self, factors: int = 4, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.bias = 0.0
        self.w = np.zeros(1 << CELL_BITS, np.float32)
        self.v = rng.normal(0, 0.02, (1 << CELL_BITS, factors)).astype(np.float32)

    def margins(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Log-odds of texts whose terms stand one after the other; pairs are scaled by the number of terms."""
        out, full = np.full(len(sizes), self.bias), sizes > 0
        if not len(ids):
            return out
        start = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
        v = self.v.take(ids, axis=0)
        sums = np.add.reduceat(v, start)
        np.square(v, out=v)
        pairs = (sums * sums).sum(axis=1) - np.add.reduceat(v, start).sum(axis=1)
        out[full] += np.add.reduceat(self.w.take(ids), start) + 0.5 * pairs / np.sqrt(sizes[full])
        return out

    def fit(self, rows: list[np.ndarray], labels: np.ndarray, epochs: int = 4, steps: int = 200, batch: int = 256, rate: float = 0.3, l1: float = 2e-3, l2: float = 1e-3, start: float = 1000.0, seed: int = 7) -> None:
        """Adagrad on the logistic loss; after each step the weights in use shrink towards zero, so idle terms stay silent.

        Adagrad begins from a large sum, so that a word of one text moves little while a word of many texts moves far; with
        few rows there are more epochs, up to ``steps`` steps.  The rarer label weighs more, so 0.5 lies between the two
        labels and not next to the rarer one."""
        rng, sizes = np.random.default_rng(seed), np.array([len(r) for r in rows])
        gw, gv, gb = np.full(len(self.w), start, np.float32), np.full(self.v.shape, start / 10, np.float32), 1e-2
        share = min(max(labels.mean(), 1e-3), 1 - 1e-3)
        weight = np.where(labels > 0, 0.5 / share, 0.5 / (1 - share))  # both labels weigh the same in sum
        for _ in range(max(epochs, -(-steps * batch // max(len(rows), batch)))):
            order = rng.permutation(len(rows))
            for at in range(0, len(order), batch):
                pick = order[at : at + batch]
                ids, n = np.concatenate([rows[i] for i in pick]), sizes[pick]
                error = 1 / (1 + np.exp(-np.clip(self.margins(ids, n), -30, 30))) - labels[pick]
                error *= weight[pick]
                gb += float(error.sum()) ** 2
                self.bias -= rate * float(error.sum()) / np.sqrt(gb)
                if not len(ids):
                    continue
                owner = np.repeat(np.arange(len(pick)), n)
                sums = np.zeros((len(pick), self.v.shape[1]), np.float32)
                sums[n > 0] = np.add.reduceat(self.v[ids], np.concatenate([[0], np.cumsum(n[n > 0])[:-1]]))
                e = error[owner].astype(np.float32)
                dv = (e / np.sqrt(n[owner]).astype(np.float32))[:, None] * (sums[owner] - self.v[ids])
                by = np.argsort(ids, kind="stable")
                used, first = np.unique(ids[by], return_index=True)
                dw, dv = np.add.reduceat(e[by], first), np.add.reduceat(dv[by], first)
                gw[used] += dw * dw
                gv[used] += dv * dv
                w = self.w[used] - rate * dw / np.sqrt(gw[used])
                self.w[used] = np.sign(w) * np.maximum(np.abs(w) - l1, 0)
                self.v[used] -= 0.5 * rate * dv / np.sqrt(gv[used]) + l2 * self.v[used]

    def predict(self, texts: list[str | None]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(*term_cells(texts)), -30, 30)))


def _chunks(texts: pa.Array, chars: int = 250_000) -> Iterator[list[str | None]]:
    part, size = [], 0
    for t in texts:
        part.append(t.as_py())
        size += len(part[-1] or "")
        if size >= chars:
            yield part
            part, size = [], 0
    if part:
        yield part


def train_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", folds: int = 5, held_fold: int = 0, train_rows: int = 12_000) -> FactorizationMachine | None:
    """A model from labelled rows outside the held fold; None without any.

    Several labels of an id count as toxic if one is; an id with several texts gives a row for each different text, and
    rows without id or label teach nothing.  ``train_rows`` bounds the ids and the rows: of more rows those with the
    smallest hashes of id and text are taken.
    """
    small_batches(docs.sparkSession)
    lab = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & (fold(F.col(id_col), folds) != held_fold))
    lab = lab.groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("label"))
    lab = lab.orderBy(F.xxhash64("id"), "id").limit(train_rows)  # at most train_rows small rows: safe to broadcast
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(lab), "id")
    picked = picked.withColumn("h", F.xxhash64("text")).dropDuplicates(["id", "h"])

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = []
            for part in _chunks(b.column("text")):
                at, sizes = term_cells(part)
                ids += [x.astype("<i4").tobytes() for x in np.split(at, np.cumsum(sizes)[:-1])]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("h"), b.column("label"), pa.array(ids, pa.binary())], names=["id", "h", "label", "ids"])

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, labels = [], []
        for b in batches:
            rows += [np.frombuffer(x.as_py(), "<i4") for x in b.column("ids")]
            labels += b.column("label").to_pylist()
        if rows:
            m = FactorizationMachine()
            m.fit(rows, np.array(labels, float))
            yield pa.RecordBatch.from_arrays([pa.array([m.bias]), pa.array([m.w.tobytes()]), pa.array([m.v.tobytes()])], names=["bias", "w", "v"])

    rows = shared_table(picked.mapInArrow(mapped, "id long, h long, label int, ids binary"), "labelled")
    taken = rows.select("id", "h").orderBy(F.xxhash64("id", "h"), "id", "h").limit(train_rows)
    # train_rows rows meet in one task, in one order
    rows = rows.join(F.broadcast(taken), ["id", "h"]).repartition(1).sortWithinPartitions("id", "h")
    got = rows.select("label", "ids").mapInArrow(fitted, "bias double, w binary, v binary").collect()
    if not got:
        return None
    model = FactorizationMachine()
    model.bias, model.w = got[0].bias, np.frombuffer(got[0].w, np.float32)
    model.v = np.frombuffer(got[0].v, np.float32).reshape(model.v.shape)
    return model


def score_toxicity(docs: DataFrame, model: FactorizationMachine | None, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, held_fold: int = 0) -> DataFrame:
    """Per row: ``doc_id, held_out, score, predicted``.

    The whole text is scored, whatever its length, and nothing but the text.  Null and empty texts have no terms and get
    the bias alone; without a model every score is 0.  Repeated rows and rows without id are scored as all others; a
    score of just 0.5 is toxic.  An empty table gives an empty result; other columns are not read.
    """

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = [model.predict(part) for part in _chunks(b.column("text"))] if model is not None else [np.zeros(b.num_rows)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(np.concatenate([*s, np.empty(0)]))], names=["doc_id", "held_out", "score"])

    small_batches(docs.sparkSession)
    inputs = docs.select(F.col(id_col).cast("long").alias("doc_id"), (fold(F.col(id_col), folds) == held_fold).alias("held_out"), F.col(text_col).alias("text"))
    out = inputs.mapInArrow(scored, "doc_id long, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def toxicity(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Train on the labelled rows and score every row."""
    return score_toxicity(docs, train_toxicity(docs, labels, **options))


def drop_toxic(docs: DataFrame, model: FactorizationMachine | None, text_col: str = "text") -> DataFrame:
    """The rows that are not predicted toxic, with all their columns, in one scan; without a model all rows stay."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = np.concatenate([*(model.predict(part) for part in _chunks(b.column(at))), np.empty(0)])
            yield b.filter(pa.array(s < 0.5))

    if model is None:
        return docs
    small_batches(docs.sparkSession)
    at = docs.columns.index(text_col)
    return docs.mapInArrow(kept, docs.schema)
