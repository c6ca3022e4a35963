"""Language identification by a bidirectional gated recurrent network over bytes (Cho et al. 2014), in numpy.

A text's bytes are cut into chunks; two recurrent layers, one from each side, label every byte of a chunk, and a
document's probabilities are the mean over all its bytes.  Chunks of many documents are columns of the same matrices.
The network is trained in one task by backpropagation through time from ``rows_per_language`` whole documents of each
language, and about ``train_rows`` of all languages together, at most (documented bounds), so neither the size of the
corpus nor a column with thousands of dirty labels makes the sample larger; only the weights come to the driver.
Prediction is one scan of all whole texts without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from velora.llm.common import fold, scratch, shared_table, small_batches

LETTER = re.compile(r"[^\W\d_]")  # or a number that is no digit: see has_letter
CHUNK = 64


def softsign(x: np.ndarray) -> np.ndarray:
    """x / (1 + |x|), in place."""
    below = np.abs(x)
    below += 1
    x /= below
    return x


class ByteGRU:
    """Gates z and r and candidate n, each with a row of ``x`` for a byte and a matrix ``u`` for the state before.

    The squashing function is the soft sign (its half plus a half for the gates), which costs a tenth of tanh here;
    every array is contiguous for the same reason.
    """

    def __init__(self, languages: list[str], hidden: int = 8, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.languages, self.hidden = languages, hidden
        h, c = hidden, len(languages)
        self.p = {}
        for side in "fb":
            for gate in "zrn":
                self.p["x" + gate + side] = rng.normal(0, 0.5, (256, h))
                self.p["u" + gate + side] = rng.normal(0, 0.5, (h, h))
            self.p["c" + side] = np.zeros(h)  # bias of the candidate's recurrent part
            self.p["o" + side] = rng.normal(0, 0.3, (h, c))
        self.p["bias"] = np.zeros(c)
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def _pass(self, x: np.ndarray, side: str, keep: bool) -> tuple[np.ndarray, list]:
        """States of one direction, x as (time, chunks); with what the gradient needs."""
        h, (steps, n) = self.hidden, x.shape
        (xz, uz), (xr, ur), (xn, un) = ((self.p["x" + g + side], self.p["u" + g + side]) for g in "zrn")
        c = self.p["c" + side]
        state, out, saved = np.zeros((n, h), c.dtype), np.empty((steps, n, h), c.dtype), []
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            z, r, m = (table.take(x[t], axis=0, mode="clip") for table in (xz, xr, xn))
            for gate, u in ((z, uz), (r, ur)):
                gate += state @ u
                softsign(gate)
                gate *= 0.5
                gate += 0.5
            inner = state @ un
            inner += c
            m += r * inner
            softsign(m)
            new = np.subtract(state, m, out=out[t])
            new *= z
            new += m
            if keep:
                saved.append((t, state, z, r, inner, m))
            state = new
        return out, saved

    def chunk_probabilities(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """Sums over the bytes of each chunk of the label probabilities at every byte; x and mask as (time, chunks)."""
        forward, _ = self._pass(x, "f", False)
        backward, _ = self._pass(x, "b", False)
        logits = self.p["of"].T @ forward.reshape(-1, self.hidden).T
        logits += self.p["ob"].T @ backward.reshape(-1, self.hidden).T
        logits += self.p["bias"][:, None]
        np.exp(np.clip(logits, -30, 30, out=logits), out=logits)
        logits *= mask.reshape(-1) / logits.sum(axis=0)
        return logits.reshape(-1, *x.shape).sum(axis=1).T

    def step(self, x: np.ndarray, y: np.ndarray, mask: np.ndarray) -> dict[str, np.ndarray]:
        """The gradient of the mean cross-entropy over all labelled bytes."""
        h = self.hidden
        (forward, kept_f), (backward, kept_b) = self._pass(x, "f", True), self._pass(x, "b", True)
        logits = forward @ self.p["of"] + backward @ self.p["ob"] + self.p["bias"]
        e = np.exp(logits - logits.max(axis=2, keepdims=True))
        d = e / e.sum(axis=2, keepdims=True)
        d[:, np.arange(len(y)), y] -= 1
        d *= (mask / max(mask.sum(), 1))[:, :, None].astype(d.dtype)
        flat = d.reshape(-1, d.shape[2])
        grad = {"of": forward.reshape(-1, h).T @ flat, "ob": backward.reshape(-1, h).T @ flat, "bias": flat.sum(axis=0)}
        for side, kept, out in (("f", kept_f, "of"), ("b", kept_b, "ob")):
            u = {g: self.p["u" + g + side] for g in "zrn"}
            du, dc = {g: np.zeros_like(u[g]) for g in "zrn"}, np.zeros_like(self.p["c" + side])
            later, rows, parts = np.zeros((x.shape[1], h), d.dtype), [], []
            for t, state, z, r, inner, m in reversed(kept):
                ds = d[t] @ self.p[out].T + later
                dm = ds * (1 - z) * (1 - np.abs(m)) ** 2
                dz = ds * (state - m) * 0.5 * (1 - np.abs(2 * z - 1)) ** 2
                dr = dm * inner * 0.5 * (1 - np.abs(2 * r - 1)) ** 2
                di = dm * r
                later = ds * z
                for g, back in (("z", dz), ("r", dr), ("n", di)):
                    du[g] += state.T @ back
                    later += back @ u[g].T
                dc += di.sum(axis=0)
                rows.append(x[t])
                parts.append((dz, dr, dm))
            at = np.concatenate(rows)
            by = np.argsort(at, kind="stable")
            seen, first = np.unique(at[by], return_index=True)
            for i, g in enumerate("zrn"):
                dx = np.zeros_like(self.p["x" + g + side])
                dx[seen] = np.add.reduceat(np.concatenate([p[i] for p in parts])[by], first)
                grad |= {"x" + g + side: dx, "u" + g + side: du[g]}
            grad["c" + side] = dc
        return grad

    def fit(self, chunks: np.ndarray, labels: np.ndarray, lengths: np.ndarray, steps: int = 120, batch: int = 1024, rate: float = 0.03, seed: int = 11) -> None:
        """Adam with a falling rate, over every chunk once or more: ``steps`` steps, or as many as one round over the
        language with the most chunks takes.  Languages share a step evenly, so a frequent one does not win by its number."""
        rng, m, v = np.random.default_rng(seed), {}, {}
        pools = [rng.permutation(np.flatnonzero(labels == k)) for k in range(len(self.languages))]
        share = max(1, batch // len(pools))
        steps = max(steps, -(-max(map(len, pools)) // share))
        for i in range(1, steps + 1):
            pick = np.concatenate([p[np.arange((i - 1) * share, i * share) % len(p)] for p in pools if len(p)])
            x = np.ascontiguousarray(chunks[pick].T)
            mask = (np.arange(CHUNK)[:, None] < lengths[pick][None, :]).astype(np.float32)
            for k, g in self.step(x, labels[pick], mask).items():
                m[k] = 0.9 * m.get(k, 0) + 0.1 * g
                v[k] = 0.99 * v.get(k, 0) + 0.01 * g * g
                self.p[k] -= (rate * (1 - 0.9 * i / steps) * (m[k] / (1 - 0.9**i)) / (np.sqrt(v[k] / (1 - 0.99**i)) + 1e-7)).astype(np.float32)

    def predict(self, texts: list[bytes], block: int = 2048) -> np.ndarray:
        """Each text's mean label probabilities over all its bytes."""
        chunks, owner, left = cut(texts)
        out = np.zeros((len(texts), len(self.languages)))
        for s in range(0, len(chunks), block):
            x = np.ascontiguousarray(chunks[s : s + block].T)
            mask = (np.arange(CHUNK)[:, None] < left[s : s + block][None, :]).astype(np.float32)
            own, first = np.unique(owner[s : s + block], return_index=True)
            out[own] += np.add.reduceat(self.chunk_probabilities(x, mask).astype(np.float64), first)
        return out / np.maximum([len(t) for t in texts], 1)[:, None]


def cut(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts in chunks of ``CHUNK`` bytes, filled with zeros; each chunk's text, and how many bytes stand from its start on."""
    sizes = np.array([len(t) for t in texts], np.int64)
    counts = -(-sizes // CHUNK)
    flat, at = np.zeros(int(counts.sum()) * CHUNK, np.uint8), 0
    for t, n in zip(texts, counts.tolist(), strict=True):
        flat[at : at + len(t)] = np.frombuffer(t, np.uint8)
        at += n * CHUNK
    owner = np.repeat(np.arange(len(texts)), counts)
    left = sizes[owner] - CHUNK * (np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts))
    return flat.reshape(-1, CHUNK), owner, left


def text_bytes(text: str | None) -> bytes:
    return (text or "").encode().lower()


def has_letter(text: str | None) -> bool:
    """Letters alone count: numbers such as fractions and raised digits are word characters, but no letters."""
    return any(m.group().isalpha() for m in LETTER.finditer(text or ""))


def train_language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 4, held_fold: int = 2, rows_per_language: int = 500, train_rows: int = 50_000) -> ByteGRU | None:
    """A network from the whole texts of rows with a language outside the held fold; None without any.

    Of each language the ``rows_per_language`` rows with the smallest hash of id and text are taken (the documented bound),
    so every language that the training rows have is learned.  With so many languages that this gives more than
    ``train_rows`` rows, each has an even share of them, and one row at least.  Rows that repeat an id and a text count once.
    """
    spark, text = docs.sparkSession, F.col(text_col)
    small_batches(spark)
    rows = docs.where(F.col(lang_col).isNotNull() & text.isNotNull() & (fold(F.col(id_col), folds) != held_fold)).select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("h"), text.alias("text"), F.col(lang_col).cast("string").alias("lang"))
    with scratch(spark):
        at = F.xxhash64("id", "h")
        counts = shared_table(rows.groupBy("lang").agg(F.approx_count_distinct(at, 0.05).alias("rows")), "languages")
        languages = counts.count()
        if not languages:
            return None
        share = min(rows_per_language, max(1, train_rows // languages))
        # first a range of the hash that holds four times as many rows as are wanted (and 40, so that a small share is
        # surely in it), so that few rows of a frequent language are sorted
        sizes = F.broadcast(counts) if languages <= SMALL_TABLE else counts
        near = rows.select("id", "h", "lang").join(sizes, "lang").where(F.col("rows") * (F.shiftrightunsigned(at, 11) / float(1 << 53)) <= 4 * share + 40)
        order = Window.partitionBy("lang").orderBy(at, "id", "h")
        picked = near.select("id", "h", "lang").distinct().withColumn("n", F.row_number().over(order)).where(F.col("n") <= share).drop("n")
        if languages <= SMALL_TABLE:
            picked = F.broadcast(picked)  # max(train_rows, languages) small rows at most
        same = F.col("r.id").eqNullSafe(F.col("p.id")) & (F.col("r.h") == F.col("p.h")) & (F.col("r.lang") == F.col("p.lang"))
        got = rows.alias("r").join(picked.alias("p"), same).select("r.id", "r.h", "r.lang", "r.text").dropDuplicates(["id", "h", "lang"])
        weights = got.repartition(1).sortWithinPartitions("lang", "id", "h").select("lang", "text").mapInArrow(fitted, WEIGHTS).collect()
    model = ByteGRU(list(weights[0].languages))
    model.p = {w.name: np.frombuffer(w.value, np.float32).reshape(w.shape) for w in weights}
    return model


SMALL_TABLE = 100_000
WEIGHTS = "languages array<string>, name string, shape array<int>, value binary"


def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The weights of a network fitted to rows that come sorted by language; only the chunks' bytes are kept of the texts."""
    languages: list[str] = []
    parts = []
    for b in batches:
        for lang, t in zip(b.column("lang").to_pylist(), b.column("text"), strict=True):
            if lang not in languages[-1:]:
                languages.append(lang)
            chunks, _, left = cut([text_bytes(t.as_py())])
            parts.append((chunks, np.full(len(chunks), len(languages) - 1, np.int64), left))
    if not languages:
        return
    model = ByteGRU(languages)
    chunks, labels, left = (np.concatenate(x) for x in zip(*parts, strict=True))
    parts.clear()
    if len(chunks):
        model.fit(chunks, labels, left)
    n = len(model.p)
    yield pa.RecordBatch.from_arrays(
        [pa.array([languages] + [None] * (n - 1), pa.list_(pa.string())), pa.array(list(model.p)), pa.array([v.shape for v in model.p.values()], pa.list_(pa.int32())), pa.array([np.ascontiguousarray(v).tobytes() for v in model.p.values()], pa.binary())],
        names=["languages", "name", "shape", "value"],
    )


def language_id(docs: DataFrame, model: ByteGRU | None = None, id_col: str = "doc_id", text_col: str = "text", folds: int = 4, held_fold: int = 2, **training) -> DataFrame:
    """Per row: ``doc_id, held_out, lang_pred, score``; trains a network first unless one is given.

    Only the text is an input.  Null texts and texts without a letter (digits, fractions and marks are none) are ``und``
    with score 0, and so is everything when no row has a language to learn from.  Of equally likely languages the first
    by name wins.  A text of any length is read whole, in chunks; repeated rows get equal predictions, rows without id
    are predicted as all others, and an empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    model = model or train_language_id(docs, id_col, text_col, folds=folds, held_fold=held_fold, **training)

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs, scores = [], []
            part: list[bytes] = []

            def flush() -> None:
                for p, raw in zip(model.predict(part) if part else (), part, strict=True):
                    langs.append(model.languages[int(p.argmax())] if raw else "und")
                    scores.append(float(min(p.max(), 1.0)) if raw else 0.0)
                part.clear()

            size = 0
            for t in b.column("text"):
                text = t.as_py()
                part.append(text_bytes(text) if model is not None and has_letter(text) else b"")
                size += len(part[-1])
                if size > 2_000_000 and model is not None:
                    flush()
                    size = 0
            if model is None:
                langs, scores = ["und"] * len(part), [0.0] * len(part)
            else:
                flush()
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    inputs = docs.select(F.col(id_col).cast("long").alias("doc_id"), (fold(F.col(id_col), folds) == held_fold).alias("held_out"), F.col(text_col).alias("text"))
    return inputs.mapInArrow(predicted, "doc_id long, held_out boolean, lang_pred string, score double")
