"""Language-model scoring by a hashed maximum-entropy model with a class-factored softmax (Goodman 2001).

P(word | history) = P(class | history) * P(word | class, history).

* The class of a word is a function of its spelling alone (the nearest of some centroids of hashed byte pairs at its
  beginning and end), but for the end token and the most frequent words, which are classes of their own.  Unseen words
  so have a class too.
* P(class | history) is a softmax over sums of weights: of the previous word (hashed), of the pair of classes before
  (n-grams), and of the classes two and three places back (skips).
* P(word | class, history) is a softmax over the class's words as a product of decisions down a Huffman tree.  A decision
  starts from the add-one counts on its two sides, and sums hashed weights of the decision with the previous word, with
  the two words before (n-grams) and with the word two back (skip).  The table of these weights grows with the training
  tokens up to ``cells``.  Words outside the head share one leaf of their class's tree, by their add-one counts, with one
  share for unseen words.

Counts are taken over all training documents.  The weights are trained in rounds on every place of every training
document.  Documents are dealt to rounds and shards by a hash of id and text and sorted by it there, so the model does not
depend on how the input is partitioned.  In a round every shard runs gradient steps from the same weights, and the mean of
the changes (of a hashed weight: over the shards that changed it) is the next round's start.  Shards grow with the input:
2 million tokens each, or a ten-thousandth of a round, so merging is bounded too.  Scoring is one scan in sparse numpy
batches with the ``head`` most frequent words in memory (a fixed number); the counts of all other words come by a join.

Words are known by 64-bit hashes: two different words would have to share one to share a count.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velora.llm.common import SPACE_BYTES, fold, shared_table, small_batches, span_hashes, text_groups

CLASSES, SINGLES, HASHED = 32, 8, 2048
#: Where each feature's rows start: classes two and three back, the pair of classes, the previous word's hash.
STARTS = np.cumsum([0, CLASSES, CLASSES, CLASSES * CLASSES])
ROWS = int(STARTS[-1]) + HASHED
END = np.uint64(1)
SHARD_TOKENS, MOST_SHARDS = 2_000_000, 10_000


def word_keys(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The tokens of all texts one after the other, as hashes and as their first and last three bytes, and each text's number of tokens.

    A-Z are lower-cased, words are runs without ASCII white space, and every text ends with the end token.
    """
    raws = [(t or "").encode().lower() for t in texts]
    raw = np.frombuffer(b" ".join([*raws, b""]), np.uint8)
    space = SPACE_BYTES[raw]
    starts = np.flatnonzero(~space & np.concatenate([[True], space[:-1]])) if len(raw) else np.empty(0, np.int64)
    ends = np.flatnonzero(~space & np.concatenate([space[1:], [True]])) + 1 if len(raw) else starts
    owner = np.searchsorted(np.cumsum([len(r) + 1 for r in raws]), starts, "right")
    lengths = np.bincount(owner, minlength=len(texts)) + 1
    h, affix = np.full(len(starts) + len(texts), END, np.uint64), np.zeros(len(starts) + len(texts), np.int64)
    if len(starts):
        at = np.arange(len(starts)) + owner
        h[at] = span_hashes(raw)(starts, ends)
        wide, own, size = raw.astype(np.int64), np.zeros(len(starts), np.int64), ends - starts
        for j in range(3):
            own |= np.where(size > j, wide.take(starts + j, mode="clip"), 0) << (40 - 8 * j) | np.where(size > j, wide.take(ends - 1 - j, mode="clip"), 0) << (16 - 8 * j)
        affix[at] = own
    return h, affix, lengths


def _pairs(affix: np.ndarray) -> np.ndarray:
    """The hashed byte pairs of beginnings and ends; (4, words)."""
    b = [(affix >> k) & 255 for k in (40, 32, 24, 16, 8, 0)]
    return np.stack([b[0] * 31 + b[1] * 17, b[1] * 31 + b[2] * 17 + 7, b[4] * 31 + b[3] * 17 + 11, b[5] * 31 + b[4] * 17 + 13]) & 255


class Head:
    """The head's words: hashes in order, with counts."""

    def __init__(self, h: np.ndarray, affix: np.ndarray, counts: np.ndarray, total: int, distinct: int):
        by = np.argsort(h)
        self.head, self.counts, self.total, self.distinct = h[by], counts[by], total, distinct
        self.log_count = np.log10(self.counts + 1.0)
        # a table of the first bits of a hash: where its words start in the head
        self.shift = np.uint64(64 - max(1, len(h)).bit_length() - 1)
        self.index = np.searchsorted(self.head >> self.shift, np.arange((1 << (64 - int(self.shift))) + 1, dtype=np.uint64))

    def find(self, h: np.ndarray) -> np.ndarray:
        """Places in the head; -1 for other words."""
        out = np.full(len(h), -1, np.int64)
        bucket = (h >> self.shift).astype(np.int64)
        at, end, live = self.index[bucket], self.index[bucket + 1], np.arange(len(h))
        while True:
            left = at < end
            live, at, end = live[left], at[left], end[left]
            if not len(live):
                return out
            same = self.head[at] == h[live]
            out[live[same]] = at[same]
            live, at, end = live[~same], at[~same] + 1, end[~same]


class Model(Head):
    """The head with the classes' centroids and sizes, and the weights."""

    def __init__(self, h: np.ndarray, affix: np.ndarray, counts: np.ndarray, total: int, distinct: int, seed: int = 13):
        super().__init__(h, affix, counts, total, distinct)
        affix = affix[np.argsort(h)]
        often = np.lexsort((self.head, -self.counts))
        self.singles = [int(END), *(self.head[often][self.head[often] != END][: SINGLES - 1].tolist())]
        self.centroids = self._cluster(affix[[i for i in often if int(self.head[i]) not in self.singles][:20_000]], CLASSES - SINGLES, seed)
        self.head_class = self.classes(self.head, affix)
        self.sizes = np.ones(CLASSES)
        self.weights = np.zeros((ROWS, CLASSES), np.float32)
        self.table = np.zeros(0, np.float32)

    def numbered(self, h: np.ndarray, affix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The leaf and the class of each token; leaves from ``len(head)`` on are the classes' shares for other words."""
        leaf = self.find(h)
        k = self.head_class[np.maximum(leaf, 0)] if len(self.head) else np.zeros(len(h), np.int64)
        other = np.flatnonzero(leaf < 0)
        k[other] = self.classes(h[other], affix[other])
        leaf[other] = len(self.head) + k[other]
        return leaf, k

    def classes(self, h: np.ndarray, affix: np.ndarray) -> np.ndarray:
        out = np.empty(len(h), np.int64)
        for at in range(0, len(h), 50_000):
            p = _pairs(affix[at : at + 50_000])
            out[at : at + 50_000] = SINGLES + sum(self.centroids[x] for x in p).argmax(axis=1)
        for i, x in enumerate(self.singles):
            out[h == np.uint64(x)] = i
        return out

    @staticmethod
    def _cluster(affix: np.ndarray, k: int, seed: int, rounds: int = 12) -> np.ndarray:
        """Spherical k-means over bags of hashed byte pairs; (256, k)."""
        rng = np.random.default_rng(seed)
        if not len(affix):
            return rng.normal(size=(256, k)).astype(np.float32)
        bags = np.zeros((len(affix), 256), np.float32)
        np.add.at(bags, (np.arange(len(affix)), _pairs(affix)), 1)
        bags /= np.linalg.norm(bags, axis=1, keepdims=True)
        centroids = bags[rng.choice(len(affix), k, replace=len(affix) < k)].copy()
        for _ in range(rounds):
            best = (bags @ centroids.T).argmax(axis=1)
            for i in range(k):
                if (best == i).any():
                    centroids[i] = bags[best == i].sum(axis=0)
            centroids /= np.linalg.norm(centroids, axis=1, keepdims=True) + 1e-9
        return centroids.T.copy()

    def grow(self, cells: int) -> None:
        """The trees of the classes' words from ``sizes``, and an empty table of two cells a training token, ``cells`` at most.

        Leaf i is head word i, leaf ``len(head) + k`` is what class k holds outside the head; a class of its own has no tree.
        """
        leaves, own = len(self.head) + CLASSES, self.head_class
        mass = np.concatenate([self.counts + 1.0, self.sizes - np.bincount(own, weights=self.counts + 1.0, minlength=CLASSES)])
        self.rest = mass[len(self.head) :]
        parent, side, bias = np.full(leaves, -1, np.int64).tolist(), [0] * leaves, []
        by = np.argsort(own, kind="stable")
        ends = np.searchsorted(own[by], np.arange(CLASSES + 1))
        for k in range(SINGLES, CLASSES):
            heap = [(float(mass[i]), i) for i in (*by[ends[k] : ends[k + 1]].tolist(), len(self.head) + k)]
            heapq.heapify(heap)
            while len(heap) > 1:
                (a, i), (b, j) = heapq.heappop(heap), heapq.heappop(heap)
                parent[i] = parent[j] = len(parent)
                side[i], side[j] = -1, 1
                heapq.heappush(heap, (a + b, len(parent)))
                parent.append(-1)
                side.append(0)
                bias.append(np.log(b / a))
        up, sides = np.array(parent, np.int64), np.array(side, np.int8)
        steps, at, live = [], np.arange(leaves), np.arange(leaves)
        while len(live := live[up[at] >= 0]):
            at = at[up[at] >= 0]
            steps.append((live, up[at] - leaves, sides[at]))
            at = up[at]
        depth = np.zeros(leaves, np.int32)
        for i, _, _ in steps:
            depth[i] += 1
        self.path_start = np.concatenate([[0], np.cumsum(depth)]).astype(np.int32)
        key, odds = scrambled(np.arange(1, len(bias) + 1, dtype=np.uint32) * np.uint32(0x9E3779B1)), np.array(bias, np.float32)
        self.path_key, self.path_side, self.path_odds = np.zeros(self.path_start[-1], np.uint32), np.zeros(self.path_start[-1], np.float32), np.zeros(self.path_start[-1], np.float32)
        for level, (i, node, s) in enumerate(steps):
            to = self.path_start[i] + level
            self.path_key[to], self.path_side[to], self.path_odds[to] = key[node], s, odds[node] * s
        self.table = np.zeros(1 << int(np.clip(np.ceil(np.log2(2 * self.total + 1)), 10, np.log2(cells))), np.float32)

    def decisions(self, leaves: np.ndarray, history: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]:
        """Of all decisions on the way to the leaves: how many each leaf has, the side taken (-1 or 1), the cells, and the log-odds of that side."""
        first = self.path_start[leaves]
        depth = self.path_start[leaves + 1] - first
        step = np.repeat(first - (np.cumsum(depth, dtype=np.int32) - depth), depth)
        step += np.arange(len(step), dtype=np.int32)
        side, key, cells, odds = self.path_side[step], self.path_key[step], [], np.zeros(len(step), np.float32)
        mask = np.uint32(len(self.table) - 1)
        for h in history:
            at = np.repeat(h, depth)
            at ^= key
            at &= mask
            cells.append(at)
            odds += self.table[at]
        odds *= side
        odds += self.path_odds[step]
        return depth, side, cells, odds

    def word_logs(self, leaves: np.ndarray, history: np.ndarray) -> np.ndarray:
        """The natural logarithm of the leaves' probability inside their classes."""
        depth, _, _, odds = self.decisions(leaves, history)
        out, some = np.zeros(len(leaves)), np.flatnonzero(depth)
        if len(some):
            np.exp(np.minimum(np.negative(odds, out=odds), np.float32(20)), out=odds)
            odds += 1
            start = np.cumsum(depth[some]) - depth[some]
            out[some] = -np.log(np.multiply.reduceat(odds.astype(np.float64), start))
        return out

    def logits(self, features: np.ndarray) -> np.ndarray:
        out = self.weights.take(features[0], axis=0)
        for f in features[1:]:
            out += self.weights.take(f, axis=0)
        return out


def scrambled(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 32-bit integers (the finaliser of MurmurHash3)."""
    x = (x ^ (x >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    x = (x ^ (x >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    return x ^ (x >> np.uint32(16))


def _back(x: np.ndarray, place: np.ndarray, j: int, fill) -> np.ndarray:
    """What stands j places before; ``fill`` before a text's first token."""
    return np.where(place >= j, np.roll(x, j), fill)


def histories(h: np.ndarray, k: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each place: the rows of the class weights (4, places), and hashes of the previous word, of the two words before and of
    the word two back (3, places).  Before a text's first word stand end tokens."""
    place = np.arange(len(h)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    key, end = (h >> np.uint64(32)).astype(np.uint32), np.uint32(0)
    one, two = (_back(key, place, j, end) for j in (1, 2))
    skip = scrambled(two ^ np.uint32(0x5BD1E995))
    back = [_back(k, place, j, 0) for j in (1, 2, 3)]
    rows = np.stack([back[1], back[2], back[0] * CLASSES + back[1], (one % np.uint32(HASHED)).astype(np.int64)]) + STARTS[:, None]
    return rows, np.stack([scrambled(one), scrambled(one ^ (skip * np.uint32(0x27D4EB2F))), skip])


def word_counts(texts: DataFrame, flush: int = 1_000_000) -> DataFrame:
    """``h, affix, n`` over all rows; a task holds ``flush`` words or a few more before it passes them on."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, size = [], 0

        def merged() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            h, affix, n = (np.concatenate(x) for x in zip(*own, strict=True))
            words, first, inverse = np.unique(h, return_index=True, return_inverse=True)
            return words, affix[first], np.bincount(inverse, weights=n).astype(np.int64)

        for b in batches:
            for _, part in text_groups(b.column(0)):
                h, affix, _ = word_keys(part)
                words, first, n = np.unique(h, return_index=True, return_counts=True)
                own.append((words, affix[first], n))
                size += len(words)
                if size > flush:
                    own[:] = [merged()]
                    size = len(own[0][0])
                    if size > flush // 2:
                        yield pa.RecordBatch.from_arrays([pa.array(own[0][0].view(np.int64)), *map(pa.array, own[0][1:])], names=["h", "affix", "n"])
                        own.clear()
                        size = 0
        if own:
            last = merged()
            yield pa.RecordBatch.from_arrays([pa.array(last[0].view(np.int64)), *map(pa.array, last[1:])], names=["h", "affix", "n"])

    return texts.mapInArrow(counted, "h long, affix long, n long").groupBy("h").agg(F.min("affix").alias("affix"), F.sum("n").alias("n"))


def train_classes(model: Model, features: np.ndarray, target: np.ndarray, speed: np.ndarray, batch: int = 8192, rate: float = 0.2) -> None:
    """Adagrad steps, with one step size for each row of the weights, over the given places."""
    for at in range(0, len(target), batch):
        f, y = features[:, at : at + batch], target[at : at + batch]
        g = model.logits(f)
        g -= g.max(axis=1, keepdims=True)
        np.exp(g, out=g)
        g /= g.sum(axis=1, keepdims=True)
        g[np.arange(len(y)), y] -= 1
        for rows in f:
            by = np.argsort(rows.astype(np.int16), kind="stable")  # a radix sort
            own = rows[by]
            first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            own = own[first]
            d = np.add.reduceat(g.take(by, axis=0), first)
            d /= np.sqrt(np.diff([*first, len(by)]))[:, None].astype(np.float32)
            speed[own] += (d * d).mean(axis=1)
            model.weights[own] -= np.float32(rate) * d / np.sqrt(speed[own])[:, None]


def train_words(model: Model, leaves: np.ndarray, history: np.ndarray, speed: np.ndarray, rate: float = 0.3) -> None:
    """Adagrad steps, with one step size for each cell of the table, over the decisions of the given places."""
    batch = max(4096, len(model.table) // 16)
    for at in range(0, len(leaves), batch):
        _, side, cells, odds = model.decisions(leaves[at : at + batch], history[:, at : at + batch])
        np.exp(np.minimum(odds, np.float32(20), out=odds), out=odds)
        odds += 1
        np.divide(side, odds, out=odds)  # minus the gradient
        d = np.zeros(len(model.table), np.float32)
        for c in cells:
            np.add.at(d, c, odds)
        used = np.flatnonzero(d)
        d = d[used]
        speed[used] += d * d
        model.table[used] += np.float32(rate) * d / np.sqrt(speed[used])


def head_words(counts: DataFrame, head: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int, int]:
    """The most frequent words (``head`` at most) as hashes, affixes and counts; all training tokens and different words."""
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    # the head by a floor on the count: a few hundred steps of a scale tell how many words each floor would take
    step = F.floor(F.log2("n") * 16)
    scale = sorted((r.step, r.words) for r in counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("words")).collect())
    floor, taken = (scale[-1][0] + 1 if scale else 0), 0
    for at, words in reversed(scale):
        taken += words
        if taken > head:
            break
        floor = at
    top = counts.where(step >= floor).toArrow()  # ``head`` words at most
    column = lambda c: top.column(c).to_numpy().astype(np.int64)
    return column("h").view(np.uint64), column("affix"), column("n"), int(total.n), int(total.v)


def train(inputs: DataFrame, counts: DataFrame, model: Model, rounds: int, cells: int) -> Model:
    """``inputs`` has ``doc_id`` and ``text`` of the training rows; ``model`` has its words and gets its weights."""
    spark = inputs.sparkSession
    shape = spark.sparkContext.broadcast(model)

    def sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(CLASSES, np.int64)
        for b in batches:
            k = shape.value.classes(b.column("h").to_numpy().view(np.uint64), b.column("affix").to_numpy())
            np.add.at(own, k, b.column("n").to_numpy() + 1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(CLASSES, dtype=np.int32)), pa.array(own)], names=["k", "size"])

    for r in counts.mapInArrow(sized, "k int, size long").groupBy("k").agg(F.sum("size").alias("size")).collect():
        model.sizes[r.k] += r["size"]

    model.weights[:CLASSES] = np.log(model.sizes / model.sizes.sum())  # before any step the model is the unigram base
    model.grow(cells)
    shape.unpersist()
    shape = spark.sparkContext.broadcast(model)
    block = 64  # rows of the weights that travel together, and as many cells
    blocks = -(-ROWS // block)
    shards = int(np.clip(-(-model.total // (rounds * SHARD_TOKENS)), 1, MOST_SHARDS))
    order = F.xxhash64("doc_id", "text")
    dealt = inputs.select(F.pmod(order, F.lit(rounds * shards)).alias("shard"), order.alias("at"), "text")
    for r in range(rounds if model.total else 0):
        start = spark.sparkContext.broadcast((model.weights, model.table))

        def changed(batches: Iterator[pa.RecordBatch], start=start) -> Iterator[pa.RecordBatch]:
            own = shape.value
            for shard in by_shard(batches):
                own.weights, own.table = (x.copy() for x in start.value)
                speed, word_speed, seen = np.ones(ROWS, np.float32), np.ones(len(own.table), np.float32), 0
                for part in shard:
                    h, affix, lengths = word_keys(part)
                    leaves, k = own.numbered(h, affix)
                    rows, history = histories(h, k, lengths)
                    train_classes(own, rows, k, speed)
                    train_words(own, leaves, history, word_speed)
                    seen += len(h)
                delta, cell_delta = own.weights - start.value[0], own.table - start.value[1]
                parts = [(i, delta[i * block : (i + 1) * block]) for i in range(blocks)]
                parts += [(blocks + i, d) for i, d in enumerate(np.split(cell_delta, range(block * CLASSES, len(cell_delta), block * CLASSES)))]
                parts = [(i, d) for i, d in parts if d.any()]
                yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in parts], pa.int32()), pa.array([seen] * len(parts), pa.int64()), pa.array([d.astype("<f2").tobytes() for _, d in parts], pa.binary())], names=["block", "seen", "delta"])

        def mean(t: pa.Table) -> pa.Table:
            """Changes of class weights weigh by the tokens behind them; those of a cell count for the shards that have it.  At most
            ``MOST_SHARDS`` rows of 4 KB meet here, and they are added in one order."""
            t = t.sort_by([("seen", "ascending"), ("delta", "ascending")])
            seen = np.maximum(t.column("seen").to_numpy().astype(float), 1)
            if t.column("block")[0].as_py() < blocks:
                out = sum(np.frombuffer(d.as_py(), "<f2").astype(float) * s for d, s in zip(t.column("delta"), seen, strict=True)) / seen.sum()
            else:
                out = had = 0.0
                for d, s in zip(t.column("delta"), seen, strict=True):
                    d = np.frombuffer(d.as_py(), "<f2").astype(float)
                    out, had = out + d * s, had + (d != 0) * s
                out /= np.maximum(had, 1)
            return pa.table({"block": t.column("block")[:1], "delta": pa.array([out.astype("<f4").tobytes()], pa.binary())})

        mine = dealt.where(F.col("shard") % rounds == r).repartition("shard").sortWithinPartitions("shard", "at")
        got = mine.select("shard", "text").mapInArrow(changed, "block int, seen long, delta binary").groupBy("block").applyInArrow(mean, "block int, delta binary").collect()
        following, table = model.weights.copy(), model.table.copy()
        for x in got:
            if x.block < blocks:
                following[x.block * block : (x.block + 1) * block] += np.frombuffer(x.delta, "<f4").reshape(-1, CLASSES)
            else:
                table[(x.block - blocks) * block * CLASSES :][: block * CLASSES] += np.frombuffer(x.delta, "<f4")
        model.weights, model.table = following, table
        start.unpersist()
    return model


def by_shard(batches: Iterator[pa.RecordBatch], chars: int = 1_000_000) -> Iterator[Iterator[list[str | None]]]:
    """The texts of each shard in groups of about so many characters, the same whatever batches they come in; rows are sorted by shard."""
    rows = ((s, t.as_py()) for b in batches for s, t in zip(b.column("shard").to_pylist(), b.column("text"), strict=True))
    for _, shard in groupby(rows, key=lambda r: r[0]):

        def parts(shard=shard) -> Iterator[list[str | None]]:
            part, size = [], 0
            for _, text in shard:
                part.append(text)
                size += len(text or "")
                if size >= chars:
                    yield part
                    part, size = [], 0
            if part:
                yield part

        yield parts()


SCORED = "doc_id long, held_out boolean, n_tokens long, known long, logs double, classes double, tail array<struct<h:long,n:int>>"


def lm_score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 7, held_fold: int = 2, head: int = 150_000, rounds: int = 2, cells: int = 1 << 21, own_score: bool = True) -> DataFrame:
    """Per row: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` (log10 probabilities of the text).

    A token is a run without ASCII white space, with A-Z lower-cased; an end token follows, so a null or empty text is
    the end token alone.  The base is an add-one unigram model.  Without training rows every count is 0.  Whole texts of
    any length are read.  Repeated rows count as often as they occur and get equal scores; a null id counts as the empty
    text when folds are dealt.  An empty table gives an empty result; other columns are not read.
    ``own_score`` False leaves ``score`` NULL and trains nothing: the other columns are counts, by the same scan and join.
    """
    spark = docs.sparkSession
    small_batches(spark)
    inputs = docs.select(F.col(id_col).cast("long").alias("doc_id"), (fold(F.col(id_col), folds) == held_fold).alias("held_out"), F.col(text_col).alias("text"))
    training = inputs.where("NOT held_out").select("doc_id", "text")
    counts = shared_table(word_counts(training.select("text")), "counts")
    words = head_words(counts, head)
    model = train(training, counts, Model(*words), rounds, cells) if own_score else Head(*words)
    sent = spark.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        base, log_rest = len(own.head), np.log10(own.rest) if own_score else None
        for b in batches:
            for at, part in text_groups(b.column("text")):
                h, affix, lengths = word_keys(part)
                owner, picked = np.repeat(np.arange(len(part)), lengths), np.zeros(len(h))
                if own_score:
                    leaves, k = own.numbered(h, affix)
                    rows, history = histories(h, k, lengths)
                else:
                    leaves = own.find(h)
                for s in range(0, len(h) if own_score else 0, 16_384):
                    z = slice(s, s + 16_384)
                    x = own.logits(rows[:, z])
                    x -= x.max(axis=1, keepdims=True)
                    chosen = x[np.arange(len(x)), k[z]]
                    np.exp(x, out=x)
                    picked[z] = (chosen - np.log(x.sum(axis=1)) + own.word_logs(leaves[z], history[:, z])) / np.log(10)
                inside = (leaves >= 0) & (leaves < base)
                if own_score:
                    picked[~inside] -= log_rest[k[~inside]]
                logs = np.where(inside, own.log_count[np.minimum(leaves, base - 1)], 0.0) if base else np.zeros(len(h))
                order = np.lexsort((h[~inside], owner[~inside]))
                o, w = owner[~inside][order], h[~inside][order]
                first = np.flatnonzero(np.concatenate([[True], (o[1:] != o[:-1]) | (w[1:] != w[:-1])])) if len(o) else order
                times = np.diff([*first, len(o)]).astype(np.int32)
                offsets = np.searchsorted(o[first], np.arange(len(part) + 1))
                tail = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays([pa.array(w[first].view(np.int64)), pa.array(times, pa.int32())], names=["h", "n"]))
                total = lambda x: np.bincount(owner, weights=x, minlength=len(part))
                c = b.slice(at, len(part))
                yield pa.RecordBatch.from_arrays([c.column("doc_id"), c.column("held_out"), pa.array(lengths.astype(np.int64)), pa.array(total(inside).astype(np.int64)), pa.array(total(logs)), pa.array(total(picked)), tail], names=["doc_id", "held_out", "n_tokens", "known", "logs", "classes", "tail"])

    rows = shared_table(inputs.mapInArrow(scored, SCORED).withColumn("at", F.monotonically_increasing_id()), "scored")
    rare = rows.select("at", F.explode("tail").alias("t")).select("at", "t.h", F.col("t.n").alias("times"))
    found = rare.join(counts.select("h", "n"), "h").groupBy("at").agg(F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("more_logs"))
    logs = F.col("logs") + F.coalesce("more_logs", F.lit(0.0))
    size = float(np.log10(model.total + model.distinct + 1))
    return rows.drop("tail").join(found, "at", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * F.lit(size)).alias("base_score"),
        (F.col("classes") + F.coalesce("more_logs", F.lit(0.0)) if own_score else F.lit(None).cast("double")).alias("score"),
    )
