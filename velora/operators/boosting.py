"""Boosted trees for the risk model: leaf-wise trees on binned features, with histograms that tasks add up.

Features are cut into bins at quantiles once, and the binned rows are written with their margins; NULL and NaN are a bin of
their own that a split may send either way.  A row's bins are one binary value of a byte (or two) for each feature, which
reaches numpy as it is.  A pass over the rows sums gradients and curvatures by leaf, feature and bin;
what reaches the driver has the size of the tree and the bins, never of the rows.  Gradients are whole numbers (fractions
of 2**-24), so a sum is the same in any order and a lost task changes nothing.

Trees grow leaf-wise: the leaf with the largest gain is split next.  A pass looks one split ahead for all leaves of the
tree, summing the smaller child of each and taking the other as the difference, so a tree takes about as many passes as it
is deep and not one for every split; the tree is the one that single splits would give.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velora.session import workers_find_package
from velora.sources.tables import written

UNIT = float(1 << 24)
ROWS = "__row long, label double, margin double, bins binary"
#: A pass adds the margins of so many trees itself; then the rows are written with them.
PENDING = 8


@dataclass
class Split:
    node: int
    feature: int
    bin: int
    absent_left: bool
    left: int
    right: int


@dataclass
class Tree:
    splits: list[Split] = field(default_factory=list)
    values: dict[int, float] = field(default_factory=dict)

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of each row; bin 0 is an absent value."""
        at = np.zeros(len(bins), np.int64)
        for s in self.splits:
            mine = np.flatnonzero(at == s.node)
            b = bins[mine, s.feature]
            left = np.where(b == 0, s.absent_left, b <= s.bin)
            at[mine] = np.where(left, s.left, s.right)
        return at

    def margins(self, bins: np.ndarray) -> np.ndarray:
        table = np.zeros(max(self.values) + 1)
        for k, v in self.values.items():
            table[k] = v
        return table[self.leaves(bins)]


def binned(x: np.ndarray, cuts: Sequence[Sequence[float]]) -> np.ndarray:
    """1 + the number of cuts below a value; 0 if it is absent."""
    out = np.zeros(x.shape, np.int32)
    for j, c in enumerate(cuts):
        known = ~np.isnan(x[:, j])
        out[known, j] = 1 + np.searchsorted(np.asarray(c, float), x[known, j], "left")
    return out


def packed(bins: np.ndarray, most: int) -> pa.Array:
    """The rows of a table of bins as binary values; ``most`` is the largest bin there may be."""
    n, data = len(bins), np.ascontiguousarray(bins, "u1" if most < 256 else "<u4" if most >= 1 << 16 else "<u2")
    ends = np.arange(n + 1, dtype=np.int32) * (bins.shape[1] * data.itemsize)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(data)])


def unpacked(column: pa.Array, width: int) -> np.ndarray:
    """The table of bins again, without a copy."""
    column = column.cast(pa.binary())
    if not len(column):
        return np.empty((0, width), np.uint8)
    ends = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4)
    size = int(ends[1] - ends[0]) // width
    return np.frombuffer(column.buffers()[2], f"<u{size}", len(column) * width, int(ends[0])).reshape(-1, width)


@dataclass
class BoostedModel:
    features: list[str]
    cuts: list[list[float]]
    start: float
    trees: list[Tree]

    def margins(self, x: np.ndarray) -> np.ndarray:
        bins = binned(x, self.cuts)
        return self.start + sum((t.margins(bins) for t in self.trees), np.zeros(len(x)))

    def score(self, df: DataFrame, column: str = "score") -> DataFrame:
        """``df`` with the positive class's probability."""
        workers_find_package(df.sparkSession)

        @F.arrow_udf("double")
        def probability(*values: pa.Array) -> pa.Array:
            x = np.column_stack([v.to_numpy(zero_copy_only=False).astype(float) for v in values])
            return pa.array(1 / (1 + np.exp(-self.margins(x))))

        return df.withColumn(column, probability(*(F.col(c).cast("double") for c in self.features)))

    def importances(self) -> dict[str, float]:
        """The share of all splits by feature."""
        n = np.bincount([s.feature for t in self.trees for s in t.splits], minlength=len(self.features))
        return dict(zip(self.features, (n / max(1, n.sum())).tolist(), strict=True))

    def to_json(self) -> str:
        trees = [{"splits": [vars(s) for s in t.splits], "values": list(t.values.items())} for t in self.trees]
        return json.dumps({"features": self.features, "cuts": self.cuts, "start": self.start, "trees": trees})

    @staticmethod
    def from_json(text: str) -> BoostedModel:
        d = json.loads(text)
        return BoostedModel(d["features"], d["cuts"], d["start"], [Tree([Split(**s) for s in t["splits"]], dict(map(tuple, t["values"]))) for t in d["trees"]])


@dataclass(frozen=True)
class Boosting:
    """Parameters of a fit; ``balanced`` weighs positives up to the negatives' sum, ``rows`` and ``columns`` are the shares
    that a tree sees, drawn by hashes of row, tree and seed."""

    trees: int = 100
    leaves: int = 31
    rate: float = 0.05
    l2: float = 1.0
    least_rows: int = 50
    rows: float = 0.8
    columns: float = 0.8
    balanced: bool = True
    bins: int = 63
    seed: int = 42

    def fit(self, df: DataFrame, features: Sequence[str], label: str = "label") -> BoostedModel:
        """Rows without label are left out; labels are 0 and 1, and both must occur."""
        features, spark = list(features), df.sparkSession
        workers_find_package(spark)
        known = written(df.where(F.col(label).isNotNull()).select(F.monotonically_increasing_id().alias("__row"), F.col(label).cast("double").alias("label"), *(F.col(c).cast("double").alias(c) for c in features)), "samples")
        totals = known.agg(F.sum("label").alias("p"), F.count(F.lit(1)).alias("n")).first()
        if not totals.n or not 0 < totals.p < totals.n:
            raise ValueError("a fit needs both labels")
        weight = (totals.n - totals.p) / totals.p if self.balanced else 1.0
        share = totals.p * weight / (totals.p * weight + totals.n - totals.p)
        start = float(np.log(share / (1 - share)))
        quantiles = known.approxQuantile(features, [i / self.bins for i in range(1, self.bins)], 0.1 / self.bins)
        cuts = [sorted({float(v) for v in q if v == v}) for q in quantiles]

        def place(batches):
            for b in batches:
                x = np.column_stack([b.column(c).to_numpy(zero_copy_only=False).astype(float) for c in features]) if b.num_rows else np.empty((0, len(features)))
                bins = packed(binned(x, cuts), self.bins)
                yield pa.RecordBatch.from_arrays([b.column("__row"), b.column("label"), pa.array(np.full(b.num_rows, start)), bins], ["__row", "label", "margin", "bins"])

        state, trees, moved = written(known.mapInArrow(place, ROWS), "binned"), [], 0
        for number in range(self.trees):
            if number - moved == PENDING:
                state, moved = written(_moved(state, trees[moved:], len(features)), "binned"), number
            trees.append(self._grow(state, trees[moved:], number, len(features), weight))
        return BoostedModel(features, cuts, start, trees)

    def _columns(self, number: int, width: int) -> list[int]:
        keep = max(1, round(self.columns * width))
        return sorted(np.random.default_rng([self.seed, number]).permutation(width)[:keep].tolist())

    def _sampled(self, rows: np.ndarray, number: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            h = (rows.astype(np.uint64) + np.uint64(number * 1_000_003 + self.seed)) * np.uint64(0x9E3779B97F4A7C15)
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return (h >> np.uint64(11)).astype(float) / 2**53 < self.rows

    def _histograms(self, state: DataFrame, pending: list[Tree], tree: Tree, wanted: dict[int, int], number: int, width: int, weight: float) -> np.ndarray:
        """Sums of gradient, curvature and rows for the ``wanted`` nodes (node: place), by feature and bin."""
        size = (self.bins + 1) * width

        def task(batches):
            sums = np.zeros((3, len(wanted) * size), np.int64)
            places = np.full(max([*wanted, *tree.values, *(x for s in tree.splits for x in (s.left, s.right))], default=0) + 1, -1)
            for k, v in wanted.items():
                places[k] = v
            for b in batches:
                mine = np.flatnonzero(self._sampled(b.column("__row").to_numpy(), number)) if b.num_rows else np.empty(0, int)
                bins = unpacked(b.column("bins"), width)[mine]
                at = places[tree.leaves(bins)]
                bins, mine, at = bins[at >= 0], mine[at >= 0], at[at >= 0]
                margin = b.column("margin").to_numpy()[mine]
                for t in pending:
                    margin = margin + t.margins(bins)
                y, p = b.column("label").to_numpy()[mine], 1 / (1 + np.exp(-margin))
                w = np.where(y > 0, weight, 1.0)
                slots = (at[:, None] * size + np.arange(width) * (self.bins + 1) + bins).reshape(-1)
                for i, v in enumerate((np.rint((p - y) * w * UNIT), np.rint(p * (1 - p) * w * UNIT), np.ones(len(y)))):
                    sums[i] += np.bincount(slots, weights=np.repeat(v, width), minlength=sums.shape[1]).astype(np.int64)
            full = np.flatnonzero(sums[2])
            yield pa.RecordBatch.from_arrays([pa.array(full), *(pa.array(sums[i][full]) for i in range(3))], ["slot", "g", "h", "n"])

        out = np.zeros((3, len(wanted) * size), np.int64)
        for r in state.mapInArrow(task, "slot long, g long, h long, n long").groupBy("slot").agg(*(F.sum(c).alias(c) for c in "ghn")).collect():  # nodes * features * bins
            out[:, r.slot] = r.g, r.h, r.n
        return out.reshape(3, len(wanted), width, self.bins + 1)

    def _best(self, hist: np.ndarray, columns: Sequence[int]) -> tuple | None:
        """The split with the largest gain: (gain, feature, bin, absent_left); the first one of equal gains."""
        g, h, n = hist
        whole = [a[columns[0]].sum() for a in (g, h, n)]
        worth = lambda a, b: (a / UNIT) ** 2 / (b / UNIT + self.l2)
        best = None
        for j in columns:
            below = [np.cumsum(a[j][1:])[:-1] for a in (g, h, n)]
            for absent_left in (True, False):
                left = [b + a[j][0] if absent_left else b for a, b in zip((g, h, n), below, strict=True)]
                right = [t - x for t, x in zip(whole, left, strict=True)]
                fits = (left[2] >= self.least_rows) & (right[2] >= self.least_rows)
                gain = np.where(fits, worth(left[0], left[1]) + worth(right[0], right[1]) - worth(whole[0], whole[1]), -np.inf)
                i = int(gain.argmax()) if len(gain) else -1
                if i >= 0 and gain[i] > 1e-9 and (best is None or gain[i] > best[0]):
                    best = (float(gain[i]), j, i + 1, absent_left)
        return best

    def _value(self, hist: np.ndarray, columns: Sequence[int]) -> float:
        return float(-self.rate * (hist[0][columns[0]].sum() / UNIT) / (hist[1][columns[0]].sum() / UNIT + self.l2))

    def _grow(self, state: DataFrame, pending: list[Tree], number: int, width: int, weight: float) -> Tree:
        columns, tree = self._columns(number, width), Tree()
        hists = {0: self._histograms(state, pending, tree, {0: 0}, number, width, weight)[:, 0]}
        best, ahead, used = {0: self._best(hists[0], columns)}, {}, 1
        while len(best) < self.leaves:
            node = max((k for k in best if best[k]), key=lambda k: (best[k][0], -k), default=None)
            if node is None:
                break
            if node not in ahead:
                used = self._look_ahead(state, pending, tree, [k for k in best if best[k] and k not in ahead], hists, ahead, used, number, width, weight)
            _, j, b, absent_left = best.pop(node)
            left, right = ahead[node]
            tree.splits.append(Split(node, j, b, absent_left, left, right))
            best |= {k: self._best(hists[k], columns) for k in (left, right)}
        tree.values = {k: self._value(hists[k], columns) for k in best}
        return tree

    def _look_ahead(self, state: DataFrame, pending: list[Tree], tree: Tree, nodes: list[int], hists: dict, ahead: dict, used: int, number: int, width: int, weight: float) -> int:
        """Histograms of both children of ``nodes``, in one pass that sums the smaller ones."""
        columns, trial, wanted = self._columns(number, width), Tree(list(tree.splits)), {}
        for k in nodes:
            _, j, b, absent_left = self._best(hists[k], columns)
            left, right = used, used + 1
            used += 2
            trial.splits.append(Split(k, j, b, absent_left, left, right))
            ahead[k] = (left, right)
            n = hists[k][2][j]
            small = left if 2 * (n[1 : b + 1].sum() + (n[0] if absent_left else 0)) <= n.sum() else right
            wanted[small] = len(wanted)
        found = self._histograms(state, pending, trial, wanted, number, width, weight)
        for k in nodes:
            left, right = ahead[k]
            small, large = (left, right) if left in wanted else (right, left)
            hists[small] = found[:, wanted[small]]
            hists[large] = hists[k] - hists[small]
        return used


def _moved(state: DataFrame, trees: list[Tree], width: int) -> DataFrame:
    """The rows with their margins after more trees."""

    def task(batches):
        for b in batches:
            bins, margin = unpacked(b.column("bins"), width), b.column("margin").to_numpy()
            for t in trees:
                margin = margin + t.margins(bins)
            yield pa.RecordBatch.from_arrays([b.column("__row"), b.column("label"), pa.array(margin), b.column("bins")], ["__row", "label", "margin", "bins"])

    return state.mapInArrow(task, ROWS)
