"""Boosted trees against a fit that splits one leaf at a time over all rows, and against MLlib's trees."""

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator

from velora.operators import model
from velora.operators.boosting import UNIT, Boosting, binned
from velora.sources.objects import ObjectStore

NAMES = ["a", "b", "c"]


def samples(spark, n=700, seed=1):
    rng = np.random.default_rng(seed)
    a, b, c = rng.normal(size=n), rng.integers(0, 6, n).astype(float), rng.exponential(size=n)
    odds = 2 * (a > 0.5) * (b < 3) + np.where(c > 1.5, 1.5, -1) - 1
    label = (rng.random(n) < 1 / (1 + np.exp(-odds))).astype(int)
    c[rng.random(n) < 0.2] = np.nan
    rows = [(float(x), float(y), None if np.isnan(z) else float(z), int(t)) for x, y, z, t in zip(a, b, c, label, strict=True)]
    return spark.createDataFrame(rows, "a double, b double, c double, label int").repartition(3), np.column_stack([a, b, c]), label


def plain_fit(params, x, y, cuts):
    """Leaf-wise trees, each split found by going over the rows of each leaf again."""
    bins, w = binned(x, cuts), np.where(y > 0, (y == 0).sum() / (y > 0).sum(), 1.0) if params.balanced else np.ones(len(y))
    p0 = (w * y).sum() / w.sum()
    margin, start = np.full(len(y), np.log(p0 / (1 - p0))), np.log(p0 / (1 - p0))
    total = np.zeros(len(y))
    for number in range(params.trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = np.rint((p - y) * w * UNIT) / UNIT, np.rint(p * (1 - p) * w * UNIT) / UNIT
        columns, worth = params._columns(number, x.shape[1]), lambda m, g=g, h=h: g[m].sum() ** 2 / (h[m].sum() + params.l2)

        def best(rows, columns=columns, worth=worth):
            found = None
            for j in columns:
                for absent_left in (True, False):
                    for b in range(1, params.bins):
                        left = np.where(bins[:, j] == 0, absent_left, bins[:, j] <= b) & rows
                        right = rows & ~left
                        if min(left.sum(), right.sum()) < params.least_rows:
                            continue
                        gain = worth(left) + worth(right) - worth(rows)
                        if gain > 1e-9 and (found is None or gain > found[0] + 1e-12):
                            found = (gain, left, right)
            return found

        leaves = [np.ones(len(y), bool)]
        options = [best(leaves[0])]
        while len(leaves) < params.leaves and any(options):
            k = max((i for i in range(len(leaves)) if options[i]), key=lambda i: options[i][0])
            _, left, right = options[k]
            leaves[k : k + 1], options[k : k + 1] = [left, right], [best(left), best(right)]
        for m in leaves:
            step = -params.rate * g[m].sum() / (h[m].sum() + params.l2)
            margin[m] += step
            total[m] += step
    return start + total


@pytest.mark.parametrize("params", [Boosting(trees=3, leaves=7, rate=0.3, least_rows=15, rows=1.0, columns=1.0, bins=16), Boosting(trees=4, leaves=12, rate=0.2, least_rows=5, rows=1.0, columns=0.67, bins=8, balanced=False)])
def test_trees_equal_a_plain_fit(spark, tmp_path, params):
    df, x, y = samples(spark)
    fitted = params.fit(df, NAMES)
    assert np.abs(fitted.margins(x) - plain_fit(params, x, y, fitted.cuts)).max() < 1e-6
    registry = model.Registry(ObjectStore(spark, f"file://{tmp_path}/r"))
    registry.register("v1", fitted, {"capture_at_k": 1.0}, NAMES)
    again = registry.load("v1")
    got = again.score(df).toPandas()
    assert np.abs(got.score - 1 / (1 + np.exp(-fitted.margins(got[NAMES].to_numpy(float))))).max() < 1e-12
    assert abs(sum(fitted.importances().values()) - 1) < 1e-9


def test_no_worse_than_trees_of_one_depth(spark):
    df, x, _ = samples(spark, 3000, 5)
    held = samples(spark, 2000, 6)[0]
    own = model.candidates(NAMES, trees=20, leaves=8, rate=0.2, least_rows=20)["boosted"].fit(df)
    assert all(len(t.values) <= 8 for t in own.trees)
    other = model.candidates(NAMES)["gbt"].fit(df.na.fill(-1.0))
    area = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label")
    assert area.evaluate(model.score(own, held)) >= area.evaluate(model.score(other, held.na.fill(-1.0))) - 0.01


def test_odd_samples(spark):
    schema = "a double, label int"
    with pytest.raises(ValueError):
        Boosting().fit(spark.createDataFrame([(1.0, 1)], schema), ["a"])
    with pytest.raises(ValueError):
        Boosting().fit(spark.createDataFrame([], schema), ["a"])
    rows = [(None, 1), (None, 1), (5.0, 0), (5.0, 0), (5.0, 0), (7.0, None)]
    fitted = Boosting(trees=5, least_rows=1, rows=1.0, rate=1.0).fit(spark.createDataFrame(rows, schema), ["a"])
    got = fitted.score(spark.createDataFrame([(None, 0), (5.0, 0)], schema)).collect()
    assert got[0].score > 0.8 > 0.2 > got[1].score  # an absent value is told from the others
