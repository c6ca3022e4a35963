"""Rows of a fit: bins as binary values, and margins of pending trees that are written once for several trees."""

import numpy as np
import pyarrow as pa
import pytest

from tests.test_boosting import NAMES, plain_fit, samples
from velora.operators import boosting
from velora.operators.boosting import Boosting, packed, unpacked


@pytest.mark.parametrize("most", [63, 255, 256, 70_000])
def test_bins_as_binary_values(most):
    bins = np.random.default_rng(0).integers(0, most + 1, (9, 4)).astype(np.int32)
    column = packed(bins, most)
    assert (unpacked(column, 4) == bins).all() and (unpacked(column.slice(3, 2), 4) == bins[3:5]).all()
    assert unpacked(pa.array([], pa.binary()), 4).shape == (0, 4) and len(packed(bins[:0], most)) == 0


def test_rows_are_not_written_for_each_tree(spark, monkeypatch):
    """Three trees write the samples and their bins once; with fewer pending trees the fit is the same."""
    seen = []
    kept = boosting.written
    monkeypatch.setattr(boosting, "written", lambda df, label: (seen.append((label, df.schema)), kept(df, label))[1])
    df, x, y = samples(spark, 400)
    params = Boosting(trees=3, leaves=5, rate=0.3, least_rows=15, rows=1.0, columns=1.0, bins=16)
    fitted = params.fit(df, NAMES)
    assert [label for label, _ in seen] == ["samples", "binned"] and seen[1][1]["bins"].dataType.typeName() == "binary"
    monkeypatch.setattr(boosting, "PENDING", 1)
    again = params.fit(df, NAMES)
    assert [label for label, _ in seen[2:]] == ["samples", "binned", "binned", "binned"]
    assert np.abs(fitted.margins(x) - plain_fit(params, x, y, fitted.cuts)).max() < 1e-6 and np.array_equal(fitted.margins(x), again.margins(x))
