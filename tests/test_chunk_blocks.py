"""Chunks that run over the edges of blocks, and how often all items are joined."""

import random

import pytest

from velora.operators import running
from velora.operators.running import size_chunks


@pytest.mark.parametrize(("most", "size", "block"), [(3, 20, 4), (50, 60, 8), (5, 1000, 1)])
def test_chunks_over_blocks(spark, monkeypatch, most, size, block):
    rng = random.Random(block)
    rows = [(i * 3, rng.choice([0, 1, 5, 30])) for i in range(90)]
    want, chunk, n, total = {}, -1, 0, 0
    for k, w in rows:
        if chunk < 0 or n == most or total + w > size:
            chunk, n, total = chunk + 1, 0, 0
        n, total = n + 1, total + w
        want[k] = chunk
    seen, kept = [], running.written
    monkeypatch.setattr(running, "written", lambda df, label: (seen.append((label, out := kept(df, label))), out)[1])
    df = spark.createDataFrame(rows, "k long, w long").repartition(3)
    got = size_chunks(df, ["k"], "w", most, size, block)
    assert {r.k: r.chunk for r in got.collect()} == want
    if block > most:  # what is doubled has few rows of each block and not all items
        assert all(t.count() <= most * (len(rows) // block + 1) for t in [t for label, t in seen if label == "jumps"][1:])
