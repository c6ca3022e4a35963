"""Exact dedup, Jaccard join, components and substring dedup against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest

from velora.llm import jaccard_join, substring_dedup
from velora.llm.common import Bitmap, bitmap_of
from velora.llm.components import components
from velora.llm.exact_dedup import exact_dedup
from velora.llm.fm_index import FMIndex


def find(parent, x):
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def squeeze(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def brute_exact(rows):
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[squeeze(t)].append(i)
    out = []
    for i, t in rows:
        g = groups[squeeze(t)]
        keep = min((x for x in g if x is not None), default=None)
        out.append((i, keep, len(g), i == keep, hashlib.sha256(squeeze(t).encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("options", [{}, {"block_bytes": 4, "bucket_bits": 2}, {"block_bytes": 200, "bucket_bits": 9}])
def test_exact_dedup(documents, odd_docs, texts, options):
    """Few bucket bits put many blocks in a bucket, so that names are told apart by rank."""
    if options.get("block_bytes") == 4:
        cases = [[(r.doc_id, r.text) for r in odd_docs.where("coalesce(length(text), 0) < 500").collect()]]
        frames = [odd_docs.where("coalesce(length(text), 0) < 500")]
    else:
        cases = [list(texts.items()), [(r.doc_id, r.text) for r in odd_docs.collect()]]
        frames = [documents, odd_docs]
    for rows, df in zip(cases, frames, strict=True):
        assert sorted((tuple(r) for r in exact_dedup(df, **options).collect()), key=repr) == brute_exact(rows)


def test_exact_dedup_cuts_few_texts_again(spark, monkeypatch):
    """With 20 bits some buckets are crowded; only the texts that hold a block of one go the second way."""
    from velora.llm import exact_dedup as module

    rng = random.Random(9)
    rows = [(i, "".join(rng.choice("abcdefgh") for _ in range(40 if i % 10 else 400))) for i in range(3000)]
    again = []
    monkeypatch.setattr(module, "_few", lambda texts, count: (again.append(count), texts)[1])
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((tuple(r) for r in exact_dedup(df, block_bytes=50, bucket_bits=20).collect()), key=repr) == brute_exact(rows)
    assert again and 0 < max(again) < 300


def test_exact_dedup_of_nothing(no_docs):
    assert exact_dedup(no_docs).count() == 0


def brute_jaccard(rows, k, percent):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = frozenset(tuple(w[j : j + min(k, len(w))]) for j in range(max(1, len(w) - k + 1))) if w else frozenset()
    parent = {i: i for i in sets}
    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(parent, i), find(parent, j)
                parent[max(x, y)] = min(x, y)
    return {i: (len(s), find(parent, i)) for i, s in sets.items()}


def near_copies(seed, n=120):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    bases = [[rng.choice(words) for _ in range(rng.randrange(4, 90))] for _ in range(6)]
    rows = []
    for i in range(n):
        t = list(rng.choice(bases))
        for _ in range(rng.randrange(0, 4)):
            t[rng.randrange(len(t))] = rng.choice(words)
        rows.append((i, " ".join(t)))
    return rows


@pytest.mark.parametrize(("k", "percent", "size"), [(3, 90, 256), (5, 80, 8), (2, 60, 8)])
def test_jaccard_components(spark, monkeypatch, k, percent, size):
    """Small sub-groups force leaders, sub-groups and openings between them."""
    monkeypatch.setattr(jaccard_join, "GROUP_DOCS", size)
    rows = near_copies(percent)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(df, words=k, percent=percent).collect()}
    assert got == brute_jaccard(rows, k, percent)


def test_jaccard_odd_rows(odd_docs, no_docs):
    got = [tuple(r) for r in jaccard_join.jaccard_components(odd_docs, words=3, percent=90).collect()]
    assert len(got) == odd_docs.count()
    ids = {i: (n, c) for i, n, c in got if i is not None}
    assert ids[2] == (0, 2) and ids[3] == (0, 3) and ids[4] == (0, 4) and ids[5] == (2, 1) and ids[8][1] == 7
    assert all(c is None for i, _, c in got if i is None)
    assert jaccard_join.jaccard_components(no_docs).count() == 0


def test_jaccard_ids_with_two_texts(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    rows = [(6, a), (6, b), (8, a + " z"), (9, b + " z"), (5, a + " y"), (None, b), (7, ""), (9, b + " z")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(df, words=3, percent=90).collect())
    assert got == sorted([(6, 58, 5), (6, 58, 6), (8, 59, 5), (9, 59, 6), (9, 59, 6), (5, 59, 5), (-1, 58, None), (7, 0, 7)])
    keyed = jaccard_join.jaccard_components(df, words=3, percent=90, with_keys=True).where("row_key = leader_key").collect()
    assert sorted((r.doc_id or -1, r.component_id) for r in keyed) == [(-1, None), (5, 5), (6, 6), (7, 7)]


def test_jaccard_opens_few_groups(spark, monkeypatch):
    """Many documents share a token with a group, and few of them as many as the required overlap takes."""
    seen = {}
    opened = jaccard_join.opened

    def counted(shared, groups, percent, least=jaccard_join.SHARED):
        seen.update({k: opened(shared, groups, percent, k).count() for k in (1, least)})
        return opened(shared, groups, percent, least)

    monkeypatch.setattr(jaccard_join, "opened", counted)
    rng = random.Random(3)
    lines = [" ".join(f"l{n}w{k}" for k in range(6)) for n in range(300)]
    rows = [(i, " ".join(rng.sample(lines, 8))) for i in range(400)] + near_copies(5, 100)
    rows = [(n, t) for n, (_, t) in enumerate(rows)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(df, words=3, percent=80).collect()}
    assert got == brute_jaccard(rows, 3, 80) and seen[jaccard_join.SHARED] < 0.8 * seen[1]


def test_signatures_miss_no_similar_pair():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 60, 700).astype(np.uint64)
    sets = [np.unique(np.concatenate([base[: 700 - int(k)], rng.integers(0, 1 << 60, int(k)).astype(np.uint64)])) for k in rng.integers(0, 200, 40)] + [base[:n] for n in (3, 255, 256, 300, 511, 600)]
    sets = [np.unique(s) for s in sets]
    n, sigs = np.array([len(s) for s in sets]), [jaccard_join.signature(s) for s in sets]
    for percent in (50, 80, 90):
        true = jaccard_join.similar(jaccard_join.overlaps(sets, sets), n, n, percent)
        assert not (true & ~jaccard_join.candidates(n, sigs, n, sigs, percent)).any()


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 360)] + [(7, 7), (5, None)]
    parent = {x: x for e in edges for x in e if x is not None}
    for a, b in edges:
        if b is not None:
            x, y = find(parent, a), find(parent, b)
            parent[max(x, y)] = min(x, y)
    linked = {x for a, b in edges if b is not None and a != b for x in (a, b)}
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(parent, x) for x in linked}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_bitmap(spark):
    keys = list(range(-500, 500, 7))
    b = bitmap_of(spark.createDataFrame([(k,) for k in keys], "k long"), "k", 16)
    assert isinstance(b, Bitmap) and b.has(np.array(keys)).all() and b.has(np.arange(10_000, 20_000)).mean() < 0.1


def brute_substrings(rows, length=35):
    seen = collections.Counter(tuple(w[j : j + length]) for _, t in rows for w in [(t or "").encode().split()] for j in range(len(w) - length + 1))
    out = []
    for i, t in rows:
        w = (t or "").encode().split()
        gone = {k for j in range(len(w) - length + 1) if seen[tuple(w[j : j + length])] > 1 for k in range(j, j + length)}
        out.append((i, len(w), len(gone), hashlib.sha256(b" ".join(x for k, x in enumerate(w) if k not in gone)).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot", [2_500_000, 60])
def test_substring_dedup(spark, documents, texts, odd_docs, monkeypatch, hot):
    """A low limit sends minimizers down the window-by-window way."""
    monkeypatch.setattr(substring_dedup, "HOT_WORDS", hot)
    monkeypatch.setattr(substring_dedup, "SHARD_WORDS", 2000)
    junk = [(1, "au " * 200), (2, "x y z " * 30), (3, " ".join(f"q{i}" for i in range(34))), (4, " ".join(f"q{i}" for i in range(35)))]
    cases = ((documents, list(texts.items())), (odd_docs, [(r.doc_id, r.text) for r in odd_docs.collect()]), (spark.createDataFrame(junk, "doc_id long, text string"), junk))
    for df, rows in cases:
        assert sorted((tuple(r) for r in substring_dedup.substring_dedup(df).collect()), key=repr) == brute_substrings(rows)


def test_substring_dedup_text_and_nothing(spark, no_docs):
    same = " ".join(f"a{i}" for i in range(40))
    df = spark.createDataFrame([(1, "x " + same), (2, same + " y")], "doc_id long, text string")
    assert {r.doc_id: r.kept_text for r in substring_dedup.substring_dedup(df, with_text=True).collect()} == {1: "x", 2: "y"}
    assert substring_dedup.substring_dedup(no_docs).count() == 0


def test_matching_statistics():
    rng = np.random.default_rng(2)
    for sigma, n in ((2, 300), (5, 500), (90, 700), (3, 2)):
        text = np.append(rng.integers(1, sigma + 1, n), 0)
        for most in (1, 3, 7):
            if n < most:
                continue
            ends = np.arange(most - 1, n)
            counts = [collections.Counter(tuple(text[i : i + k].tolist()) for i in range(len(text) - k + 1)) for k in range(1, most + 1)]
            want = [max((k for k in range(1, most + 1) if counts[k - 1][tuple(text[e - k + 1 : e + 1].tolist())] > 1), default=0) for e in ends]
            assert FMIndex(text, most).matching_statistics(text, ends, most).tolist() == want


def test_substring_dedup_of_a_passage_everywhere(spark):
    """The same passage stands in all documents, between their own words, and two passages differ in one word."""
    passage = " ".join(f"p{i}" for i in range(90))
    rows = [(i, " ".join(f"d{i}x{j}" for j in range(i % 7)) + " " + passage + f" e{i}") for i in range(300)]
    rows += [(1000, passage.replace("p45", "q45")), (1001, " ".join(f"u{i}" for i in range(200)))]
    got = sorted((tuple(r) for r in substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=repr)
    assert got == brute_substrings(rows)
