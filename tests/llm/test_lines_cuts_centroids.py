"""Line dedup, fill-in-the-middle and centroid clustering against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from velora.llm import fill_in_middle as fim
from velora.llm import line_dedup as lines_module
from velora.llm.centroids import centroid_clusters, nearest, squared_distances
from velora.llm.line_dedup import kept_text, line_dedup


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


# line dedup


def line_key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\v\f\r"))


def brute_lines(rows, min_chars, min_docs):
    holders = collections.defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(line_key(line)) >= min_chars:
                holders[line_key(line)].add(i)
    out = []
    for i, t in rows:
        own = (t or "").split("\n")
        last = lambda ids: max((x for x in ids if x is not None), default=None)
        kept = [x for x in own if len(line_key(x)) < min_chars or len(holders[line_key(x)]) < min_docs or last(holders[line_key(x)]) == i]
        out.append((i, len(own), len(own) - len(kept), sha("\n".join(kept))))
    return sorted(out, key=repr)


def deduped(df, **options):
    kept = kept_text(F.col("__text"), F.col("keep"), F.col("n_dropped"))
    return line_dedup(df, **options).select("doc_id", "n_lines", "n_dropped", kept.alias("t"), "keep")


@pytest.mark.parametrize("parts", [1000, 4])
def test_line_dedup(spark, monkeypatch, parts):
    """With few parts hardly any key is hot, with many most are; a common line stands in most documents."""
    monkeypatch.setattr(lines_module, "PARTS", parts)
    rng = random.Random(parts)
    pool = [f"{'Repeated line of boilerplate ' * 2}{i}" for i in range(30)] + ["short", "", "  ", "x" * 39, "y" * 40, "é" * 40]
    rows = [(i, None if i % 50 == 0 else "\n".join(["\t" + "A Common Line in Most Documents of all the corpus "] * (i % 3 > 0) + [rng.choice(["", " ", "\r"]) + rng.choice(pool) for _ in range(rng.randrange(0, 30))])) for i in range(300)]
    rows += [(7, "a second text of document seven\n" + pool[0]), (None, pool[0]), (None, pool[1]), rows[11], rows[11]]
    got = deduped(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), min_docs=5).collect()
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, sha(r.t)) for r in got), key=repr) == brute_lines(rows, 40, 5)
    for r in got:
        assert sum(k["size"] for k in r.keep) == r.n_lines - r.n_dropped
        assert all(a["start"] + a["size"] < b["start"] for a, b in zip(r.keep, r.keep[1:], strict=False))


def test_line_dedup_odd_rows(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = deduped(odd_docs, min_chars=5, min_docs=2).collect()
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, sha(r.t)) for r in got), key=repr) == brute_lines(rows, 5, 2)
    assert deduped(no_docs).count() == 0
    long = "\n".join(f"a line that is long enough to be judged, number {i % 70_000}" for i in range(100_000))
    rows = [(1, long), (2, "\n".join(long.split("\n")[::3]) + "\n"), (3, "other")]  # every third line goes: many runs
    got = deduped(spark.createDataFrame(rows, "doc_id long, text string"), min_docs=2).collect()
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, sha(r.t)) for r in got), key=repr) == brute_lines(rows, 40, 2)


def test_line_dedup_plan(spark, odd_docs):
    """No Python on the main path, and the window needs no exchange after the range partitioning."""
    lines = lines_module.long_lines(odd_docs, "doc_id", "text", 5)
    plan = lines_module.repeats(lines, 2)._jdf.queryExecution().toString()
    assert "rangepartitioning" in plan and "Python" not in plan and "Arrow" not in plan
    stream = plan.split("== Physical Plan ==")[1].split("rangepartitioning")[0]
    assert "Exchange hashpartitioning(h1" not in stream


# fill-in-the-middle


def brute_cuts(i, t, percent, spm):
    t = t or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", t)
    h = hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    if not t or any(x in t for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= percent:
        return (i, len(units), "plain", None, None, sha(t), sha(t))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    out = f"<S>{s}<P>{p}<M>{m}" if h4 % 100 < spm else f"<P>{p}<S>{s}<M>{m}"
    return (i, len(units), "spm" if h4 % 100 < spm else "psm", len(p), len(m), sha(out), sha(t))


def cut_rows(df, **options):
    out = fim.fill_in_middle(df, **options)
    text = fim.restored(F.col("output"), F.col("form"))
    columns = ["doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256), F.sha2(text, 256)]
    return sorted((tuple(r) for r in out.select(columns).collect()), key=repr)


@pytest.mark.parametrize(("chunk", "percent", "spm"), [(1 << 16, 100, 50), (1, 100, 0), (7, 60, 100), (64, 100, 50)])
def test_fill_in_middle(spark, odd_docs, chunk, percent, spm):
    """Chunks of a byte or a few cut inside code points and between line feeds."""
    rng = random.Random(chunk)
    pieces = ["a", "\n", "\n\n", "é", "日本語", "🙂", "<", "S>", "word ", "\r\n", "<P", ">"]
    rows = [(i, "".join(rng.choice(pieces) for _ in range(rng.randrange(0, 80)))) for i in range(400)] + [(401, None), (None, "x\ny"), (402, "a<M>b"), (403, "\n"), (404, "no line feed"), (403, "again 403\n\n")]
    assert cut_rows(spark.createDataFrame(rows, "doc_id long, text string"), chunk=chunk, percent=percent, spm_percent=spm) == sorted((brute_cuts(i, t, percent, spm) for i, t in rows), key=repr)
    if chunk > 1:
        own = [(r.doc_id, r.text) for r in odd_docs.collect()]
        assert cut_rows(odd_docs, chunk=chunk, percent=percent, spm_percent=spm) == sorted((brute_cuts(i, t, percent, spm) for i, t in own), key=repr)


def test_fill_in_middle_long_and_empty(spark, no_docs):
    assert cut_rows(no_docs) == []
    rows = [(i, f"line {i} of a long text, ünïcode\n" * 200_000) for i in range(3)]
    assert cut_rows(spark.createDataFrame(rows, "doc_id long, text string")) == sorted((brute_cuts(i, t, 100, 50) for i, t in rows), key=repr)


def test_only_owning_chunks_are_scanned_again(monkeypatch):
    raw = np.frombuffer(("ab\n" * 100_000).encode(), np.uint8)
    seen = []
    own = fim._starts
    monkeypatch.setattr(fim, "_starts", lambda r, s, e, b: (seen.append((s, e)), own(r, s, e, b))[1])
    got = fim.chunk_cuts(raw, np.array([0, len(raw)]), np.array([5]), np.array([77_777]), 1000)
    assert (got["n"][0], got["at1"][0], got["at2"][0]) == (100_000, 15, 233_331)
    assert len(seen) == 302 and seen[300:] == [(0, 1000), (233_000, 234_000)]


# centroids


def brute_lloyd(rows, k, rounds, dims, scale=64):
    kept = [(i, [int(np.floor(scale * float(x))) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    start = sorted((hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)[:k]
    c = [v for _, v in start]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, x, strict=True)), n) for n, x in enumerate(c)) for _, v in kept]

    for _ in range(rounds):
        owners = assign()
        for n in range(len(c)):
            mine = [v for (_, v), (_, o) in zip(kept, owners, strict=True) if o == n]
            if mine:
                c[n] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    last = assign()
    per = collections.Counter()
    for d, n in last:
        per[n] += d
    return sorted(((i, n, d, per[n], sum(per.values()), sha(",".join(map(str, c[n])))) for (i, _), (d, n) in zip(kept, last, strict=True)), key=repr)


def vector_rows(seed, n, dims, copies=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dims))
    rows = [(i, [float(x) for x in centres[i % 6] + rng.normal(size=dims) * 0.7]) for i in range(n)]
    return rows + [(1000 + i, rows[0][1]) for i in range(copies)]


@pytest.mark.parametrize(("n", "k", "rounds", "copies"), [(200, 8, 3, 0), (300, 16, 6, 150), (5, 16, 3, 0), (120, 4, 20, 3)])
def test_centroid_clusters(spark, n, k, rounds, copies):
    """Many rounds reach a state in which some centroids stand still, and then one in which all do."""
    rows = vector_rows(n, n, 5, copies)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    assert sorted((tuple(r) for r in centroid_clusters(df, k=k, rounds=rounds, dims=5).collect()), key=repr) == brute_lloyd(rows, k, rounds, 5)


def test_centroid_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    odd = [(None, [0.5, -0.25, 1.0]), (1, None), (2, []), (3, [1.0, 2.0]), (4, [1.0, None, 2.0]), (5, [nan, 0.0, 0.0]), (6, [inf, 0.0, 0.0]), (7, [-0.001, 0.0, 0.0]), (7, [-0.001, 0.0, 0.0]), (8, [1000.5, -1000.5, 0.0]), (9, [0.0, 0.0, 0.0, 0.0])]
    rows = [(i, v, "x", 1, 2) for i, v in odd]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, owner string, v int, distance int")
    assert sorted((tuple(r) for r in centroid_clusters(df, k=3, dims=3).collect()), key=repr) == brute_lloyd(odd, 3, 3, 3)
    assert centroid_clusters(df.limit(0), k=3, dims=3).count() == 0
    with pytest.raises(Exception, match="too large"):
        centroid_clusters(spark.createDataFrame([(1, [1e18])], "vec_id long, embedding array<double>"), dims=1).count()


def test_nearest_compares_changed_centroids_alone(monkeypatch):
    from velora.llm import centroids as module

    rng = np.random.default_rng(3)
    v, c = rng.integers(-50, 50, (500, 4)), rng.integers(-50, 50, (9, 4))
    owner, distance = nearest(v, np.full(500, -1), np.zeros(500, np.int64), c, np.ones(9, bool))
    moved = c.copy()
    moved[[2, 5]] += 3
    sizes = []
    own = module.squared_distances
    monkeypatch.setattr(module, "squared_distances", lambda a, b: (sizes.append((len(a), len(b))), own(a, b))[1])
    changed = (moved != c).any(axis=1)
    got = nearest(v, owner, distance, moved, changed)
    again = squared_distances(v, moved)
    assert (got[0] == again.argmin(axis=1)).all() and (got[1] == again.min(axis=1)).all()
    stale = int(np.isin(owner, [2, 5]).sum())
    assert sizes == [(stale, 9), (500 - stale, 2)]


def test_distances_of_large_integers():
    v, c = np.array([[1 << 25, -(1 << 25)]]), np.array([[-(1 << 25), 1 << 25]])
    assert squared_distances(v, c).tolist() == [[2 * (1 << 26) ** 2]]
