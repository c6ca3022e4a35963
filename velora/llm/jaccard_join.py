"""N-gram Jaccard join with a token-group matrix (after Li et al., "LES3", 2021), exact.

Documents with equal shingle sets form a class; the join works on one row per class.  Tokens (shingles) are put in one
order for all documents, rarest first by a count sketch of fixed size.  Of two sets that are similar enough, the first
few tokens in that order (the prefixes, ``SHARED`` tokens longer than would do for one) have ``SHARED`` tokens in common,
so only these few are stored.

1. Groups: every class joins the group of its prefix token that most other classes have too, and there the group of
   those with a like least hash, so that similar classes are together.  Large groups are dealt into sub-groups of bounded
   size, each with the group's leader, and linked inside by a blockwise product.
2. Matrix: for each token the groups whose union of prefixes has it, with the range of sizes and labels of its owners.
3. Bound: the tokens that a query shares with a group's union are counted, over the owners that may be similar to it.
   A count below ``SHARED`` (or, with very small sets, below the overlap that a pair needs) leaves the required overlap out
   of reach whatever the rest of the set is: the group stays shut.
4. Opened sub-groups are compared with their queries, in blocks, first by signatures of the whole sets, then by exact
   intersections; components close the links.

A hot group is never in one task, pairs inside a group are never emitted as rows, and no candidate is dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velora.llm.common import Bitmap, bitmap_of, by_key, join_classes, merge_pieces, mixed, scratch, shared_table, small_batches, text_grams, text_groups
from velora.llm.components import components

CELL_BITS, PIECE_BITS = 22, 14
#: Documents and tokens of a sub-group.
GROUP_DOCS, GROUP_TOKENS = 256, 2_000_000
#: Tokens that the prefixes of similar sets have in common.
SHARED = 3


def shingles(texts: list[str | None], k: int) -> list[np.ndarray]:
    """Hashes of the shingles of each text, as often as they occur."""
    return text_grams([(t or "").encode().lower() for t in texts], k)


def _cells(tokens: np.ndarray) -> np.ndarray:
    return (mixed(tokens) >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def token_levels(texts: DataFrame, k: int) -> np.ndarray:
    """How common the tokens of each of 2**22 cells are: the binary logarithm of their count over all rows against
    twice the mean (a task's own count stops at 255).  It orders tokens and decides nothing; the driver gets 2**22 small numbers, whatever the input."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(1 << CELL_BITS, np.uint32)
        for b in batches:
            for _, part in text_groups(b.column(0)):
                np.add.at(own, _cells(np.concatenate(shingles(part, k))), np.uint32(1))
        own = np.minimum(own, 255).astype(np.uint8).reshape(-1, 1 << PIECE_BITS)
        full = np.flatnonzero(own.any(axis=1))
        yield pa.RecordBatch.from_pydict({"piece": full.astype(np.int32), "counts": [own[i].tobytes() for i in full]}, schema=pa.schema([("piece", pa.int32()), ("counts", pa.binary())]))

    def added(t: pa.Table) -> bytes:
        out = np.zeros(1 << PIECE_BITS, np.int64)
        for x in t.column("counts"):
            x = x.as_py()
            out += np.frombuffer(x, np.uint8 if len(x) == len(out) else np.int64)
        return out.tobytes()

    def logs(data: bytes) -> bytes:
        return np.log2(np.frombuffer(data, np.int64) + 1.0).astype(np.float16).tobytes()

    level = np.zeros((1 << (CELL_BITS - PIECE_BITS), 1 << PIECE_BITS), np.float16)
    for piece, data in merge_pieces(texts.mapInArrow(counted, "piece int, counts binary"), added, "counts", logs):
        level[piece] = np.frombuffer(data, np.float16)
    level = level.reshape(-1)
    mean = np.mean([np.exp2(x.astype(np.float32)).mean() for x in np.split(level, 64)])
    return np.clip(level - np.float16(np.log2(2 * mean)), 0, 30).astype(np.uint8)


def signature(tokens: np.ndarray) -> bytes:
    """The cells that a set's tokens fall in, one bit each; the power of two cells above the set's size, 2**8 to 2**16."""
    cells = 1 << min(max(int(len(tokens)).bit_length(), 8), 16)
    bits = np.zeros(cells, np.uint8)
    bits[(mixed(tokens ^ np.uint64(0x5851F42D4C957F2D)) & np.uint64(cells - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def candidates(q_n: np.ndarray, q_sigs: list[bytes], m_n: np.ndarray, m_sigs: list[bytes], percent: int) -> np.ndarray:
    """Pairs whose similarity can reach ``percent`` by their signatures: every cell of one set that the other lacks is
    a token that they do not share, so no similar pair is missed.  Signatures are folded to the shorter one's cells."""
    q_len, m_len = np.array([len(x) for x in q_sigs]), np.array([len(x) for x in m_sigs])
    out = np.zeros((len(q_sigs), len(m_sigs)), bool)
    folded = lambda sigs, pick, size: np.stack([np.unpackbits(np.bitwise_or.reduce(np.frombuffer(sigs[i], np.uint8).reshape(-1, size), axis=0), bitorder="little") for i in pick]).astype(np.float32)
    for size in np.unique(np.concatenate([q_len, m_len])):
        qs, ms = np.flatnonzero(q_len >= size), np.flatnonzero(m_len >= size)
        if not len(qs) or not len(ms):
            continue
        low, high = q_n[qs].min() * percent // 100, 100 * q_n[qs].max() // percent + 1
        if size < max(q_len.max(), m_len.max()):  # sets far larger than any partner of this size need no fold
            top = 1 + 100 * max(q_n[q_len == size].max(initial=0), m_n[m_len == size].max(initial=0)) // percent
            qs, ms = qs[q_n[qs] <= top], ms[m_n[ms] <= top]
        ms = ms[(m_n[ms] >= low) & (m_n[ms] <= high)]
        if not len(qs) or not len(ms):
            continue
        a, b = folded(q_sigs, qs, size), folded(m_sigs, ms, size)
        both = a @ b.T
        bound = np.minimum(q_n[qs][:, None] - (a.sum(axis=1)[:, None] - both), m_n[ms][None, :] - (b.sum(axis=1)[None, :] - both)).astype(np.int64)
        fits = similar(bound, q_n[qs], m_n[ms], percent) & (np.minimum(q_len[qs][:, None], m_len[ms][None, :]) == size)
        out[np.ix_(qs, ms)] |= fits
    return out


def needed(n, percent: int):
    """The overlap that a set of n tokens has at least with a similar one: percent / 100 * n, rounded up."""
    return (percent * n + 99) // 100


def shingle_prefixes(docs: DataFrame, levels: np.ndarray, k: int, percent: int) -> DataFrame:
    """Per row: ``doc, r, n, f1, f2, least, prefix, sig``: the row's key, size, fingerprint, least hash and signature of the
    set, and its first tokens in the common order."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = {"doc": b.column(0).to_pylist(), "r": b.column(2).to_pylist(), "n": [], "f1": [], "f2": [], "least": [], "prefix": [], "sig": []}
            for s in (s for _, part in text_groups(b.column(1)) for s in shingles(part, k)):
                s = np.unique(s)
                f, n = xxhash.xxh3_128_digest(s.tobytes()), len(s)
                least = int(mixed(s).min().view(np.int64)) if n else 0
                size = n - needed(n, percent) + min(SHARED, needed(n, percent))
                first = s[np.argsort(levels[_cells(s)], kind="stable")[:size]] if n else s
                f = np.frombuffer(f, np.int64)
                for c, v in (("n", n), ("f1", f[0]), ("f2", f[1]), ("least", least), ("prefix", first.view(np.int64)), ("sig", signature(s))):
                    out[c].append(v)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([*((c, pa.int64()) for c in ("doc", "r", "n", "f1", "f2", "least")), ("prefix", pa.list_(pa.int64())), ("sig", pa.binary())]))

    return docs.mapInArrow(rows, "doc long, r long, n long, f1 long, f2 long, least long, prefix array<long>, sig binary")


def shingle_sets(texts: DataFrame, wanted: Bitmap, k: int) -> DataFrame:
    """``r, f1, tokens`` of the rows whose key is in the bitmap (and perhaps some others): the whole set, sorted, as 64-bit integers."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            r, out = b.column(2).to_numpy(), {"r": [], "f1": [], "tokens": []}
            new = [i for i in np.flatnonzero(wanted.has(r)).tolist() if r[i] not in seen and not seen.add(r[i])]  # a row that occurs often comes once a task
            sets = (s for _, part in text_groups(b.column(1).take(pa.array(new, pa.int64()))) for s in shingles(part, k))
            for i, s in zip(new, sets, strict=True):
                s = np.unique(s).tobytes()
                for c, v in (("r", r[i]), ("f1", np.frombuffer(xxhash.xxh3_128_digest(s), np.int64)[0]), ("tokens", s)):
                    out[c].append(v)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("r", pa.int64()), ("f1", pa.int64()), ("tokens", pa.binary())]))

    return texts.mapInArrow(rows, "r long, f1 long, tokens binary")


def overlaps(queries: list[np.ndarray], members: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of sorted sets, by products of 0/1 blocks over the tokens that both sides have."""
    sizes = [len(x) for x in (*queries, *members)]
    tokens, column = np.unique(np.concatenate([*queries, *members]), return_inverse=True)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    both = np.zeros(len(tokens), np.uint8)
    both[column[owner < len(queries)]] |= 1
    both[column[owner >= len(queries)]] |= 2
    place = np.cumsum(both == 3) - 1
    keep = both[column] == 3
    owner, column = owner[keep], place[column[keep]]
    by = np.argsort(column, kind="stable")
    owner, column = owner[by], column[by]
    out, width = np.zeros((len(queries), len(members))), 16_384
    for start in range(0, int(place[-1]) + 1 if len(place) else 0, width):
        a, z = np.searchsorted(column, [start, start + width])
        block = np.zeros((len(sizes), min(width, int(place[-1]) + 1 - start)), np.float32)
        block[owner[a:z], column[a:z] - start] = 1
        out += block[: len(queries)] @ block[len(queries) :].T
    return out.astype(np.int64)


def similar(shared: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int) -> np.ndarray:
    return 100 * shared >= percent * (left[:, None] + right[None, :] - shared)


def _sets(t: pa.Table) -> list[np.ndarray]:
    return [np.frombuffer(x.as_py(), np.uint64) for x in t.column("tokens")]


LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _inner_candidates(groups: DataFrame, percent: int) -> DataFrame:
    """``g, sub, doc`` of the documents that can be similar to another of their sub-group."""

    def gate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in by_key(batches, 2):
            if t.num_rows > 1:
                n, sigs = t.column("n").to_numpy(), t.column("sig").to_pylist()
                pairs = candidates(n, sigs, n, sigs, percent)
                np.fill_diagonal(pairs, False)
                if pairs.any():
                    yield from t.select(["g", "sub", "doc"]).filter(pa.array(pairs.any(axis=1) | pairs.any(axis=0))).to_batches()

    return groups.select("g", "sub", "doc", "n", "sig").repartition("g", "sub").sortWithinPartitions("g", "sub").mapInArrow(gate, "g long, sub int, doc long")


def _outer_candidates(asked: DataFrame, percent: int) -> DataFrame:
    """``g, sub, part, query, doc, label``: the queries that can be similar to a member of another label, and those members."""

    def gate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in by_key(batches, 3):
            query = t.column("query").to_numpy(zero_copy_only=False).astype(bool)
            if query.all() or not query.any():
                continue
            n, label, sigs = t.column("n").to_numpy(), t.column("label").to_numpy(), t.column("sig").to_pylist()
            qs, ms = np.flatnonzero(query), np.flatnonzero(~query)
            pairs = candidates(n[qs], [sigs[i] for i in qs], n[ms], [sigs[i] for i in ms], percent) & (label[qs][:, None] != label[ms][None, :])
            if pairs.any():
                keep = np.zeros(len(n), bool)
                keep[qs], keep[ms] = pairs.any(axis=1), pairs.any(axis=0)
                yield from t.select(["g", "sub", "part", "query", "doc", "label"]).filter(pa.array(keep)).to_batches()

    keys = ("g", "sub", "part")
    return asked.select(*keys, "query", "doc", "label", "n", "sig").repartition(*keys).sortWithinPartitions(*keys).mapInArrow(gate, "g long, sub int, part int, query boolean, doc long, label long")


def _inner_links(groups: DataFrame, percent: int) -> DataFrame:
    """``a, b``: each document of a sub-group with the smallest document that it reaches inside."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out_a, out_b = [], []
        for t in by_key(batches, 2):
            if t.num_rows < 2:
                continue
            docs, sets = t.column("doc").to_numpy(), _sets(t)
            by = np.argsort(docs, kind="stable")
            docs, sets = docs[by], [sets[i] for i in by]
            n = np.array([len(s) for s in sets], np.int64)
            linked = similar(overlaps(sets, sets), n, n, percent)
            label = np.arange(len(docs))
            while True:
                low = np.where(linked, label, len(docs)).min(axis=1)
                low = np.minimum(label, low)
                low = low[low]
                if (low == label).all():
                    break
                label = low
            moved = label != np.arange(len(docs))
            out_a.append(docs[moved])
            out_b.append(docs[label[moved]])
        if out_a:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))], schema=LINKS)

    return groups.select("g", "sub", "doc", "tokens").repartition("g", "sub").sortWithinPartitions("g", "sub").mapInArrow(link, "a long, b long")


def _outer_links(opened: DataFrame, percent: int) -> DataFrame:
    """``a, b``: each query with a member of every label that it is similar to."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in by_key(batches, 3):
            query = t.column("query").to_numpy(zero_copy_only=False).astype(bool)
            if query.all() or not query.any():
                continue
            docs, label, sets = t.column("doc").to_numpy(), t.column("label").to_numpy(), _sets(t)
            qs, ms = np.flatnonzero(query), np.flatnonzero(~query)
            n = np.array([len(s) for s in sets], np.int64)
            i, j = np.nonzero(similar(overlaps([sets[x] for x in qs], [sets[x] for x in ms]), n[qs], n[ms], percent))
            pairs = np.unique(np.stack([docs[qs[i]], label[ms[j]]], axis=1), axis=0)
            if len(pairs):
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], schema=LINKS)

    keys = ("g", "sub", "part")
    return opened.select(*keys, "query", "doc", "label", "tokens").repartition(*keys).sortWithinPartitions(*keys).mapInArrow(link, "a long, b long")


def grouped(reps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The prefix tokens that several classes have (``doc, n, pos, token, docs``), and the classes in their groups (``g, sub, subs, leader, doc, n``)."""
    tokens = reps.select("doc", "n", "least", F.posexplode("prefix").alias("pos", "token"))
    common = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("docs")).where("docs > 1")
    shared = shared_table(join_classes(tokens, shared_table(common, "common"), ["token"], "docs"), "shared")
    sized = (F.count(F.lit(1)).alias("rows"), F.greatest(F.ceil(F.count(F.lit(1)) / GROUP_DOCS), F.ceil(F.sum("n") / GROUP_TOKENS)).cast("int").alias("subs"))
    home = shared_table(shared.groupBy("doc", "n", "least").agg(F.max(F.struct("docs", "token"))["token"].alias("g")), "home")
    like = F.xxhash64("g", F.pmod(F.xxhash64("least"), "subs")).alias("g")
    home = shared_table(join_classes(home, shared_table(home.groupBy("g").agg(*sized), "sizes"), ["g"], "rows").select(like, "doc", "n"), "home")
    sizes = shared_table(home.groupBy("g").agg(*sized, F.min("doc").alias("leader")), "sizes")
    return shared, shared_table(join_classes(home, sizes, ["g"], "rows").withColumn("sub", F.pmod(F.xxhash64("doc"), "subs").cast("int")), "groups")


def opened(shared: DataFrame, groups: DataFrame, percent: int, least: int = SHARED) -> DataFrame:
    """``q, q_n, q_label, q_g, q_sub, g, tokens``: the groups that a class has to be compared with.

    A similar pair (x, y) with x no larger than y is found by y: its prefix and the first tokens of x up to x's place for
    an equal partner have min(``least``, the overlap that the smaller one needs) tokens in common.
    """
    equal = lambda n: (2 * percent * n + (100 + percent) - 1) / (100 + percent)
    must = lambda n: F.least(F.lit(least), F.ceil(F.lit(percent) * n / 100))
    spans = (F.min("n").alias("n_lo"), F.max("n").alias("n_hi"), F.min("label").alias("l_lo"), F.max("label").alias("l_hi"))
    placed = shared.select("doc", "pos", "token").join(groups, "doc")
    matrix = placed.where(F.col("pos") < F.col("n") - F.floor(equal(F.col("n"))) + must(F.col("n"))).groupBy("token", "g").agg(*spans)
    query = placed.select("token", F.col("doc").alias("q"), F.col("n").alias("q_n"), F.col("label").alias("q_label"), F.col("g").alias("q_g"), F.col("sub").alias("q_sub"), F.col("subs").alias("q_subs"))
    pairs = query.join(matrix, "token").where(may_open(percent) & ((F.col("g") != F.col("q_g")) | (F.col("q_subs") > 1)))
    counted = pairs.groupBy("q", "q_n", "q_label", "q_g", "q_sub", "g").agg(F.count(F.lit(1)).alias("tokens"), F.min("n_lo").alias("n_lo"))
    return counted.where(F.col("tokens") >= F.least(must(F.col("q_n")), must(F.col("n_lo")))).drop("n_lo")


def may_open(percent: int):
    """Whether sizes and labels of some classes allow a new link with the query."""
    return (F.col("n_lo") <= F.col("q_n")) & (100 * F.col("n_hi") >= percent * F.col("q_n")) & ((F.col("l_lo") != F.col("q_label")) | (F.col("l_hi") != F.col("q_label")))


def _with_sets(rows: DataFrame, texts: DataFrame, reps: DataFrame, k: int) -> DataFrame:
    """The gated rows with the whole token sets of their classes."""
    keys = shared_table(rows.select("doc").distinct().join(reps.select("doc", "r", "f1"), "doc"), "keys")
    sets = shared_table(shingle_sets(texts, bitmap_of(keys, "r"), k), "sets")
    return rows.join(keys, "doc").join(sets, ["r", "f1"])


def _similar_links(texts: DataFrame, reps: DataFrame, k: int, percent: int) -> DataFrame:
    """Links (``a, b``) that connect all similar classes; reps has ``doc, r, n, f1, least, prefix, sig``."""
    shared, groups = grouped(reps)
    sigs = reps.select("doc", "n", "sig")

    led = groups.where("subs > 1").select("g", "subs", "leader").distinct().select("g", F.explode(F.sequence(F.lit(0), F.col("subs") - 1)).alias("sub"), F.col("leader").alias("doc"))
    rows = groups.select("g", "sub", "doc").unionByName(led).distinct()
    rows = shared_table(_inner_candidates(rows.join(sigs, "doc"), percent), "gated")
    inner = shared_table(_inner_links(_with_sets(rows, texts, reps, k), percent), "inner")

    labels = inner.groupBy(F.col("a").alias("doc")).agg(F.min("b").alias("label"))
    groups = shared_table(groups.join(labels, "doc", "left").select("g", "sub", "subs", "doc", "n", F.coalesce("label", "doc").alias("label")), "groups")

    asked = opened(shared, groups, percent)
    subs = groups.groupBy("g", "sub").agg(F.min("n").alias("n_lo"), F.max("n").alias("n_hi"), F.min("label").alias("l_lo"), F.max("label").alias("l_hi"))
    asked = shared_table(asked.join(subs, "g").where(may_open(percent) & ~((F.col("g") == F.col("q_g")) & (F.col("sub") == F.col("q_sub")))).select("g", "sub", "q", "q_n", "q_label"), "asked")

    parts = asked.groupBy("g", "sub").agg(F.greatest(F.ceil(F.count(F.lit(1)) / GROUP_DOCS), F.ceil(F.sum("q_n") / GROUP_TOKENS)).cast("int").alias("parts"))
    queries = asked.join(parts, ["g", "sub"]).select("g", "sub", F.pmod(F.xxhash64("q"), "parts").cast("int").alias("part"), F.lit(True).alias("query"), F.col("q").alias("doc"), F.col("q_label").alias("label"))
    members = groups.join(parts, ["g", "sub"]).select("g", "sub", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(False).alias("query"), "doc", "label")
    rows = shared_table(_outer_candidates(queries.unionByName(members).join(sigs, "doc"), percent), "gated")
    return inner.unionByName(_outer_links(_with_sets(rows, texts, reps, k), percent))


def row_key(doc: Column, text: Column) -> Column:
    """A key of a row by its id and text."""
    return F.xxhash64(doc.cast("long"), text)


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80, with_keys: bool = False) -> DataFrame:
    """Per row: ``doc_id, n_shingles, component_id``, where rows link if their shingle sets' Jaccard similarity is
    ``percent`` or more (in integers: 100 * intersection >= percent * union).

    Words are runs without ASCII white space, with A-Z lower-cased, of whole texts of any length.  Fewer words than a
    shingle are one shingle; null texts and texts without words have none, link with nothing and are their own component.
    Repeated rows get equal results.  Rows that share an id with different texts are told apart: each has the smallest id
    that its own text reaches.  Rows without an id take no part and have a null component.  An empty table gives an empty
    result; other columns are not read.

    ``with_keys`` adds ``row_key``, the row's ``row_key(id, text)``, and ``leader_key``, that of the one row that stands for its
    component: the row with the smallest id, and of several texts under it the one with the smallest key.
    """
    small_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    texts = texts.withColumn("r", row_key(F.col("doc"), F.col("text")))
    levels = token_levels(texts.select("text"), words)
    every = shared_table(shingle_prefixes(texts, levels, words, percent), "prefixes")
    keys = ["f1", "f2", "n"]
    own = every.where("n > 0 AND doc IS NOT NULL")
    classes = own.groupBy(*keys).agg(F.min(F.struct("doc", "r")).alias("rep"), F.count(F.lit(1)).alias("rows"), F.first("least").alias("least"), F.first("prefix").alias("prefix"), F.first("sig").alias("sig"))  # equal sets have equal prefixes
    # numbered as they are written, so the numbers stand fast whatever is computed again later
    classes = shared_table(classes.select(F.monotonically_increasing_id().alias("doc"), *keys, F.col("rep.doc").alias("rep"), F.col("rep.r").alias("r"), "rows", "least", "prefix", "sig"), "classes")
    first = F.struct("rep", "r").alias("first")
    with scratch(docs.sparkSession) as keep:
        found = shared_table(components(_similar_links(texts, classes, words, percent)).join(classes.select(F.col("doc").alias("node"), first), "node"), "found")
        smallest = shared_table(found.groupBy("component").agg(F.min("first").alias("smallest"), F.count(F.lit(1)).alias("nodes")), "smallest")
        reached = join_classes(found, smallest, ["component"], "nodes").select(F.col("node").alias("doc"), "smallest")
        named = classes.select("doc", *keys, "rows", first).join(reached, "doc", "left").select(*keys, "rows", F.coalesce("smallest", "first").alias("leader"))
        named = keep(shared_table(named, "named"))
    linked = join_classes(own.select("doc", "r", *keys), named, keys, "rows").select("doc", "n", F.col("leader.rep").alias("component"), "r", F.col("leader.r").alias("leader"))
    alone = every.where("n = 0 OR doc IS NULL").select("doc", "n", F.col("doc").alias("component"), "r", F.col("r").alias("leader"))
    out = linked.unionByName(alone).select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), F.col("r").alias("row_key"), F.col("leader").alias("leader_key"))
    return out if with_keys else out.drop("row_key", "leader_key")
