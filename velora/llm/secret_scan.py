"""Secret scan: patterns find candidates, a random forest (Breiman 2001) removes the false ones.

Features are a candidate's length, its character transitions, how much of it words of a dictionary cover, whether it looks
like a path, and the words before and after it.  The dictionary is the corpus's own: its most frequent words, counted over
all documents.  The forest is trained from labelled findings: a table of them if one is given, else the candidates of
``train_rows`` documents outside a held-out fold, labelled by what a reviewer would go by (a published key format or a key
word before the value; or an address, a number, a date, a path), together with findings that are composed by rule from a
fixed seed for forms that the corpus lacks.  The model is a few thousand numbers; the scan is one pass over all whole texts.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from velora.llm.common import fold, shared_table, small_batches
from velora.llm.decontaminate import word_hashes

#: Long runs without white space or quotes, and values after a key word.
CANDIDATE = re.compile(r"[A-Za-z0-9_\-+/=.]{12,}")
KEYED = re.compile(r"(?:(?:password|passwd|passphrase|pwd|secret|token|key|auth|bearer|credential|private)(?:s|key|token|[_\-][a-z0-9_\-]{0,30})?[\"'`]?[ \t]{0,3}(?::=|=>|[:=](?!=))[ \t]{0,3}|bearer[ \t]{1,3})(?:([\"'`])|(?=[^\s\"'`]))", re.IGNORECASE)
UNQUOTED = re.compile(r"[^\s\"'`<>]*")
NEXT_NAME = re.compile(r"[&;,][A-Za-z0-9_\-]*$")
KEY_WORDS = ("password", "passwd", "pwd", "secret", "token", "key", "apikey", "auth", "bearer", "credential", "private")
BENIGN_WORDS = ("commit", "version", "sha", "md5", "checksum", "uuid", "id", "isbn", "phone", "date", "url", "path", "file", "example")
FORMATS = re.compile(r"AKIA[0-9A-Z]{16}$|gh[pousr]_[A-Za-z0-9]{20,}$|sk-[A-Za-z0-9]{20,}$|[prs]k_(?:live|test)_[A-Za-z0-9]{16,}$|xox[abp]-[A-Za-z0-9-]{10,}$|AIza[A-Za-z0-9_\-]{30,}$|eyJ[A-Za-z0-9_\-]{8,}\.")
UUID = re.compile(r"[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$", re.IGNORECASE)
WORDISH = re.compile(r"[A-Za-z]{4,}")
#: Words inside a value, also in camel case.
PARTS = re.compile(r"[A-Z]?[a-z]{2,}|[A-Z]{3,}")
PLAIN = re.compile(r"\d{1,3}(?:\.\d{1,3}){3}$|[\d\-+./:T ]+$|[A-Za-z\-]+$|\S+@\S+\.\w+$|[\w\-]+(?:/[\w.\-]+)+$")
FEATURES = ("length", "entropy", "transitions", "digits", "upper", "symbols", "word_cover", "longest_digits", "path", "uuid", "hex", "format", "assigned", "key_before", "benign_before", "quoted", "words_before", "words_after")


def candidates(text: str) -> Iterator[tuple[int, int]]:
    """Spans of strings that could be a secret, in text order: a digit is in them, or a known form, or a key word stands before.

    A value after a key word (``password: x``, ``secret="x"``, ``bearer x``) may have any length and any characters: up
    to the closing quote on its line, or else up to white space, without marks of a sentence at its end.
    """
    keyed, signs = [], list(KEYED.finditer(text))
    run = line = (0, -1)  # where the last search for a run's or a line's end began and what it found: signs before that end need no other
    for m, following in zip(signs, [*signs[1:], None], strict=False):
        s, quote = m.end(), m.group(1)
        if keyed and s < keyed[-1][1]:
            continue
        e = -1
        if quote:
            if not line[0] <= s <= line[1]:
                line = s, (text.find("\n", s) + 1 or len(text) + 1) - 1
            e = text.find(quote, s, line[1])
        if e < 0:
            if not run[0] <= s <= run[1]:
                run = s, UNQUOTED.match(text, s).end()
            e = run[1]
            if following and following.start() < e and (other := NEXT_NAME.search(text, s, following.start())):
                e = other.start()  # a=b&key=c
            while e > s and text[e - 1] in ".,;:)]}&":
                e -= 1
        if e > s:
            keyed.append((s, e))
    ends = iter([*keyed, (len(text) + 1, len(text) + 1)])
    now = next(ends)
    for s, e in _runs(text):
        while now[1] <= s:
            yield now
            now = next(ends)
        if e <= now[0]:
            yield s, e
    while now[0] <= len(text):
        yield now
        now = next(ends)


def _runs(text: str) -> Iterator[tuple[int, int]]:
    """Long runs with a digit or of a known form."""
    for m in CANDIDATE.finditer(text):
        s, e = m.span()
        cut = text.find("=", s, e)  # name=value; signs at the end of a value are its padding
        if s < cut and text[cut:e].strip("=") and WORDISH.match(text, s):
            s = cut + 1
        while e > s and text[e - 1] in ".-":
            e -= 1
        value = text[s:e]
        if e - s >= 8 and (any(c.isdigit() for c in value) or FORMATS.match(value)):
            yield s, e


def _kind(c: str) -> int:
    return 0 if c.isdigit() else 1 if c.islower() else 2 if c.isupper() else 3


def _shape(value: str, chunk: int = 1 << 18) -> tuple[float, int, list[int]]:
    """Entropy, number of places where the kind of character changes, and characters by kind; in chunks, so that a value of
    any length takes little memory."""
    counts: dict[int, int] = {}
    kinds, changes, last = [0] * 4, 0, None
    for at in range(0, len(value), chunk):
        codes, place, n = np.unique(np.frombuffer(value[at : at + chunk].encode("utf-32-le", "surrogatepass"), np.uint32), return_inverse=True, return_counts=True)
        kind = np.array([_kind(chr(c)) for c in codes])
        each = kind[place]
        changes += int(np.count_nonzero(each[1:] != each[:-1])) + (last is not None and last != each[0])
        last = each[-1]
        for c, k, m in zip(codes.tolist(), kind.tolist(), n.tolist(), strict=True):
            counts[c] = counts.get(c, 0) + m
            kinds[k] += m
    size = len(value)
    return -sum(k / size * math.log2(k / size) for _, k in sorted(counts.items())), changes, kinds


class Dictionary:
    """Words by their 64-bit hashes, in order."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.sort(hashes)

    def shares(self, texts: list[list[str]], sizes: list[int]) -> np.ndarray:
        """The letters of each list's known words against its size."""
        out = np.zeros(len(texts))
        words = [w for t in texts for w in t]
        if not words or not len(self.hashes):
            return out
        h, counts = word_hashes(words)  # a word of letters is one word
        owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        letters = np.array([len(w) for w in words])
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        known = np.zeros(len(words), bool)
        known[np.repeat(np.arange(len(words)), counts)] = self.hashes[at] == h
        return np.bincount(owner, weights=letters * known, minlength=len(texts)) / np.maximum(sizes, 1)


def corpus_words(docs: DataFrame, text_col: str = "text", words: int = 50_000, often: int = 20) -> Dictionary:
    """The most frequent words of all texts, ``words`` at most, that occur ``often`` times or more: a secret is no word."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            part, size = [], 0

            def flush(part: list) -> pa.RecordBatch:
                h, n = np.unique(word_hashes(part)[0], return_counts=True)
                return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], names=["h", "n"])

            for t in b.column(0):
                part.append(t.as_py())
                size += len(part[-1] or "")
                if size > 1_000_000:
                    yield flush(part)
                    part, size = [], 0
            if part:
                yield flush(part)

    counts = docs.select(text_col).mapInArrow(counted, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    counts = shared_table(counts.where(F.col("n") >= often), "words")
    step = F.floor(F.log2("n") * 16)
    floor, taken = None, 0
    for at, k in sorted(((r.step, r.k) for r in counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("k")).collect()), reverse=True):
        taken += k
        if taken > words:
            break
        floor = at
    if floor is None:
        return Dictionary(np.empty(0, np.uint64))
    return Dictionary(counts.where(step >= floor).select("h").toArrow().column("h").to_numpy().view(np.uint64))


def features(findings: list[tuple[str, int, int]], dictionary: Dictionary) -> np.ndarray:
    """A row of ``FEATURES`` for each (text, start, end)."""
    rows, inside, before, after = [], [], [], []
    for text, start, end in findings:
        value, lead, rest = text[start:end], text[max(0, start - 40) : start], text[end : end + 40]
        n = len(value)
        entropy, changes, kinds = _shape(value)
        words = re.findall(r"[a-z0-9]+", lead.lower())[-3:]
        inside.append(PARTS.findall(value))
        before.append(re.findall(r"[A-Za-z]{2,}", lead)[-3:])
        after.append(re.findall(r"[A-Za-z]{2,}", rest)[:3])
        rows.append([
            n,
            entropy,
            changes / max(1, n - 1),
            kinds[0] / n,
            kinds[2] / n,
            kinds[3] / n,
            0.0,
            max((len(x) for x in re.findall(r"\d+", value)), default=0) / n,
            float("/" in value[:-1] or value.count(".") >= 2),
            float(bool(UUID.match(value))),
            float(bool(re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", value))),
            float(bool(FORMATS.match(value))),
            float(bool(re.search(r"[=:]\s*[\"']?$", lead))),
            float(any(w.endswith(k) for w in words for k in KEY_WORDS)),
            float(any(w in BENIGN_WORDS for w in words)),
            float(rest[:1] in "\"'`" and bool(rest)),
            0.0,
            0.0,
        ])
    x = np.array(rows, float).reshape(-1, len(FEATURES))
    if len(x):
        for name, words, sizes in (("word_cover", inside, [e - s for _, s, e in findings]), ("words_before", before, [sum(map(len, w)) for w in before]), ("words_after", after, [sum(map(len, w)) for w in after])):
            x[:, FEATURES.index(name)] = dictionary.shares(words, sizes)
    return x


def reviewed(text: str, start: int, end: int) -> int | None:
    """What a reviewer would call a candidate by its form and the sign before it: 1 a secret, 0 none, None undecided."""
    value, lead = text[start:end], text[max(0, start - 40) : start].lower()
    if FORMATS.match(value):
        return 1
    keyed = re.search(r"(?:^|[^a-z])(?:[a-z_\-]*(?:" + "|".join(KEY_WORDS) + r"))[\"']?\s{0,3}[:=]\s{0,3}[\"'`]?$", lead)
    if keyed and len(value) >= 8 and any(c.isdigit() for c in value):
        return 1
    if not keyed and (PLAIN.match(value) or UUID.match(value) or any(w in BENIGN_WORDS for w in re.findall(r"[a-z0-9]+", lead)[-2:])):
        return 0
    return 0 if keyed and len(value) <= 3 else None


def corpus_findings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, held_fold: int = 0, train_rows: int = 20_000, around: int = 60, longest: int = 1000) -> list[tuple[str, int, int, int]]:
    """Labelled candidates (text around it, start, end, label) of the ``train_rows`` documents outside the held-out fold with
    the smallest hash of id and text (a documented bound); values of more than ``longest`` characters teach nothing.

    Equal findings count once, under the smallest of their documents' hashes, so that training repeats."""
    key = F.xxhash64(F.col(id_col).cast("long"), F.col(text_col))
    rows = docs.where(F.col(text_col).isNotNull() & (fold(F.col(id_col), folds) != held_fold)).select(key.alias("key"), F.col(text_col).alias("text"))
    picked = rows.select("key").distinct().orderBy("key").limit(train_rows)  # a bounded side

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: dict[str, list] = {"key": [], "text": [], "start": [], "end": [], "label": []}
            for key, t in zip(b.column("key").to_pylist(), b.column("text").to_pylist(), strict=True):
                for s, e in candidates(t):
                    label = reviewed(t, s, e)
                    if label is not None and e - s <= longest:
                        at = max(0, s - around)
                        for k, v in zip(out, (key, t[at : e + around], s - at, e - at, label), strict=True):
                            out[k].append(v)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("key", pa.int64()), ("text", pa.string()), *((k, pa.int64()) for k in ("start", "end", "label"))]))

    got = rows.join(F.broadcast(picked), "key").mapInArrow(found, "key long, text string, start long, end long, label long")
    got = got.groupBy("text", "start", "end").agg(F.min("key").alias("key"), F.min("label").alias("label")).withColumn("n", F.row_number().over(Window.partitionBy("label").orderBy("key", "text", "start"))).where(F.col("n") <= train_rows).toArrow().sort_by([("key", "ascending"), ("start", "ascending"), ("text", "ascending")])
    return list(zip(*(got.column(c).to_pylist() for c in ("text", "start", "end", "label")), strict=True))


def composed_findings(rows: int = 3_000, seed: int = 5) -> list[tuple[str, int, int, int]]:
    """Labelled findings (text, start, end, 1 for a secret) by rule: keys, tokens and passwords against ids, numbers and paths."""
    rng = np.random.default_rng(seed)
    pick = lambda letters, n: "".join(rng.choice(list(letters), n))
    low, up, digits, hexes = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "0123456789abcdef"
    prose = lambda n: " ".join(pick(low, int(rng.integers(2, 9))) for _ in range(n))
    secrets = (
        lambda: ("", "AKIA" + pick(up + digits, 16)),
        lambda: ("password=", pick(hexes, int(rng.integers(12, 33)))),
        lambda: ('token = "', pick(hexes, 40)),
        lambda: ("api_key: ", pick(low + up + digits, int(rng.integers(20, 45)))),
        lambda: ("secret=", pick(low + up + digits + "+/", int(rng.integers(24, 48)))),
        lambda: ("", "ghp_" + pick(low + up + digits, 36)),
        lambda: (("password: ", "pwd=", 'secret: "')[int(rng.integers(3))], pick(low, int(rng.integers(4, 9))) + pick(digits, int(rng.integers(2, 5)))),
        lambda: (("secret=", "password: ")[int(rng.integers(2))], "".join(pick(low, int(rng.integers(4, 9))).capitalize() for _ in range(3))),
        lambda: (("password=", "passwd: ")[int(rng.integers(2))], pick(low + up + digits, int(rng.integers(4, 10))) + pick("@!#$%", 2) + pick(low + digits, int(rng.integers(2, 6)))),
        lambda: ("secret=", pick(low + up + digits + "+/", int(rng.integers(16, 40))) + "=="),
        lambda: (("password=", "secret: ")[int(rng.integers(2))], pick(low, int(rng.integers(16, 32)))),
        lambda: ("", ("sk_live_", "rk_test_")[int(rng.integers(2))] + pick((low, low + up + digits)[int(rng.integers(2))], 24)),
        lambda: ("bearer ", "eyJ" + pick(low + up + digits, 20) + "." + pick(low + up + digits, 30)),
    )
    others = (
        lambda: ("id ", str(uuid.UUID(bytes=rng.bytes(16)))),
        lambda: ("", f"{rng.integers(1990, 2030)}-{rng.integers(10, 13)}-{rng.integers(10, 29)}T{rng.integers(10, 24)}"),
        lambda: ("", pick(digits, int(rng.integers(12, 20)))),
        lambda: ("file ", "/".join(pick(low, int(rng.integers(3, 8))) for _ in range(4)) + "/v" + pick(digits, 2)),
        lambda: ("", "-".join(pick(low, int(rng.integers(4, 8))) for _ in range(3)) + pick(digits, 1)),
        lambda: ("commit ", pick(hexes, 40)),
        lambda: ("version ", f"{rng.integers(10, 99)}.{rng.integers(10, 99)}.{rng.integers(1000, 9999)}-{pick(low, 4)}"),
        lambda: ("", "+" + pick(digits, 3) + "-" + pick(digits, 3) + "-" + pick(digits, 5)),
        lambda: ("", f"{pick(low, 6)}.{pick(digits, 2)}.mail{pick(digits, 1)}.example.com"),
        lambda: (("key: ", "token: ", "password: ", "secret = ")[int(rng.integers(4))], pick(low, int(rng.integers(1, 11)))),
        lambda: (("key: ", "token=")[int(rng.integers(2))], pick(low, int(rng.integers(3, 9))).capitalize()),
        lambda: ("password=", "example-" + pick(low, 4) + "-1234"),
    )
    out = []
    for i in range(rows):
        kinds, label = (secrets, 1) if i % 2 else (others, 0)
        lead, value = kinds[int(rng.integers(len(kinds)))]()
        head = prose(4) + " " + lead
        out.append((f"{head}{value} {prose(3)}", len(head), len(head) + len(value), label))
    return out


class Forest:
    """Trees as arrays (feature, threshold, left, right, share of secrets), grown on bootstrap rows."""

    def __init__(self, x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 9, leaf: int = 4, seed: int = 3):
        rng, self.trees = np.random.default_rng(seed), []
        take = max(2, int(math.sqrt(x.shape[1])) + 1)
        for _ in range(trees if len(y) else 0):
            rows = rng.integers(0, len(y), len(y))
            nodes: list[list[float]] = []

            def grow(idx: np.ndarray, level: int, nodes: list = nodes) -> int:
                at, share = len(nodes), float(y[idx].mean())
                nodes.append([-1, 0.0, 0, 0, share])
                if level == depth or len(idx) < 2 * leaf or share in (0.0, 1.0):
                    return at
                best = (share * (1 - share) * len(idx) - 1e-9, -1, 0.0)
                for f in rng.choice(x.shape[1], take, replace=False):
                    v = x[idx, f]
                    for t in np.unique(np.quantile(v, np.linspace(0.05, 0.95, 13))):
                        go = v <= t
                        n = int(go.sum())
                        if leaf <= n <= len(idx) - leaf:
                            a, b = y[idx[go]].mean(), y[idx[~go]].mean()
                            cost = a * (1 - a) * n + b * (1 - b) * (len(idx) - n)
                            if cost < best[0]:
                                best = (cost, int(f), float(t))
                if best[1] >= 0:
                    go = x[idx, best[1]] <= best[2]
                    nodes[at][:2] = best[1:]
                    nodes[at][2] = grow(idx[go], level + 1)
                    nodes[at][3] = grow(idx[~go], level + 1)
                return at

            grow(rows, 0)
            self.trees.append(np.array(nodes))

    def predict(self, x: np.ndarray) -> np.ndarray:
        """The share of votes for a secret, a number for each row."""
        out = np.zeros(len(x))
        for t in self.trees:
            at = np.zeros(len(x), np.int64)
            while (inner := t[at, 0] >= 0).any():
                i = at[inner]
                go = x[inner, t[i, 0].astype(np.int64)] <= t[i, 1]
                at[inner] = np.where(go, t[i, 2], t[i, 3]).astype(np.int64)
            out += t[at, 4]
        return out / max(1, len(self.trees))


def train_forest(findings: list[tuple[str, int, int, int]], dictionary: Dictionary) -> Forest:
    return Forest(features([f[:3] for f in findings], dictionary), np.array([f[3] for f in findings], float))


def find_secrets(docs: DataFrame, forest: Forest | None = None, dictionary: Dictionary | None = None, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5, **training) -> DataFrame:
    """Per row: ``doc_id, n_candidates, findings`` with the findings' ``start, end, score`` in characters, in text order.

    Whole texts of any length are scanned.  Null and empty texts have no candidates.  Repeated rows get equal findings, a
    null id is carried through, and a vote of just ``threshold`` counts.  An empty table gives an empty result; other
    columns are not read.
    """
    small_batches(docs.sparkSession)
    dictionary = dictionary or corpus_words(docs, text_col)
    forest = forest or train_forest(corpus_findings(docs, id_col, text_col, **training) + composed_findings(), dictionary)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
    sent = docs.sparkSession.sparkContext.broadcast((forest, dictionary))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, dictionary = sent.value
        for b in batches:
            counts, found = [], []
            for t in b.column("text"):
                text = t.as_py() or ""
                spans = list(candidates(text))
                counts.append(len(spans))
                scores = forest.predict(features([(text, s, e) for s, e in spans], dictionary)) if spans else ()
                found.append([{"start": s, "end": e, "score": float(p)} for (s, e), p in zip(spans, scores, strict=True) if p >= threshold])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(counts, pa.int64()), pa.array(found, kind)], names=["doc_id", "n_candidates", "findings"])

    inputs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return inputs.mapInArrow(scan, "doc_id long, n_candidates long, findings array<struct<start:long,end:long,score:double>>")


def secret_scan(docs: DataFrame, **options) -> DataFrame:
    """Per row: ``doc_id, n_candidates, n_secrets, first_start, score``: the findings of ``find_secrets`` in figures."""
    found = find_secrets(docs, **options)
    return found.select("doc_id", "n_candidates", F.size("findings").cast("long").alias("n_secrets"), F.get("findings", F.lit(0))["start"].alias("first_start"), F.coalesce(F.array_max(F.col("findings.score")), F.lit(0.0)).alias("score"))
