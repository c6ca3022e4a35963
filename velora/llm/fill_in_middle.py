"""Fill-in-the-middle transformation by overlapping chunks.

A text is a sequence of units (lines).  Its bytes are cut into chunks of one size, each read with the byte before it: a
unit starts where that neighbour is a line feed, so every chunk counts its own starts without its neighbours' results,
and so it counts its code points.  Running sums over a text's chunks say which chunk owns the start of any unit; each of
the two cut ranks goes to its owning chunk, and only those chunks are scanned again.  Texts stay in their rows: nothing
is shuffled, and the parts are put together by built-in functions.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velora.llm.common import small_batches

#: The signs before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
CUTS = "struct<n:bigint,at1:bigint,at2:bigint,chars1:bigint,chars2:bigint>"


def _starts(raw: np.ndarray, s: int, e: int, begin: int) -> np.ndarray:
    """Whether a unit starts at each byte of the chunk [s, e) of the text that begins at ``begin``."""
    before = raw[max(s - 1, begin) : e - 1] == 10
    return np.concatenate([[True], before]) if s == begin else before


def _letters(raw: np.ndarray) -> int:
    """Code points that begin in these bytes."""
    return int(np.count_nonzero((raw & 0xC0) != 0x80))


def chunk_cuts(raw: np.ndarray, offsets: np.ndarray, first: np.ndarray, second: np.ndarray, chunk: int) -> dict[str, np.ndarray]:
    """Of the texts between ``offsets``: the number of units, and bytes and code points before two units.

    The cuts stand before unit ``first % (n + 1)`` and ``second % (n + 1)``, the smaller one first; unit n is the end.
    """
    sizes = np.diff(offsets)
    count = -(-sizes // chunk)
    last = np.cumsum(count)
    owner = np.repeat(np.arange(len(sizes)), count)
    s = offsets[owner] + (np.arange(len(owner)) - (last - count)[owner]) * chunk
    e = np.minimum(s + chunk, offsets[owner + 1])
    spans = list(zip(s.tolist(), e.tolist(), offsets[owner].tolist(), strict=True))
    units = np.concatenate([[0], np.cumsum([np.count_nonzero(_starts(raw, *span)) for span in spans], dtype=np.int64)])
    chars = np.concatenate([[0], np.cumsum([_letters(raw[a:b]) for a, b, _ in spans], dtype=np.int64)])
    low, high = last - count, last  # the text's chunks
    n = units[high] - units[low]
    ranks = np.sort(np.stack([first % (n + 1), second % (n + 1)]), axis=0)
    out = {"n": n}
    for k, rank in enumerate(ranks, 1):
        at, before = sizes.astype(np.int64), chars[high] - chars[low]
        inside = np.flatnonzero(rank < n)
        own = np.searchsorted(units, units[low[inside]] + rank[inside], "right") - 1
        for i, c in zip(inside.tolist(), own.tolist(), strict=True):
            a, b, begin = spans[c]
            place = a + int(np.flatnonzero(_starts(raw, a, b, begin))[units[low[i]] + rank[i] - units[c]])
            at[i], before[i] = place - begin, chars[c] - chars[low[i]] + _letters(raw[a:place])
        out |= {f"at{k}": at, f"chars{k}": before}
    return out


def _cuts(chunk: int):
    @F.arrow_udf(CUTS)
    def cuts(text: pa.Array, first: pa.Array, second: pa.Array) -> pa.Array:
        offsets = np.frombuffer(text.buffers()[1], np.int32)[text.offset : text.offset + len(text) + 1].astype(np.int64)
        data = text.buffers()[2]
        raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
        found = chunk_cuts(raw, offsets, first.to_numpy(zero_copy_only=False), second.to_numpy(zero_copy_only=False), chunk)
        return pa.StructArray.from_arrays([pa.array(found[c]) for c in ("n", "at1", "at2", "chars1", "chars2")], ["n", "at1", "at2", "chars1", "chars2"])

    return cuts


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 7, percent: int = 100, spm_percent: int = 50, chunk: int = 1 << 16) -> DataFrame:
    """Per row: ``doc_id, n, form, prefix_chars, middle_chars, output``.

    Cuts and form follow the hash of seed and id alone, so rows that repeat an id are cut by the same numbers, and a null
    id counts as the empty text.  A null or empty text, and one that holds a sign, is plain: its output is the text and
    its counts are null.  Texts of any length are cut whole.  An empty table gives an empty result; other columns of
    ``docs`` are not read.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    number = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]
    cut = rows.select("doc_id", "text", *number).select("*", _cuts(chunk)("text", "h1", "h2").alias("c"))
    signed = F.lit(False)
    for sign in (PREFIX, SUFFIX, MIDDLE):
        signed = signed | F.contains("text", F.lit(sign))
    plain = (F.col("text") == "") | signed | (F.col("h3") % 100 >= percent)
    form = F.when(plain, "plain").when(F.col("h4") % 100 < spm_percent, "spm").otherwise("psm")
    raw = F.col("text").cast("binary")
    part = lambda start, size: F.substring(raw, (start + 1).cast("int"), size.cast("int")).cast("string")
    at1, at2 = F.col("c.at1"), F.col("c.at2")
    prefix, middle, suffix = part(F.lit(0), at1), part(at1, at2 - at1), part(at2, F.octet_length("text") - at2)
    p, s, m = (F.lit(x) for x in (PREFIX, SUFFIX, MIDDLE))
    output = F.when(F.col("form") == "plain", F.col("text")).when(F.col("form") == "psm", F.concat(p, prefix, s, suffix, m, middle)).otherwise(F.concat(s, suffix, p, prefix, m, middle))
    whole = cut.select("*", form.alias("form"))
    count = lambda c: F.when(F.col("form") != "plain", c)
    return whole.select("doc_id", F.col("c.n").alias("n"), "form", count(F.col("c.chars1")).alias("prefix_chars"), count(F.col("c.chars2") - F.col("c.chars1")).alias("middle_chars"), output.alias("output"))


def restored(output: Column, form: Column) -> Column:
    """The exact text, from an output and its form alone."""
    n, m = len(PREFIX), F.substring_index(output, MIDDLE, -1)
    head = F.substring_index(output, MIDDLE, 1)
    psm = F.concat(F.substring(F.substring_index(head, SUFFIX, 1), n + 1, 2**31 - 1), m, F.substring_index(head, SUFFIX, -1))
    spm = F.concat(F.substring_index(head, PREFIX, -1), m, F.substring(F.substring_index(head, PREFIX, 1), n + 1, 2**31 - 1))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)
