"""DuckDB SQL for the text queries that SQL can express over whole tables."""

from __future__ import annotations

from velora.llm.common import LOWER, UPPER
from velora.llm.license_scan import BASE_PHRASES, TEMPLATES, K

SPACE = r"[\x20\x09-\x0D]+"


def _words(text: str, pattern: str = SPACE) -> str:
    return f"list_filter(string_split_regex({text}, '{pattern}'), lambda x: x <> '')"


_LOW = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"

JACCARD = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_words(_LOW)} AS t FROM documents),
s AS (SELECT doc_id, CASE WHEN len(t) = 0 THEN [] WHEN len(t) < 3 THEN [array_to_string(t, ' ')]
      ELSE list_distinct(list_transform(range(1, len(t) - 1), lambda i: t[i] || ' ' || t[i + 1] || ' ' || t[i + 2])) END AS g FROM w),
x AS (SELECT doc_id, len(g) AS n, hash(unnest(g)) AS k FROM s),
e AS (SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.k = b.k AND a.doc_id <> b.doc_id AND 100 * a.n >= 90 * b.n AND 100 * b.n >= 90 * a.n
      GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
r AS (SELECT doc_id AS d, doc_id AS c FROM documents UNION SELECT r.d, e.b FROM r JOIN e ON e.a = r.c)
SELECT doc_id, CAST(len(g) AS BIGINT) AS n_shingles, component_id FROM s JOIN (SELECT d AS doc_id, min(c) AS component_id FROM r GROUP BY d) USING (doc_id)
"""

EXACT = rf"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '{SPACE}', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM n
"""

SUBSTRINGS = f"""
WITH w AS (SELECT doc_id, {_words("coalesce(text, '')")} AS t FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(t[i:i + 34], ' ')) AS h FROM (SELECT doc_id, t, unnest(range(1, len(t) - 33)) AS i FROM w)),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS j FROM win WHERE h IN (SELECT h FROM win GROUP BY h HAVING count(*) > 1)),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY j) AS k FROM (SELECT doc_id, unnest(t) AS x, generate_subscripts(t, 1) AS j FROM w) v ANTI JOIN gone USING (doc_id, j) GROUP BY doc_id)
SELECT doc_id, CAST(len(t) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id) LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id) USING (doc_id)
"""

#: crc32 of an ASCII text: each byte goes into the register, which is then shifted by eight bits.
_CRC = """xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, x: xor(CAST(xor(a, greatest(x, 0)) AS BIGINT) >> 1, 3988292384 * (xor(a, greatest(x, 0)) & 1))), 4294967295)"""

UNIGRAMS = f"""
WITH w AS (SELECT doc_id, {_CRC} % 7 = 2 AS held_out, list_concat({_words(_LOW)}, [' ']) AS t FROM documents),
x AS (SELECT doc_id, held_out, unnest(t) AS k FROM w),
c AS (SELECT k, count(*) AS n FROM x WHERE NOT held_out GROUP BY k),
z AS (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS total, count(*) AS v FROM c)
SELECT doc_id, held_out, count(*) AS n_tokens, count(n) AS n_known, total AS train_tokens, round(sum(log10((coalesce(n, 0) + 1.0) / (total + v + 1))), 5) AS base_score
FROM x LEFT JOIN c USING (k), z GROUP BY doc_id, held_out, total
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_LICENSE_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_ROWS = ",\n".join(f"({n}, {_quoted(text)}, '{label}', {str(n < len(BASE_PHRASES)).lower()})" for n, (text, label) in enumerate([*BASE_PHRASES.items(), *TEMPLATES.items()]))

LICENSES = f"""
WITH d AS (SELECT doc_id, {_words(_LOW, _LICENSE_WORDS)} AS w FROM documents),
tw AS (SELECT template, label, base, {_words(_LOW, _LICENSE_WORDS)} AS t FROM (VALUES {_ROWS}) AS v(template, text, label, base)),
tg AS (SELECT template, label, base, len(t) - {K - 1} AS grams, i - 1 AS p, t[i] AS a, t[i + 1] AS b, t[i + 2] AS c FROM (SELECT *, unnest(range(1, len(t) - 1)) AS i FROM tw)),
dg AS (SELECT doc_id, i - 1 AS pos, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM (SELECT *, unnest(range(1, len(w) - 1)) AS i FROM d)),
lines AS (SELECT doc_id, template, label, base, grams, pos - p AS diagonal, list(DISTINCT p) AS ats FROM dg JOIN tg USING (a, b, c) GROUP BY ALL),
spans AS (SELECT *, sum(apart) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS span FROM
    (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY doc_id, template ORDER BY diagonal) <= 2 THEN 0 ELSE 1 END AS apart FROM lines)),
merged AS (SELECT doc_id, template, label, base, grams + {K - 1} AS size, count(*) FILTER (base AND len(ats) = grams) AS places, min(diagonal) FILTER (base AND len(ats) = grams) AS f, max(diagonal) FILTER (base AND len(ats) = grams) AS l,
    max(diagonal + list_max(ats)) + {K} - min(diagonal + list_min(ats)) AS span_size, len(list_distinct(flatten(list_transform(flatten(list(ats)), lambda t: [t, t + 1, t + 2])))) AS covered FROM spans GROUP BY doc_id, template, label, base, grams, span),
found AS (SELECT *, CASE WHEN base THEN CASE WHEN places > 0 THEN 1.0 END WHEN covered >= 0.7 * size AND covered >= 0.7 * least(span_size, size) THEN covered / size END AS score FROM merged),
r AS (SELECT doc_id, sum(places) AS n_base, min(f) AS first_word, max(l) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score FROM found WHERE score IS NOT NULL GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
    coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CAST(coalesce(score, 0.0) AS DOUBLE) AS score FROM d LEFT JOIN r USING (doc_id)
"""


def _centroids(k: int = 16, rounds: int = 3, dims: int = 64) -> str:
    first = "row_number() OVER (ORDER BY sha256('1:' || CAST(vec_id AS VARCHAR)), v)"
    steps = [
        f"""kept AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({dims} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims})""",
        f"c0 AS (SELECT CAST({first} - 1 AS INTEGER) AS cluster, v AS c FROM kept QUALIFY {first} <= {k})",
    ]
    for r in range(rounds + 1):
        steps.append(
            f"""a{r} AS (SELECT vec_id, v, cluster, CAST(d AS BIGINT) AS distance FROM (SELECT vec_id, v, cluster, list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d FROM kept, c{r})
QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, cluster) = 1)"""
        )
        if r < rounds:
            steps.append(
                f"""m{r} AS (SELECT cluster, list(CAST(floor(total / n) AS BIGINT) ORDER BY i) AS c FROM (SELECT cluster, i, sum(x) AS total, count(*) AS n FROM (SELECT cluster, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{r}) GROUP BY cluster, i) GROUP BY cluster),
c{r + 1} AS (SELECT cluster, coalesce(m{r}.c, c{r}.c) AS c FROM c{r} LEFT JOIN m{r} USING (cluster))"""
            )
    return f"""
WITH {(", " + chr(10)).join(steps)}
SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} USING (cluster)
"""


CENTROIDS = _centroids()

FILL_IN_MIDDLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || CAST(doc_id AS VARCHAR)) AS h FROM documents),
u AS (SELECT doc_id, t, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS u, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2, CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d),
r AS (SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
      CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS pre, coalesce(array_to_string(u[a + 1:b], ''), '') AS mid, coalesce(array_to_string(u[b + 1:n], ''), '') AS suf FROM r)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256
FROM p
"""

LINES = f"""
WITH l AS (SELECT doc_id, unnest(s) AS line, generate_subscripts(s, 1) AS pos FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents)),
k AS (SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key FROM l),
c AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
j AS (SELECT k.*, c.last IS NOT NULL AND c.last <> k.doc_id AS gone FROM k LEFT JOIN c USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""
