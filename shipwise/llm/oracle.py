"""DuckDB statements for the llm queries that SQL can express."""

from __future__ import annotations

from .quality_rules import REPEAT_WINDOW, STOP_WORDS, SYMBOLS, THRESHOLDS
from .vector_codes import ENTRIES, PARTS, ROUNDS, SCALE


def _verdict() -> str:
    parts = []
    for r in THRESHOLDS:
        parts += [f"{r.metric} >= {r.low}"] if r.low is not None else []
        parts += [f"{r.metric} <= {r.high}"] if r.high is not None else []
    return " AND ".join(parts)


def _quality_rules() -> str:
    stop = ", ".join(f"'{w}'" for w in sorted({w for ws in STOP_WORDS.values() for w in ws.split()}))
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT r, doc_id, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM d
), win AS (
  SELECT r, i, array_to_string(ws[i:i + {REPEAT_WINDOW - 1}], ' ') AS k
  FROM (SELECT r, ws, unnest(range(1, len(ws) - {REPEAT_WINDOW - 2})) AS i FROM w)
), rep AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS c FROM win) WHERE c > 1
), cov AS (
  SELECT r, sum(least({REPEAT_WINDOW}, coalesce(nx - i, {REPEAT_WINDOW}))) AS n
  FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nx FROM rep) GROUP BY r
), m AS (
  SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(translate(t, '{SYMBOLS}', '')) AS BIGINT) AS n_symbols,
    CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words,
    len(ls) AS n_lines, len(list_filter(ws, lambda x: lower(rtrim(x, '.,;:!?')) IN ({stop}))) AS n_stop
  FROM w LEFT JOIN cov USING (r)
), x AS (
  SELECT *, word_chars / greatest(n_words, 1) AS mean_word_chars, n_symbols / greatest(n_words, 1) AS symbol_ratio,
    n_stop / greatest(n_words, 1) AS stop_ratio, n_dup_lines / greatest(n_lines, 1) AS dup_line_ratio,
    n_repeat_words / greatest(n_words, 1) AS repeat_ratio,
    n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND {_verdict()} AS kept
FROM x"""


# crc32 by its table of 256 entries, which the rule of the polynomial gives.
_SHARDING = """
WITH RECURSIVE tab(n, k, c) AS (
  SELECT n, 0, n FROM range(0, 256) AS g(n)
  UNION ALL
  SELECT n, k + 1, CASE WHEN c & 1 = 1 THEN xor(3988292384::BIGINT, c >> 1) ELSE c >> 1 END FROM tab WHERE k < 8
), lut AS (SELECT list(c ORDER BY n) AS l FROM tab WHERE k = 8),
d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) + 1 AS size FROM documents
), c AS (
  SELECT doc_id, CAST(size AS BIGINT) AS size,
    xor(4294967295::BIGINT, list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(range(0, size - 1), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)),
      lambda a, b: xor(a >> 8, l[xor(a & 255, b) + 1]))) AS text_crc32
  FROM d, lut
), p AS (
  SELECT *, sum(size) OVER (ORDER BY doc_id, text_crc32, size ROWS UNBOUNDED PRECEDING) - size AS before,
    sum(size) OVER () AS total, row_number() OVER (ORDER BY doc_id, text_crc32, size) AS rn
  FROM c
), s AS (
  SELECT *, CAST(least(7, (2 * before + size) * 8 // (2 * total)) AS INTEGER) AS shard FROM p
)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
  CAST(row_number() OVER (PARTITION BY shard ORDER BY rn) - 1 AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM s"""

_SUBSTRING = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents
), win AS (
  SELECT r, doc_id, i, array_to_string(ws[i:i + 12], ' ') AS k
  FROM (SELECT r, doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM d)
), gone AS (
  SELECT r, i FROM (SELECT r, doc_id, i, min(doc_id) OVER (PARTITION BY k) AS least FROM win) WHERE doc_id > least
), words AS (
  SELECT r, doc_id, p, ws[p] AS w FROM (SELECT r, doc_id, ws, unnest(range(1, len(ws) + 1)) AS p FROM d)
), cut AS (
  SELECT DISTINCT r, unnest(range(i, i + 13)) AS p FROM gone
), left_over AS (
  SELECT w.r, count(*) AS n, string_agg(w.w, ' ' ORDER BY w.p) AS t
  FROM words w LEFT JOIN cut c ON c.r = w.r AND c.p = w.p WHERE c.p IS NULL GROUP BY w.r
)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(l.n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(l.t, '')) AS kept_sha256
FROM d LEFT JOIN left_over l ON l.r = d.r"""

def _vector_codes() -> str:
    """Plain Lloyd rounds in integers, one pair of CTEs a round."""

    def nearest(k: int) -> str:
        return f"""a{k} AS MATERIALIZED (
  SELECT r, p, e, d FROM (
    SELECT x.r, x.p, c.e, CAST(sum((x.v - c.v) * (x.v - c.v)) AS BIGINT) AS d FROM x JOIN c{k} c USING (p, j) GROUP BY x.r, x.p, c.e)
  QUALIFY row_number() OVER (PARTITION BY r, p ORDER BY d, e) = 1)"""

    def means(k: int) -> str:
        return f"""m{k} AS (
  SELECT x.p, a.e, x.j, CAST(sum(x.v) AS BIGINT) AS s, count(*) AS n FROM x JOIN a{k} a USING (r, p) GROUP BY x.p, a.e, x.j
), c{k + 1} AS MATERIALIZED (
  SELECT c.p, c.e, c.j, CASE WHEN n IS NULL THEN c.v ELSE (s - ((s % n) + n) % n) // n END AS v
  FROM c{k} c LEFT JOIN m{k} m ON m.p = c.p AND m.e = c.e AND m.j = c.j)"""

    rounds = ",\n".join(f"{nearest(k)},\n{means(k)}" for k in range(ROUNDS))
    return f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) AS r,
    list_transform(embedding, lambda y: CAST(floor({SCALE} * CAST(y AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0
), x AS MATERIALIZED (
  SELECT r, (i - 1) // (n // {PARTS}) AS p, (i - 1) % (n // {PARTS}) AS j, v
  FROM (SELECT r, len(q) AS n, unnest(q) AS v, generate_subscripts(q, 1) AS i FROM kept)
), c0 AS MATERIALIZED (SELECT p, r - 1 AS e, j, v FROM x WHERE r <= {ENTRIES}),
{rounds},
{nearest(ROUNDS)},
book AS (SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY p, e, j)) AS h FROM c{ROUNDS}),
coded AS (SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
FROM kept JOIN coded USING (r), book"""


SQL = {
    "op2_quality_rules": _quality_rules(), "op9_sharding": _SHARDING, "op10_substring_dedup": _SUBSTRING,
    "op11_vector_codes": _vector_codes(),
}
