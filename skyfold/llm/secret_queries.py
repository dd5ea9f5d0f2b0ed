"""Registered query of the secret scan and its oracle, whose patterns and limits are written out on their own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skyfold.llm import secrets
from skyfold.llm.common import Query, table


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def _found(rows: str, keys: str, kind: str, no: int, pattern: str, group: int = 0) -> str:
    """Matches of one pattern in ``rows(keys, text)``, one row each, with places in code points."""
    quoted = "'" + pattern.replace("'", "''") + "'"
    return f"""
    SELECT {keys}, kind, no, whole, value, upto - length(whole) AS b, upto AS e FROM (
        SELECT *, sum(length(before) + length(whole)) OVER (PARTITION BY {keys} ORDER BY i) AS upto FROM (
            SELECT {keys}, '{kind}' AS kind, {no} AS no, unnest(range(1, len(matches) + 1)) AS i, unnest(matches) AS whole,
                   unnest(regexp_extract_all(text, {quoted}, {group})) AS value, unnest(regexp_split_to_array(text, {quoted})[:-2]) AS before
            FROM (SELECT {keys}, text, regexp_extract_all(text, {quoted}, 0) AS matches FROM {rows}) WHERE len(matches) > 0))"""


_ASSIGN = (
    r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))"""
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)

OP13_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents
), assigned AS ({_found("d", "doc_id", "assign", 0, _ASSIGN, 2)}
), access AS ({_found("d", "doc_id", "access", 1, "AKIA[A-Z0-9]+")}
), hex AS ({_found("d", "doc_id", "hex", 2, "[0-9a-f]{16,}")}
), candidates AS ({_found("d", "doc_id", "candidate", 9, "[A-Za-z0-9+/_.=:-]{16,}")}
), suspects AS (
    SELECT doc_id, b AS place, whole AS text FROM candidates
    WHERE length(whole) >= 16
      AND NOT regexp_matches(whole, '[Ee][Xx][Aa][Mm][Pp][Ll][Ee]|[Pp][Ll][Aa][Cc][Ee][Hh][Oo][Ll][Dd][Ee][Rr]|[Rr][Ee][Dd][Aa][Cc][Tt][Ee][Dd]')
      AND NOT regexp_matches(whole, '[Xx][Xx][Xx][Xx]|00000000|1234567|abcdefg|ABCDEFG|://')
      AND NOT regexp_full_match(whole, '[0-9a-fA-F]{{8}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{12}}')
      AND NOT regexp_full_match(whole, '[0-9.:+/_=-]+')
      AND NOT regexp_full_match(whole, '[A-Za-z]?[a-z]*([./:_=+-]+[A-Za-z]?[a-z]*)*')
      AND NOT (starts_with(whole, 'sha256-') OR starts_with(whole, 'sha384-') OR starts_with(whole, 'sha512-'))
), runs AS (
    SELECT *, 16 AS w, 3.0 AS bits FROM ({_found("suspects", "doc_id, place", "hex_digits", 3, "[0-9A-Fa-f]{16,}")})
    UNION ALL SELECT *, 20, 3.6 FROM ({_found("suspects", "doc_id, place", "capitals", 4, "[A-Z0-9]{20,}")})
    UNION ALL SELECT *, 24, 4.1 FROM ({_found("suspects", "doc_id, place", "base64", 5, "[A-Za-z0-9+/_-]{24,}")})
), windows AS (
    SELECT doc_id, kind, no, w, bits, place + b AS run, place + b + i AS b, string_split(substr(whole, i + 1, w), '') AS symbols
    FROM (SELECT *, unnest(range(0, length(whole) - w + 1)) AS i FROM runs WHERE length(whole) >= w)
), flagged AS (
    SELECT doc_id, kind, no, run, b, b + w AS e,
           CASE WHEN b <= lag(b + w) OVER (PARTITION BY doc_id, kind, run ORDER BY b) THEN 0 ELSE 1 END AS fresh
    FROM windows
    WHERE list_sum([CAST(round(1e6 * c * log2(c)) AS BIGINT) FOR c IN map_values(list_histogram(symbols))]) <= round(1e6 * w * (log2(w) - bits))
), islands AS (
    SELECT *, sum(fresh) OVER (PARTITION BY doc_id, kind, run ORDER BY b) AS island FROM flagged
), base AS (
    SELECT doc_id, kind, no, b, e FROM assigned WHERE length(value) >= 12
    UNION ALL SELECT doc_id, kind, no, b, e FROM access WHERE length(whole) >= 18
    UNION ALL SELECT doc_id, kind, no, b, e FROM hex WHERE length(whole) >= 16
), spans AS (
    SELECT * FROM base
    UNION ALL SELECT doc_id, kind, no, min(b), max(e) FROM islands GROUP BY doc_id, kind, no, run, island
), listed AS (
    SELECT doc_id, count(*) FILTER (no = 0) AS n_assign, count(*) FILTER (no = 1) AS n_access, count(*) FILTER (no = 2) AS n_hex,
           count(*) FILTER (no > 2) AS n_entropy,
           string_agg(kind || ':' || b || ':' || e, ',' ORDER BY b, no) FILTER (no <= 2) AS base,
           string_agg(kind || ':' || b || ':' || e, ',' ORDER BY b, no) AS spans
    FROM spans GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, coalesce(n_entropy, 0) AS n_entropy,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN listed USING (doc_id)
"""

REGISTERED: dict[str, Query] = {"op13_secrets": (op13_secrets, OP13_SQL)}
