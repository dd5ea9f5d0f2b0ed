"""Registered query of the spelling variants and its oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skyfold.llm import spelling
from skyfold.llm.common import Query, table


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH RECURSIVE bits AS (
    SELECT CAST(i AS BIGINT) AS i, CAST(i AS BIGINT) AS c, 0 AS k FROM range(256) t(i)
    UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, CAST(3988292384 AS BIGINT)) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8
), crc AS (
    SELECT list(c ORDER BY i) AS tab FROM bits WHERE k = 8
), runs AS (
    SELECT doc_id, run, count(*) AS times FROM (
        SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run FROM documents)
    WHERE length(run) >= 5 GROUP BY doc_id, run
), spelled AS (
    SELECT run, times, flatten([CASE WHEN u < 128 THEN [u] ELSE [192 | (u >> 6), 128 | (u & 63)] END
                                FOR u IN [CAST(unicode(s) AS BIGINT) FOR s IN string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, '')]]) AS bytes
    FROM runs
), hashed AS (
    SELECT run, times, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), bytes), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), CAST(4294967295 AS BIGINT)) AS h
    FROM spelled, crc
), w AS (
    SELECT word, CAST(sum(times) AS BIGINT) AS n
    FROM (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, times FROM hashed)
    WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3
), cuts AS (
    SELECT word, substr(word, 1, i) || substr(word, i + 2) AS shorter, substr(word, 1, i) || '_' || substr(word, i + 2) AS holed
    FROM (SELECT word, unnest(range(0, length(word))) AS i FROM w)
), near AS (
    SELECT a.word, b.word AS other FROM cuts a JOIN cuts b USING (holed) WHERE a.word <> b.word
    UNION SELECT c.word, w.word FROM cuts c JOIN w ON c.shorter = w.word
    UNION SELECT w.word, c.word FROM cuts c JOIN w ON c.shorter = w.word
), best AS (
    SELECT x.word, count(*) AS n_near, first(other ORDER BY w.n DESC, other) AS form, max(w.n) AS form_n FROM near x JOIN w ON x.other = w.word GROUP BY x.word
), known AS (
    SELECT word, CASE WHEN form_n >= 2 * n THEN form END AS form, n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 2 * n THEN form_n END AS form_n
    FROM w LEFT JOIN best USING (word)
), chain AS (
    SELECT word, word AS here, 0 AS steps FROM known
    UNION ALL SELECT c.word, k.form, steps + 1 FROM chain c JOIN known k ON c.here = k.word WHERE k.form IS NOT NULL
), roots AS (
    SELECT word, arg_max(here, steps) AS root FROM chain GROUP BY word
)
SELECT word, form, root, n, n_near, form_n FROM known JOIN roots USING (word)
"""

REGISTERED: dict[str, Query] = {"op11_spelling": (op11_spelling, OP11_SQL)}
