"""Registered query of the hard-negative mining and its oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skyfold.llm import hard_negatives
from skyfold.llm.common import Query, table


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"))


OP12_SQL = """
WITH r AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), a AS (
    SELECT vec_id AS anchor_id, label AS own, v AS w FROM r WHERE vec_id % 100 = 0
), s AS (
    SELECT anchor_id, own = label AS alike, vec_id, CAST(list_inner_product(v, w) AS BIGINT) AS score FROM a, r WHERE vec_id <> anchor_id
), p AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE alike
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT alike AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 5
"""

REGISTERED: dict[str, Query] = {"op12_negatives": (op12_negatives, OP12_SQL)}
