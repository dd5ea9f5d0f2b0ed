"""Set and membership operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def members(df: DataFrame, of: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(of.select(*on), list(on), "left_semi")


def missing_and_extra(expected: DataFrame, found: DataFrame, on: str) -> DataFrame:
    """``on, state`` for keys on one side only."""
    a = expected.select(on).distinct().withColumn("_e", F.lit(True))
    b = found.select(on).distinct().withColumn("_f", F.lit(True))
    both = a.join(b, on, "full_outer").where(F.col("_e").isNull() | F.col("_f").isNull())
    return both.select(on, F.when(F.col("_f").isNull(), "missing").otherwise("extra").alias("state"))


def unique_pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.select(a, b).distinct().orderBy(a, b)


def stack(tables: Sequence[DataFrame]) -> DataFrame:
    """All rows of all tables; columns by name, later tables cast to the types of the first."""
    first = tables[0]
    types = dict(first.dtypes)
    cast = [t.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in t.columns]) for t in tables[1:]]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), cast, first)


def label_mean(df: DataFrame, label: str, value: str, name: str = "mean") -> DataFrame:
    return df.groupBy(label).agg(F.avg(value).alias(name))
