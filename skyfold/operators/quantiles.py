"""Exact percentiles that stay exact and bounded when one group is huge.

Spark's ``percentile`` counts every distinct value of a group in one buffer. That is right for ordinary groups. For a
group above ``HOT_GROUP_ROWS`` rows, ``percentile_approx`` has a bounded sketch with a guaranteed rank error, so two
sketch quantiles bracket the wanted rank. Values outside the bracket are clamped to its ends: the ranks inside stay as
they are, so ``percentile`` gives the same value, from a buffer that holds the few values inside. Buffers are merged
from partial ones, so a hot group spreads over all tasks, and equal values share an entry.

All of it is one lazy plan. Without hot groups the table of brackets is empty and adaptive execution drops its branch.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

HOT_GROUP_ROWS = 2_000_000
ACCURACY = 50_000
#: Half the width of a bracket, in sketch errors.
SLACK = 4.0


def real_values(df: DataFrame, value: str) -> DataFrame:
    return df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value)))


def _same(keys: Sequence[str]) -> Column:
    """Equal keys, nulls included, of a table and one whose keys are called ``_k_<key>``."""
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys], F.lit(True))


def _brackets(clean: DataFrame, keys: Sequence[str], values: Mapping[str, tuple[str, float]], hot_rows: int, accuracy: int) -> DataFrame:
    """``_k_<key>`` of each group above ``hot_rows`` and, for each percentile, ``_lo_<name>`` and ``_hi_<name>``.

    There is at most one such group in ``hot_rows`` rows, so both tables that are broadcast here stay small.
    """
    renamed = {k: f"_k_{k}" for k in keys}
    sizes = clean.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size")).where(F.col("_size") > hot_rows).drop("_size")
    crowd = clean.join(F.broadcast(sizes.withColumnsRenamed(renamed)), _same(keys), "left_semi")
    slack = SLACK / accuracy
    ends = []
    for name, (value, q) in values.items():
        low, high = q - slack, q + slack
        ends += [
            (F.min(value) if low <= 0 else F.percentile_approx(value, low, accuracy)).alias(f"_lo_{name}"),
            (F.max(value) if high >= 1 else F.percentile_approx(value, high, accuracy)).alias(f"_hi_{name}"),
        ]
    return crowd.groupBy(*keys).agg(*ends).withColumnsRenamed(renamed)


def exact_percentiles(
    df: DataFrame, keys: Sequence[str], wanted: Mapping[str, tuple[str, float]], hot_rows: int | None = HOT_GROUP_ROWS, extra: Sequence[Column] = (), accuracy: int = ACCURACY
) -> DataFrame:
    """``{name: (column, q)}`` per group, NULL and NaN left out, plus ``extra`` aggregates.

    Interpolates linearly between ranks, as the median of an even group does. ``hot_rows`` is None where the caller knows
    that no group is hot.
    """
    keys = list(keys)
    values = {name: (f"_p_{c}", q) for name, (c, q) in wanted.items()}
    clean = df.withColumns({f"_p_{c}": F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c, _ in wanted.values()})
    if hot_rows is None:
        return clean.groupBy(*keys).agg(*[F.percentile(value, q).alias(name) for name, (value, q) in values.items()], *extra)
    # A whole table is one group; the key is only for the join.
    on = keys or ["_all"]
    clean = clean if keys else clean.withColumn("_all", F.lit(0))
    joined = clean.join(F.broadcast(_brackets(clean, on, values, hot_rows, accuracy)), _same(on), "left")
    found, checks = [], []
    for name, (value, q) in values.items():
        v, low, high = F.col(value), F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        clamped = F.when(v < low, low).when(v > high, high).otherwise(v)
        place = F.lit(q) * (F.count(v) - 1)
        held = (F.count_if(v < low) <= F.floor(place)) & (F.count_if(v > high) <= F.count(v) - 1 - F.ceil(place))
        found.append(F.percentile(clamped, q).alias(name))
        checks.append((held | (F.count(v) == 0)).alias(f"_held_{name}"))
    out = joined.groupBy(*keys).agg(*found, *checks, *extra)
    missed = F.raise_error(F.lit("the wanted rank lies outside its bracket")).cast("double")
    out = out.withColumns({name: F.when(F.col(f"_held_{name}"), F.col(name)).otherwise(missed) for name in wanted})
    return out.drop(*[f"_held_{name}" for name in wanted])


def exact_median(df: DataFrame, keys: Sequence[str], value: str, name: str, hot_rows: int = HOT_GROUP_ROWS, extra: Sequence[Column] = ()) -> DataFrame:
    return exact_percentiles(df, keys, {name: (value, 0.5)}, hot_rows, extra)
