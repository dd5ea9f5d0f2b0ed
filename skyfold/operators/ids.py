"""Dense ids without an unpartitioned window over the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from skyfold.session import materialize

ID_BASE = 10**13
ID_PER_PIXEL = 10**8


def object_id(pixel: Column, sequence: Column) -> Column:
    """Catalog-wide id of the n-th object of a shard pixel; a pixel with more than ``ID_PER_PIXEL`` objects raises."""
    number = sequence.cast("long")
    full = F.raise_error(F.lit("more objects in a pixel than ids")).cast("long")
    return F.lit(ID_BASE) + pixel.cast("long") * ID_PER_PIXEL + F.when(number < ID_PER_PIXEL, number).otherwise(full)


def sequence_id(pixel: Column, candidate: Column) -> Column:
    """``candidate``, an id made by adding to one of ``pixel``, unless it runs into the next pixel's ids: that raises."""
    return object_id(pixel, candidate - F.lit(ID_BASE) - pixel.cast("long") * ID_PER_PIXEL)


def dense_ids(df: DataFrame, keys: Sequence[str], name: str, start: int = 0) -> DataFrame:
    """Adds ``name``: the rank of the row's key among the distinct keys, counting from ``start``.

    The distinct keys are range-partitioned and written with their partition number. Each partition
    numbers its own keys and adds the count of the partitions before it; the only unpartitioned window
    runs over one row per partition. ``name`` may be one of the keys and is then replaced.
    """
    keys = list(keys)
    distinct = df.select(*keys).distinct()
    ranged = materialize(distinct.repartitionByRange(*keys).withColumn("_pid", F.spark_partition_id()), "ranged")
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = W.orderBy("_pid").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    rank = F.row_number().over(W.partitionBy("_pid").orderBy(*keys))
    numbered = ranged.withColumn("_rank", rank).join(F.broadcast(offsets), "_pid")
    numbered = numbered.select(*keys, (F.col("_rank") - 1 + F.col("_off") + start).cast("long").alias("_dense"))
    if name in keys:
        return df.join(numbered, keys).drop(name).withColumnRenamed("_dense", name)
    return df.join(numbered.withColumnRenamed("_dense", name), keys)
