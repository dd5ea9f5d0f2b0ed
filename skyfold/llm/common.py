"""Helpers shared by the pipeline operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from skyfold.session import materialize

Query = tuple[Callable[[SparkSession, str], DataFrame], str | None]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def texts(column: pa.Array) -> list[str]:
    """Strings of an Arrow column, null as the empty string."""
    return [x or "" for x in column.to_pylist()]


def utf8(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of an Arrow column, null as no bytes."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def per_batch(fn: Callable[[pa.RecordBatch], dict], schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Function for ``mapInArrow`` from one that turns a batch into columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                columns = fn(batch)
                yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)

    return run


def running_totals(df: DataFrame, keys: list[str], totals: dict[str, str], label: str = "ranged") -> DataFrame:
    """Adds, for each ``name: column``, the sum of ``column`` over all rows that sort before the row.

    ``keys`` must order the rows totally (equal rows may come in any order). The rows are range-partitioned and
    written with their partition number; each partition adds up its own rows, and the one window that is not
    partitioned runs over one row per partition.
    """
    ranged = materialize(df.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id()), label)
    parts = ranged.groupBy("_part").agg(*[F.sum(column).alias(f"_sum_{name}") for name, column in totals.items()])
    earlier = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = parts.select("_part", *[F.coalesce(F.sum(f"_sum_{name}").over(earlier), F.lit(0)).alias(f"_off_{name}") for name in totals])
    inside = W.partitionBy("_part").orderBy(*keys).rowsBetween(W.unboundedPreceding, -1)
    own = ranged.select("*", *[F.coalesce(F.sum(column).over(inside), F.lit(0)).alias(f"_own_{name}") for name, column in totals.items()])
    joined = own.join(F.broadcast(offsets), "_part")
    return joined.select(*df.columns, *[(F.col(f"_own_{name}") + F.col(f"_off_{name}")).alias(name) for name in totals])


class Bounded(dict):
    """Computes missing values and starts anew when it holds ``most`` of them."""

    def __init__(self, compute: Callable, most: int = 400_000):
        super().__init__()
        self.compute, self.most = compute, most

    def __missing__(self, key):
        value = self.compute(key)
        if len(self) >= self.most:
            self.clear()
        self[key] = value
        return value


def fold(doc_id: Column, folds: int) -> Column:
    """``crc32(doc_id as text) mod folds``; a null id is in no fold."""
    return F.crc32(doc_id.cast("long").cast("string").cast("binary")) % folds


def sampled_labels(labels: DataFrame, name: str, kept: Column, bound: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted ids and 0/1 labels of about ``bound`` labelled rows at most, chosen by a hash of the id.

    A document with several labels counts by the largest; null ids and labels are left out. The bound makes the
    arrays fit for a broadcast at any number of labels.
    """
    given = labels.where(F.col("doc_id").isNotNull() & F.col(name).isNotNull()).groupBy("doc_id").agg(F.max(F.col(name).cast("int")).alias("label")).where(kept)
    share = min(1.0, bound / max(1, given.count()))
    rows = given.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * share)).toPandas().sort_values("doc_id")
    return rows["doc_id"].to_numpy(np.int64), (rows["label"].to_numpy() > 0).astype(np.int64)


def label_of(doc_ids: pa.Array, known: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """The label of each id, -1 for ids without one."""
    ids = np.array([-1 if d is None else d for d in doc_ids.to_pylist()], np.int64)
    if not len(known):
        return np.full(len(ids), -1)
    at = np.minimum(np.searchsorted(known, ids), len(known) - 1)
    there = (known[at] == ids) & np.asarray(doc_ids.is_valid())
    return np.where(there, labels[at], -1)
