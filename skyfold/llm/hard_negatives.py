"""Hard-negative mining by vertical scans of column blocks (branch and bound over dimensions).

Vectors are stored by column: a block holds some thousand rows, one array of integers for each dimension, and the
smallest and largest value of each. An anchor reads a block's dimensions in descending order of its own magnitudes.
After every few dimensions, what the remaining ones can add at least and at most follows from their smallest and largest
values, so each candidate has a lower and an upper bound of its score. Candidates whose bounds cannot meet what is
looked for leave the bitmap, and the rest go on until all dimensions are read and scores are exact. Two scans follow
each other:

1. *positives*: the best rows of the anchor's own label; a candidate leaves when its upper bound is below the k-th
   largest lower bound;
2. *negatives*: the best rows of other labels within a window of each positive's score; a candidate leaves when its
   bounds miss all windows, or when each window that it can meet has k rows that are certain to be in it and better.

Blocks of anchors meet blocks of rows: a group holds one of each, of a fixed size, whatever the labels. A group returns
the best few rows of each anchor, and Spark ranks these over all groups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from skyfold.session import materialize

POSITIVES = 5
NEGATIVES = 5
#: A negative scores between these parts of the positive's score: LOW / HIGH and 1.
LOW, HIGH = 80, 100
LABELS = 10
SCALE = 256.0
#: Dimensions read between two looks at the bounds.
STRIDE = 8
ROWS_IN_BLOCK, VALUES_IN_BLOCK, ANCHORS_IN_BLOCK = 8192, 1 << 22, 4096
#: Vectors of a larger sum of squares take no part: their products would not fit a long.
LARGEST_NORM = float(1 << 62)

BLOCK = "block long, ids binary, labels binary, kind string, dims array<binary>, lows array<long>, highs array<long>"
BLOCK_ARROW = pa.schema(
    [("block", pa.int64()), ("ids", pa.binary()), ("labels", pa.binary()), ("kind", pa.string()), ("dims", pa.list_(pa.binary())), ("lows", pa.list_(pa.int64())), ("highs", pa.list_(pa.int64()))]
)


def prepared(vectors: DataFrame) -> DataFrame:
    """``vec_id, label, v`` of the rows that take part, written: whole-number components, each id once.

    Rows without id, label or vector, or with a null or non-finite component, take no part. The label of ids that 7
    divides moves on by one. Rows that repeat an id count once: the one with the smallest (label, vector).
    """
    vec_id, x = F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    whole = F.transform(x, lambda c: F.floor(c * F.lit(SCALE)))
    given = vectors.where(vec_id.isNotNull() & F.col("label").isNotNull() & x.isNotNull() & ~F.coalesce(bad, F.lit(True)))
    moved = F.when(vec_id % 7 == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label")).cast("int")
    rows = given.select(vec_id.alias("vec_id"), moved.alias("label"), whole.alias("v"))
    norm = F.aggregate("v", F.lit(0.0), lambda acc, c: acc + c.cast("double") * c.cast("double"))
    least = rows.where(norm < LARGEST_NORM).groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("r"))
    return materialize(least.select("vec_id", "r.label", "r.v"), "vectors")


def _matrix(lists: pa.Array) -> np.ndarray:
    """Rows of an Arrow list column; shorter vectors end in zeros."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    lengths = np.asarray(lists.value_lengths())
    width = int(lengths.max()) if len(lengths) else 0
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    if (lengths == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns of the rows of a partition, as they come, in the narrowest type that holds them; the number is the first id."""
    for batch in batches:
        vectors = _matrix(batch.column("v"))
        size = max(1, min(ROWS_IN_BLOCK, VALUES_IN_BLOCK // max(1, vectors.shape[1])))
        ids, labels = (batch.column(c).to_numpy() for c in ("vec_id", "label"))
        for at in range(0, len(ids), size):
            part = vectors[at : at + size]
            lows, highs = part.min(axis=0), part.max(axis=0)
            kind = next(k for k in ("<i2", "<i4", "<i8") if not len(lows) or (lows.min() >= np.iinfo(k).min and highs.max() <= np.iinfo(k).max))
            dims = [c.tobytes() for c in np.ascontiguousarray(part.T, kind)]
            row = [int(ids[at]), ids[at : at + size].astype("<i8").tobytes(), labels[at : at + size].astype("<i4").tobytes(), kind, dims, lows.tolist(), highs.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, BLOCK_ARROW, strict=True)], schema=BLOCK_ARROW)


def column_blocks(rows: DataFrame) -> DataFrame:
    """Written column blocks of :func:`prepared` rows."""
    return materialize(rows.mapInArrow(_blocks, BLOCK), "column-blocks")


class Scan:
    """One anchor's way through a block: candidates with exact partial sums and bounds of what remains."""

    def __init__(self, anchor: np.ndarray, columns: np.ndarray, lows: np.ndarray, highs: np.ndarray, alive: np.ndarray):
        width = min(len(anchor), len(columns))
        self.order = np.argsort(-np.abs(anchor[:width]), kind="stable")
        self.anchor, self.columns, self.alive = anchor, columns, alive
        a, b = anchor[self.order] * lows[self.order], anchor[self.order] * highs[self.order]
        # What the dimensions from each place on add at least and at most.
        self.least = np.append(np.cumsum(np.minimum(a, b)[::-1])[::-1], 0)
        self.most = np.append(np.cumsum(np.maximum(a, b)[::-1])[::-1], 0)
        self.sums, self.at = np.zeros(len(alive), np.int64), 0

    def step(self) -> bool:
        """Reads the next dimensions; False when all are read."""
        if self.at >= len(self.order) or not len(self.alive):
            return False
        dims = self.order[self.at : self.at + STRIDE]
        for d in dims:
            self.sums += self.anchor[d] * self.columns[d][self.alive]
        self.at += len(dims)
        return True

    def bounds(self) -> tuple[np.ndarray, np.ndarray]:
        return self.sums + self.least[self.at], self.sums + self.most[self.at]

    def keep(self, mask: np.ndarray) -> None:
        if not mask.all():
            self.alive, self.sums = self.alive[mask], self.sums[mask]


def _kth(values: np.ndarray, k: int) -> int | None:
    """The k-th largest of the values, None if there are fewer."""
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else None


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k first rows by descending score, then id."""
    if len(ids) > 4 * k:
        cut = np.flatnonzero(scores >= _kth(scores, k))
        return cut[np.lexsort((ids[cut], -scores[cut]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def best_rows(scan: Scan, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the k best candidates."""
    while scan.step():
        low, high = scan.bounds()
        limit = _kth(low, k)
        if limit is not None:
            scan.keep(high >= limit)
    chosen = _best(ids[scan.alive], scan.sums, k)
    return ids[scan.alive][chosen], scan.sums[chosen]


def best_in_windows(scan: Scan, ids: np.ndarray, windows: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Ids and scores of the k best candidates of each window ``(lowest, highest)``."""
    while scan.step():
        low, high = scan.bounds()
        wanted = np.zeros(len(low), bool)
        for first, last in windows:
            meets = (high >= first) & (low <= last)
            limit = _kth(low[(low >= first) & (high <= last)], k)
            wanted |= meets if limit is None else meets & (high >= limit)
        scan.keep(wanted)
    out = []
    for first, last in windows:
        inside = np.flatnonzero((scan.sums >= first) & (scan.sums <= last))
        chosen = inside[_best(ids[scan.alive][inside], scan.sums[inside], k)]
        out.append((ids[scan.alive][chosen], scan.sums[chosen]))
    return out


def lowest_negative(score: int) -> int:
    """The smallest whole score that is at least ``LOW / HIGH`` of ``score``."""
    return -((-LOW * score) // HIGH)


FOUND = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("positive_score", pa.int64()), ("found_id", pa.int64()), ("score", pa.int64())])


def _met(negatives: bool, k: int):
    """Function of a group of anchors and a block: the block's best rows of each anchor, or of each of its windows."""

    def run(anchors: pa.Table, blocks: pa.Table) -> pa.Table:
        out = []
        if anchors.num_rows and blocks.num_rows:
            vectors = _matrix(anchors.column("v"))
            wanted = anchors.column("positives").to_pylist() if negatives else None
            for block in blocks.to_pylist():
                ids, labels = np.frombuffer(block["ids"], "<i8"), np.frombuffer(block["labels"], "<i4")
                columns = [np.frombuffer(c, block["kind"]) for c in block["dims"]]
                lows, highs = np.array(block["lows"], np.int64), np.array(block["highs"], np.int64)
                for i, (anchor_id, label) in enumerate(zip(anchors.column("anchor_id").to_pylist(), anchors.column("label").to_pylist(), strict=True)):
                    own = np.flatnonzero(labels != label if negatives else (labels == label) & (ids != anchor_id))
                    scan = Scan(vectors[i], columns, lows, highs, own)
                    if not negatives:
                        out.append((anchor_id, None, None, *best_rows(scan, ids, k)))
                        continue
                    windows = np.array([(lowest_negative(p["score"]), p["score"]) for p in wanted[i]], np.int64).reshape(-1, 2)
                    for p, found in zip(wanted[i], best_in_windows(scan, ids, windows, k), strict=True):
                        out.append((anchor_id, p["found_id"], p["score"], *found))
        rows = [(a, p, s, int(f), int(x)) for a, p, s, fs, xs in out for f, x in zip(fs, xs, strict=True)]
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * 5, FOUND, strict=True)], schema=FOUND)

    return run


def _groups(anchors: DataFrame, blocks: DataFrame, parts: int, slots: int, negatives: bool, k: int) -> DataFrame:
    """Every block of anchors with every block of rows; a group holds one part of the anchors and one slot of the blocks."""
    copied = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    left = anchors.withColumn("part", F.pmod(F.xxhash64("anchor_id"), F.lit(parts))).withColumn("slot", copied(slots))
    right = blocks.withColumn("slot", F.pmod(F.xxhash64("block"), F.lit(slots))).withColumn("part", copied(parts))
    met = left.groupBy("part", "slot").cogroup(right.groupBy("part", "slot"))
    return met.applyInArrow(_met(negatives, k), "anchor_id long, positive_id long, positive_score long, found_id long, score long")


def _ranked(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """``rank`` 1 to k by descending score, then id, among the rows of each key."""
    order = W.partitionBy(*keys).orderBy(F.desc("score"), "found_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def is_anchor(vec_id: Column) -> Column:
    return vec_id % 100 == 0


def mine(vectors: DataFrame) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` of all anchors in ``vectors``.

    ``vectors(vec_id, embedding, label)``; other columns are ignored. Vectors of different lengths are compared over the
    dimensions that both have. Anchors without other rows of their label, and positives whose window is empty, have no
    rows; neither have empty tables. See :func:`prepared` for nulls and repeated ids.
    """
    rows = prepared(vectors)
    blocks = column_blocks(rows)
    anchors = materialize(rows.where(is_anchor(F.col("vec_id"))).withColumnRenamed("vec_id", "anchor_id"), "anchors")
    parts, slots = max(1, -(-anchors.count() // ANCHORS_IN_BLOCK)), max(1, blocks.count())
    positives = _ranked(_groups(anchors, blocks, parts, slots, False, POSITIVES), ["anchor_id"], POSITIVES)
    listed = positives.groupBy("anchor_id").agg(F.collect_list(F.struct("found_id", "score")).alias("positives"))
    asking = materialize(anchors.join(listed, "anchor_id"), "positives")
    negatives = _ranked(_groups(asking, blocks, parts, slots, True, NEGATIVES), ["anchor_id", "positive_id"], NEGATIVES)
    return negatives.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("found_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
