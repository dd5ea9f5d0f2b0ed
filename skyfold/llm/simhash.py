"""SimHash near-duplicates with pivot distance tables.

A fingerprint has 64 bits, one for each bit that is set in more than half of the XXH64 hashes of the text's word
shingles. Fingerprints link at ``MAX_BITS`` or fewer differing bits. Links are found in two steps.

*Blocks.* The bits are cut into ``MAX_BITS + t`` blocks. Two linked fingerprints agree on at least ``t`` blocks,
so every choice of ``t`` blocks gives one key per fingerprint, and linked ones share a key for some choice. ``t``
is a parameter: the result is the same for each, a larger one makes more keys and fewer chance meetings.

*Pivots.* Within a key, every fingerprint has its row of Hamming distances to ``PIVOTS`` reference fingerprints.
By the triangle inequality no coordinate of a linked pair differs by more than ``MAX_BITS``. Rows are sorted by the
first coordinate, so a scan ends where it differs too much; the other coordinates discard pairs one after the
other, and the bits of the survivors are compared. Pairs that earlier links connect already are skipped, so a key
gives at most one link less than it has members, and no dense group emits its pairs.

Keys with more than ``PIECE`` members are dealt into pieces; each pair of pieces is a group of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from skyfold.llm.common import per_batch, utf8
from skyfold.llm.components import components
from skyfold.session import materialize

SHINGLE = 4
SEED = 42
MAX_BITS = 4
SHARED_BLOCKS = 3
PIVOTS = 24
PIECE = 4096
CHUNK = 1 << 14


def reference_fingerprints(count: int = PIVOTS) -> np.ndarray:
    """The pivots: hashes of their numbers, so that any two differ in about half of the bits."""
    return np.array([xxhash.xxh64_intdigest(str(k), SEED) for k in range(count)], np.uint64)


def fingerprint(text: bytes, width: int = SHINGLE) -> int:
    """SimHash of one UTF-8 text: A-Z lower-cased, words split at ASCII white space; no words give 0."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    begins = np.concatenate(([0], ends[:-1]))[: len(words) - width + 1].tolist()
    stops = (ends[width - 1 :] - 1).tolist()
    counts = np.zeros(64, np.int64)
    for at in range(0, len(stops), CHUNK):
        hashes = [xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(begins[at : at + CHUNK], stops[at : at + CHUNK], strict=True)]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8), bitorder="little").reshape(-1, 64)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int((np.uint64(1) << np.flatnonzero(counts * 2 > len(stops)).astype(np.uint64)).sum(dtype=np.uint64))


def _fingerprint_batch(batch: pa.RecordBatch) -> dict:
    values = np.array([fingerprint(t) for t in utf8(batch.column("text"))], np.uint64).view(np.int64)
    return {"doc_id": batch.column("doc_id"), "fp": values}


def fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, fp)`` for every row of ``docs``; ``fp`` holds the 64 bits as a signed long."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(per_batch(_fingerprint_batch, schema), "doc_id long, fp long")


def hex_digits(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def block_keys(fp: Column, t: int) -> Column:
    """Array of ``(choice, key)``: the fingerprint masked to each choice of ``t`` out of ``MAX_BITS + t`` blocks."""
    edges = [64 * i // (MAX_BITS + t) for i in range(MAX_BITS + t + 1)]
    blocks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    masks = np.array([sum(chosen) for chosen in combinations(blocks, t)], np.uint64).view(np.int64).tolist()
    return F.array(*[F.struct(F.lit(k).alias("choice"), fp.bitwiseAND(F.lit(m)).alias("key")) for k, m in enumerate(masks)])


def distance_table(fps: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Hamming distances, one row for each pivot."""
    return np.stack([np.bitwise_count(fps ^ p) for p in pivots]).astype(np.int8)


def spanning_links(group: np.ndarray, fps: np.ndarray, max_bits: int, pivots: np.ndarray) -> list[tuple[int, int]]:
    """Positions of links that connect, within each group, the same fingerprints as all links do."""
    table = distance_table(fps, pivots)
    order = np.lexsort((table[0], group))
    group, fps, table = group[order], fps[order], table[:, order]
    parent = np.arange(len(fps))
    links = []

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    near = np.arange(len(fps))
    step = 0
    while len(near):
        step += 1
        near = near[near + step < len(fps)]
        other = near + step
        near = near[(group[near] == group[other]) & (table[0, other] - table[0, near] <= max_bits)]
        left = near[parent[near] != parent[near + step]]
        for row in table[1:]:
            if not len(left):
                break
            left = left[np.abs(row[left] - row[left + step]) <= max_bits]
        left = left[np.bitwise_count(fps[left] ^ fps[left + step]) <= max_bits]
        for a in left.tolist():
            ra, rb = root(a), root(a + step)
            if ra != rb:
                parent[max(ra, rb)] = min(ra, rb)
                links.append((int(order[a]), int(order[a + step])))
        if len(left):
            while not np.array_equal(parent[parent], parent):
                parent = parent[parent]
    return links


LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])
ROWS_AT_ONCE = 1 << 18


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of the groups in a partition that is sorted by group; a group is whole when the next one begins."""
    pivots = reference_fingerprints()

    def solved(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        number = np.cumsum(np.concatenate(([0], (keys[:, 1:] != keys[:, :-1]).any(axis=0))))
        found = np.array(spanning_links(number, fps.view(np.uint64), MAX_BITS, pivots), np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(fps[found[:, 0]]), pa.array(fps[found[:, 1]])], schema=LINKS)

    held: list[np.ndarray] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(5)]))
        rows += batch.num_rows
        if rows >= ROWS_AT_ONCE:
            data = np.concatenate(held, axis=1)
            change = np.flatnonzero((data[:4, 1:] != data[:4, :-1]).any(axis=0))
            cut = int(change[-1]) + 1 if len(change) else 0
            if cut:
                yield solved(data[:4, :cut], data[4, :cut])
            held, rows = [data[:, cut:]], data.shape[1] - cut
    if rows:
        data = np.concatenate(held, axis=1)
        yield solved(data[:4], data[4])


def fingerprint_links(distinct: DataFrame, t: int = SHARED_BLOCKS) -> DataFrame:
    """``(a, b)``: links that connect the same fingerprints as all pairs within ``MAX_BITS`` do.

    ``distinct`` holds each fingerprint once in column ``fp``. Only keys that two fingerprints share are dealt out.
    Spark takes the key rows to be as few as the fingerprints they were exploded from, so the join is told to merge.
    """
    keyed = distinct.select("fp", F.explode(block_keys(F.col("fp"), t)).alias("k")).select("fp", "k.choice", "k.key")
    shared = keyed.groupBy("choice", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    dealt = keyed.join(shared.hint("merge"), ["choice", "key"]).withColumn("pieces", F.ceil(F.col("n") / PIECE).cast("int"))
    own = F.pmod(F.xxhash64("fp"), F.col("pieces")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("pieces") - 1), lambda s: F.struct(F.least(s, "own").alias("i"), F.greatest(s, "own").alias("j")))
    grouped = dealt.withColumn("own", own).withColumn("pairs", F.when(F.col("pieces") > 1, F.filter(pairs, lambda p: p.i != p.j)).otherwise(pairs))
    groups = grouped.select("choice", "key", "fp", F.explode("pairs").alias("p")).select("choice", "key", "p.i", "p.j", "fp")
    placed = groups.repartition("choice", "key", "i", "j").sortWithinPartitions("choice", "key", "i", "j")
    return placed.mapInArrow(_links, "a long, b long").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` with its fingerprint and the smallest ``doc_id`` that links reach from it.

    Returns ``doc_id, fp, component_id``. Null and blank texts have fingerprint 0 and link like any other. Rows that
    repeat a ``doc_id`` each keep their own fingerprint. A null ``doc_id`` keeps its row and is never the smallest;
    a component without ids has a null ``component_id``. Other columns are ignored; no rows give no rows.
    """
    stored = materialize(fingerprints(docs), "simhash")
    distinct = materialize(stored.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    roots = components(fingerprint_links(distinct.select("fp"))).withColumnRenamed("node", "fp")
    linked = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return stored.join(linked.join(least, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose ``doc_id`` is the smallest of its component; rows without an id all stay."""
    kept = near_duplicates(docs).where("doc_id = component_id").select("doc_id").distinct()
    return docs.join(kept, "doc_id", "left_semi").unionByName(docs.where("doc_id IS NULL")).select(*docs.columns)
