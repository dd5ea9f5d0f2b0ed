"""SpotSigs fingerprints: chains of content words that follow common-word anchors.

Every occurrence of an anchor word starts a chain: the anchor and the next ``CHAIN`` words that are no anchors. A
text's fingerprint is its set of chains (64-bit hashes); texts are alike by the Jaccard coefficient of their sets.
The start of a text counts as an anchor, so a text without common words has a signature too; a text without words is
signed by its characters, and only blank texts have none.

``following_pairs`` compares neighbours in ``doc_id`` order with one shuffle of the texts. ``near_pairs`` finds the
alike among all: sets are partitioned by length, so that only equal or adjacent partitions can meet; they meet on
their rarest signatures; and a comparison stops when lengths or what is left of a prefix rule the threshold out.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window as W, functions as F

from skyfold.llm.common import texts
from skyfold.session import materialize

CHAIN = 3
THRESHOLD = 0.8
WORD = re.compile(r"[^\W_]+")

#: Anchors, frequent words of four languages.
ANCHORS = frozenset(
    "the of and to in is are that for be with on this by it as was an or from at he a le la les de des du un une et en dans que qui pour par sur au elle "
    "der die das und den von zu mit sich auf für ist im dem nicht ein eine als auch el los las se con no su para es del y lo esta".split()
)


def signatures(text: str) -> set[int]:
    """The chains of a text, as 64-bit hashes."""
    content: list[str] = []
    marks: list[tuple[str, int]] = [("", 0)]
    for word in WORD.findall(text.lower()):
        if word in ANCHORS:
            marks.append((word, len(content)))
        else:
            content.append(word)
    found = {xxhash.xxh64_intdigest(" ".join([anchor, *content[k : k + CHAIN]])) for anchor, k in marks if k < len(content)}
    if not found and text.strip():
        found = {xxhash.xxh64_intdigest(" ".join(text.lower().split()))}
    return found


def digest(signed: set[int]) -> str:
    """Fingerprint of a set: equal for equal sets only; empty sets have the digest of nothing."""
    return hashlib.sha256(np.sort(np.fromiter(signed, np.uint64, len(signed))).astype("<u8").tobytes()).hexdigest()


def likeness(a: set[int], b: set[int], threshold: float = 0.0) -> float:
    """Jaccard coefficient; two empty sets are alike. 0 as soon as the lengths rule ``threshold`` out."""
    if not a or not b:
        return float(not a and not b)
    if min(len(a), len(b)) < threshold * max(len(a), len(b)):
        return 0.0
    both = len(a & b)
    return both / (len(a) + len(b) - both)


RESULT = pa.schema([
    ("part", pa.int32()), ("role", pa.int8()), ("doc_id", pa.int64()), ("text", pa.string()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
    ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()), ("n_signatures", pa.int64()),
])
COLUMNS = "part int, role byte, doc_id long, text string, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, n_signatures long"
DONE, FIRST, LAST = 0, 1, 2
ROWS_AT_ONCE = 512


def compared(doc_id: int | None, text: str, signed: set[int], after: str, after_signed: set[int]) -> dict:
    """Result of a document and the one that follows it."""
    half = len(text) // 2
    edited = text[: len(text) - half] + after[:half]
    edited_signed = signatures(edited)
    return {
        "role": DONE, "doc_id": doc_id, "n_chars": len(text), "edited_sha256": hashlib.sha256(edited.encode()).hexdigest(), "fingerprint": digest(signed), "edited_fingerprint": digest(edited_signed),
        "near_edited": likeness(signed, edited_signed), "near_next": likeness(signed, after_signed), "n_signatures": len(signed),
    }


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of all rows of a sorted partition but the last, which goes on with its text, as does the first."""
    from pyspark import TaskContext

    part, out, held = TaskContext.get().partitionId(), [], None
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch.column("text")), strict=True):
            signed = signatures(text)
            if held is None:
                out.append({"part": part, "role": FIRST, "doc_id": doc_id, "text": text})
            else:
                out.append(compared(*held, text, signed))
            held = (doc_id, text, signed)
            if len(out) >= ROWS_AT_ONCE:
                yield pa.RecordBatch.from_pylist(out, RESULT)
                out = []
    if held is not None:
        yield pa.RecordBatch.from_pylist([*out, {"part": part, "role": LAST, "doc_id": held[0], "text": held[1]}], RESULT)


def _join_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(batch.column("doc_id").to_pylist(), texts(batch.column("text")), texts(batch.column("after")), strict=True)
        yield pa.RecordBatch.from_pylist([compared(d, t, signatures(t), a, signatures(a)) for d, t, a in rows], RESULT)


def following_pairs(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` fingerprinted and compared with its edited text and with the next row's.

    The edited text has its last half (rounded down) replaced by as much of the beginning of the next row in
    ascending ``doc_id`` order, the first row following the last. Returns ``doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next, n_signatures``. A null text counts as empty; null ids
    sort first; rows that repeat an id follow each other in the order of their texts. A single row follows itself.

    The texts are range-partitioned and sorted, and each task holds two at a time. Its last row meets the first row of
    the next partition in a second, small step over one row per partition.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    placed = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    stored = materialize(placed.mapInArrow(_scan, COLUMNS), "spotsigs")
    firsts = stored.where(F.col("role") == FIRST).select("part", F.col("text").alias("after"))
    by_part = W.orderBy("part")
    lowest = F.first("part").over(by_part)
    order = firsts.select("part", F.coalesce(F.lead("part").over(by_part), lowest).alias("next"))
    ends = stored.where(F.col("role") == LAST).select("part", "doc_id", "text").join(order, "part").join(firsts.withColumnRenamed("part", "next"), "next")
    joined = ends.select("doc_id", "text", "after").mapInArrow(_join_ends, COLUMNS)
    names = [f.name for f in RESULT][4:]
    return stored.where(F.col("role") == DONE).unionByName(joined).select("doc_id", *names)


def signature_sets(docs: DataFrame) -> DataFrame:
    """``(doc_id, signatures)``: the sorted set of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("signatures", pa.list_(pa.int64()))])

    def batch_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.sort(np.fromiter((s := signatures(t)), np.uint64, len(s)).view(np.int64)) for t in texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sets, pa.list_(pa.int64()))], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(batch_sets, "doc_id long, signatures array<long>")


def near_pairs(docs: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """Links between distinct fingerprints, and who has which fingerprint.

    Returns ``(a, b, likeness)`` for every pair of distinct sets with Jaccard of ``threshold`` or more, by the smallest
    ``doc_id`` of each, and ``(doc_id, first_id)`` for every row with an id. Copies are thus never expanded into pairs.
    Empty sets are one fingerprint that links to no other.
    """
    sets = materialize(signature_sets(docs).where("doc_id IS NOT NULL"), "sets")
    classes = materialize(sets.groupBy("signatures").agg(F.min("doc_id").alias("first_id")).withColumn("n", F.size("signatures")), "classes")
    members = sets.join(classes, "signatures").select("doc_id", "first_id")
    spread = classes.select("first_id", "n", F.explode("signatures").alias("s"))
    counted = spread.join(spread.groupBy("s").agg(F.count(F.lit(1)).alias("uses")), "s")
    ranked = counted.groupBy("first_id", "n").agg(F.array_sort(F.collect_list(F.struct("uses", "s"))).alias("by_use"))
    prefix = F.col("n") - F.ceil(F.col("n") * threshold) + 1
    tokens = ranked.select("first_id", "n", F.posexplode(F.slice("by_use", F.lit(1), prefix)).alias("at", "t")).select("first_id", "n", "at", F.col("t.s").alias("s"))
    step = -math.log(threshold) if threshold < 1 else 1.0
    at_length = F.ln(F.col("n")) / step
    left = tokens.withColumn("part", F.floor(at_length))
    right = tokens.withColumn("part", F.explode(F.sequence(F.floor(at_length - 1e-9), F.floor(at_length + 1 + 1e-9))))
    l, r = left.alias("l"), right.alias("r")
    met = l.join(r, (F.col("l.part") == F.col("r.part")) & (F.col("l.s") == F.col("r.s")))
    shorter = (F.col("r.n") < F.col("l.n")) | ((F.col("r.n") == F.col("l.n")) & (F.col("r.first_id") < F.col("l.first_id")))
    longest_overlap = F.least(F.col("l.n") - F.col("l.at"), F.col("r.n") - F.col("r.at"))
    needed = threshold / (1 + threshold) * (F.col("l.n") + F.col("r.n"))
    pruned = met.where(shorter & (F.col("r.n") >= threshold * F.col("l.n")) & (longest_overlap >= needed - 1e-9))
    candidates = pruned.select(F.col("r.first_id").alias("a"), F.col("l.first_id").alias("b")).distinct()
    have = classes.select("first_id", "signatures")
    both = candidates.join(have.toDF("a", "x"), "a").join(have.toDF("b", "y"), "b")
    common = F.size(F.array_intersect("x", "y"))
    scored = both.select("a", "b", (common / (F.size("x") + F.size("y") - common)).alias("likeness")).where(F.col("likeness") >= threshold)
    return scored.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "likeness"), members
