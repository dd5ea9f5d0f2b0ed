"""Chat formatting after a collapse of cumulative snapshots, in DataFrame operations only.

Loggers often store a conversation again after every turn. A conversation whose turns are the first turns of a longer
one is such a snapshot; the maximal conversations are kept and rendered.

Every turn gets two 64-bit hashes of its place, role and text; the exclusive-or of the hashes up to a turn is the
rolling hash of that prefix. A conversation is a snapshot when the hash of all its turns is also the hash of a proper
prefix, which an anti-join decides. Hashes are rolled over range partitions of (conversation, turn): a partition
rolls its own turns, and one row per partition and conversation carries the hash of the partitions before. So a
conversation of any length is dealt over many tasks, and conversations that share a first turn or all turns are only
equal rows in a grouping.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from skyfold.session import materialize

ORDER = ["turn", "role", "text"]


def turns_of(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text``, each different row once; rows without a ``conv_id`` belong to no conversation."""
    known = conversations.where("conv_id IS NOT NULL")
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text"))
    return known.select("conv_id", F.col("turn").cast("long").alias("turn"), role, text).distinct()


def numbered_turns(turns: DataFrame) -> DataFrame:
    """Written ``conv_id, _part, pos, role, text, t1, t2``: place of every turn from 1, and its hashes."""
    pieces = materialize(turns.repartitionByRange("conv_id", *ORDER).withColumn("_part", F.spark_partition_id()), "turns")
    inside = W.partitionBy("conv_id", "_part").orderBy(*ORDER).rowsBetween(W.unboundedPreceding, 0)
    before = W.partitionBy("conv_id").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    counts = pieces.groupBy("conv_id", "_part").agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.select("conv_id", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_ahead"))
    placed = pieces.withColumn("_row", F.count(F.lit(1)).over(inside)).join(counts, ["conv_id", "_part"])
    numbered = placed.withColumn("pos", F.col("_row") + F.col("_ahead")).drop("_row", "_ahead")
    return materialize(numbered.withColumns({"t1": F.xxhash64("pos", "role", "text"), "t2": F.xxhash64("text", "pos", "role")}), "numbered")


def prefix_hashes(numbered: DataFrame) -> DataFrame:
    """Written ``conv_id, pos, n, h1, h2``: turns in all and rolling hashes up to each turn; the texts stay behind."""
    hashed = numbered.select("conv_id", "_part", "pos", "t1", "t2")
    before = W.partitionBy("conv_id").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    totals = hashed.groupBy("conv_id", "_part").agg(F.bit_xor("t1").alias("x1"), F.bit_xor("t2").alias("x2"))
    carried = totals.select("conv_id", "_part", *[F.coalesce(F.bit_xor(x).over(before), F.lit(0).cast("long")).alias(f"c{x}") for x in ("x1", "x2")])
    local = W.partitionBy("conv_id", "_part").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    rolled = hashed.withColumns({"o1": F.bit_xor("t1").over(local), "o2": F.bit_xor("t2").over(local)}).join(carried, ["conv_id", "_part"])
    sizes = hashed.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    joined = rolled.join(sizes, "conv_id")
    return materialize(joined.select("conv_id", "pos", "n", F.col("o1").bitwiseXOR(F.col("cx1")).alias("h1"), F.col("o2").bitwiseXOR(F.col("cx2")).alias("h2")), "prefixes")


def maximal(prefixes: DataFrame) -> DataFrame:
    """``conv_id, n, copies``: conversations that are no proper prefix of another; of equal ones the smallest id."""
    whole = prefixes.where("pos = n").groupBy("n", "h1", "h2").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("copies"))
    shorter = prefixes.where("pos < n").select(F.col("pos").alias("n"), "h1", "h2").distinct()
    return whole.join(shorter, ["n", "h1", "h2"], "left_anti").select("conv_id", "n", "copies")


def rendered_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), text, F.lit("<|end|>\n"))


def collapse(conversations: DataFrame) -> DataFrame:
    """Maximal conversations rendered: ``conv_id, n_turns, copies, rendered``.

    Turns follow each other by ``turn`` (null first), then role and text; repeated rows count once; null roles and
    texts are empty. ``copies`` counts the conversations with exactly these turns. Other columns are ignored; no rows
    give no rows. A rendered conversation is one string, so it has to fit into a row.
    """
    numbered = numbered_turns(turns_of(conversations))
    kept = materialize(maximal(prefix_hashes(numbered)), "maximal")
    turns = numbered.select("conv_id", "pos", rendered_turn(F.col("role"), F.col("text")).alias("turn")).join(kept, "conv_id")
    joined = turns.groupBy("conv_id", F.col("n").alias("n_turns"), "copies").agg(F.array_sort(F.collect_list(F.struct("pos", "turn"))).alias("parts"))
    return joined.select("conv_id", "n_turns", "copies", F.array_join(F.col("parts.turn"), "").alias("rendered"))
