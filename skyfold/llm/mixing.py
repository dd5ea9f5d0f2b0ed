"""Mixing sources to target weights by iterative proportional fitting.

Tokens are counted per cell (source, language, topic); the cells' weights are raked in turn to the target share of each
margin until all margins hold. The ratio of a cell's fitted to its own tokens, times the wanted size, is the expected
number of copies of each of its documents: the whole part is taken for certain, and the fraction is the calibrated
probability of one more copy. So the sample itself has the target margins, in expectation and without weights: cells
that are too large lose documents, and those that are too small repeat them, up to a stated number of epochs. The draw
hashes the ``doc_id``, so it is the same on every run and any cluster.

Counting adds up by task before the shuffle, so a source with a third of all rows is one row per task. Raking works on
the table of cells with grouped sums joined back, each sweep ending in a written table; its size follows the number
of cells and not the number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from skyfold.llm.common import fresh
from skyfold.session import discard, materialize

MARGINS = ("source", "lang", "topic")
#: Exponent of the default targets: 1 keeps the shares as they are, 0 makes all values of a margin equal.
TEMPER = 0.9
#: Size of the sample, as a part of all tokens.
SIZE = 1.0
#: Copies of a document at most; a cell that asks for more falls short, which :func:`margins` shows.
EPOCHS = 4
TOLERANCE = 1e-6
#: Targets that the cells cannot meet together settle at a table that sweeps no longer change by more than this.
SETTLED = 1e-7
CELLS_IN_A_TASK = 100_000
DRAWS = 1 << 40


def token_count(text: Column) -> Column:
    """Number of runs of non-blank characters; null has none."""
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(r"\S+")), F.lit(0)).cast("long")


def topic_of(text: Column) -> Column:
    """Topic of a text by its make-up: tables, code or markup, numbers, dialogue and prose, or none for blank texts."""
    whole = F.coalesce(text.cast("string"), F.lit(""))
    size = F.char_length(whole)
    share = lambda kept: F.try_divide(F.regexp_count(whole, F.lit(kept)), size)
    chosen = F.when(share(r"\|") > 0.02, "table").when(share(r"[{}<>=#$%&*\\\[\]]") > 0.03, "markup").when(share("[0-9]") > 0.1, "numbers").when(share(r'[!?"]') > 0.02, "dialogue").otherwise("prose")
    return F.when(F.trim(whole) == "", "none").otherwise(chosen)


def described(docs: DataFrame) -> DataFrame:
    """``doc_id, source, lang, topic, tokens`` of every row, written; null sources and languages are the value ''."""
    there = {c.lower() for c in docs.columns}
    named = [(F.coalesce(F.col(c).cast("string"), F.lit("")) if c in there else F.lit("")).alias(c) for c in ("source", "lang")]
    text = F.col("text")
    return materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"), *named, topic_of(text).alias("topic"), token_count(text).alias("tokens"), F.crc32(F.coalesce(text.cast("string"), F.lit("")).cast("binary")).alias("key")), "described")


def tempered_targets(cells: DataFrame, temper: float = TEMPER) -> DataFrame:
    """``(margin, value, share)``: each margin's token shares raised to ``temper`` and made to add up to 1."""
    parts = [cells.groupBy(F.lit(m).alias("margin"), F.col(m).alias("value")).agg(F.sum("tokens").alias("t")) for m in MARGINS]
    powers = parts[0].unionByName(parts[1]).unionByName(parts[2]).select("margin", "value", F.pow(F.col("t").cast("double"), F.lit(temper)).alias("w"))
    return powers.join(powers.groupBy("margin").agg(F.sum("w").alias("whole")), "margin").select("margin", "value", F.coalesce(F.try_divide("w", "whole"), F.lit(0.0)).alias("share"))


def _raked(cells: DataFrame, targets: DataFrame, margin: str) -> DataFrame:
    """Weights scaled so that ``margin`` has its target shares; values without a target get weight 0."""
    wanted = targets.where(F.col("margin") == margin).select(F.col("value").alias(margin), "share")
    have = cells.groupBy(margin).agg(F.sum("weight").alias("have"))
    factor = have.join(wanted, margin, "left").select(margin, F.when(F.col("have") > 0, F.coalesce("share", F.lit(0.0)) / F.col("have")).otherwise(F.lit(0.0)).alias("factor"))
    return cells.join(factor, margin).withColumn("weight", F.col("weight") * F.col("factor")).drop("factor")


def _deviation(cells: DataFrame, targets: DataFrame, margins: Sequence[str]) -> float:
    """Largest difference between a margin's share and its target."""
    parts = None
    for m in margins:
        have = cells.groupBy(F.col(m).alias("value")).agg(F.sum("weight").alias("have"))
        own = have.join(targets.where(F.col("margin") == m), "value", "full").select(F.abs(F.coalesce("have", F.lit(0.0)) - F.coalesce("share", F.lit(0.0))).alias("d"))
        parts = own if parts is None else parts.union(own)
    return parts.agg(F.max("d")).first()[0] or 0.0


def rake(cells: DataFrame, targets: DataFrame, margins: Sequence[str] = MARGINS, tolerance: float = TOLERANCE, settled: float = SETTLED) -> tuple[DataFrame, float]:
    """``cells`` (the margins and ``tokens``) with the fitted ``weight``, and the largest gap of a margin that is left.

    Ends when all margins hold within ``tolerance``. Targets that contradict each other on the cells there are never do:
    raking then ends when a sweep leaves the fitted table as it was, the last margin holds, and the gap tells how far
    the others are. A fit that is only slow still moves, and goes on. Cells without tokens, and values without a
    target, have weight 0.
    """
    whole, tasks = cells.agg(F.sum("tokens"), F.ceil(F.count(F.lit(1)) / CELLS_IN_A_TASK)).first()
    now = materialize(cells.withColumn("weight", F.col("tokens") / F.lit(float(max(whole or 0, 1)))), "cells")
    if not whole:
        return now, 0.0
    while True:
        following = now.coalesce(tasks).withColumn("_before", F.col("weight"))
        for m in margins:
            following = _raked(following, targets, m)
        following = materialize(following, "cells")
        discard(now)
        now = following.drop("_before")
        gap = _deviation(now.coalesce(tasks), targets, margins[:-1])
        moved = following.agg(F.max(F.abs(F.col("weight") - F.col("_before")))).first()[0]
        if gap <= tolerance or moved <= settled:
            return now, gap


def mixture(docs: DataFrame, targets: DataFrame | None = None, seed: int = 0, size: float = SIZE, epochs: int = EPOCHS) -> DataFrame:
    """Every row of ``docs`` with its share: ``doc_id, source, lang, topic, tokens, weight, expected, probability, copies``.

    ``weight`` is the row's token share after raking, ``expected`` the number of copies that gives it that share in a
    sample of ``size`` times all tokens, ``probability`` its fraction and ``copies`` what was drawn. ``targets(margin,
    value, share)`` default to tempered shares. A table without ``source`` or ``lang`` has the value '' there. Rows without
    tokens have weight 0 and one copy: they change no margin. Rows that repeat a ``doc_id`` are drawn together; rows
    without one are drawn by their text. No rows give no rows.
    """
    rows = described(docs)
    cells = materialize(rows.groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens")), "cells")
    wanted = materialize(tempered_targets(cells) if targets is None else targets, "targets")
    fitted, _ = rake(cells.where("tokens > 0"), wanted)
    whole = float(cells.agg(F.sum("tokens")).first()[0] or 1)
    ratio = fitted.select(*MARGINS, (F.col("weight") * F.lit(whole) / F.col("tokens")).alias("ratio"))
    joined = rows.join(ratio, list(MARGINS), "left").withColumn("ratio", F.coalesce("ratio", F.lit(0.0)))
    expected = F.when(F.col("tokens") == 0, F.lit(1.0)).otherwise(F.least(F.col("ratio") * F.lit(float(size)), F.lit(float(epochs))))
    placed = joined.withColumns({"weight": F.col("tokens") * F.col("ratio") / F.lit(whole), "expected": expected})
    drawn = F.pmod(F.xxhash64(F.coalesce("doc_id", "key"), F.lit(seed)), F.lit(DRAWS)) / F.lit(float(DRAWS))
    fraction = placed.withColumn("probability", F.col("expected") - F.floor("expected"))
    copies = (F.floor("expected") + (drawn < F.col("probability")).cast("long")).cast("int")
    return fraction.withColumn("copies", copies).select("doc_id", *MARGINS, "tokens", "weight", "expected", "probability", "copies", "key")


def margins(mixed: DataFrame) -> DataFrame:
    """``(margin, value, corpus, target, expected, reached)``: token shares before, wanted, in expectation and drawn.

    ``target`` is what raking reached. ``mixed`` comes from :func:`mixture` and should be a written table.
    """
    tokens = F.col("tokens").cast("double")
    sums = [F.sum(tokens).alias("corpus"), F.sum("weight").alias("target"), F.sum(tokens * F.col("expected")).alias("expected"), F.sum(tokens * F.col("copies")).alias("reached")]
    parts = [mixed.groupBy(F.lit(m).alias("margin"), F.col(m).alias("value")).agg(*sums) for m in MARGINS]
    whole = mixed.agg(*sums).withColumnsRenamed({c: f"_{c}" for c in ("corpus", "target", "expected", "reached")})
    joined = parts[0].unionByName(parts[1]).unionByName(parts[2]).join(whole, F.lit(True))
    share = lambda c: F.coalesce(F.try_divide(F.col(c), F.col(f"_{c}")), F.lit(0.0)).alias(c)
    return joined.select("margin", "value", share("corpus"), share("target"), share("expected"), share("reached"))


def sampled_documents(docs: DataFrame, targets: DataFrame | None = None, seed: int = 0, size: float = SIZE, epochs: int = EPOCHS) -> DataFrame:
    """The sample: rows of ``docs`` as often as the mixture takes them, with their columns as they are."""
    own, mark, times = fresh(docs, "_own_id"), fresh(docs, "_text_mark"), fresh(docs, "_copies")
    changed = mixture(docs, targets, seed, size, epochs).where("copies <> 1").select(F.col("doc_id").alias(f"{own}2"), F.col("key").alias(f"{mark}2"), F.col("copies").alias(times)).distinct()
    marked = docs.withColumns({own: F.col("doc_id").cast("long"), mark: F.crc32(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"))})
    met = F.col(own).eqNullSafe(F.col(f"{own}2")) & (F.col(mark) == F.col(f"{mark}2"))
    counted = marked.join(changed, met, "left").withColumn(times, F.coalesce(F.col(times), F.lit(1)))
    return counted.select(*docs.columns, F.explode(F.array_repeat(F.lit(1), F.col(times))).alias(own)).select(*docs.columns)
