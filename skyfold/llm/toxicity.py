"""Toxicity from class-conditional Kneser-Ney models.

Words are spelled by a character model of order ``ORDER``: a word's likelihood is the product over its characters,
each given the characters before it in the word. There is one model for toxic and one for ordinary text. Their
highest order counts documents of the class; below it both use the same backoff chain, the Kneser-Ney continuation
counts of the whole corpus, so a rare expression costs both models the same and says little.

1. One pass over all documents counts, for each word, the documents that use it: all of them, and the toxic and the
   ordinary ones of the labelled sample. Each task adds up its own documents before the shuffle.
2. Words become character n-grams, pre-added by task; the chain and the log ratio of each n-gram are joins of
   n-gram tables.
3. All n-grams of the labelled sample go to the workers, the most telling ``MODEL_GRAMS`` as a dictionary, the others as
   sorted arrays. A second pass over all documents compares the
   length-normalised log-likelihoods: over the whole text, and over the words that differ most (a share of the length).
4. A logistic curve through these, fitted on labelled rows that the counts left out, gives the score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Mapping
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from skyfold.llm.common import Bounded, fold, label_of, per_batch, sampled_labels, texts
from skyfold.session import materialize

ORDER = 5
DISCOUNT = 0.75
FOLDS = 5
HELD_OUT, CALIBRATION = 0, 4
#: Bounds of the labelled rows that the class counts and the curve are fitted on.
COUNT_ROWS, CURVE_ROWS = 60_000, 20_000
#: N-grams (and histories) that workers hold in a dictionary, the most telling; the others are looked up in sorted arrays.
MODEL_GRAMS = 400_000
FLUSH = 400_000
TOP_SHARES = (0.02, 0.01)
WORD = re.compile(r"[^\W_]+")
#: Curve without labelled rows to fit it: a word that is e^4 times likelier in toxic text is on the edge.
PRIOR = np.array([0.0, 1.0, 0.0, -4.0])


def grams(word: str) -> list[str]:
    """Character n-grams that spell the word, from its start to its end mark."""
    marked = "^" * (ORDER - 1) + word + "$"
    return [marked[k : k + ORDER] for k in range(len(word) + 1)]


def added_up(emit, names: list[str]):
    """Function for ``mapInArrow`` that adds up the keyed counts ``emit`` takes from each batch before it gives them on."""
    schema = pa.schema([("item", pa.string())] + [(n, pa.int64()) for n in names])

    def flush(counters: list[Counter]) -> pa.RecordBatch:
        keys = list(counters[0])
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.string())] + [pa.array([c[k] for k in keys], pa.int64()) for c in counters], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = [Counter() for _ in names]
        for batch in batches:
            for _ in emit(batch, counters):
                if len(counters[0]) >= FLUSH:
                    yield flush(counters)
                    counters = [Counter() for _ in names]
        if counters[0]:
            yield flush(counters)

    return run, "item string, " + ", ".join(f"{n} long" for n in names)


def word_counts(docs: DataFrame, known: np.ndarray, labels: np.ndarray) -> DataFrame:
    """``(item, n, ordinary, toxic)``: documents with each word."""

    def emit(batch: pa.RecordBatch, counters: list[Counter]):
        marks = label_of(batch.column("doc_id"), known, labels).tolist()
        for text, mark in zip(texts(batch.column("text")), marks, strict=True):
            words = set(WORD.findall(text.lower()))
            counters[0].update(words)
            if mark >= 0:
                counters[1 + mark].update(words)
            yield

    run, kind = added_up(emit, ["n", "ordinary", "toxic"])
    counted = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, kind)
    return counted.groupBy("item").agg(*[F.sum(c).alias(c) for c in ("n", "ordinary", "toxic")])


def gram_counts(words: DataFrame) -> DataFrame:
    """``(item, n, ordinary, toxic)``: counts of the n-grams that spell the words."""

    def emit(batch: pa.RecordBatch, counters: list[Counter]):
        columns = [batch.column(c).to_pylist() for c in ("item", "n", "ordinary", "toxic")]
        all_, ordinary, toxic = counters
        for word, n, o, t in zip(*columns, strict=True):
            for g in grams(word):
                all_[g] += n
                if o:
                    ordinary[g] += o
                if t:
                    toxic[g] += t
            yield

    run, kind = added_up(emit, ["n", "ordinary", "toxic"])
    return words.mapInArrow(run, kind).groupBy("item").agg(*[F.sum(c).alias(c) for c in ("n", "ordinary", "toxic")])


def _head(gram: Column) -> Column:
    return F.substr(gram, F.lit(1), F.length(gram) - 1)


def _tail(gram: Column) -> Column:
    return F.substr(gram, F.lit(2))


def backoff_chain(grams_: DataFrame) -> DataFrame:
    """``(item, p)``: Kneser-Ney probabilities of the (ORDER - 1)-grams from continuation counts, interpolated down."""
    levels, upper = [], grams_.select("item")
    for _ in range(ORDER - 1):
        upper = materialize(upper.groupBy(_tail(F.col("item")).alias("item")).agg(F.count(F.lit(1)).alias("c")), "continuations")
        levels.append(upper)
    types = levels[-1].count()
    lower: DataFrame | None = None
    for level in reversed(levels):
        counted = level.withColumn("h", _head(F.col("item")))
        totals = counted.groupBy("h").agg(F.sum("c").alias("total"), F.count(F.lit(1)).alias("kinds"))
        joined = counted.join(totals, "h")
        if lower is None:
            joined = joined.withColumn("below", F.lit(1.0 / (types + 1)))
        else:
            joined = joined.withColumn("tail", _tail(F.col("item"))).join(lower.select(F.col("item").alias("tail"), F.col("p").alias("below")), "tail")
        p = F.greatest(F.col("c") - DISCOUNT, F.lit(0.0)) / F.col("total") + DISCOUNT * F.col("kinds") / F.col("total") * F.col("below")
        lower = joined.select("item", p.alias("p"))
    return lower


def log_ratios(counted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(item, ratio, weight)`` of the n-grams that a class has seen, and ``(item, ratio, weight)`` of their histories.

    The ratio is log P(toxic) - log P(ordinary); a history's stands for every n-gram that neither class has seen.
    """
    stored = materialize(counted, "grams")
    seen = stored.withColumn("h", _head(F.col("item")))
    per_class = [F.sum(c).alias(f"total_{c}") for c in ("ordinary", "toxic")] + [F.sum((F.col(c) > 0).cast("long")).alias(f"kinds_{c}") for c in ("ordinary", "toxic")]
    histories = seen.groupBy("h").agg(*per_class).where("total_ordinary + total_toxic > 0")

    def left_over(c: str) -> Column:
        return F.when(F.col(f"total_{c}") > 0, DISCOUNT * F.col(f"kinds_{c}") / F.col(f"total_{c}")).otherwise(F.lit(1.0))

    def probability(c: str) -> Column:
        own = F.when(F.col(f"total_{c}") > 0, F.greatest(F.col(c) - DISCOUNT, F.lit(0.0)) / F.col(f"total_{c}")).otherwise(F.lit(0.0))
        return own + left_over(c) * F.col("p")

    unseen = F.ln(left_over("toxic") / left_over("ordinary"))
    heads = histories.select(F.col("h").alias("item"), unseen.alias("ratio"), F.abs(unseen).alias("weight"))
    tails = backoff_chain(stored).select(F.col("item").alias("tail"), "p")
    used = seen.where("ordinary + toxic > 0").withColumn("tail", _tail(F.col("item"))).join(tails, "tail").join(histories, "h")
    ratio = F.ln(probability("toxic") / probability("ordinary"))
    return used.select("item", ratio.alias("ratio"), F.abs(ratio - unseen).alias("weight")), heads


class Ratios(Mapping):
    """Log ratios by n-gram: the most telling in a dictionary, all others in sorted arrays."""

    def __init__(self, telling: dict[str, float], grams_: np.ndarray, values: np.ndarray):
        order = np.argsort(grams_)
        self.telling, self.grams, self.values = telling, grams_[order], values[order]

    def __len__(self) -> int:
        return len(self.telling) + len(self.grams)

    def __iter__(self) -> Iterator[str]:
        return chain(self.telling, self.grams.tolist())

    def __getitem__(self, gram: str) -> float:
        found = self.get(gram)
        if found is None:
            raise KeyError(gram)
        return found

    def get(self, gram: str, missing: float | None = None) -> float | None:
        found = self.telling.get(gram)
        if found is None and len(self.grams):
            k = int(np.searchsorted(self.grams, gram))
            if k < len(self.grams) and self.grams[k] == gram:
                return float(self.values[k])
        return missing if found is None else found


def _ratios(rows: DataFrame, most: int) -> Ratios:
    """Every row's ratio; ``most`` of them at most, those of largest weight, in the dictionary."""
    stored = materialize(rows, "ratios")
    n = stored.count()
    telling = F.lit(True)
    if n > most:
        telling = F.coalesce(F.col("weight") > stored.approxQuantile("weight", [1 - most / n], 1e-3)[0], F.lit(False))
    first = stored.where(telling).select("item", "ratio").toArrow()
    others = stored.where(~telling).select("item", "ratio").toArrow()
    items = np.concatenate([np.empty(0, f"U{ORDER}"), *(np.array(c.to_pylist(), f"U{ORDER}") for c in others["item"].chunks)])
    values = dict(zip(first["item"].to_pylist(), np.round(first["ratio"].to_numpy(), 6).tolist(), strict=True))
    return Ratios(values, items, np.round(others["ratio"].to_numpy().astype(float), 6))


def fit_ratios(docs: DataFrame, known: np.ndarray, labels: np.ndarray) -> tuple[Ratios, Ratios]:
    """The model: log ratios of all n-grams and histories that the labelled sample has."""
    words = materialize(word_counts(docs, known, labels), "words")
    grams_, heads = log_ratios(gram_counts(words))
    return _ratios(grams_, MODEL_GRAMS), _ratios(heads, MODEL_GRAMS)


def word_ratio(word: str, grams_: Ratios, heads: Ratios) -> float:
    total = 0.0
    for g in grams(word):
        ratio = grams_.get(g)
        total += heads.get(g[:-1], 0.0) if ratio is None else ratio
    return total


def compared(words: list[str], ratios) -> list[float]:
    """Log-likelihood ratio per character, and per word over the top shares of the length; a text without words has zeros."""
    if not words:
        return [0.0] * (1 + len(TOP_SHARES))
    values = np.array([ratios[w] for w in words])
    length = sum(map(len, words)) + len(words)
    tops = []
    for share in TOP_SHARES:
        k = max(1, round(len(values) * share))
        tops.append(float(np.partition(values, len(values) - k)[-k:].mean()))
    return [float(values.sum()) / length, *tops]


def features(docs: DataFrame, grams_: Ratios, heads: Ratios) -> DataFrame:
    """``(doc_id, f0, f1, f2)`` of every row."""
    names = [f"f{k}" for k in range(1 + len(TOP_SHARES))]
    schema = pa.schema([("doc_id", pa.int64())] + [(n, pa.float64()) for n in names])
    model = docs.sparkSession.sparkContext.broadcast((grams_, heads))

    def batch_features(batch: pa.RecordBatch) -> dict:
        ratios = word_ratios(model)
        rows = np.array([compared(WORD.findall(t.lower()), ratios) for t in texts(batch.column("text"))])
        return {"doc_id": batch.column("doc_id")} | {n: rows[:, k] for k, n in enumerate(names)}

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(per_batch(batch_features, schema), "doc_id long, " + ", ".join(f"{n} double" for n in names))


_kept: list = []


def word_ratios(model) -> Bounded:
    """The worker's word ratios under a broadcast model; only the last model's are kept."""
    value = model.value
    if not _kept or _kept[0] is not value:
        grams_, heads = value
        _kept[:] = [value, Bounded(lambda w: word_ratio(w, grams_, heads))]
    return _kept[1]


def fit_curve(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic weights (the last one is the constant) by Newton steps; ``PRIOR`` unless both classes occur."""
    if len(set(y.tolist())) < 2:
        return PRIOR
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.c_[(x - mean) / scale, np.ones(len(x))]
    w = np.zeros(z.shape[1])
    ridge = 0.1 * np.eye(len(w))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        w = w + np.linalg.solve(z.T @ (z * (p * (1 - p) + 1e-9)[:, None]) + ridge, z.T @ (y - p) - ridge @ w)
    return np.append(w[:-1] / scale, w[-1] - (w[:-1] * mean / scale).sum())


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every row of ``docs`` with its score: ``doc_id, held_out, score, predicted``.

    Labels of the held-out fold are never read. Null and wordless texts score like a text without evidence. Rows that
    repeat a ``doc_id`` are scored each by its text; a null ``doc_id`` is scored and not held out. Without labels of both
    classes a fixed curve stands in. Other columns are ignored; no rows give no rows.
    """
    part = fold(F.col("doc_id"), FOLDS)
    known, marks = sampled_labels(labels, "toxic", ~part.isin(HELD_OUT, CALIBRATION), COUNT_ROWS)
    scored = materialize(features(docs, *fit_ratios(docs, known, marks)), "toxicity")
    curve_ids, curve_marks = sampled_labels(labels, "toxic", part == CALIBRATION, CURVE_ROWS)
    curve = docs.sparkSession.createDataFrame([(int(i), int(m)) for i, m in zip(curve_ids, curve_marks, strict=True)], "doc_id long, mark int")
    rows = scored.join(curve, "doc_id").toPandas()
    names = [c for c in scored.columns if c != "doc_id"]
    weights = fit_curve(rows[names].to_numpy(float), rows["mark"].to_numpy(float))
    logit = sum((F.lit(float(w)) * F.col(n) for w, n in zip(weights, names)), F.lit(float(weights[-1])))
    score = 1 / (1 + F.exp(-logit))
    return scored.select("doc_id", F.coalesce(part == HELD_OUT, F.lit(False)).alias("held_out"), score.alias("score"), (score >= 0.5).cast("int").alias("predicted"))
