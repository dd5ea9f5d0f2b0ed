"""Quality classifier: an additive model of binned features with pairwise interactions.

Features come from the whole text, once. The model is a lookup table per feature and one per chosen pair of
features, learned by cyclic boosting: feature after feature, round after round, a shallow tree over the bins of one
feature takes a small step against the logistic loss. Pairs are ranked by how much loss a four-way split of their
coarse bins would remove from what the single features leave, and the best get tables in the same way. A score
is a sum of table entries, added up for a batch of rows at once.

Only the fit sees a bounded sample of labelled rows (``SAMPLE_ROWS``); features and scores cover every row.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from skyfold.llm.common import fold, per_batch, sampled_labels, utf8
from skyfold.session import materialize

FOLDS, HELD_OUT = 3, 1
SAMPLE_ROWS = 30_000
BINS, COARSE_BINS = 48, 8
ROUNDS, RATE, LEAVES = 150, 0.15, 4
PAIRS, PAIR_ROUNDS = 6, 60
RIDGE = 1.0
LEAST_ROWS = 8

#: Frequent function words of the corpus languages, as UTF-8.
FUNCTION_WORDS = frozenset(
    "the of and to in is are that for be with on this by it as was an or from at he le la les de des du un une et en dans que qui pour par sur au "
    "der die das und den von zu mit sich auf für ist im dem nicht ein als el los las se con no su para es del y lo".encode().split()
)
UPPER = bytes(range(65, 91))
LOWER = bytes(range(97, 123))
DIGITS = bytes(range(48, 58))
STOPS = b".,;:?'\"()-"
SYMBOLS = bytes(c for c in range(33, 127) if c not in UPPER + LOWER + DIGITS + STOPS)
BLANKS = b" \t\r\n\x0b\x0c"
NAMES = [
    "log_bytes", "log_words", "word_length", "longest_word", "upper", "digits", "symbols", "stops", "exclaimed", "piped", "blanks", "function_words",
    "distinct_words", "repeated_lines", "words_per_line", "capitalised_words", "bare_words", "stopped_words",
]


def text_features(text: bytes) -> list[float]:
    """Features of one UTF-8 text by position in ``NAMES``; an empty text has zeros."""
    size = len(text)
    words = text.split()
    if not words:
        return [float(np.log1p(size))] + [0.0] * (len(NAMES) - 1)
    count = lambda kept: size - len(text.translate(None, kept))
    upper, blanks, n = count(UPPER), count(BLANKS), len(words)
    solid = size - blanks
    lines = [line for line in text.split(b"\n") if line.strip()]
    return [
        float(np.log1p(size)), float(np.log1p(n)), solid / n, float(np.log1p(max(map(len, words)))), upper / solid, count(DIGITS) / solid, count(SYMBOLS) / solid, count(STOPS) / solid,
        text.count(b"!") / n, text.count(b"|") / n, blanks / size, sum(w in FUNCTION_WORDS for w in text.lower().split()) / n,
        len(set(words)) / n, 1 - len(set(lines)) / len(lines), n / len(lines), upper / n, count(LOWER + BLANKS) / size, text.count(b".") / n,
    ]


def features(docs: DataFrame) -> DataFrame:
    """``doc_id`` and one double column per feature, for every row."""
    schema = pa.schema([("doc_id", pa.int64())] + [(n, pa.float64()) for n in NAMES])

    def batch_features(batch: pa.RecordBatch) -> dict:
        rows = np.array([text_features(t) for t in utf8(batch.column("text"))])
        return {"doc_id": batch.column("doc_id")} | {n: rows[:, k] for k, n in enumerate(NAMES)}

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(per_batch(batch_features, schema), "doc_id long, " + ", ".join(f"{n} double" for n in NAMES))


@dataclass
class AdditiveModel:
    """Cut points and a table of bin values per feature; coarse cut points and a table per pair."""

    constant: float
    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    coarse: list[np.ndarray]
    pair_tables: list[np.ndarray]

    def scores(self, x: np.ndarray) -> np.ndarray:
        logit = np.full(len(x), self.constant)
        for k, (cuts, table) in enumerate(zip(self.cuts, self.tables, strict=True)):
            logit += table[np.searchsorted(cuts, x[:, k], side="right")]
        if self.pairs:
            coarse = [np.searchsorted(cuts, x[:, k], side="right") for k, cuts in enumerate(self.coarse)]
            for (a, b), table in zip(self.pairs, self.pair_tables, strict=True):
                logit += table[coarse[a], coarse[b]]
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def _cut_points(values: np.ndarray, bins: int) -> np.ndarray:
    """Quantile cuts halfway between neighbouring values, so that a value near a cut is rare."""
    distinct = np.unique(values)
    inner = np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))
    at = np.searchsorted(distinct, inner)
    at = np.unique(at[(at > 0)])
    return (distinct[at - 1] + distinct[at]) / 2


def _gain(g, h):
    return g * g / (h + RIDGE)


def _tree_steps(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Newton step of each bin under the best tree of ``LEAVES`` leaves over ordered bins."""
    sums = [np.concatenate(([0.0], np.cumsum(v))) for v in (g, h, n)]

    def best_split(a: int, b: int) -> tuple[float, int]:
        at = np.arange(a + 1, b)
        if not len(at):
            return 0.0, 0
        left = [s[at] - s[a] for s in sums]
        right = [s[b] - s[at] for s in sums]
        gain = _gain(left[0], left[1]) + _gain(right[0], right[1]) - _gain(sums[0][b] - sums[0][a], sums[1][b] - sums[1][a])
        gain = np.where((left[2] >= LEAST_ROWS) & (right[2] >= LEAST_ROWS), gain, 0.0)
        k = int(gain.argmax())
        return float(gain[k]), int(at[k])

    leaves = [(0, len(g))]
    while len(leaves) < LEAVES:
        (gain, at), (a, b) = max((best_split(a, b), (a, b)) for a, b in leaves)
        if gain <= 1e-9:
            break
        leaves.remove((a, b))
        leaves += [(a, at), (at, b)]
    steps = np.empty(len(g))
    for a, b in leaves:
        steps[a:b] = (sums[0][b] - sums[0][a]) / (sums[1][b] - sums[1][a] + RIDGE)
    return steps


def _best_cross(g: np.ndarray, h: np.ndarray) -> tuple[float, int, int]:
    """Gain and place of the best split of a two-way table into four quarters."""
    cg, ch = (np.pad(v.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for v in (g, h))
    i, j = np.meshgrid(np.arange(1, g.shape[0]), np.arange(1, g.shape[1]), indexing="ij")
    total = 0.0
    for rows in ((0, i), (i, g.shape[0])):
        for columns in ((0, j), (j, g.shape[1])):
            part = [c[rows[1], columns[1]] - c[rows[0], columns[1]] - c[rows[1], columns[0]] + c[rows[0], columns[0]] for c in (cg, ch)]
            total = total + _gain(*part)
    if not np.size(total):
        return 0.0, 0, 0
    k = np.unravel_index(int(total.argmax()), total.shape)
    return float(total[k] - _gain(cg[-1, -1], ch[-1, -1])), int(i[k]), int(j[k])


def fit(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """Model of 0/1 labels; with no rows, or one class only, a constant that says as much."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    model = AdditiveModel(float(np.log(share / (1 - share))), [np.zeros(0)] * x.shape[1], [np.zeros(1)] * x.shape[1], [], [np.zeros(0)] * x.shape[1], [])
    if len(set(y.tolist())) < 2:
        return model
    model.cuts = [_cut_points(x[:, k], BINS) for k in range(x.shape[1])]
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    bins = [np.searchsorted(c, x[:, k], side="right") for k, c in enumerate(model.cuts)]
    sizes = [np.bincount(b, minlength=len(t)) for b, t in zip(bins, model.tables, strict=True)]
    logit = np.full(len(y), model.constant)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for k, (own, table) in enumerate(zip(bins, model.tables, strict=True)):
            if len(table) > 1:
                g, h = slopes()
                step = RATE * _tree_steps(np.bincount(own, g, len(table)), np.bincount(own, h, len(table)), sizes[k])
                table += step
                logit += step[own]
    model.coarse = [_cut_points(x[:, k], COARSE_BINS) for k in range(x.shape[1])]
    coarse = [np.searchsorted(c, x[:, k], side="right") for k, c in enumerate(model.coarse)]
    widths = [len(c) + 1 for c in model.coarse]

    def table_of(a: int, b: int, v: np.ndarray) -> np.ndarray:
        return np.bincount(coarse[a] * widths[b] + coarse[b], v, widths[a] * widths[b]).reshape(widths[a], widths[b])

    g, h = slopes()
    ranked = sorted(((_best_cross(table_of(a, b, g), table_of(a, b, h))[0], (a, b)) for a, b in combinations(range(x.shape[1]), 2)), reverse=True)
    model.pairs = [pair for gain, pair in ranked[:PAIRS] if gain > 0]
    model.pair_tables = [np.zeros((widths[a], widths[b])) for a, b in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for (a, b), table in zip(model.pairs, model.pair_tables, strict=True):
            g, h = slopes()
            tg, th = table_of(a, b, g), table_of(a, b, h)
            gain, i, j = _best_cross(tg, th)
            if gain <= 0:
                continue
            step = np.empty_like(table)
            for rows in (slice(0, i), slice(i, None)):
                for columns in (slice(0, j), slice(j, None)):
                    step[rows, columns] = RATE * tg[rows, columns].sum() / (th[rows, columns].sum() + RIDGE)
            table += step
            logit += step[coarse[a], coarse[b]]
    return model


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every row of ``docs`` with its score: ``doc_id, held_out, score, predicted``.

    Labels of the held-out fold are never read. Null texts count as empty and are scored like any other. Rows that
    repeat a ``doc_id`` are scored each by its text; a null ``doc_id`` is scored and not held out. Without labels
    the score is 0.5. Other columns are ignored; no rows give no rows.
    """
    stored = materialize(features(docs), "features")
    part = fold(F.col("doc_id"), FOLDS)
    ids, marks = sampled_labels(labels, "quality", part != HELD_OUT, SAMPLE_ROWS)
    known = docs.sparkSession.createDataFrame([(int(i), int(m)) for i, m in zip(ids, marks, strict=True)], "doc_id long, mark int")
    rows = stored.join(known, "doc_id").groupBy("doc_id", *NAMES).agg(F.max("mark").alias("mark")).orderBy("doc_id", *NAMES).toPandas()
    model = fit(rows[NAMES].to_numpy(float), rows["mark"].to_numpy(float))
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def batch_scores(batch: pa.RecordBatch) -> dict:
        x = np.stack([batch.column(n).to_numpy(zero_copy_only=False) for n in NAMES], axis=1)
        return {"doc_id": batch.column("doc_id"), "score": model.scores(x)}

    scored = stored.mapInArrow(per_batch(batch_scores, schema), "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(part == HELD_OUT, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``docs`` without those whose document is predicted to be of low quality.

    Of rows that repeat a ``doc_id``, all go if one is rejected; rows without an id are not looked up and stay.
    """
    rejected = quality(docs, labels).where("predicted = 0").select("doc_id").distinct()
    return docs.join(rejected, "doc_id", "left_anti").select(*docs.columns)
