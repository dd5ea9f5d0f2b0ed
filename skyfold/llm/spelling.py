"""Spelling variants: words that differ by one letter, found in tries over letter-group counts.

Words become vectors: how often they hold letters of each group of ``GROUPS``. One inserted, deleted or replaced letter
changes the vector by a surplus of at most one and a deficit of at most one. A trie arranges the words by the counts of
successive groups; a depth-first search follows, for each word, the branches with an equal count, one more while
the surplus is unspent, and one fewer while the deficit is. What arrives at a leaf is verified letter by letter.

*Distribution.* The groups form four blocks. An edit changes two groups at most, so two near words agree on all counts
of two blocks at least. Each word goes into six tries, one that begins with each two blocks; the counts of these are the
key that Spark deals tries out by, and the search inside begins below it. A pair counts in the first trie that it meets
in. Tries of more than ``PIECE`` words are dealt over pairs of pieces, so a task never holds more than two pieces of a trie.
Pairs are summed up by word where they are found; no list of pairs is made.

Counting words is plain Spark: runs are exploded and summed by task before they are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from skyfold.session import discard, materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN_RUNS = "[^A-Za-zÀ-ÿ]+"
#: One run in so many is edited.
EVERY = 97
SHORTEST, FEWEST = 5, 3
#: A form has at least so many times the word's occurrences.
RATIO = 2
#: Letter groups in four blocks of about equal use; letters beyond ASCII are dealt by their code.
GROUPS = (("e", "h", "r", "fq", "gz"), ("t", "s", "d", "wk", "yx"), ("a", "n", "l", "m", "pv"), ("o", "i", "c", "u", "bj"))
TRIES = list(combinations(range(len(GROUPS)), 2))
BEYOND = [chr(c) for c in range(0xC0, 0x100)]
PIECE = 8192
#: Pairs of rows and searching words that are compared at once.
AT_ONCE = 1 << 18
LONGEST = 48


def _codes() -> tuple[str, str, list[str]]:
    """Letters, the code letter of each one's group, and the codes of each block."""
    letters, codes, blocks = "", "", []
    for b, groups in enumerate(GROUPS):
        members = [*groups, "".join(c for c in BEYOND if ord(c) % len(GROUPS) == b)]
        blocks.append("".join(chr(ord("A") + len(members) * b + k) for k in range(len(members))))
        for group, code in zip(members, blocks[-1], strict=True):
            letters, codes = letters + group, codes + code * len(group)
    return letters, codes, blocks


LETTERS, CODES, BLOCKS = _codes()
ALL_CODES = "".join(BLOCKS)
COLUMNS = [[ALL_CODES.index(c) for c in block] for block in BLOCKS]


def runs_of(text: Column) -> Column:
    """Maximal runs of letters; null has none, and an empty string may stand at either end."""
    return F.split(F.coalesce(text.cast("string"), F.lit("")), BETWEEN_RUNS)


def lowered(run: Column) -> Column:
    return F.when(F.octet_length(run) == F.char_length(run), F.lower(run)).otherwise(F.translate(run, UPPER, LOWER))


def word_counts(docs: DataFrame) -> DataFrame:
    """``(word, n)``, written: the results of all runs, at least ``SHORTEST`` letters and ``FEWEST`` occurrences.

    A run whose CRC-32 of ``<doc_id>:<run>`` is a multiple of ``EVERY`` loses one letter. A null id counts as the
    empty text in front of the colon.
    """
    doc_id = F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit(""))
    runs = docs.select(doc_id.alias("doc_id"), F.explode(runs_of(F.col("text"))).alias("run")).select("doc_id", lowered(F.col("run")).alias("run"))
    long_enough = runs.where(F.char_length("run") >= SHORTEST)
    h = F.crc32(F.concat("doc_id", F.lit(":"), "run").cast("binary"))
    hashed = long_enough.select("run", h.alias("h"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.char_length("run")))
    word = F.when(F.col("h") % EVERY == 0, cut).otherwise(F.col("run"))
    counted = hashed.select(word.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return materialize(counted.where((F.col("n") >= FEWEST) & (F.char_length("word") >= SHORTEST)), "words")


def placed(words: DataFrame) -> DataFrame:
    """``trie, key, word, codes, n``: each word once for each two blocks, ``key`` their sorted codes."""
    coded = words.withColumn("codes", F.translate("word", LETTERS, CODES))
    held = [F.array_join(F.array_sort(F.split(F.regexp_replace("codes", f"[^{block}]", ""), "")), "").alias(f"b{k}") for k, block in enumerate(BLOCKS)]
    keys = [F.struct(F.lit(t).alias("trie"), F.concat(f"b{a}", F.lit("-"), f"b{b}").alias("key")) for t, (a, b) in enumerate(TRIES)]
    return coded.select("word", "codes", "n", *held).select("word", "codes", "n", F.inline(F.array(*keys)))


def count_vectors(codes: list[str]) -> np.ndarray:
    """How often each word holds each group, one row for each word; counts end at 255."""
    flat = np.frombuffer("".join(codes).encode("ascii"), np.uint8) - ord(ALL_CODES[0])
    row = np.repeat(np.arange(len(codes)), [len(c) for c in codes])
    found = np.bincount(row * len(ALL_CODES) + flat, minlength=len(codes) * len(ALL_CODES))
    return np.minimum(found, 255).astype(np.uint8).reshape(len(codes), len(ALL_CODES))


def packed(vectors: np.ndarray) -> np.ndarray:
    """One 64-bit word for each vector: each count as so many set bits, clipped where it does not fit.

    The bits of one word that another does not have number its surplus, or less where counts were clipped.
    """
    room = 64 // vectors.shape[1]
    held = (1 << np.minimum(vectors, room).astype(np.uint64)) - np.uint64(1)
    return np.bitwise_or.reduce(held << (room * np.arange(vectors.shape[1])).astype(np.uint64), axis=1)


class Trie:
    """Vectors in the order of their successive counts: a node is a range of rows that agree on the counts so far."""

    def __init__(self, vectors: np.ndarray):
        self.order = np.lexsort(vectors.T[::-1])
        self.rows = vectors[self.order]
        self.bits = packed(self.rows)

    def near(self, queries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs ``(query, row)`` of places, in parts: all within a surplus and a deficit of one each, and few others."""
        asked_bits = packed(queries)
        stack = [(0, len(self.rows), 0, np.arange(len(queries)), np.ones(len(queries), bool), np.ones(len(queries), bool))]
        while stack:
            lo, hi, level, who, surplus, deficit = stack.pop()
            if not len(who) or lo == hi:
                continue
            if (hi - lo) * len(who) <= AT_ONCE or level == self.rows.shape[1]:
                step = max(1, AT_ONCE // (hi - lo))
                for at in range(0, len(who), step):
                    asked, there = asked_bits[who[at : at + step], None], self.bits[None, lo:hi]
                    change = asked ^ there
                    q, r = np.nonzero((np.bitwise_count(change & there) <= 1) & (np.bitwise_count(change & asked) <= 1))
                    yield who[at + q], self.order[lo + r]
                continue
            column, asked = self.rows[lo:hi, level], queries[who, level]
            counts, begins = np.unique(column, return_index=True)
            for count, a, b in zip(counts.tolist(), begins.tolist(), [*begins[1:].tolist(), hi - lo], strict=True):
                same, more, fewer = asked == count, (asked == count - 1) & surplus, (asked == count + 1) & deficit
                ok = same | more | fewer
                stack.append((lo + a, lo + b, level + 1, who[ok], (surplus & ~more)[ok], (deficit & ~fewer)[ok]))


def letter_matrix(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of words from the left and their lengths; columns end at ``LONGEST``."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    wide = min(LONGEST, int(lengths.max(initial=1)))
    return np.array([w[:wide].encode("latin-1") for w in words], f"S{wide}").view(np.uint8).reshape(len(words), wide), lengths


def one_edit(a: str, b: str) -> bool:
    """Whether one inserted, deleted or replaced letter makes ``b`` of ``a``."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[k + (len(a) >= len(b)) :] == b[k + (len(b) >= len(a)) :]


def verified(words: list[str], left: np.ndarray, lengths: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether the words ``i`` and ``j``, ``j`` not shorter, differ by one letter."""
    ok = np.zeros(len(i), bool)
    gap = lengths[j] - lengths[i]
    long = lengths[j] > left.shape[1]
    for at in np.flatnonzero(long).tolist():
        ok[at] = one_edit(words[i[at]], words[j[at]])
    short = np.flatnonzero(~long & (gap <= 1) & (gap >= 0))
    for at in range(0, len(short), AT_ONCE):
        s = short[at : at + AT_ONCE]
        a, b, n = left[i[s]], left[j[s]], lengths[i[s]]
        differ = a != b
        # The first place where they differ; what follows must agree, one place later in the longer word.
        first = np.where(differ.any(axis=1), differ.argmax(axis=1), a.shape[1])
        behind = np.arange(a.shape[1]) > first[:, None]
        replaced = ~(differ & behind).any(axis=1) & (first < n)
        moved = np.concatenate((b[:, 1:], np.zeros((len(b), 1), np.uint8)), axis=1)
        inserted = ~((a != moved) & (behind | (np.arange(a.shape[1]) == first[:, None])) & (np.arange(a.shape[1]) < n[:, None])).any(axis=1)
        ok[s] = np.where(gap[s] == 0, replaced, inserted)
    return ok


FOUND = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("form", pa.string()), ("form_n", pa.int64())])


def summed(words: list[str], counts: np.ndarray, own: np.ndarray, other: np.ndarray) -> dict:
    """For each word of the pairs: number of near words, and the one of the largest count, smallest in code points."""
    by_word = np.argsort(np.argsort(np.array(words, object), kind="stable"), kind="stable")
    order = np.lexsort((by_word[other], -counts[other], own))
    own, other = own[order], other[order]
    firsts = np.flatnonzero(np.append(True, own[1:] != own[:-1])) if len(own) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(firsts, len(own)))
    return {"word": [words[k] for k in own[firsts].tolist()], "n_near": sizes, "form": [words[k] for k in other[firsts].tolist()], "form_n": counts[other[firsts]]}


def _whole(block: np.ndarray) -> np.ndarray:
    """The counts of a block as one number."""
    out = np.zeros((len(block), 8), np.uint8)
    out[:, : block.shape[1]] = block
    return out.view("<u8")[:, 0]


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs of each group of a partition that is sorted by group."""
    for (trie, _, first, second), group in _grouped(batches, ["trie", "key", "i", "j"]):
        words, codes, counts = group.column("word").to_pylist(), group.column("codes").to_pylist(), group.column("n").to_numpy()
        piece = group.column("own").to_numpy()
        if len(words) < 2:
            continue
        vectors = count_vectors(codes)
        one, two = TRIES[trie]
        left, lengths = letter_matrix(words)
        rows, asking = (np.flatnonzero(piece == p) for p in (first, second))
        below = vectors[:, [c for k, block in enumerate(COLUMNS) if k not in (one, two) for c in block]]
        earlier = [_whole(vectors[:, COLUMNS[k]]) for k in range(two) if k != one]
        pairs = []
        for q, r in Trie(below[rows]).near(below[asking]):
            i, j = asking[q], rows[r]
            once = i < j if first == second else np.ones(len(i), bool)
            for block in earlier:
                once &= block[i] != block[j]
            i, j = i[once], j[once]
            i, j = np.where(lengths[i] <= lengths[j], i, j), np.where(lengths[i] <= lengths[j], j, i)
            near = verified(words, left, lengths, i, j)
            pairs += [(i[near], j[near])]
        i, j = (np.concatenate([p[k] for p in pairs]) if pairs else np.zeros(0, np.int64) for k in (0, 1))
        if len(i):
            found = summed(words, counts, np.concatenate((i, j)), np.concatenate((j, i)))
            yield pa.RecordBatch.from_arrays([pa.array(found[f.name], f.type) for f in FOUND], schema=FOUND)


def _grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """Groups of rows with equal keys, whole, from batches that are sorted by them."""
    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_pylist() for k in keys]
        rows = list(zip(*columns, strict=True))
        starts = [0, *[k for k in range(1, len(rows)) if rows[k] != rows[k - 1]], len(rows)]
        for a, b in zip(starts, starts[1:]):
            if held and rows[a] != last:
                yield last, pa.Table.from_batches(held)
                held = []
            held, last = [*held, batch.slice(a, b - a)], rows[a]
    if held:
        yield last, pa.Table.from_batches(held)


def near_words(words: DataFrame) -> DataFrame:
    """``(word, n_near, form, form_n)`` for the words that have near words; ``form`` is the near word of largest count."""
    tries = placed(words)
    sizes = tries.groupBy("trie", "key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    dealt = tries.join(sizes, ["trie", "key"]).withColumn("pieces", F.ceil(F.col("members") / PIECE).cast("int"))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("word"), F.col("pieces")).cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("pieces") - 1), lambda s: F.struct(F.least(s, "own").alias("i"), F.greatest(s, "own").alias("j")))
    groups = dealt.select("trie", "key", "word", "codes", "n", "own", F.inline(pairs))
    sorted_groups = groups.repartition("trie", "key", "i", "j").sortWithinPartitions("trie", "key", "i", "j")
    found = sorted_groups.mapInArrow(_search, "word string, n_near long, form string, form_n long")
    best = F.min(F.struct((-F.col("form_n")).alias("order"), F.col("form").alias("form")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select("word", "n_near", F.col("b.form").alias("form"), (-F.col("b.order")).alias("form_n"))


def last_forms(forms: DataFrame) -> DataFrame:
    """``(word, root)`` for ``forms(word, form)``: where following forms ends. Each round doubles the steps taken."""
    now = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = now.join(onward, "root", "left")
        following = materialize(joined.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        discard(now)
        now = following.drop("moved")
        if following.where("moved").isEmpty():
            return now


def variants(docs: DataFrame) -> DataFrame:
    """Every word of ``docs(doc_id, text)`` with its form and root: ``word, form, root, n, n_near, form_n``.

    The form is the near word of largest count (ties: the first in code points) if that is at least ``RATIO`` times the
    word's own count, else null; the root is where following forms ends, the word itself without a form. Null, empty
    and letterless texts have no words; repeated rows count again; other columns are ignored; no rows give no rows.
    """
    words = word_counts(docs)
    near = materialize(words.join(near_words(words), "word", "left"), "near-words")
    fits = F.col("form_n") >= RATIO * F.col("n")
    known = near.select("word", F.when(fits, F.col("form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(fits, F.col("form_n")).alias("form_n"))
    roots = last_forms(known.where("form IS NOT NULL"))
    return known.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
