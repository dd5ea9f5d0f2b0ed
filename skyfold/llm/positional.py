"""Benchmark decontamination with a positional inverted index, in DataFrame operations only.

The index holds one posting ``(term_id, doc, key, pos)`` for each occurrence of a term that some test window uses;
terms that no window uses are never looked up, so their postings are not stored. It is written once and read four times:

1. postings are counted by term; a window with a term that never occurs drops out, the others rank their terms from
   the rarest;
2. postings of the rarest and the second rarest term, moved back by their offsets in the window, give starts; starts
   in both lists survive (a grouped ``bit_or``, so no list is collected and a frequent term is just more rows);
3. the remaining terms of the survivors are expected at known places; they are joined with the postings of the
   documents in question, and a start is a match when every place holds its term;
4. proximity search works on the same table: other terms within a distance of the rarest one.

No step looks at pairs of documents. Documents are identified by ``doc`` (the ``doc_id``, null as 0) and ``key`` (a
hash of the text and of whether the id is null), so rows that repeat an id are searched each by its own text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from skyfold.llm.common import fresh
from skyfold.operators.ids import dense_ids
from skyfold.session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORDS = 10


def words_of(text: Column) -> Column:
    """Array of words: A-Z lower-cased, then runs of 0-9, a-z and characters beyond ASCII; null has none."""
    whole = F.coalesce(text.cast("string"), F.lit(""))
    ascii_only = F.octet_length(whole) == F.char_length(whole)
    lowered = F.when(ascii_only, F.lower(whole)).otherwise(F.translate(whole, UPPER, LOWER))
    return F.array_remove(F.split(lowered, BETWEEN_WORDS), "")


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id, doc, key, text`` of every row; other columns go."""
    doc_id, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    key = F.hash(F.coalesce(text, F.lit("")), doc_id.isNull())
    return docs.select(doc_id.alias("doc_id"), F.coalesce(doc_id, F.lit(0)).alias("doc"), key.alias("key"), text.alias("text"))


def windows_of(items: DataFrame, size: int = WORDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Distinct word windows of ``items(item_id, text)``.

    Returns ``(window_id, item_id)``, ``(window_id, n, offset, term_id)`` and ``(term, term_id)``, all written. An
    item of fewer words than ``size`` is one window; one without words has none. Items that share windows or repeat
    are listed side by side; an item whose id is null has windows but no name.
    """
    split = items.select(F.col("item_id"), words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
    last = F.greatest(F.size("words") - size, F.lit(0))
    slices = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice("words", i + 1, size))
    found = split.select("item_id", F.explode(slices).alias("words")).distinct()
    numbered = materialize(dense_ids(found, ["words"], "window_id"), "windows")
    parts = numbered.select("window_id", "words").distinct().select("window_id", F.size("words").alias("n"), F.posexplode("words").alias("offset", "term"))
    terms = materialize(dense_ids(parts.select("term").distinct(), ["term"], "term_id").select("term", F.col("term_id").cast("int")), "terms")
    return numbered.select("window_id", "item_id"), materialize(parts.join(terms, "term").drop("term"), "window-terms"), terms


def build_index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Written postings ``(term_id, doc, key, pos)`` of all ``terms`` in all rows of ``docs``, whole texts."""
    spread = keyed(docs).select("doc", "key", F.posexplode(words_of(F.col("text"))).alias("pos", "term"))
    return materialize(spread.join(terms, "term").select("term_id", "doc", "key", "pos"), "postings")


def rarest_first(index: DataFrame, window_terms: DataFrame) -> DataFrame:
    """``window_terms`` with ``rank`` 1, 2, ... by ascending number of postings, of windows whose terms all occur."""
    counted = window_terms.join(index.groupBy("term_id").agg(F.count(F.lit(1)).alias("postings")), "term_id")
    own = W.partitionBy("window_id")
    ranked = counted.withColumn("rank", F.row_number().over(own.orderBy("postings", "offset"))).withColumn("present", F.count(F.lit(1)).over(own))
    return materialize(ranked.where("present = n").drop("present"), "plan")


def phrase_matches(index: DataFrame, window_terms: DataFrame) -> DataFrame:
    """``(window_id, n, doc, key, start)``: every place where a window's words follow each other."""
    plan = rarest_first(index, window_terms)
    lists = index.join(plan.where("rank <= 2"), "term_id").select("window_id", "n", "doc", "key", (F.col("pos") - F.col("offset")).alias("start"), "rank")
    met = lists.groupBy("window_id", "n", "doc", "key", "start").agg(F.bit_or("rank").alias("seen"))
    alive = materialize(met.where((F.col("n") == 1) | (F.col("seen") == 3)).drop("seen"), "starts")
    rest = plan.where("rank > 2").select("window_id", "offset", "term_id")
    expected = alive.where("n > 2").join(rest, "window_id").select("window_id", "n", "doc", "key", "start", (F.col("start") + F.col("offset")).alias("pos"), "term_id")
    wanted = materialize(alive.where("n > 2").select("doc", "key").distinct(), "candidates")
    nearby = index.join(wanted, ["doc", "key"], "left_semi")
    held = expected.join(nearby, ["doc", "key", "pos", "term_id"], "left_semi")
    whole = held.groupBy("window_id", "n", "doc", "key", "start").agg(F.count(F.lit(1)).alias("held")).where("held = n - 2").drop("held")
    return alive.where("n <= 2").unionByName(whole)


def proximity_matches(index: DataFrame, window_terms: DataFrame, within: int) -> DataFrame:
    """``(window_id, doc, key, pos)``: places of a window's rarest term with all its terms at most ``within`` words away."""
    plan = rarest_first(index, window_terms)
    needed = plan.groupBy("window_id").agg(F.countDistinct("term_id").alias("needed"))
    anchors = index.join(plan.where("rank = 1").select("window_id", "term_id"), "term_id").select("window_id", "doc", "key", F.col("pos").alias("at")).distinct()
    cell = F.explode(F.sequence(F.floor((F.col("at") - within) / (within + 1)), F.floor((F.col("at") + within) / (within + 1))))
    sought = anchors.withColumn("cell", cell).join(plan.select("window_id", "term_id").distinct(), "window_id")
    met = sought.join(index.withColumn("cell", F.floor(F.col("pos") / (within + 1))), ["doc", "key", "term_id", "cell"]).where(F.abs(F.col("pos") - F.col("at")) <= within)
    counted = met.groupBy("window_id", "doc", "key", "at").agg(F.countDistinct("term_id").alias("seen"))
    return counted.join(needed, "window_id").where("seen = needed").select("window_id", "doc", "key", F.col("at").alias("pos"))


def covered(spans: Column) -> Column:
    """Number of places in a set of ``(begin, end)`` spans."""
    start = F.struct(F.lit(0).alias("upto"), F.lit(0).cast("long").alias("n"))
    step = lambda acc, s: F.struct(F.greatest(acc.upto, s.end).alias("upto"), (acc.n + F.greatest(s.end - F.greatest(acc.upto, s.begin), F.lit(0))).alias("n"))
    return F.aggregate(F.array_sort(spans), start, step, lambda acc: acc.n)


def contamination(docs: DataFrame, items: DataFrame, size: int = WORDS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_hit, item_ids, contaminated``.

    A document word inside any occurrence of a test window is hit. ``item_ids`` lists the items with occurring
    windows as strings, in order. Null and wordless texts have no words and no hits; without items nothing is hit;
    without documents there are no rows. Rows that repeat a ``doc_id``, or have none, get their own results.
    """
    window_items, window_terms, terms = windows_of(items, size)
    index = build_index(docs, terms)
    matches = phrase_matches(index, window_terms)
    span = F.struct(F.col("start").alias("begin"), (F.col("start") + F.col("n")).alias("end"))
    spans = matches.groupBy("doc", "key").agg(covered(F.collect_set(span)).alias("n_hit"), F.collect_set("window_id").alias("window_ids"))
    found = materialize(spans, "hits")
    named = found.select("doc", "key", F.explode("window_ids").alias("window_id")).join(window_items, "window_id").select("doc", "key", F.col("item_id").cast("string")).distinct()
    listed = named.groupBy("doc", "key").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    hit = found.select("doc", "key", "n_hit").join(listed, ["doc", "key"])
    rows = keyed(docs).select("doc_id", "doc", "key", F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
    joined = rows.join(hit, ["doc", "key"], "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return joined.select("doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"), (n_hit > 0).alias("contaminated"))


def clean_documents(docs: DataFrame, items: DataFrame, size: int = WORDS) -> DataFrame:
    """Rows of ``docs`` in which no test window occurs, with their columns as they are."""
    _, window_terms, terms = windows_of(items, size)
    matches = phrase_matches(build_index(docs, terms), window_terms)
    doc, key = fresh(docs, "_doc"), fresh(docs, "_key")
    hit = materialize(matches.select(F.col("doc").alias(doc), F.col("key").alias(key)).distinct(), "hits")
    doc_id, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    marked = docs.withColumns({doc: F.coalesce(doc_id, F.lit(0)), key: F.hash(F.coalesce(text, F.lit("")), doc_id.isNull())})
    return marked.join(hit, [doc, key], "left_anti").select(*docs.columns)
