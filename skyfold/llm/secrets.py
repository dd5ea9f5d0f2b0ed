"""Secret scan in DataFrame functions only: three fixed patterns, then sliding-window entropy over candidate strings.

Everything happens within a row, so nothing is shuffled and a hot source or a group of copies costs what its rows cost.

*Patterns.* ``located`` splits a text at a pattern and adds up the lengths of what lies between and of the matches,
which gives their places in code points. Rows without a match are told by one search and not split.

*Entropy.* Candidates are runs of token characters. In each candidate, the runs of each character class that hold at
least one window are read from left to right: the state has a count for each symbol of the class and the sum of
``c * log2(c)`` over them, and each step adds the entering symbol and takes the leaving one away. The Shannon entropy of a
window of ``w`` symbols is ``log2(w) - sum / w`` bits. Sums are whole millionths, so windows at the limit are decided alike
everywhere. Windows of enough bits join to spans where they touch. Candidates on the allow-list give no such span.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from skyfold.functions.staging import fixed

#: The three base patterns, and the size that an assigned value needs. The look-ahead only saves time.
ASSIGN = (
    r"(?=[PpSsTtAa])([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"
ASSIGNED = 12

#: A run of characters that tokens are made of, as long as the shortest window; the look-behind only saves time.
CANDIDATE = "(?<![A-Za-z0-9+/_.=:-])[A-Za-z0-9+/_.=:-]{16,}"
MILLION = 1_000_000


class Symbols(NamedTuple):
    """A character class: its regular expression and symbols, the window, and the bits that make a window suspicious."""

    name: str
    pattern: str
    symbols: str
    window: int
    bits: float


DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
CLASSES = (
    Symbols("hex_digits", "[0-9A-Fa-f]", DIGITS + "ABCDEFabcdef", 16, 3.0),
    Symbols("capitals", "[A-Z0-9]", DIGITS + UPPER, 20, 3.6),
    Symbols("base64", "[A-Za-z0-9+/_-]", DIGITS + UPPER + LOWER + "+/_-", 24, 4.1),
)

#: Candidates that look random and are none: fixed values.
ALLOWED = (
    r"[Ee][Xx][Aa][Mm][Pp][Ll][Ee]|[Pp][Ll][Aa][Cc][Ee][Hh][Oo][Ll][Dd][Ee][Rr]|[Rr][Ee][Dd][Aa][Cc][Tt][Ee][Dd]",  # stand-ins
    r"[Xx]{4}|0{8}|1234567|abcdefg|ABCDEFG",  # fillers and alphabets
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",  # UUIDs
    r"://",  # addresses
    r"^[0-9.:+/_=-]+$",  # numbers, dates, versions
    r"^[A-Za-z]?[a-z]*([./:_=+-]+[A-Za-z]?[a-z]*)*$",  # names and paths of plain words
    r"^sha(256|384|512)-",  # digests of public files
)
#: Kinds in the order in which spans of one start are listed.
KINDS = ("assign", "access", "hex", *(c.name for c in CLASSES))


def located(text: Column, pattern: str, group: int = 0) -> Column:
    """Array of ``(begin, end, match)``: matches from left to right, places in code points, ``match`` the given group."""
    # One more entry than there are matches: what follows the last one.
    taken = lambda g: F.concat(F.regexp_extract_all(text, F.lit(pattern), F.lit(g)), F.array(F.lit("")))
    match = "match" if group else "whole"
    rows = F.arrays_zip(F.split(text, pattern, -1).alias("before"), taken(0).alias("whole"), *([taken(group).alias("match")] if group else []))
    none = F.array().cast("array<struct<begin:bigint,end:bigint,match:string>>")
    start = F.struct(F.lit(0).cast("long").alias("at"), none.alias("found"))

    def step(acc: Column, row: Column) -> Column:
        begin = acc["at"] + F.char_length(row["before"])
        end = begin + F.char_length(row["whole"])
        span = F.array(F.struct(begin.alias("begin"), end.alias("end"), row[match].alias("match")))
        return F.struct(end.alias("at"), F.when(row["whole"] != "", F.concat(acc["found"], span)).otherwise(acc["found"]).alias("found"))

    return F.when(text.rlike(pattern), F.aggregate(rows, start, step, lambda acc: acc["found"])).otherwise(none)


def windowed(run: Column, kind: Symbols) -> Column:
    """Array of ``(begin, end)``: joined windows of a run of class symbols that hold enough bits, places within the run."""
    w = kind.window
    weights = [round(MILLION * c * math.log2(c)) if c else 0 for c in range(w + 1)]
    limit = round(MILLION * w * (math.log2(w) - kind.bits))
    weight = lambda count: F.element_at(F.array(*[F.lit(x) for x in weights]), (count + 1).cast("int"))
    codes = F.transform(F.split(run, ""), lambda c: F.instr(F.lit(kind.symbols), c))
    # Symbol that enters at each step and the one that leaves, 0 before the first window is full.
    steps = F.arrays_zip(codes.alias("enters"), F.concat(F.array_repeat(F.lit(0), w), codes).alias("leaves"))
    none = F.array().cast("array<struct<begin:bigint,end:bigint>>")
    start = F.struct(
        F.array_repeat(F.lit(0), len(kind.symbols)).alias("counts"), F.lit(0).cast("long").alias("sum"), F.lit(0).cast("long").alias("at"), none.alias("spans")
    )

    def step(acc: Column, move: Column) -> Column:
        enters, leaves = move["enters"], move["leaves"]
        left = F.when(leaves > 0, F.element_at(acc["counts"], F.greatest(leaves, F.lit(1)))).otherwise(F.lit(0))
        after = F.when(leaves > 0, weight(left - 1) - weight(left)).otherwise(F.lit(0))
        held = F.element_at(acc["counts"], enters) - F.when(enters == leaves, 1).otherwise(0)
        total = acc["sum"] + after + weight(held + 1) - weight(held)
        counts = F.transform(acc["counts"], lambda c, i: c + F.when(i + 1 == enters, 1).otherwise(0) - F.when(i + 1 == leaves, 1).otherwise(0))
        at = acc["at"] + 1
        last = F.try_element_at(acc["spans"], F.lit(-1))
        joined = F.concat(F.slice(acc["spans"], 1, F.greatest(F.size(acc["spans"]) - 1, F.lit(0))), F.array(F.struct(last["begin"].alias("begin"), at.alias("end"))))
        apart = F.concat(acc["spans"], F.array(F.struct((at - w).alias("begin"), at.alias("end"))))
        spans = F.when((at < w) | (total > limit), acc["spans"]).when(last["end"] >= at - w, joined).otherwise(apart)
        return F.struct(counts.alias("counts"), total.cast("long").alias("sum"), at.alias("at"), spans.alias("spans"))

    whole = F.filter(steps, lambda move: move["enters"].isNotNull())
    return F.aggregate(whole, start, step, lambda acc: acc["spans"])


def entropy_spans(candidates: Column, kind: Symbols) -> Column:
    """Array of ``(begin, end)``: suspicious spans of one class in ``candidates(begin, end, match)``."""
    runs = lambda c: located(c["match"], f"{kind.pattern}{{{kind.window},}}")
    moved = lambda s, by: F.struct((s["begin"] + by).alias("begin"), (s["end"] + by).alias("end"))
    in_run = lambda c: lambda r: F.transform(windowed(r["match"], kind), lambda s: moved(s, c["begin"] + r["begin"]))
    return F.flatten(F.transform(candidates, lambda c: F.flatten(F.transform(runs(c), in_run(c)))))


def _listed(spans: dict[str, Column]) -> Column:
    """``kind:begin:end`` of all spans by begin, then kind as listed, comma-joined."""

    def rows(kind: str) -> Column:
        text = lambda s: F.concat_ws(":", F.lit(kind), s["begin"], s["end"])
        return F.transform(spans[kind], lambda s: F.struct(s["begin"].alias("begin"), F.lit(KINDS.index(kind)).alias("no"), text(s).alias("text")))

    return F.array_join(F.transform(F.array_sort(F.concat(*map(rows, spans))), lambda s: s["text"]), ",")


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_assign, n_access, n_hex, n_entropy, base_sha256, spans``.

    Spans count code points, ends are exclusive. Base spans are never suppressed; entropy spans are listed beside them,
    also where they overlap. A null or empty text has no spans, and ``spans`` is then empty. Rows that repeat a
    ``doc_id`` or have none each give their own row; other columns are ignored; no rows give no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    assigned = F.filter(located(F.col("text"), ASSIGN, 2), lambda s: F.char_length(s["match"]) >= ASSIGNED)
    suspects = F.filter(located(F.col("text"), CANDIDATE), lambda c: ~c["match"].rlike("|".join(f"(?:{a})" for a in ALLOWED)))
    found = fixed(rows, {"assign": assigned, "access": located(F.col("text"), ACCESS), "hex": located(F.col("text"), HEX), "suspects": suspects}).drop("text")
    marked = fixed(found, {kind.name: entropy_spans(F.col("suspects"), kind) for kind in CLASSES}).drop("suspects")
    base, rest = {k: F.col(k) for k in KINDS[:3]}, {k: F.col(k) for k in KINDS[3:]}
    count = lambda k: F.size(k).cast("long")
    return marked.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in base],
        sum((count(k) for k in rest), F.lit(0).cast("long")).alias("n_entropy"),
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(base | rest).alias("spans"),
    )
