"""Secrets in texts: three patterns, and strings of high entropy, in DataFrame functions only.

Method: candidate strings are the longest runs of ``LEAST`` or more characters of a class (hex digits; base64).  A window of
``WINDOW`` characters slides along each candidate.  The counts of its characters are kept as it slides: the entering
character's count goes up, the leaving one's down, and the sum of ``c * log2(c)`` changes by those two terms alone.
A window is a secret's if its Shannon entropy, ``log2(WINDOW) - sum / WINDOW``, reaches the threshold of the class;
windows that overlap or touch are one span.  Candidates that match an entry of the allow list give none.

The terms are integers (2**20ths), so a window's verdict does not depend on the order of additions.

The patterns are taken leftmost and without overlap, each kind for itself; matches that are too short are dropped after
matching, so they still hide what they cover:
``assign`` is a name such as ``password`` or ``api_key``, a ``:`` or ``=``, and a value of 6 or more characters;
``access`` is ``AKIA`` and capitals or digits, 20 or more; ``hex`` is 24 or more lower-case hex digits.

Spans are ``kind:start:end`` in code points, the end exclusive.  They come from the texts' parts between matches: a
match starts where all parts and matches before it end.  One pass, no shuffle; a row's work follows its own text, also
when it has very many matches (running sums go by blocks).

Defined cases: a null text is an empty one, which has no spans.  One place may be found by several kinds.  Repeated rows
each have their spans.  Extra columns are ignored.  No rows in, no rows out.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 20
LEAST = 20

# The patterns of the three kinds, and the least length of what their last group matches.
_NAMES = ("password", "passwd", "secret", "token", "api_?key")
_VALUE = "[A-Za-z0-9+/_.=-]"


def _either_case(name: str) -> str:
    # spelt out, for no engine's folding of letters beyond ASCII to come in
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in name)


ASSIGN = f"(?:{'|'.join(map(_either_case, _NAMES))})[\"']?\\x20*[:=]\\x20*[\"']?({_VALUE}+)"
ASSIGN_LEAST = 6
# A run has one match at most, so a shorter one hides nothing and the least length can stand in the pattern.
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
BASE = ("assign", "access", "hex")

# class: its characters and the entropy, in bits, that a window of WINDOW characters must reach
CLASSES = {
    "entropy_hex": ("0123456789abcdefABCDEF", 3.0),
    "entropy_base64": ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", 3.9),
}

# whole candidates that are no secrets
ALLOWED = (
    "[0-9+/_=-]+",  # numbers, dates, rules
    "[A-Za-z+/_=-]+",  # words and paths without a digit
    "[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",  # random ids
    "(?:[a-z]+|[A-Z][a-z]*|[0-9]{1,4})(?:[/_=-](?:[a-z]+|[A-Z][a-z]*|[0-9]{1,4}))*",  # paths of words and short numbers
    ".*(?:[Ee][Xx][Aa][Mm][Pp][Ll][Ee]|[Pp][Ll][Aa][Cc][Ee][Hh][Oo][Ll][Dd][Ee][Rr]|[Cc][Hh][Aa][Nn][Gg][Ee][Mm][Ee]).*",
)

_BLOCK = 256


def _zero() -> Column:
    return F.lit(0).cast("long")


def terms() -> list[int]:
    """``c * log2(c)`` in 2**20ths, for the counts that a window can hold."""
    return [round(c * math.log2(c) * 2**20) if c else 0 for c in range(WINDOW + 1)]


def most(bits: float) -> int:
    """The largest sum of terms of a window whose entropy is ``bits`` or more."""
    return math.floor(WINDOW * (math.log2(WINDOW) - bits) * 2**20)


def _list(values: Sequence[int]) -> Column:
    return F.expr(f"array({', '.join(f'{v}L' for v in values)})")


def _empty(kind: str) -> Column:
    return F.expr("array()").cast(f"array<{kind}>")


def _before(lengths: Column) -> Column:
    """For every place of a list of longs, the sum of all before it; by blocks, since lists grow by being copied."""

    def sums(values: Column, value) -> Column:
        start = F.struct(_zero().alias("total"), _empty("bigint").alias("starts"))
        return F.aggregate(
            values, start,
            lambda a, x: F.struct((a["total"] + value(x)).alias("total"), F.concat(a["starts"], F.array(a["total"])).alias("starts")),
        )

    n = F.size(lengths)
    blocks = F.when(n > 0, F.sequence(F.lit(0), F.floor((n - 1) / _BLOCK).cast("int"))).otherwise(_empty("int"))
    within = F.transform(blocks, lambda b: sums(F.slice(lengths, b * _BLOCK + 1, F.lit(_BLOCK)), lambda x: x))
    offsets = sums(within, lambda w: w["total"])["starts"]
    return F.flatten(F.zip_with(within, offsets, lambda w, at: F.transform(w["starts"], lambda s: s + at)))


def locate(rows: DataFrame, patterns: Mapping[str, str]) -> DataFrame:
    """``doc_id`` and, under each pattern's name, the start, end and string of its matches in ``text``.

    Matches are leftmost and without overlap.  A text is cut into the parts between matches only where there are any.
    """
    names = list(patterns)
    found = rows.select("doc_id", "text", *[F.regexp_extract_all("text", F.lit(patterns[n]), 0).alias(n) for n in names])

    def parts(name: str) -> Column:  # what stands before each match, back to the one before it
        n = F.size(name)
        return F.when(n > 0, F.slice(F.split("text", patterns[name], -1), F.lit(1), n)).otherwise(_empty("string"))

    cut = found.select("doc_id", *names, *[parts(n).alias(f"{n}_before") for n in names])
    measured = cut.select(
        "doc_id", *names,
        *[F.transform(f"{n}_before", lambda x: F.length(x).cast("long")).alias(f"{n}_before") for n in names],
        *[F.zip_with(f"{n}_before", n, lambda x, m: (F.length(x) + F.length(m)).cast("long")).alias(f"{n}_step") for n in names],
    )
    placed = measured.select("doc_id", *names, *[F.zip_with(_before(F.col(f"{n}_step")), f"{n}_before", lambda a, x: a + x).alias(f"{n}_at") for n in names])
    return placed.select(
        "doc_id",
        *[
            F.zip_with(f"{n}_at", n, lambda at, m: F.struct(at.alias("start"), (at + F.length(m)).alias("end"), m.alias("found"))).alias(n)
            for n in names
        ],
    )


def _marked(spans: Column, kind: int) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")))


def windows(candidate: Column, alphabet: str, bits: float) -> Column:
    """Start and end of the stretches of a candidate whose windows reach the entropy, counted from its first character."""
    table, limit = _list(terms()), most(bits)
    codes = F.transform(F.split(candidate, "", -1), lambda c: F.instr(F.lit(alphabet), c) - 1)

    def term(count: Column) -> Column:
        return F.get(table, count.cast("int"))

    def step(state: Column, i: Column) -> Column:
        enters, leaves = F.get(state["codes"], i), F.get(state["codes"], i - WINDOW)
        counts = state["counts"]
        same = F.coalesce(enters == leaves, F.lit(False))
        rise, fall = F.get(counts, enters), F.get(counts, leaves)
        change = F.when(same, _zero()).otherwise(
            term(rise + 1) - term(rise) - F.coalesce(term(fall) - term(fall - 1), _zero())
        )
        after = F.when(same, counts).otherwise(
            F.transform(
                counts,
                lambda c, k: c + F.when(k == enters, F.lit(1)).when(k == leaves, F.lit(-1)).otherwise(F.lit(0)),
            )
        )
        total = state["total"] + change
        start = F.greatest(i - (WINDOW - 1), F.lit(0))
        high = (i >= WINDOW - 1) & (total <= limit)
        apart = high & (start > state["till"])
        closed = F.when(apart & (state["till"] > 0), F.concat(state["closed"], F.array(_span(state)))).otherwise(state["closed"])
        return F.struct(
            state["codes"].alias("codes"), after.alias("counts"), total.alias("total"), closed.alias("closed"),
            F.when(apart | (high & (state["till"] == 0)), start).otherwise(state["since"]).alias("since"),
            F.when(high, i + 1).otherwise(state["till"]).alias("till"),
        )

    begin = F.struct(
        codes.alias("codes"), F.array_repeat(F.lit(0), len(alphabet)).alias("counts"), _zero().alias("total"),
        _empty("struct<start:int,end:int>").alias("closed"), F.lit(0).alias("since"), F.lit(0).alias("till"),
    )
    return F.aggregate(
        F.sequence(F.lit(0), F.length(candidate) - 1), begin, step,
        lambda s: F.when(s["till"] > 0, F.concat(s["closed"], F.array(_span(s)))).otherwise(s["closed"]),
    )


def _span(state: Column) -> Column:
    return F.struct(state["since"].alias("start"), state["till"].alias("end"))


def _entropy_spans(candidates: Column, name: str, kind: int, allowed: Sequence[str]) -> Column:
    alphabet, bits = CLASSES[name]
    listed = "^(?:" + "|".join(allowed) + ")$"
    doubtful = F.filter(candidates, lambda c: ~c["found"].rlike(listed)) if allowed else candidates
    return F.flatten(
        F.transform(
            doubtful,
            lambda c: F.transform(
                windows(c["found"], alphabet, bits),
                lambda w: F.struct((c["start"] + w["start"]).alias("start"), F.lit(kind).alias("kind"), (c["start"] + w["end"]).alias("end")),
            ),
        )
    )


def as_text(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in (*BASE, *CLASSES)])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def scan(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", allowed: Sequence[str] = ALLOWED,
) -> DataFrame:
    """``doc_id, base, spans`` of each document: arrays of (start, kind, end), by start and then kind.

    A kind is its place in ``BASE`` followed by ``CLASSES``; ``base`` holds those of the patterns, ``spans`` all.
    ``allowed`` are patterns of whole candidates of high entropy that are no secrets; they do not touch the base.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    runs = {name: f"[{alphabet}]{{{LEAST},}}" for name, (alphabet, _) in CLASSES.items()}
    found = locate(rows, {"assign": ASSIGN, "access": ACCESS, "hex": HEX} | runs)
    long_enough = F.filter("assign", lambda s: F.length(F.regexp_extract(s["found"], ASSIGN, 1)) >= ASSIGN_LEAST)
    found = found.withColumn("assign", long_enough)
    marked = found.select(
        "doc_id",
        F.array_sort(F.concat(*[_marked(F.col(name), kind) for kind, name in enumerate(BASE)])).alias("base"),
        *[_entropy_spans(F.col(name), name, kind, allowed).alias(name) for kind, name in enumerate(CLASSES, len(BASE))],
    )
    return marked.select("doc_id", "base", F.array_sort(F.concat("base", *CLASSES)).alias("spans"))
