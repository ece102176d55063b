"""Language identification with language-bitmask n-gram filters.

Method: a Bloom filter per language, stored bit-sliced: slot ``i`` of one table holds bit ``i`` of every language's
filter, so ANDing an n-gram's ``HASHES`` slots returns the set of all languages that contain it as one bitmask.
Per language the set bits over a text's n-grams are counted; the share is corrected by the language's measured
false positive rate, ``(share - fp) / (1 - fp)``, and divided by what it comes to in the language's own documents; the
largest corrected share decides.

Which n-grams a language contains: n-grams of ``GRAM`` characters of the lower-cased text (letters, with every run of
other characters as one space) that make up at least ``MIN_RATE`` of the language's n-grams and are at least
``MIN_RATIO`` as frequent there as in the language that has most of them.  Without that, every filter would fill up
with what other languages quote.  A language has at most ``1 / MIN_RATE`` such n-grams, so the filters' size does not
depend on the corpus; the table is sized to them and broadcast.

Learning sees at most about ``sample`` labelled documents per language, chosen by a hash of their ids.

Defined cases: ``und`` with score 0 if the text is null or has no letter, or if nothing was learned; ties go to the
language that sorts first; rows without a label are not learned from; repeated rows each get a row; extra columns
are ignored.  No rows in, no rows out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GRAM = 4
MIN_RATE = 2e-5
MIN_RATIO = 0.25
HASHES = 3
BITS_PER_GRAM = 12
SAMPLE = 4000
UNKNOWN = "und"
_CHUNK = 1 << 20  # characters at a time
_MIX = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


_LAST = 0x323B0  # no letter stands here or above


def letter_table() -> np.ndarray:
    """For each code point its lower-case letter, or 32 for what is no letter."""
    table = np.full(_LAST + 1, 32, np.uint32)
    for point in range(_LAST):
        char = chr(point)
        if char.isalpha():
            lower = char.lower()
            table[point] = ord(lower) if len(lower) == 1 else point
    return table


def gram_hashes(text: str, table: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every n-gram of a text; none if it has no letter."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    letters = table[np.minimum(points, _LAST)]
    blank = letters == 32
    keep = np.ones(len(letters), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    letters = letters[keep]
    if not len(letters) or (len(letters) == 1 and letters[0] == 32):
        return np.zeros(0, np.uint64)
    edge = np.full(1, 32, np.uint32)
    padded = np.concatenate([edge if letters[0] != 32 else letters[:0], letters, edge if letters[-1] != 32 else letters[:0]])
    if len(padded) < GRAM:
        padded = np.concatenate([padded, np.full(GRAM - len(padded), 32, np.uint32)])
    wide = padded.astype(np.uint64)
    out = wide[: len(wide) - GRAM + 1].copy()
    for i in range(1, GRAM):
        out *= _MIX[0]
        out ^= out >> np.uint64(29)
        out += wide[i : len(wide) - GRAM + 1 + i]
    out *= _MIX[1]
    out ^= out >> np.uint64(32)
    return out


def _slots(hashes: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """The ``HASHES`` slots of each n-gram in a table of ``size`` slots, a power of two."""
    shift = np.uint64(64 - int(math.log2(size)))
    for k in range(HASHES):
        yield ((hashes * _MIX[k + 1]) >> shift).astype(np.int64)


@dataclass
class Filters:
    """Bit-sliced Bloom filters: ``table[slot]`` has one bit per language."""

    letters: np.ndarray
    languages: list[str]
    table: np.ndarray
    false_positives: np.ndarray
    coverage: np.ndarray  # share of a language's own n-grams that its filter holds

    @classmethod
    def of(cls, letters: np.ndarray, languages: list[str], grams: dict[str, np.ndarray], coverage: list[float]) -> Filters:
        most = max([1, *(len(g) for g in grams.values())])
        size = 1 << max(10, math.ceil(math.log2(most * BITS_PER_GRAM)))
        kind = next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if len(languages) <= 8 * np.dtype(t).itemsize)
        table = np.zeros(size, kind)
        rates = []
        for bit, language in enumerate(languages):
            for slots in _slots(grams.get(language, np.zeros(0, np.uint64)), size):
                table[slots] |= kind(1 << bit)
            rates.append((np.count_nonzero(table & kind(1 << bit)) / size) ** HASHES)
        return cls(letters, languages, table, np.array(rates), np.array(coverage))

    def shares(self, text: str) -> np.ndarray | None:
        """Per language the corrected share of the text's n-grams that it contains; None without n-grams."""
        hashes = gram_hashes(text, self.letters)
        if not len(hashes):
            return None
        hits = np.zeros(len(self.languages))
        for at in range(0, len(hashes), _CHUNK):
            first, *rest = _slots(hashes[at : at + _CHUNK], len(self.table))
            masks = self.table[first]
            for slots in rest:
                masks &= self.table[slots]
            for bit in range(len(self.languages)):
                hits[bit] += np.count_nonzero(masks & masks.dtype.type(1 << bit))
        true = np.clip((hits / len(hashes) - self.false_positives) / (1 - self.false_positives), 0, 1)
        return true / np.maximum(self.coverage, 1e-9)

    def decide(self, text: str | None) -> tuple[str, float]:
        shares = self.shares(text) if text and self.languages else None
        if shares is None:
            return UNKNOWN, 0.0
        best = int(np.argmax(shares))
        total = float(shares.sum())
        return self.languages[best], float(shares[best] / total) if total else 0.0


def learn(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", sample: int = SAMPLE) -> Filters:
    """Filters from labelled documents; at most 64 languages."""
    labelled = docs.select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(F.col(id_col)).alias("draw")
    ).where("lang IS NOT NULL AND text IS NOT NULL")
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) > 64:
        raise ValueError("a bitmask holds at most 64 languages")
    languages, letters = sorted(sizes), letter_table()
    if not languages:
        return Filters.of(letters, [], {}, [])
    share = F.coalesce(*[F.when(F.col("lang") == k, F.lit(min(1.0, sample / n))) for k, n in sizes.items()])
    drawn = labelled.where(F.pmod("draw", F.lit(1 << 20)) < share * (1 << 20)).select("lang", "text")

    table = docs.sparkSession.sparkContext.broadcast(letters)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                parts.setdefault(lang, []).append(gram_hashes(text.as_py(), table.value))
            for lang, hashes in parts.items():
                grams, n = np.unique(np.concatenate(hashes), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(grams), pa.string()), pa.array(grams.view(np.int64)), pa.array(n)], ["lang", "gram", "n"]
                )

    counts = drawn.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # one row per n-gram with its count in each language, then the rates; what stays is at most 1 / MIN_RATE each
    wide = counts.groupBy("gram").agg(
        *[F.coalesce(F.sum(F.when(F.col("lang") == k, F.col("n"))), F.lit(0)).alias(f"n{i}") for i, k in enumerate(languages)]
    )
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    rates = [F.col(f"n{i}") / F.lit(max(1, totals.get(k, 0))) for i, k in enumerate(languages)]
    top = F.greatest(*rates) if len(rates) > 1 else rates[0]
    held = [F.coalesce((r >= MIN_RATE) & (r >= MIN_RATIO * top), F.lit(False)) for r in rates]
    mask = sum((F.when(h, F.lit(1 << i if i < 63 else -(1 << 63)).cast("long")).otherwise(F.lit(0).cast("long")) for i, h in enumerate(held)), F.lit(0).cast("long"))
    own = [F.when(h, r).otherwise(F.lit(0.0)).alias(f"own{i}") for i, (h, r) in enumerate(zip(held, rates))]
    found = wide.select("gram", mask.alias("mask"), *own).where("mask <> 0").toPandas()
    grams, masks = found["gram"].to_numpy(np.int64).view(np.uint64), found["mask"].to_numpy(np.int64).view(np.uint64)
    return Filters.of(letters, languages, {k: grams[(masks >> np.uint64(i)) & np.uint64(1) == 1] for i, k in enumerate(languages)}, [float(found[f"own{i}"].sum()) for i in range(len(languages))])


def identify(docs: DataFrame, filters: Filters, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` per row: the language, and its part of all corrected shares."""
    shared = docs.sparkSession.sparkContext.broadcast((filters.letters, filters.languages, filters.table, filters.false_positives, filters.coverage))
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = picked.schema["doc_id"].dataType.simpleString()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Filters(*shared.value)
        for batch in batches:
            found = [known.decide(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

    return picked.mapInArrow(each, f"doc_id {kind}, lang_pred string, score double")
