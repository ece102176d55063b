"""Document fingerprints by order MinHash, which follow edit distance.

Method: a text's k-mers are numbered by occurrence (the third ``abab`` is another element than the first), so that the
set keeps how often each comes.  For each of ``TUPLES`` hash functions the ``CHOSEN`` elements with the smallest values
are selected, put back into the order in which they stand in the text, and hashed as a tuple.  Two texts agree in a
tuple only if the same k-mers are chosen and stand in the same order; the share of equal tuples falls with their
edit distance, where plain MinHash does not notice moved passages.

``likeness`` of two fingerprints is the share of equal tuples, 0 to 1.

Defined cases: a null or empty text has no k-mer and the fingerprint of no element, equal to that of other empty texts
and, in every tuple, unlike any other; a text shorter than k is one k-mer; a text with fewer elements than a tuple uses
all it has.  Equal texts have equal fingerprints.  Repeated rows each get a row; rows are ordered by id (null first),
then text.  Extra columns are ignored.  No rows in, no rows out; one row is its own next.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

K = 6
TUPLES = 24
CHOSEN = 2
_CHUNK = 1 << 16  # elements hashed at a time
_A, _B, _C = (np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
# odd multipliers, one per hash function
_FUNCTIONS = np.random.default_rng(20).integers(0, 2**63, TUPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def elements(text: str) -> np.ndarray:
    """A 64-bit hash of every k-mer with its occurrence number, in the order of the text."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    if not len(points):
        return np.zeros(0, np.uint64)
    width = min(K, len(points))
    n = len(points) - width + 1
    kmers = points[:n].copy()
    for i in range(1, width):
        kmers *= _A
        kmers += points[i : i + n]
    kmers = _mix(kmers)
    # occurrence numbers: sort by k-mer, then place (one number holds both), and count within equal k-mers
    bits = np.uint64(max(1, int(n - 1).bit_length()))
    packed = np.sort((kmers >> bits) << bits | np.arange(n, dtype=np.uint64))
    place = (packed & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    group = packed >> bits
    first = np.ones(n, bool)
    first[1:] = group[1:] != group[:-1]
    index = np.arange(n)
    number = np.empty(n, np.uint64)
    number[place] = index - np.maximum.accumulate(np.where(first, index, 0))
    return _mix(kmers + number * _A)


def signature(text: str | None) -> np.ndarray:
    """``TUPLES`` 32-bit tuple hashes."""
    items = elements(text or "")
    if not len(items):
        return np.zeros(TUPLES, np.uint32)
    take = min(CHOSEN, len(items))
    chosen = np.empty((TUPLES, take), np.int64)
    for t, factor in enumerate(_FUNCTIONS):
        best: list[tuple[int, int]] = []
        for at in range(0, len(items), _CHUNK):
            values = items[at : at + _CHUNK] * factor
            for _ in range(min(take, len(values))):
                i = int(values.argmin())
                best.append((int(values[i]), at + i))
                values[i] = np.uint64(2**64 - 1)
        chosen[t] = sorted(i for _, i in sorted(best)[:take])
    out = np.zeros(TUPLES, np.uint64)
    for j in range(take):
        out = _mix(out * _A + items[chosen[:, j]] + np.uint64(j + 1))
    # zero stands for no element
    return np.maximum((out >> np.uint64(32)).astype(np.uint32), np.uint32(1))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float(np.mean(a == b))


def as_text(fingerprint: np.ndarray) -> str:
    return fingerprint.astype(">u4").tobytes().hex()


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_chars, fingerprint`` per row."""
    picked = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = picked.schema["doc_id"].dataType.simpleString()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array([as_text(signature(t)) for t in texts], pa.string())],
                ["doc_id", "n_chars", "fingerprint"],
            )

    return picked.mapInArrow(each, f"doc_id {kind}, n_chars long, fingerprint string")


def _runs(docs: DataFrame) -> DataFrame:
    """Rows ``run, borrowed, doc_id, hash, text``, one partition per run: documents in runs by id, each run closed by the
    first document of the next (the last by the first of all), which is marked as borrowed.

    There are as many runs as shuffle partitions; what reaches the driver, or is broadcast, is a few numbers per run.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = sorted(set(docs.stat.approxQuantile("doc_id", [i / parts for i in range(1, parts)], 0.1 / parts))) if parts > 1 else []
    # two levels of cuts: a row is compared with about twice the square root of their number
    step = max(1, math.isqrt(len(cuts)))
    id_ = F.col("doc_id").cast("double")

    def below(numbers: Column) -> Column:
        return F.size(F.filter(numbers, lambda cut: cut <= id_))

    every = F.array(*[F.lit(float(c)) for c in cuts]).cast("array<double>")
    coarse = F.array(*[F.lit(float(c)) for c in cuts[step - 1 :: step]]).cast("array<double>")
    whole = below(coarse) * step
    run = F.coalesce(F.when(id_.isNotNull(), whole + below(F.slice(every, whole + 1, F.lit(step)))), F.lit(0))
    marked = docs.select(run.cast("int").alias("bin"), "doc_id", F.xxhash64("text").alias("hash"), "text")
    # a null id sorts first, as in the runs
    firsts = sorted(
        (r["bin"], r["first"]["doc_id"], r["first"]["hash"])
        for r in marked.groupBy("bin").agg(F.min(F.struct("doc_id", "hash")).alias("first")).collect()
    )
    runs = len(firsts)
    if not runs:
        return marked.select(F.col("bin").alias("run"), F.lit(False).alias("borrowed"), "doc_id", "hash", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    lent = spark.createDataFrame(
        [(first, hash_, (n - 1) % runs) for n, (_, first, hash_) in enumerate(firsts)], f"id {kind}, h long, lent_to int"
    )
    numbered = spark.createDataFrame([(bin_, n) for n, (bin_, _, _) in enumerate(firsts)], "bin int, run int")
    rows = marked.join(F.broadcast(numbered), "bin").join(
        F.broadcast(lent), F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("hash") == F.col("h")), "left"
    )
    own = F.struct(F.col("run"), F.lit(False).alias("borrowed"))
    given = F.struct(F.col("lent_to").alias("run"), F.lit(True).alias("borrowed"))
    placed = F.when(F.col("lent_to").isNull(), F.array(own)).otherwise(F.array(own, given))
    return (
        rows.select(F.inline(placed), "doc_id", "hash", "text")
        .repartitionById(runs, F.col("run"))
        .sortWithinPartitions("borrowed", "doc_id", "hash", "text")
    )


def edited_neighbours(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text's fingerprint beside that of an edited text and of the next document.

    The edited text has its last quarter (of code points, rounded down) replaced by as many first code points of the
    next document by id, or all it has; after the last comes the first.  Columns: ``doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next``.  Documents pass a task one by one, two at a time in
    memory.
    """
    picked = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = picked.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def row(key, text: str, own: np.ndarray, following: str, its: np.ndarray) -> tuple:
        cut = len(text) // 4
        edited = text[: len(text) - cut] + following[:cut]
        changed = own if edited == text else signature(edited)
        digest = sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
        return key, len(text), digest, as_text(own), as_text(changed), likeness(own, changed), likeness(own, its)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        types = [to_arrow_type(key_type), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
        last = None  # the document that waits for its next
        for batch in batches:
            rows = []
            for borrowed, key, text in zip(batch.column("borrowed"), batch.column("doc_id"), batch.column("text")):
                text = text.as_py()
                marks = signature(text)
                if last is not None:
                    rows.append(row(*last, text, marks))
                    last = None
                if borrowed.as_py():
                    break
                last = key.as_py(), text, marks
            columns = list(zip(*rows)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    key_type = picked.schema["doc_id"].dataType
    schema = (
        f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    return _runs(picked).mapInArrow(each, schema)
