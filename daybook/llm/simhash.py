"""Near-duplicate groups by SimHash and a byte-position inverted index.

Method: a fingerprint of eight bytes is posted in an inverted index by byte positions.  Two fingerprints that
differ in at most ``max_bits`` bits differ in at most that many bytes, so they share at least
``8 - max_bits`` positional bytes: the guaranteed minimum.  Posting single bytes and tallying them per pair would
pair up 1/256 of all fingerprints with each other, so the count filter is put into the key: a fingerprint is
posted once for each choice of ``8 - max_bits`` positions, under the bytes it has there, and two fingerprints meet
in a posting exactly if their tally of shared positional bytes reaches the minimum.  Pairs below it are never
made.  Fingerprints that meet are verified by their differing bits.

A posting holds different fingerprints that agree in all but ``max_bits`` bytes: at most ``256 ** max_bits``, however
many documents there are (65,536 for two).  Inside a posting each fingerprint is verified against those that can be
within ``max_bits`` bits, looked up by flipping bits, and only the links of a spanning forest leave the task, so a
large group makes rows in proportion to its members, not to their pairs.

Fingerprints: A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``, shingles of ``shingle`` words joined by a space (repeats
count; fewer words: the whole sequence), XXH64 of UTF-8 with seed 42; a bit is set if more than half of the hashes
have it.  Copies share a fingerprint and are one node of the graph.

Defined cases: a null, empty or blank text has fingerprint zero and is linked like any other; a null document id
stays in the result and never becomes a component's name unless all its members are null.  Repeated rows each get
a row.  Extra columns are ignored.  No rows in, no rows out.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.components import components
from daybook.llm.staging import Stages, tidy

SEED = 42
_CHUNK = 1 << 15  # shingles hashed at a time, so that a very long text needs little more than its words


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The unsigned 64-bit SimHash of one text."""
    import xxhash

    words = (text or "").encode().lower().split()  # bytes: ASCII letters and ASCII white space only
    if not words:
        return 0
    xxh64, total = xxhash.xxh64_intdigest, max(1, len(words) - shingle + 1)
    counts = np.zeros(64, np.int64)
    for at in range(0, total, _CHUNK):
        own = words[at : at + _CHUNK + shingle - 1]
        joined = b" ".join(own)
        ends = list(accumulate(len(w) + 1 for w in own))
        hashes = [xxh64(joined[a : b - 1], SEED) for a, b in zip([0, *ends], ends[min(shingle, len(own)) - 1 :])]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.uint32)
    set_bits = np.packbits(counts * 2 > total, bitorder="little")
    return int(set_bits.view("<u8")[0])


def _mark(text_col: str) -> Column:
    return F.xxhash64(F.col(text_col))


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``doc_id, mark, fp`` per row; ``fp`` is the fingerprint as a signed 64-bit number, ``mark`` tells texts apart."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2)
            values = np.array([fingerprint(t.as_py(), shingle) for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(values.view(np.int64))], ["doc_id", "mark", "fp"]
            )

    picked = docs.select(F.col(id_col).alias("doc_id"), _mark(text_col).alias("mark"), F.col(text_col).alias("text"))
    kind = picked.schema["doc_id"].dataType.simpleString()
    return picked.mapInArrow(tidy(each), f"doc_id {kind}, mark long, fp long")


def _masks(max_bits: int) -> list[np.uint64]:
    """All non-zero 64-bit patterns are too many; these are the flips within ``max_bits`` bytes of a posting."""
    width = 8 * max_bits
    return [
        sum(1 << b for b in chosen) for n in range(1, max_bits + 1) for chosen in combinations(range(width), n)
    ]


def links(nodes: DataFrame, max_bits: int = 2) -> DataFrame:
    """Pairs ``a, b`` of the different fingerprints ``fp`` that connect all within ``max_bits`` of each other."""
    left = list(combinations(range(8), max_bits))  # the byte positions that a posting leaves open

    def of(positions) -> int:
        return sum(0xFF << (8 * p) for p in positions)

    def signed(x: int) -> int:
        return x - (1 << 64) if x >= 1 << 63 else x

    fp = F.col("fp")
    posts = F.array(
        *[
            F.struct(F.lit(k).cast("byte").alias("left"), fp.bitwiseAND(F.lit(signed(~of(open_) & (2**64 - 1)))).alias("shared"))
            for k, open_ in enumerate(left)
        ]
    )
    # few bytes become many postings: spread them over the tasks of a shuffle first, whatever their size
    spread = nodes.repartition(int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")
    postings = (
        spread.select("fp", F.explode(posts).alias("post"))
        .groupBy("post")
        .agg(F.collect_list("fp").alias("members"))
        .where(F.size("members") > 1)
        .select("post.left", "members")
    )

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flips = np.array(_masks(max_bits), np.uint64)
        for batch in batches:
            a, b = [], []
            for k, members in zip(batch.column(0).to_pylist(), batch.column(1)):
                fps = np.sort(members.values.to_numpy(zero_copy_only=False).view(np.uint64))
                for x, y in _forest(fps, left[k], flips, max_bits):
                    a.append(x)
                    b.append(y)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(a, np.uint64).view(np.int64)), pa.array(np.array(b, np.uint64).view(np.int64))], ["a", "b"]
            )

    return postings.mapInArrow(tidy(verify), "a long, b long")


def _forest(fps: np.ndarray, open_: tuple[int, ...], flips: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of one posting's fingerprints (sorted, different) within ``max_bits``."""
    parent = list(range(len(fps)))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    found = []

    def join(i: int, j: int) -> None:
        a, b = find(i), find(j)
        if a != b:
            parent[max(a, b)] = min(a, b)
            found.append((int(fps[i]), int(fps[j])))

    if len(fps) <= 2 * len(flips):  # few: compare each with the later ones
        for i in range(len(fps) - 1):
            for j in np.flatnonzero(np.bitwise_count(fps[i + 1 :] ^ fps[i]) <= max_bits):
                join(i, i + 1 + int(j))
        return found
    # many: look up the flipped values; the open bytes side by side are a number below 256 ** max_bits
    small = sum(((fps >> np.uint64(8 * p)) & np.uint64(255)) << np.uint64(8 * n) for n, p in enumerate(open_))
    order = np.argsort(small)
    ranked = small[order]
    for flip in flips:
        want = ranked ^ flip
        at = np.minimum(np.searchsorted(ranked, want), len(ranked) - 1)
        for i in np.flatnonzero((ranked[at] == want) & (ranked < want)):
            join(int(order[i]), int(order[at[i]]))
    return found


def near_duplicates(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2
) -> DataFrame:
    """``doc_id, mark, fp, component_id, root``: for each row the smallest document id reachable over links, and the
    fingerprint that stands for its group.

    ``max_bits`` is 1 to 3; the index posts each fingerprint 8, 28 or 56 times.
    """
    if max_bits not in (1, 2, 3):
        raise ValueError("max_bits is 1, 2 or 3")
    stages = Stages(docs.sparkSession, "simhash")
    marked = stages.write(fingerprints(docs, id_col=id_col, text_col=text_col, shingle=shingle))
    nodes = stages.write(marked.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = stages.write(components(links(nodes, max_bits), stages))
    named = (
        nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
        .select("fp", "first", F.coalesce("root", "fp").alias("root"))
    )
    names = named.groupBy("root").agg(F.min("first").alias("component_id"))
    per_fp = stages.write(named.join(names, "root").select("fp", "component_id", "root"))
    return marked.join(per_fp, "fp").select("doc_id", "mark", "fp", "component_id", "root")


def keep_one(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2
) -> DataFrame:
    """Of each group of near duplicates one row, with all its columns: that of the smallest id, nulls last.

    A row is found by id and text, so documents that share an id (or have none) stay if their groups differ; of
    rows equal in id and text the one whose columns sort first stays (any one, if a column's type has no order).
    """
    groups = near_duplicates(docs, id_col=id_col, text_col=text_col, shingle=shingle, max_bits=max_bits)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")
    firsts = groups.groupBy("root").agg(F.min(order).alias("first")).select("first.doc_id", "first.mark")
    # the documents' own columns stay in a struct, so that no name of theirs can meet one of the join's
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"))
    own_id, own_text = f"_doc.`{id_col}`", f"_doc.`{text_col}`"
    same = F.col(own_id).eqNullSafe(F.col("doc_id")) & (_mark(own_text) == F.col("mark"))
    kept = rows.join(firsts, same, "left_semi").groupBy(F.col(own_id).alias("id"), F.col(own_text).alias("text"))
    # of rows equal in id and text the one that sorts first stays, whatever task it comes from
    others = F.struct(F.lit(0).alias("_"), *[F.col(f"_doc.`{c}`") for c in docs.columns if c not in (id_col, text_col)])
    ordered = not any("map<" in kind or kind == "variant" for _, kind in docs.dtypes)
    one = kept.agg((F.min(others) if ordered else F.first(others)).alias("_doc"))
    names = {id_col: "id", text_col: "text"}
    return one.select(*[F.col(names.get(c, f"_doc.`{c}`")).alias(c) for c in docs.columns])
