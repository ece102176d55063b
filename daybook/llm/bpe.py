"""Byte-level BPE encoding and decoding, by recursive DuckDB queries inside each partition.

Method: a task splits its texts into pieces by the tokenizer's pattern and hands every distinct piece once to an
in-process DuckDB.  A recursive query joins the pieces' token-position rows to the merge table, contracts each
piece's leftmost pair of minimum rank and repeats until no piece has a pair left; ordered aggregation collects each
piece's ids and decodes them to bytes.  A text's ids are its pieces' ids in order, and so are its decoded bytes.

Ids are those of the rank file: a piece that is itself a token is that token; otherwise pairs merge by rank.  A
piece of more than ``LONG_PIECE`` bytes would make the recursion keep rows in proportion to its square, so such
pieces are contracted by the same rule with a heap of ranks.

A worker keeps its database with the merge table, and what the query gave for the pieces that it met first, the
frequent ones for the most part, for the runs and tasks that follow; all other pieces are queried.

Memory: texts are taken in runs of at most ``run_chars`` characters (one text at least), with a piece table of their
own; how many pieces are remembered is a fixed part of it.  A query takes pieces, by length, until its recursion may
keep ``_STEP_ROWS`` rows.  A task's memory follows ``run_chars`` and its longest text, not the partition; smaller runs
query more pieces anew.

Defined cases: a null or empty text has no ids and decodes to no bytes.  Special tokens' strings are ordinary text.
Repeated rows each get a row.  Extra columns are ignored.  No rows in, no rows out.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.staging import tidy

LONG_PIECE = 256
RUN_CHARS = 20_000_000
REMEMBERED = 100  # one piece for so many characters of a run
_STEP_ROWS = 2_000_000  # the sum of squared lengths of a query's pieces

# One step: rows that still may merge, the best pair of each piece, and the rows with that pair contracted.  A row
# knows its right neighbour (position and id), so a step needs no sort.
_CONTRACT = """
WITH RECURSIVE step(w, p, id, np, nid, done) AS (
  SELECT w, p, id, lead(p) OVER by_place, lead(id) OVER by_place, false
  FROM start WINDOW by_place AS (PARTITION BY w ORDER BY p)
  UNION ALL
  (WITH live AS MATERIALIZED (
     SELECT w, p, id, np, nid, merged
     FROM step LEFT JOIN merges ON pair = (id::BIGINT << 32) | nid WHERE NOT done),
   best AS MATERIALIZED (
     SELECT w, min(merged::BIGINT << 32 | p) AS k, arg_min(np, merged::BIGINT << 32 | p) AS gone
     FROM live WHERE merged IS NOT NULL GROUP BY w),
   contracted AS MATERIALIZED (
     SELECT b.w, (k & 4294967295) AS at, (k >> 32)::INTEGER AS id, gone, np, nid
     FROM best b JOIN live l ON l.w = b.w AND l.p = b.gone)
   SELECT s.w, s.p,
          CASE WHEN s.p = c.at THEN c.id ELSE s.id END,
          CASE WHEN s.p = c.at THEN c.np ELSE s.np END,
          CASE WHEN s.p = c.at THEN c.nid WHEN s.np = c.at THEN c.id ELSE s.nid END,
          c.at IS NULL
   FROM live s LEFT JOIN contracted c ON s.w = c.w
   WHERE c.at IS NULL OR s.p <> c.gone))
SELECT w, list(id ORDER BY p) AS ids, list(bytes ORDER BY p) AS parts
FROM step JOIN vocabulary USING (id) WHERE done GROUP BY w ORDER BY w
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a rank file of this machine."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class _Remembered:
    """Ids and decoded bytes of pieces that this process has queried, for one vocabulary at a time."""

    ranks: dict[bytes, int] | None = None
    pieces: dict[bytes, tuple[np.ndarray, bytes]] = {}

    @classmethod
    def of(cls, ranks: dict[bytes, int]) -> dict[bytes, tuple[np.ndarray, bytes]]:
        if cls.ranks != ranks:
            cls.ranks, cls.pieces = ranks, {}
        return cls.pieces


class Encoder:
    """A merge table in an in-process DuckDB, and the recursive query over it."""

    def __init__(self, ranks: dict[bytes, int], run_chars: int = RUN_CHARS):
        import duckdb

        self.remembered = run_chars // REMEMBERED
        self.ranks = ranks
        self.known = _Remembered.of(ranks)
        left, right, merged = [], [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(rank)
        self.byte_ids = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "100MB"})
        pairs = np.array(left, np.int64) << 32 | np.array(right, np.int64)
        table = pa.table({"pair": pairs, "merged": np.array(merged, np.int32)})
        words = pa.table({"id": pa.array(list(self.tokens), pa.int32()), "bytes": pa.array(list(self.tokens.values()), pa.binary())})
        for name, rows in (("merges", table), ("vocabulary", words)):
            self.db.register("given", rows)
            self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
            self.db.unregister("given")

    def close(self) -> None:
        self.db.close()

    @classmethod
    def of(cls, ranks: dict[bytes, int], run_chars: int) -> Encoder:
        """This process's encoder for the vocabulary; one is kept at a time."""
        kept = cls.__dict__.get("kept")
        if kept is None or kept.ranks != ranks:
            kept = cls.kept = cls(ranks, run_chars)
        kept.remembered = run_chars // REMEMBERED
        return kept

    def encode(self, pieces: list[bytes]) -> tuple[list[np.ndarray], list[bytes]]:
        """Each piece's ids, and the bytes that these decode to."""
        ids: list = [None] * len(pieces)
        decoded: list = [b""] * len(pieces)
        known, todo = self.known, []
        for i, piece in enumerate(pieces):
            if piece in known:
                ids[i], decoded[i] = known[piece]
                continue
            whole = self.ranks.get(piece)
            if whole is not None:
                ids[i], decoded[i] = np.array([whole], np.uint32), self.tokens[whole]
            elif len(piece) > LONG_PIECE:
                ids[i] = np.array(_contract_long(piece, self.ranks), np.uint32)
                decoded[i] = b"".join(self.tokens[t] for t in ids[i].tolist())
            else:
                todo.append(i)
        remembered = todo[: max(0, self.remembered - len(known))]
        todo.sort(key=lambda i: len(pieces[i]))
        squares = np.cumsum([len(pieces[i]) ** 2 for i in todo], dtype=np.int64)
        at = 0
        while at < len(todo):
            before = squares[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(squares, before + _STEP_ROWS, "right")))
            some, at = todo[at:stop], stop
            found = self._query([pieces[i] for i in some])
            flat = found["ids"].combine_chunks()
            values = flat.values.to_numpy().astype(np.uint32)
            ends = flat.offsets.to_numpy()
            # the parts of all pieces lie end to end, in order, so that a piece's bytes are one stretch of theirs
            parts = found["parts"].combine_chunks()
            joined, cuts = _bytes_of(parts.values)
            cuts = cuts[parts.offsets.to_numpy()].tolist()
            ends = ends.tolist()
            for n, i in enumerate(some):
                ids[i] = values[ends[n] : ends[n + 1]]
                decoded[i] = joined[cuts[n] : cuts[n + 1]]
        for i in remembered:
            known[pieces[i]] = ids[i].copy(), decoded[i]
        return ids, decoded

    def _query(self, pieces: list[bytes]) -> pa.Table:
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        starts = np.cumsum(lengths) - lengths
        rows = pa.table(
            {
                "w": np.repeat(np.arange(len(pieces), dtype=np.int32), lengths),
                "p": (np.arange(len(raw)) - np.repeat(starts, lengths)).astype(np.int32),
                "id": self.byte_ids[raw],
            }
        )
        self.db.register("start", rows)
        try:
            return self.db.sql(_CONTRACT).to_arrow_table()
        finally:
            self.db.unregister("start")


def _bytes_of(values: pa.Array) -> tuple[bytes, np.ndarray]:
    """The values of a binary array end to end, and where they begin and end."""
    values = values.cast(pa.large_binary())
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1]
    return values.buffers()[2].to_pybytes(), offsets


def _contract_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one long piece: leftmost pair of minimum rank first, by a heap over linked positions."""
    n = len(piece)
    end = list(range(1, n + 1))  # of the token that starts here
    before = list(range(-1, n - 1))
    alive = [True] * n
    heap: list[tuple[int, int, int, int]] = []

    def offer(i: int) -> None:
        if i >= 0 and end[i] < n:
            rank = ranks.get(piece[i : end[end[i]]])
            if rank is not None:
                heapq.heappush(heap, (rank, i, end[i], end[end[i]]))

    for i in range(n):
        offer(i)
    while heap:
        _, i, middle, stop = heapq.heappop(heap)
        if not alive[i] or end[i] != middle or end[middle] != stop:
            continue
        end[i], alive[middle] = stop, False
        if stop < n:
            before[stop] = i
        offer(i)
        offer(before[i])
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


class Splitter:
    """Texts as lists of chunk numbers, and chunks as lists of pieces.

    A single space between two characters that are no white space starts a piece whatever stands before it, so
    texts can be cut there and every distinct chunk split by the pattern once.  Texts with other white space
    beside a space are split whole.
    """

    def __init__(self, pattern: str):
        import regex

        self.pattern = regex.compile(pattern)
        self.chunks: dict[str, int] = {}  # at a text's start, or whole texts
        self.after: dict[str, int] = {}  # behind a space, which belongs to them
        self.pieces: dict[str, int] = {}
        self.of_chunk: list[list[int]] = []
        self.unclean: set[int] = set()  # chunks that other white space begins or ends, and empty ones

    def _add(self, chunk: str, body: str) -> int:
        number = len(self.of_chunk)
        if not body or body[0].isspace() or body[-1].isspace():
            self.unclean.add(number)
        pieces = self.pieces
        self.of_chunk.append([pieces.setdefault(p, len(pieces)) for p in self.pattern.findall(chunk)])
        return number

    def _first(self, chunk: str) -> int:
        number = self.chunks.get(chunk)
        if number is None:
            number = self.chunks[chunk] = self._add(chunk, chunk)
        return number

    def chunks_of(self, text: str) -> list[int]:
        if not text:
            return []
        first, *rest = text.split(" ")
        after = self.after
        numbers = [self._first(first), *map(after.get, rest)]
        if None in numbers:
            for i, number in enumerate(numbers):
                if number is None:
                    chunk = rest[i - 1]
                    if chunk not in after:
                        after[chunk] = self._add(" " + chunk, chunk)
                    numbers[i] = after[chunk]
        if rest and not self.unclean.isdisjoint(numbers):
            return [self._first(text)]
        return numbers


def _runs(batches: Iterator[pa.RecordBatch], run_chars: int) -> Iterator[tuple[list, list[str]]]:
    keys: list = []
    texts: list[str] = []
    chars = 0
    for batch in batches:
        for key, text in zip(batch.column(0), batch.column(1)):
            text = text.as_py() or ""
            if texts and chars + len(text) > run_chars:
                yield keys, texts
                keys, texts, chars = [], [], 0
            keys.append(key.as_py())
            texts.append(text)
            chars += len(text)
    if texts:
        yield keys, texts


def _gather(arrays: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.fromiter(map(len, arrays), np.int64, len(arrays))
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.uint32)
    return flat, np.concatenate([[0], np.cumsum(lengths)])


def _ranges(numbers: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The places of the ranges ``ends[n]:ends[n + 1]``, one after the other."""
    lengths = ends[numbers + 1] - ends[numbers]
    shift = np.repeat(ends[numbers] - (np.cumsum(lengths) - lengths), lengths)
    return np.arange(len(shift)) + shift


def encode_run(texts: list[str], splitter: Splitter, encoder: Encoder) -> Iterator[tuple[np.ndarray, bytes]]:
    """Ids and decoded bytes of each text."""
    rows = [np.array(splitter.chunks_of(t), np.int32) for t in texts]
    ids, decoded = encoder.encode([p.encode() for p in splitter.pieces])
    flat, ends = _gather(ids)
    counts = np.fromiter(map(len, splitter.of_chunk), np.int64, len(splitter.of_chunk))
    piece_ends = np.concatenate([[0], np.cumsum(counts)])
    pieces = np.fromiter(chain.from_iterable(splitter.of_chunk), np.int64, piece_ends[-1])
    del ids
    for row in rows:
        if not len(row):
            yield np.zeros(0, np.uint32), b""
            continue
        own = pieces[_ranges(row, piece_ends)]
        yield flat[_ranges(own, ends)], b"".join([decoded[p] for p in own.tolist()])


def tokenize(
    docs: DataFrame, ranks: dict[bytes, int], pattern: str, emit, schema: str, *, id_col: str = "doc_id", text_col: str = "text",
    run_chars: int = RUN_CHARS,
) -> DataFrame:
    """``emit(ids, decoded)`` as a tuple of the columns of ``schema`` behind ``doc_id``, for each document.

    ``ranks`` is a tokenizer's vocabulary, whose size does not depend on the documents; it is broadcast.
    """
    spark = docs.sparkSession
    vocabulary = spark.sparkContext.broadcast(ranks)
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = picked.schema["doc_id"].dataType.simpleString()
    out = spark.createDataFrame([], f"doc_id {kind}, {schema}").schema

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(out)
        encoder = Encoder.of(vocabulary.value, run_chars)
        for keys, texts in _runs(batches, run_chars):
            found = encode_run(texts, Splitter(pattern), encoder)
            rows = ((k, *emit(*x)) for k, x in zip(keys, found))
            while some := list(islice(rows, 500)):
                columns = [pa.array(c, f.type) for c, f in zip(zip(*some), arrow)]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return picked.mapInArrow(tidy(each), out)


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, **settings) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded_sha256`` of each document: ids as an array, the decoded bytes as a digest."""

    def emit(ids: np.ndarray, decoded: bytes):
        from hashlib import sha256

        return len(ids), ids.astype(np.int32), sha256(decoded).hexdigest()

    return tokenize(docs, ranks, pattern, emit, "n_tokens long, ids array<int>, decoded_sha256 string", **settings)


def digests(docs: DataFrame, ranks: dict[bytes, int], pattern: str, **settings) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of each document.

    The digests are lowercase hex: of the ids as little-endian unsigned 32-bit integers, and of the decoded bytes.
    """

    def emit(ids: np.ndarray, decoded: bytes):
        from hashlib import sha256

        return len(ids), sha256(ids.astype("<u4").tobytes()).hexdigest(), sha256(decoded).hexdigest()

    return tokenize(docs, ranks, pattern, emit, "n_tokens long, ids_sha256 string, decoded_sha256 string", **settings)
