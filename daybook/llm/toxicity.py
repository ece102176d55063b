"""Toxicity scores on text restored by a noisy channel.

Method: a token that looks disguised (digits or symbols among letters, a letter three times in a row, letters spaced out,
or only characters that imitate letters) becomes a lattice: each character stands for itself, for the letters it imitates, or, if it separates or repeats, for
nothing.  Viterbi decoding finds the path that is likeliest under a character trigram model of the corpus times the
channel's costs, for tokens of any length; runs of one character count as three.  The restored tokens are scored by a
logistic model on words and word beginnings.

What is learned: the character model's counts cover all texts that ``learn`` is given.  The logistic model sees
labelled documents only, at most about ``sample`` of them, chosen by a hash of their ids; its features are the
``FEATURES`` words and beginnings that tell the labels apart best.  Both have a size that does not depend on the corpus
and are broadcast.

Defined cases: a null or empty text is scored by the prior alone; without labelled rows of both kinds, or without a feature
that tells them apart, every score is the smoothed share of toxic rows, but below one half; null labels are not learned from; repeated rows each get a row, and a document with
several labels counts once for each; extra columns are ignored.  No rows in, no rows out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from os.path import commonprefix

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.staging import Stages, tidy

SAMPLE = 16_000
FEATURES = 4000
CANDIDATES = 100_000  # words and beginnings of most toxic documents, from which the features are chosen
LEAST_Z = 4.0
_CLASSES = 64  # character classes of the model: 0 for what is no letter, 1-26 for a-z, the rest share 37
_LAST = 0x323B0
_CACHE = 400_000  # tokens whose weights a task remembers at a time
_COMMIT = 64  # characters after which decoding settles what all its paths share
_CHUNK = 1 << 20
_UNDECIDED = -0.1  # log odds, at most, where nothing tells documents apart: a score just below one half

# What characters imitate, and which separate letters.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "*": "aeiou",
}
CODED = 3  # characters that imitate letters, in a token without letters that can be a word
SEPARATORS = " .-_*~'\"·,/\\"
IMITATES, DROPS, REPEATS, STAYS, STAYS_LEET = np.log(0.3), np.log(0.3), np.log(0.5), np.log(0.02), np.log(1e-4)

_EDGES = re.compile(r"^[^\w@$!|+(€£*]+|[^\w@$]+$")
_LETTER = re.compile(r"[^\W\d_]")
_SIGN = re.compile(r"[\d@$!|+(€£* ._\-~'\"·,/\\]")
_LETTER_TRIPLE = re.compile(r"([^\W\d_])\1\1")
_LONG_RUN = re.compile(r"(.)\1{3,}")
_TRIPLE = re.compile(r"(.)\1\1")
_PLAIN_EDGES = ".,;:?\"'()[]-"
_PAIR_OF_SINGLES = re.compile(r"(?:^|\s)\S[ \t]\S(?!\S)")
_SPACED = re.compile(r"(?:(?<=\s)|^)(?:[^\W_]|[@$!|+(€£*])(?:[ \t](?:[^\W_]|[@$!|+(€£*])(?=\s|$|[.,;:?])){2,}")


def character_classes() -> np.ndarray:
    """For each code point its class in the character model."""
    table = np.zeros(_LAST + 1, np.uint8)
    for point in range(_LAST):
        char = chr(point)
        if char.isalpha():
            table[point] = _class_of(char.lower()[0])
    return table


def _class_of(char: str) -> int:
    if "a" <= char <= "z":
        return ord(char) - 96
    return 27 + ord(char) % (_CLASSES - 27) if char.isalpha() else 0


def trigram_counts(texts: DataFrame) -> np.ndarray:
    """Counts of character class triples over all texts (one column), by task, then by triple."""
    table = texts.sparkSession.sparkContext.broadcast(character_classes())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_CLASSES**3, np.int64)

        def add(joined: str) -> None:
            points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
            for at in range(2, len(points), _CHUNK):
                kinds = table.value[np.minimum(points[at - 2 : at + _CHUNK], _LAST)].astype(np.int32)
                triples = (kinds[:-2] << 12) | (kinds[1:-1] << 6) | kinds[2:]
                np.add(total, np.bincount(triples, minlength=_CLASSES**3), out=total)

        held, size = [""], 0  # texts are counted together, two blanks before and behind each
        for batch in batches:
            for text in batch.column(0):
                text = text.as_py() or ""
                held.append(text)
                size += len(text)
                if size > _CHUNK:
                    add("  ".join([*held, ""]))
                    held, size = [""], 0
        add("  ".join([*held, ""]))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["triple", "n"])

    counts = texts.mapInArrow(count, "triple long, n long").groupBy("triple").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(_CLASSES**3, np.float64)
    out[counts["triple"].to_numpy(np.int64)] = counts["n"].to_numpy(np.float64)
    return out


def character_model(counts: np.ndarray) -> np.ndarray:
    """log p(c | a, b) as a table by class, trigrams backed off to bigrams and single characters."""
    three = counts.reshape(_CLASSES, _CLASSES, _CLASSES)
    two, one = three.sum(axis=0), three.sum(axis=(0, 1))
    single = (one + 0.5) / (one.sum() + 0.5 * _CLASSES)
    pair = (two + 20 * single) / (two.sum(axis=1, keepdims=True) + 20)
    triple = (three + 20 * pair[None]) / (three.sum(axis=2, keepdims=True) + 20)
    return np.log(triple).astype(np.float32)


def _disguised(token: str) -> bool:
    """Whether it has a letter and a digit or symbol, a letter three times in a row, or no letter but CODED imitations.

    In time linear in the token's length.
    """
    if _LETTER.search(token):
        return bool(_SIGN.search(token) or _LETTER_TRIPLE.search(token))
    return sum(char in LEET for char in token) >= CODED


def restore(token: str, model: np.ndarray) -> str:
    """The likeliest text behind a lower-case token (or letters with spaces between them), of any length."""
    token = _LONG_RUN.sub(r"\1\1\1", token)
    settled: list[str] = []
    # by the classes of the last two characters: (log probability, text behind what is settled)
    paths: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
    for i, char in enumerate(token):
        if i and i % _COMMIT == 0:  # what all paths begin with is in the result whichever wins, so this changes nothing
            prefix = commonprefix([text for _, text in paths.values()])
            settled.append(prefix)
            paths = {state: (score, text[len(prefix) :]) for state, (score, text) in paths.items()}
        options: list[tuple[str, float]] = []
        if char.isalpha():
            options.append((char, 0.0))
        else:
            options.append((char, STAYS_LEET if char in LEET else STAYS))
        options += [(letter, IMITATES) for letter in LEET.get(char, "")]
        if char in SEPARATORS and 0 < i < len(token) - 1:
            options.append(("", DROPS if char != " " else DROPS / 2))
        if i > 1 and char == token[i - 1] == token[i - 2] or i and char == token[i - 1] and token[i + 1 : i + 2] == char:
            options.append(("", REPEATS))
        following: dict[tuple[int, int], tuple[float, str]] = {}
        for (a, b), (score, text) in paths.items():
            for letter, cost in options:
                if letter:
                    c = _class_of(letter)
                    state, total, longer = (b, c), score + cost + float(model[a, b, c]), text + letter
                else:
                    state, total, longer = (a, b), score + cost, text
                known = following.get(state)
                if known is None or total > known[0]:
                    following[state] = (total, longer)
        paths = following
    ended = ((score + float(model[a, b, 0]), text) for (a, b), (score, text) in paths.items())
    return "".join(settled) + max(ended)[1]


def words_of(raw: str, model: np.ndarray) -> list[str]:
    """The restored words of a white-space token of lower-case text, or of spaced-out letters."""
    token = raw.strip(_PLAIN_EDGES)
    if token.isalpha() and (len(token) - len(set(token)) < 2 or not _TRIPLE.search(token)):
        return [token]
    token = _EDGES.sub("", raw)
    if not token:
        return []
    plain = re.findall(r"[^\W\d_]+", token)
    if _disguised(token):
        return sorted({*plain, *re.findall(r"[^\W\d_]+", restore(token, model))})
    return plain


def features_of(word: str) -> list[str]:
    """The word, and its beginnings of 3 to 7 letters."""
    return [f"={word}", *(word[:n] for n in range(3, min(7, len(word)) + 1))]


def token_features(raw: str, model: np.ndarray) -> list[str]:
    """Features of a token's words; of one without letters, which may be a number, the whole words only."""
    words = words_of(raw, model)
    return [f for w in words for f in features_of(w)] if _LETTER.search(raw) else [f"={w}" for w in words]


def tokens_of(text: str) -> set[str]:
    """The different white-space tokens of a text, lower-cased, and its runs of spaced-out letters."""
    lower = text.lower()
    found = set(lower.split())
    if _PAIR_OF_SINGLES.search(lower):
        found.update(m.group() for m in _SPACED.finditer(lower))
    return found


@dataclass
class Scorer:
    model: np.ndarray
    weights: dict[str, float]
    bias: float
    known: dict[str, float] = field(default_factory=dict)

    def _weigh(self, token: str) -> float:
        if len(self.known) >= _CACHE:
            self.known.clear()
        weight = self.weights.get
        total = sum([weight(f, 0.0) for f in token_features(token, self.model)], 0.0)
        self.known[token] = total
        return total

    def score(self, text: str | None) -> float:
        total = self.bias
        known = self.known
        for token in tokens_of(text or ""):
            weight = known.get(token)
            total += self._weigh(token) if weight is None else weight
        return float(1 / (1 + np.exp(-np.clip(total, -30, 30))))


def _fit(rows: pd.DataFrame, features: int, prior: float) -> tuple[np.ndarray, float]:
    """Logistic regression on sparse counts with a ridge, by Adam on all rows.

    Toxic rows weigh more, by how rare they are: one word among many has to be enough.
    """
    weights, bias = np.zeros(features), prior
    at = np.repeat(np.arange(len(rows)), [len(x) for x in rows["found"]])
    if not len(at):
        return weights, bias
    which = np.concatenate([np.asarray(x, np.int64) for x in rows["found"]])
    toxic = rows["toxic"].to_numpy(np.float64)
    weigh = np.where(toxic == 1, max(1.0, (1 - toxic).sum() / max(1.0, toxic.sum())) ** 0.75, 1.0)
    mean, spread = np.zeros(features + 1), np.zeros(features + 1)
    for step in range(1, 501):
        margin = bias + np.bincount(at, weights[which], len(rows))
        error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - toxic) * weigh
        slope = np.append(np.bincount(which, error[at], features) + 0.02 * weights, error.sum())
        slope /= len(rows)
        mean, spread = 0.9 * mean + 0.1 * slope, 0.99 * spread + 0.01 * slope**2
        move = 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.99**step)) + 1e-9)
        weights, bias = weights - move[:-1], bias - move[-1]
    return weights, float(bias)


def learn(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    sample: int = SAMPLE,
) -> Scorer:
    """A scorer from the texts of ``docs`` and the labels 0 and 1 of some of them; ``labels`` has id and label.

    Without labels of both kinds, or without a feature that tells them apart, every document scores below one half.
    """
    spark = docs.sparkSession
    stages = Stages(spark, "toxicity")
    model = character_model(trigram_counts(docs.select(text_col)))
    marked = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic")).where("toxic IN (0, 1) AND id IS NOT NULL")
    totals = marked.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")).first()
    share = min(1.0, sample / max(1, totals["n"]))
    prior = float(np.log((totals["toxic"] + 0.5) / (totals["n"] - totals["toxic"] + 0.5)))
    if not 0 < totals["toxic"] < totals["n"]:
        return Scorer(model, {}, min(prior, _UNDECIDED))
    drawn = marked.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < share * (1 << 20))
    shared = spark.sparkContext.broadcast(model)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list[str]] = {}
        for batch in batches:
            found = []
            for text in batch.column(1):
                own: set[str] = set()
                for token in tokens_of(text.as_py() or ""):
                    if token not in known:
                        if len(known) >= _CACHE // 4:
                            known.clear()
                        known[token] = token_features(token, shared.value)
                    own.update(known[token])
                found.append(sorted(own))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.string()))], ["toxic", "features"])

    # the sample's ids are bounded by ``sample``, so they are broadcast
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(drawn), "id").select("toxic", "text")
    examples = stages.write(texts.mapInArrow(tidy(extract), "toxic int, features array<string>"))
    seen = examples.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")).first()
    yes, no = seen["toxic"], seen["n"] - seen["toxic"]
    if not yes or not no:
        return Scorer(model, {}, min(prior, _UNDECIDED))
    in_toxic = examples.where("toxic = 1").select(F.explode("features").alias("f")).groupBy("f").agg(F.count(F.lit(1)).alias("a"))
    candidates = stages.write(in_toxic.where("a >= 5").orderBy(F.desc("a"), "f").limit(CANDIDATES))
    every = examples.select(F.explode("features").alias("f")).join(F.broadcast(candidates), "f")
    per_feature = every.groupBy("f", "a").agg(F.count(F.lit(1)).alias("n"))
    p, q, both = F.col("a") / yes, (F.col("n") - F.col("a")) / no, F.col("n") / (yes + no)
    z = (p - q) / F.sqrt(both * (1 - both) * (1 / yes + 1 / no) + 1e-12)
    best = per_feature.select("f", z.alias("z")).where(F.col("z") >= LEAST_Z).orderBy(F.desc("z"), "f").limit(FEATURES)
    names = [r["f"] for r in best.collect()]
    place = {f: i for i, f in enumerate(names)}

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[place[f] for f in x.as_py() if f in place] for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int32()))], ["toxic", "found"])

    rows = examples.mapInArrow(tidy(pick), "toxic int, found array<int>").toPandas()
    stages.drop(examples)
    if not names:
        return Scorer(model, {}, min(prior, _UNDECIDED))
    weights, bias = _fit(rows, len(names), prior)
    return Scorer(model, dict(zip(names, weights.tolist())), bias)


def score(docs: DataFrame, scorer: Scorer, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score, predicted`` per row; 1 from a score of one half on."""
    shared = docs.sparkSession.sparkContext.broadcast((scorer.model, scorer.weights, scorer.bias))
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = picked.schema["doc_id"].dataType.simpleString()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Scorer(*shared.value)
        for batch in batches:
            found = np.array([own.score(t.as_py()) for t in batch.column(1)], np.float64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found), pa.array((found >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"]
            )

    return picked.mapInArrow(tidy(each), f"doc_id {kind}, score double, predicted int")


def keep_clean(docs: DataFrame, scorer: Scorer, *, text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, whose text scores below one half."""
    shared = docs.sparkSession.sparkContext.broadcast((scorer.model, scorer.weights, scorer.bias))
    at = docs.columns.index(text_col)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Scorer(*shared.value)
        for batch in batches:
            yield batch.filter(pa.array([own.score(t.as_py()) < 0.5 for t in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(tidy(each), docs.schema)
