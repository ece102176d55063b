"""Mixing sources to target weights by soft membership.

Method: a softmax classifier learned from a table of labelled documents predicts for every document the posterior of
each domain.  A document's rate is how many times it is wanted; a domain's expected total is the sum of rate x tokens x
posterior.  Projected-gradient least squares moves all rates from 1 until the totals match the targets, with rates kept
between ``lowest`` (0) and ``most`` (3): each step adds to every rate the posterior's product with the totals' gap and
cuts it at the bounds.  The gap is scaled by the overlap of the domains among documents that no bound holds, which takes
few steps; once a bound stands in the way, by one number for all domains, told from the last two gaps.  The rates of
the least squared error count.  A step is one distributed sum per domain, made in numpy where the rows are; a rate
follows from the steps' gaps, a few numbers each, so nothing but these sums reaches the driver, no rates are written
between steps, and the driver's plan is the same size at every step.
Documents that the classifier takes for one of the domains ``kept`` have the lower bound 1 instead, and the budget is
raised as far as these domains' tokens ask for, so that none of their documents is dropped at any share.  Targets that
cannot be met within the bounds are left as near as least squares comes; ``Fit.unmet`` has what is missing.

The classifier sees at most about ``sample`` labelled documents, chosen by a hash of their ids; its features are byte
trigram frequencies in ``BUCKETS`` buckets and a few shares that describe a text, so its size is fixed and it is
broadcast.  Everything else covers all documents.

Defined cases: a null or empty text, or one of white space, has no tokens and no weight in the totals, so its rate is 1;
without any bytes its posteriors are the class shares of the sample.  Without labelled documents all domains of the
targets are equally likely.  A domain without a target has target 0; one that no document belongs to is reported as a
gap, as are totals that cannot be met.  Repeated rows each have a rate; whole copies are drawn by id and text.  Other
columns pass through ``expand`` untouched.  No rows in, no rows out.
"""

from __future__ import annotations

from collections.abc import Collection, Iterator, Mapping
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.staging import Stages, tidy

SAMPLE = 8000
BUCKETS = 512
STEPS = 40
CLOSE = 1e-6
MOST = 3.0  # times that one document may come
_CHUNK = 1 << 20


def describe(text: str | None) -> np.ndarray:
    """Square roots of trigram bucket shares, then shares of kinds of bytes and of different words."""
    out = np.zeros(BUCKETS + 8, np.float32)
    data = (text or "").encode("utf-8", "surrogatepass")
    if not data:
        return out
    raw = np.frombuffer(data, np.uint8)
    counts = np.zeros(BUCKETS, np.int64)
    for at in range(0, len(raw), _CHUNK):
        wide = raw[at : at + _CHUNK + 2].astype(np.uint32)
        if len(wide) > 2:
            mixed = (wide[:-2] * np.uint32(0x9E3779B1) + wide[1:-1] * np.uint32(0x85EBCA77) + wide[2:] * np.uint32(0xC2B2AE3D))
            counts += np.bincount(mixed >> np.uint32(23), minlength=BUCKETS)
    out[:BUCKETS] = np.sqrt(counts / max(1, counts.sum()))
    kinds = np.bincount(raw, minlength=256)
    n = len(raw)
    words = data.split()
    out[BUCKETS:] = (
        kinds[65:91].sum() / n, kinds[48:58].sum() / n, kinds[33:48].sum() / n, kinds[58:65].sum() / n,
        kinds[128:].sum() / n, kinds[10] / n, len(set(words)) / max(1, len(words)), min(1.0, len(words) / 1000),
    )
    return out


@dataclass
class Classifier:
    domains: list[str]
    weights: np.ndarray  # features x domains, for standardised features
    bias: np.ndarray
    mean: np.ndarray
    spread: np.ndarray

    def posteriors(self, features: np.ndarray) -> np.ndarray:
        logits = (features - self.mean) / self.spread @ self.weights + self.bias
        # no features, no evidence
        logits[~features.any(axis=1)] = self.bias
        logits = np.exp(logits - logits.max(axis=1, keepdims=True))
        return logits / logits.sum(axis=1, keepdims=True)


def learn(
    docs: DataFrame, labelled: DataFrame, domains: list[str], *, id_col: str = "doc_id", text_col: str = "text",
    domain_col: str = "domain", sample: int = SAMPLE,
) -> Classifier:
    """A classifier of ``domains`` from the texts of ``docs`` and a table of ids and domains."""
    marked = labelled.select(F.col(id_col).alias("id"), F.col(domain_col).alias("domain")).where(
        F.col("domain").isin(domains) & F.col("id").isNotNull()
    )
    share = min(1.0, sample / max(1, marked.count()))
    drawn = marked.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < share * (1 << 20))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [describe(t.as_py()).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["domain", "features"])

    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(drawn), "id")
    rows = texts.select("domain", "text").mapInArrow(tidy(extract), "domain string, features binary").toPandas()
    size = BUCKETS + 8
    k = len(domains)
    if rows.empty:
        return Classifier(domains, np.zeros((size, k)), np.zeros(k), np.zeros(size), np.ones(size))
    features = np.frombuffer(b"".join(rows["features"]), np.float32).reshape(len(rows), size)
    return _fit(features, rows["domain"].map({d: i for i, d in enumerate(domains)}).to_numpy(), domains)


def _fit(features: np.ndarray, truth: np.ndarray, domains: list[str]) -> Classifier:
    """Softmax regression with a ridge, by full-batch Adam."""
    k = len(domains)
    mean, spread = features.mean(axis=0), features.std(axis=0) + 1e-3
    x = (features - mean) / spread
    wanted = np.eye(k, dtype=np.float32)[truth]
    weights = np.zeros((x.shape[1], k), np.float32)
    bias = np.log((wanted.sum(axis=0) + 0.5) / (len(x) + 0.5 * k)).astype(np.float32)
    first, second = np.zeros((x.shape[1] + 1, k)), np.zeros((x.shape[1] + 1, k))
    for step in range(1, 151):
        logits = x @ weights + bias
        guess = np.exp(logits - logits.max(axis=1, keepdims=True))
        guess /= guess.sum(axis=1, keepdims=True)
        error = (guess - wanted) / len(x)
        slope = np.vstack([x.T @ error + 1e-3 * weights, error.sum(axis=0)])
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        move = 0.03 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        weights, bias = (weights - move[:-1]).astype(np.float32), (bias - move[-1]).astype(np.float32)
    return Classifier(domains, weights, bias, mean, spread)


def memberships(docs: DataFrame, classifier: Classifier, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, draw, n_tokens, posteriors``: white-space tokens, and the posteriors in the classifier's order.

    ``draw`` is a number in [0, 1) that a document's id and text fix.
    """
    shared = docs.sparkSession.sparkContext.broadcast(
        (classifier.domains, classifier.weights, classifier.bias, classifier.mean, classifier.spread)
    )
    draw = F.pmod(F.xxhash64(F.lit("copies"), F.col(id_col), F.col(text_col)), F.lit(1 << 30)) / float(1 << 30)
    picked = docs.select(F.col(id_col).alias("doc_id"), draw.alias("draw"), F.col(text_col).alias("text"))
    kind = picked.schema["doc_id"].dataType.simpleString()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Classifier(*shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                texts = [t.as_py() for t in part.column(2)]
                found = known.posteriors(np.stack([describe(t) for t in texts]))
                tokens = [len((t or "").split()) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(tokens, pa.int64()), pa.array(found.tolist(), pa.list_(pa.float64()))],
                    ["doc_id", "draw", "n_tokens", "posteriors"],
                )

    return picked.mapInArrow(tidy(each), f"doc_id {kind}, draw double, n_tokens long, posteriors array<double>")


def _bound(lowest: float | Column) -> Column:
    return lowest if isinstance(lowest, Column) else F.lit(float(lowest))


def _rate(
    posteriors: Column, gaps: list[np.ndarray], lowest: float | Column, most: float = np.inf, tokens: Column | None = None
) -> Column:
    """A document's rate after the steps with these (scaled) gaps; 1 if it has no tokens."""

    def step(rate: Column, gap: Column) -> Column:
        move = sum((posteriors[i] * gap[i] for i in range(len(gaps[0]))), F.lit(0.0))
        rate = F.greatest(_bound(lowest), rate + move)
        return F.least(F.lit(float(most)), rate) if most < np.inf else rate

    # a loop over the gaps: an expression nested once a step would have to be compiled again for each number of steps
    rate = F.aggregate(F.lit([[float(g) for g in gap] for gap in gaps]), F.lit(1.0), step) if gaps else F.lit(1.0)
    return rate if tokens is None else F.when(tokens > 0, rate).otherwise(F.lit(1.0))


def _rates(posteriors: np.ndarray, gaps: list[np.ndarray], lowest: np.ndarray, most: float) -> np.ndarray:
    """The same in numpy; ``posteriors`` is domains x documents."""
    rate = np.ones(posteriors.shape[1])
    for gap in gaps:
        move = np.zeros_like(rate)
        for own, g in zip(posteriors, gap):
            move += own * g
        rate = np.minimum(most, np.maximum(lowest, rate + move))
    return rate


@dataclass
class Fit:
    gaps: list[np.ndarray]
    lowest: float | Column
    targets: np.ndarray  # tokens per domain
    totals: np.ndarray  # expected tokens per domain at the fitted rates
    most: float = np.inf

    @property
    def unmet(self) -> np.ndarray:
        """Tokens that each domain lacks (or, below 0, has too many of)."""
        return self.targets - self.totals

    def rate(self) -> Column:
        return _rate(F.col("posteriors"), self.gaps, self.lowest, self.most, F.col("n_tokens"))


def fit_rates(
    members: DataFrame, targets: np.ndarray, *, lowest: float | Column = 0.0, most: float = np.inf, steps: int = STEPS
) -> Fit:
    """Rates whose expected domain totals match ``targets`` (tokens by domain); ``members`` is read once a step."""
    k = len(targets)
    columns = [F.col("posteriors")[i] for i in range(k)] + [F.col("n_tokens").cast("double"), _bound(lowest).cast("double")]
    given = members.select(*[F.coalesce(c, F.lit(0.0)).alias(f"c{i}") for i, c in enumerate(columns)])

    def sums(gaps: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = np.zeros(k + 2 * k * k + 1)
            for batch in batches:
                *p, t, low = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(k + 2))
                p = np.stack(p)
                rate = _rates(p, gaps, low, most)
                # before the first step all may move, also those whose bound is where rates start
                moving = np.where((rate > low) & (rate < most), t, 0.0) if gaps else t
                now, every, some = (p * (t * rate)).sum(axis=1), (p * t) @ p.T, (p * moving) @ p.T
                found += np.concatenate([now, every.ravel(), some.ravel(), [t.sum()]])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(found))), pa.array(found)], ["place", "value"])

        # one plan for all steps, whose size does not follow their number
        rows = given.mapInArrow(tidy(each), "place long, value double").groupBy("place").agg(F.sum("value").alias("value")).collect()
        found = np.zeros(k + 2 * k * k + 1)
        for row in rows:
            found[row["place"]] = row["value"]
        every, some = found[k:-1].reshape(2, k, k)
        return found[:k], every, some, max(1.0, found[-1])

    gaps: list[np.ndarray] = []
    best, held, totals = np.inf, gaps, None
    quick, error_before, left_before, stale = True, np.inf, None, 0
    for _ in range(steps):
        now, every, some, whole = sums(gaps)
        left, every, some = (targets - now) / whole, every / whole, some / whole
        error = float((left**2).sum())
        stale = 0 if error < best * (1 - 1e-6) else stale + 1
        if error < best:
            best, held, totals, best_step = error, gaps, now, (left, every, some)
        if np.sqrt(best) < CLOSE or stale > 5:
            break
        if quick and error > error_before / 2:  # a bound stands in the way: go on from the best rates by plain steps
            quick, gaps, left_before, (left, every, some) = False, held, None, best_step
        if quick:
            step = np.linalg.pinv(some + 1e-9 * np.eye(k)) @ left
        else:  # of a length after Barzilai and Borwein, once there is a step to tell it from
            step = left / max(1e-9, float(np.linalg.eigvalsh(every).max()))
            change = left - left_before if left_before is not None else np.zeros(k)
            if change.any():
                step = left * min(1e3, max(1.0, (change @ change) / max(1e-12, change @ some @ change)))
            left_before = left
        error_before = error
        gaps = [*gaps, step]
    return Fit(held, lowest, targets, totals, most)


def mix(
    docs: DataFrame, labelled: DataFrame, targets: Mapping[str, float], *, id_col: str = "doc_id", text_col: str = "text",
    domain_col: str = "domain", budget: float = 1.0, lowest: float = 0.0, most: float = MOST, sample: int = SAMPLE,
    kept: Collection[str] = (),
) -> tuple[DataFrame, Fit]:
    """``doc_id, draw, n_tokens, posteriors, rate, copies`` per row, and the fit.

    ``targets`` are shares of the mixture by domain (scaled to sum 1); ``budget`` is the mixture's size in times of the
    documents' tokens, or more if the domains ``kept`` need it: documents that the classifier takes for one of these have
    a rate of 1 or more.  ``copies`` is the rate rounded up or down at random, so that totals stay right on average.
    """
    if not max(1.0, lowest) <= most < float("inf"):
        raise ValueError("most is a finite number, at least 1 and at least lowest")
    stages = Stages(docs.sparkSession, "mixing")
    domains = sorted(targets)
    if not domains or min(targets.values()) < 0 or sum(targets.values()) <= 0:
        raise ValueError("targets are shares of at least one domain, none below 0")
    if any(targets.get(d, 0) <= 0 for d in kept):
        raise ValueError("domains that are kept have targets above 0")
    classifier = learn(docs, labelled, domains, id_col=id_col, text_col=text_col, domain_col=domain_col, sample=sample)
    members = stages.write(memberships(docs, classifier, id_col=id_col, text_col=text_col))
    p, n = F.col("posteriors"), F.col("n_tokens")
    sums = members.agg(F.sum(n), *[F.sum(n * p[i]) for i in range(len(domains))]).first()
    tokens, *whole = [x or 0 for x in sums]
    shares = np.array([targets[d] for d in domains], np.float64)
    shares /= shares.sum()
    size = max([budget * tokens, *(whole[i] / shares[i] for i, d in enumerate(domains) if d in kept)])
    bound: float | Column = lowest
    if kept:
        taken = [p[i] == F.array_max(p) for i, d in enumerate(domains) if d in kept]
        bound = F.when(reduce(Column.__or__, taken), F.lit(max(1.0, lowest))).otherwise(F.lit(float(lowest)))
    fit = fit_rates(members, shares * size, lowest=bound, most=most)
    rated = members.withColumn("rate", fit.rate())
    return rated.withColumn("copies", F.floor(F.col("rate") + F.col("draw")).cast("long")), fit


def expand(docs: DataFrame, mixed: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, each as often as its copies say."""
    draw = F.pmod(F.xxhash64(F.lit("copies"), F.col(f"_doc.`{id_col}`"), F.col(f"_doc.`{text_col}`")), F.lit(1 << 30)) / float(1 << 30)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"))
    # repeated rows have the same copies, so one of them is enough to look these up
    wanted = mixed.where("copies > 0").groupBy(F.col("doc_id").alias("_id"), F.col("draw").alias("_draw")).agg(F.max("copies").alias("_copies"))
    found = rows.join(wanted, F.col(f"_doc.`{id_col}`").eqNullSafe(F.col("_id")) & (draw == F.col("_draw")))
    # a document comes ``most`` times at most
    return found.select("_doc", F.explode(F.array_repeat(F.lit(True), F.col("_copies").cast("int"))).alias("_copy")).select("_doc.*")
