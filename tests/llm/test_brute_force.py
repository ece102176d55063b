"""Learned operators against plain versions of what they compute."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from daybook.llm import langid, lm_scoring, toxicity

DATA = "/root/testdata/sf0.001"


# ---------------------------------------------------------------- language: exact sets of n-grams


def grams(text):
    """Runs of letters, lower-cased where that is one letter, with one blank around each; every 4 characters of it."""
    letters = "".join((c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else " " for c in text)
    if not letters.strip():
        return []
    padded = f" {' '.join(letters.split())} ".ljust(langid.GRAM)
    return [padded[i : i + langid.GRAM] for i in range(len(padded) - langid.GRAM + 1)]


def exact_sets(rows):
    counts = {}
    for lang, text in rows:
        counts.setdefault(lang, Counter()).update(grams(text))
    totals = {k: sum(c.values()) for k, c in counts.items()}
    held, coverage = {}, {}
    for k, c in counts.items():
        rate = {g: n / totals[k] for g, n in c.items()}
        held[k] = {
            g for g, r in rate.items()
            if r >= langid.MIN_RATE and r >= langid.MIN_RATIO * max(counts[o][g] / totals[o] for o in counts)
        }
        coverage[k] = sum(rate[g] for g in held[k])
    return held, coverage


def test_bloom_filters_decide_like_exact_sets(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").where("lang IS NOT NULL AND text IS NOT NULL")
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    learned = [(r["lang"], r["text"]) for r in docs.where(fold != 0).select("lang", "text").collect()]
    held, coverage = exact_sets(learned)
    filters = langid.learn(docs.where(fold != 0))
    assert filters.languages == sorted(held)
    assert np.allclose(filters.coverage, [coverage[k] for k in filters.languages], atol=1e-9)
    texts = [r["text"] for r in docs.select("text").collect()]
    assert len(texts) > 50
    for text in [*texts, "ab", "Ünïcode ÇA", "İstanbul"]:
        found = grams(text)
        assert len(langid.gram_hashes(text, filters.letters)) == len(found)
        exact = np.array([sum(g in held[k] for g in found) / len(found) for k in filters.languages])
        # a filter misses none of its own; what it adds beside them is subtracted on average
        shares = filters.shares(text) * filters.coverage
        noise = 5 * np.sqrt(filters.false_positives / len(found)) + 1e-6
        assert (np.abs(shares - exact) <= noise + 2 * filters.false_positives).all(), text[:40]
        weighed = exact / np.array([coverage[k] for k in filters.languages])
        first, second = sorted(weighed)[-1:-3:-1] if len(weighed) > 1 else (weighed[0], 0)
        if first - second > 0.1:
            assert filters.decide(text)[0] == filters.languages[int(np.argmax(weighed))]


# ---------------------------------------------------------------- language model: one id at a time


def plain_score(w, vocabulary, ids, end):
    """log10 probability of a text, each id from the window that scores it, position by position, in doubles."""
    w = {k: v.astype(np.float64) for k, v in w.items()}
    total, width = 0.0, lm_scoring.WIDTH
    for at, target in enumerate(ids):
        if at < lm_scoring.WINDOW:
            start = 0
        else:
            start = lm_scoring.STRIDE * ((at - lm_scoring.WINDOW) // lm_scoring.STRIDE + 1)
        inputs = [end if p == 0 else ids[p - 1] for p in range(start, at + 1)]
        states = [w["embed"][vocabulary.inputs[i]] + w["place"][n] for n, i in enumerate(inputs)]
        query = states[-1] @ w["q"]
        scores = [math.exp(float(query @ (s @ w["k"])) / math.sqrt(width)) for s in states]
        mixed = sum(a * (s @ w["v"]) for a, s in zip(scores, states)) / sum(scores)
        h = states[-1] + mixed @ w["o"]
        top = h + np.maximum(h @ w["in"] + w["in_bias"], 0) @ w["out"]
        logits = top @ w["class"] + w["class_bias"]
        total += (logits[vocabulary.classes[target]] - math.log(np.exp(logits).sum())) / math.log(10)
        total += float(vocabulary.part[target])
    return total


def test_scores_like_a_plain_forward_pass():
    draw = np.random.default_rng(3)
    counts = draw.integers(0, 500, 3000).astype(float)
    vocabulary = lm_scoring.Vocabulary(counts, draw.random((3000, lm_scoring.NEIGHBOURS)))
    weights = lm_scoring.initial(vocabulary)
    end = 2999
    sizes = [1, 2, 16, 31, 32, 33, 47, 48, 49, 64, 65, 200]
    texts = [np.append(draw.integers(0, end, n - 1), end).astype(np.int32) for n in sizes]
    seen = [(t, np.full(1, len(t))) for t in texts]
    trained = lm_scoring._trained(weights, vocabulary, lambda: iter(seen), end, 5)
    found = lm_scoring._scores(trained, vocabulary, np.concatenate(texts), np.array(sizes), end)
    for text, score in zip(texts, found):
        assert math.isclose(score, plain_score(trained, vocabulary, text.tolist(), end), rel_tol=1e-4, abs_tol=1e-3), len(text)


# ---------------------------------------------------------------- toxicity: every path through the lattice


def readings(token, i):
    """What the character at ``i`` can stand for, with its cost."""
    char = token[i]
    own = 0.0 if char.isalpha() else toxicity.STAYS_LEET if char in toxicity.LEET else toxicity.STAYS
    found = [(char, own)] + [(letter, toxicity.IMITATES) for letter in toxicity.LEET.get(char, "")]
    if char in toxicity.SEPARATORS and 0 < i < len(token) - 1:
        found.append(("", toxicity.DROPS / 2 if char == " " else toxicity.DROPS))
    run_before = i > 1 and token[i - 2 : i] == char * 2
    run_around = i > 0 and token[i - 1] == char and token[i + 1 : i + 2] == char
    if run_before or run_around:
        found.append(("", toxicity.REPEATS))
    return found


def all_readings(token, model):
    paths = [("", 0.0)]
    for i in range(len(token)):
        paths = [(text + letter, cost + more) for text, cost in paths for letter, more in readings(token, i)]
    for text, cost in paths:
        kinds = [0, 0, *(toxicity._class_of(c) for c in text), 0]
        yield cost + sum(float(model[kinds[n : n + 3][0], kinds[n + 1], kinds[n + 2]]) for n in range(len(kinds) - 2)), text


@pytest.mark.parametrize("seed", range(8))
def test_viterbi_finds_the_best_of_all_paths(seed):
    draw = np.random.default_rng(seed)
    model = toxicity.character_model(draw.integers(0, 50, toxicity._CLASSES**3).astype(float))
    for n in (1, 2, 3, 5, 8):
        for _ in range(12):
            token = "".join(draw.choice(list("aabls0011144$@|*-. "), n))
            if toxicity._LONG_RUN.search(token):
                continue  # shortened before it is decoded
            by_text = {}
            for score, text in all_readings(token, model):
                by_text[text] = max(score, by_text.get(text, -math.inf))
            best = max(by_text.values())
            assert by_text[toxicity.restore(token, model)] >= best - 1e-9, token
