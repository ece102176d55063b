"""Operators that learn: held-out accuracy, exact parts against brute force, defined cases."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from daybook.llm import langid, lm_scoring, mixing, toxicity
from daybook.llm.queries import KEPT, TARGETS, op9_mixing, quality_domains, tokenizer

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


def fold(n):
    return F.crc32(F.col("doc_id").cast("string")) % n


def test_languages_of_held_out_documents(docs, odd_docs, no_docs):
    filters = langid.learn(docs.where(fold(5) != 0))
    held = docs.where(fold(5) == 0)
    right = langid.identify(held, filters).join(held.select("doc_id", "lang"), "doc_id")
    assert right.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97
    rows = langid.identify(odd_docs, filters).collect()
    assert len(rows) == odd_docs.count()
    assert {r["doc_id"] for r in rows if r["lang_pred"] == "und"} == {4, 5, 6}
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert langid.identify(no_docs, filters).count() == 0
    nothing = langid.learn(no_docs)
    assert {r["lang_pred"] for r in langid.identify(odd_docs, nothing).collect()} == {"und"}


def test_masks_name_every_language_of_a_gram():
    letters = langid.letter_table()
    a, b = (langid.gram_hashes(t, letters) for t in ("the same words", "die anderen worte"))
    both = langid.Filters.of(letters, ["x", "y"], {"x": a, "y": np.concatenate([a, b])}, [1.0, 1.0])
    x, y = both.shares("the same words")
    assert x == y == 1
    assert both.decide("die anderen worte")[0] == "y"
    assert both.decide("the same words")[0] == "x"  # a tie
    assert both.decide("123 ...") == ("und", 0.0)


def test_disguises_are_restored():
    text = "the loser is an idiot and stupid moron of trash, a scum clown " * 50
    triples = np.zeros(toxicity._CLASSES**3)
    kinds = [toxicity._class_of(c) for c in "  " + text]
    for a, b, c in zip(kinds, kinds[1:], kinds[2:]):
        triples[(a << 12) | (b << 6) | c] += 1
    model = toxicity.character_model(triples)
    for disguised, word in [
        ("l0ser", "loser"), ("1d10t", "idiot"), ("$tup1d", "stupid"), ("mooooron", "moron"), ("s-c-u-m", "scum"),
        ("i d i o t", "idiot"), ("tr@sh!", "trash"), ("cl0wn,", "clown"),
    ]:
        assert word in toxicity.words_of(disguised, model), disguised
    assert toxicity.words_of("plain,", model) == ["plain"]
    assert toxicity.words_of("...", model) == []


def test_long_disguises_are_restored():
    text = "you are a worthless loser and a piece of trash, an idiot, a stupid moron of scum " * 50
    triples = np.zeros(toxicity._CLASSES**3)
    kinds = [toxicity._class_of(c) for c in "  " + text]
    for a, b, c in zip(kinds, kinds[1:], kinds[2:]):
        triples[(a << 12) | (b << 6) | c] += 1
    model = toxicity.character_model(triples)
    spaced = "y o u a r e a w o r t h l e s s l o s e r"
    assert spaced in toxicity.tokens_of(spaced)
    for disguised, words in [
        (spaced, {"worthless", "loser"}), ("you-are-a-w0rthless-p1ece-of-tr@sh-and-scum", {"worthless", "piece", "trash"}),
        ("l" + "o" * 60 + "ser", {"loser"}), ("1d10t-" * 1000 + "l0ser", {"idiot", "loser"}),
    ]:
        assert words <= set(toxicity.words_of(disguised, model)), disguised[:50]


def test_words_without_letters_are_restored():
    text = "what an ass, a pass over the grass, a boss " * 50
    triples = np.zeros(toxicity._CLASSES**3)
    kinds = [toxicity._class_of(c) for c in "  " + text]
    for a, b, c in zip(kinds, kinds[1:], kinds[2:]):
        triples[(a << 12) | (b << 6) | c] += 1
    model = toxicity.character_model(triples)
    for coded in ("455", "@$$", "4$$,"):
        assert toxicity.token_features(coded, model) == ["=ass"], coded
    assert toxicity.token_features("12", model) == []
    assert {"=boss", "bos"} <= set(toxicity.token_features("b0$$", model))
    assert toxicity.SAMPLE >= 16_000


def test_settled_text_does_not_change_what_is_restored(monkeypatch):
    draw = np.random.default_rng(4)
    model = toxicity.character_model(draw.integers(0, 50, toxicity._CLASSES**3).astype(float))
    for n in (1, 63, 64, 65, 300):
        token = "".join(draw.choice(list("abilos104$@|-. "), n))
        monkeypatch.setattr(toxicity, "_COMMIT", 10**9)
        whole = toxicity.restore(token, model)
        for every in (1, 7, 64):
            monkeypatch.setattr(toxicity, "_COMMIT", every)
            assert toxicity.restore(token, model) == whole


def test_triples_are_counted_within_texts(spark):
    rows = spark.createDataFrame([("ab",), (None,), ("",), ("b" * 10,)], "text string")
    three = toxicity.trigram_counts(rows).reshape((toxicity._CLASSES,) * 3)
    assert three[1, 2].sum() == 1 and three[1, 2, 0] == 1  # a, b, then the blank between texts
    assert three[2, 2, 2] == 8


def test_toxicity_of_planted_documents(spark, odd_docs, no_docs):
    clean = ["the quick brown fox", "a day of rest and sun", "words that say nothing", "over the hill it ran"]
    rows = []
    for i in range(400):
        text = " ".join(clean[(i + j) % 4] for j in range(6))
        rows.append((i, text + (" you idiot" if i % 5 == 0 else ""), int(i % 5 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    scorer = toxicity.learn(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    tests = spark.createDataFrame([(1, "an 1d10t ran over the hill"), (2, "a day of rest"), (3, "such an iiidiot"), (4, None)], "doc_id long, text string")
    assert {r["doc_id"]: r["predicted"] for r in toxicity.score(tests, scorer).collect()} == {1: 1, 2: 0, 3: 1, 4: 0}
    assert sorted(r["doc_id"] for r in toxicity.keep_clean(tests, scorer).collect()) == [2, 4]
    assert toxicity.keep_clean(odd_docs, scorer).columns == odd_docs.columns
    assert len(toxicity.score(odd_docs, scorer).collect()) == odd_docs.count()
    assert toxicity.score(no_docs, scorer).count() == 0
    one_kind = toxicity.learn(docs.select("doc_id", "text"), docs.where("toxic = 0").select("doc_id", "toxic"))
    assert toxicity.score(tests, one_kind).agg(F.max("score")).first()[0] < 0.5
    assert toxicity.learn(no_docs, no_docs.select("doc_id", F.lit(1).alias("toxic"))).weights == {}


def test_rates_meet_targets_also_at_the_bound(spark):
    draw = np.random.default_rng(3)
    rows = [(i, int(t), [float(p), float(1 - p)]) for i, (t, p) in enumerate(zip(draw.integers(1, 500, 400), draw.random(400)))]
    members = spark.createDataFrame(rows, "doc_id long, n_tokens long, posteriors array<double>")
    tokens = np.array([r[1] for r in rows], float)
    p = np.array([r[2] for r in rows])
    for share in (0.5, 0.8, 0.92):
        targets = np.array([share, 1 - share]) * tokens.sum()
        fit = mixing.fit_rates(members, targets)
        rates = np.array([r["rate"] for r in members.withColumn("rate", mixing._rate(F.col("posteriors"), fit.gaps, 0.0)).orderBy("doc_id").collect()])
        assert rates.min() >= 0
        # brute force: the same steps in numpy
        plain = np.ones(len(rows))
        for gap in fit.gaps:
            plain = np.maximum(0, plain + p @ gap)
        assert np.allclose(plain, rates)
        assert np.allclose((rates * tokens) @ p, fit.totals)
        if share < 0.9:
            assert np.allclose(fit.totals, targets, rtol=1e-3)


@pytest.mark.parametrize("good", [0.5, 0.86, 0.95, 0.99])
def test_good_documents_are_kept_at_any_share(spark, monkeypatch, good):
    draw = np.random.default_rng(6)
    is_good = draw.random(3000) < good
    p = np.where(is_good, draw.beta(12, 1, 3000), draw.beta(1, 12, 3000))
    rows = [(i, float(draw.random()), int(t), [float(x), float(1 - x)]) for i, (t, x) in enumerate(zip(draw.integers(50, 500, 3000), p))]
    members = spark.createDataFrame(rows, "doc_id long, draw double, n_tokens long, posteriors array<double>")
    monkeypatch.setattr(mixing, "learn", lambda *a, **b: None)
    monkeypatch.setattr(mixing, "memberships", lambda *a, **b: members)
    mixed, fit = mixing.mix(members, members, {"good": 0.9, "poor": 0.1}, kept=("good",))
    found = mixed.where("posteriors[0] >= 0.5").agg(F.min("rate").alias("rate"), F.min("copies").alias("copies")).first()
    assert found["rate"] >= 1 and found["copies"] >= 1
    assert mixed.agg(F.min("rate")).first()[0] >= 0
    assert sum(fit.targets) >= sum(r[2] for r in rows) * (1 - 1e-9)
    with pytest.raises(ValueError):
        mixing.mix(members, members, {"good": 0.0, "poor": 1.0}, kept=("good",))


def test_mixing_of_documents(spark, docs, odd_docs, no_docs):
    labelled = quality_domains(spark.read.parquet(f"{DATA}/labels.parquet"))
    targets = {"good": 0.8, "poor": 0.2}
    mixed, fit = mixing.mix(docs, labelled, targets)
    assert np.allclose(fit.totals, fit.targets, rtol=1e-4)
    truth = mixed.join(labelled, "doc_id").where((F.col("posteriors")[0] > 0.5) == (F.col("domain") == "good")).count()
    assert truth / labelled.count() > 0.9
    out = mixing.expand(docs, mixed)
    assert out.columns == docs.columns
    assert out.count() == mixed.agg(F.sum("copies")).first()[0]
    odd, _ = mixing.mix(odd_docs, labelled.limit(0), targets)
    assert odd.count() == odd_docs.count()
    assert mixing.expand(odd_docs, odd).count() == odd.agg(F.sum("copies")).first()[0]
    assert mixing.mix(no_docs, labelled, targets)[0].count() == 0
    with pytest.raises(ValueError):
        mixing.mix(docs, labelled, {"good": -1.0})


def test_mixing_query_returns_targets_and_totals(spark, small):
    rows = op9_mixing(spark, small).collect()
    assert len(TARGETS) >= 3
    for d in TARGETS:
        assert len({(r[f"target_{d}"], r[f"total_{d}"]) for r in rows}) == 1
        expected = sum(r["rate"] * r["n_tokens"] * r[f"p_{d}"] for r in rows)
        assert math.isclose(rows[0][f"total_{d}"], expected, rel_tol=1e-6)
    assert sum(rows[0][f"target_{d}"] for d in TARGETS) > 0
    for r in rows:
        assert 0 <= r["rate"] <= mixing.MOST and r["copies"] in (int(r["rate"]), int(r["rate"]) + 1)
        best = max(TARGETS, key=lambda d: r[f"p_{d}"])
        assert r["rate"] >= 1 or best not in KEPT
    # a real move: some domain's documents come more often, and some less
    assert max(r["rate"] for r in rows) > 1.2 and min(r["rate"] for r in rows) < 0.95


def least_squares(tokens, p, targets, low, high):
    """Box-bounded least squares by coordinate descent: one rate at a time to its own optimum, until none moves."""
    rates = np.ones(len(tokens))
    rows = p * tokens[:, None]
    gap = targets - rows.T @ rates
    for _ in range(300):
        moved = 0.0
        for i, row in enumerate(rows):
            if tokens[i]:
                new = np.clip(rates[i] + row @ gap / (row @ row), low[i], high)
                gap -= row * (new - rates[i])
                moved, rates[i] = max(moved, abs(new - rates[i])), new
        if moved < 1e-9:
            break
    return rows.T @ rates


@pytest.mark.parametrize("shares", [(0.4, 0.3, 0.3), (0.7, 0.2, 0.1), (0.05, 0.05, 0.9), (0.0, 0.0, 1.0)])
@pytest.mark.parametrize("kept", [False, True])
def test_totals_are_those_of_another_solver(spark, shares, kept):
    draw = np.random.default_rng(9)
    p = draw.dirichlet((0.9, 0.4, 0.3), 250)
    tokens = draw.integers(0, 300, 250) * draw.integers(0, 2, 250)
    rows = [(i, int(t), [float(x) for x in q]) for i, (t, q) in enumerate(zip(tokens, p))]
    members = spark.createDataFrame(rows, "doc_id long, n_tokens long, posteriors array<double>")
    low = (p.argmax(axis=1) == 0) * 1.0 if kept else np.zeros(250)
    column = F.when(F.col("posteriors")[0] == F.array_max("posteriors"), 1.0).otherwise(0.0) if kept else 0.0
    targets = np.array(shares) * tokens.sum()
    fit = mixing.fit_rates(members, targets, lowest=column, most=mixing.MOST)
    plain = least_squares(tokens.astype(float), p, targets, low, mixing.MOST)
    assert ((targets - fit.totals) ** 2).sum() <= ((targets - plain) ** 2).sum() + (1e-3 * tokens.sum()) ** 2
    assert np.allclose(fit.totals, plain, atol=5e-3 * tokens.sum())
    assert np.allclose(fit.unmet, targets - fit.totals)
    found = members.withColumn("rate", fit.rate()).collect()
    assert all(r["rate"] == 1 for r in found if not r["n_tokens"])
    assert all(low[r["doc_id"]] <= r["rate"] <= mixing.MOST for r in found)


def test_steps_of_the_fit_share_one_plan(spark, monkeypatch):
    """The driver's plan must not follow the number of steps: at 40 steps it took the driver's memory."""
    draw = np.random.default_rng(6)
    p = draw.dirichlet((0.9, 0.4, 0.3), 200)
    rows = [(i, int(t), [float(x) for x in q]) for i, (t, q) in enumerate(zip(draw.integers(1, 300, 200), p))]
    members = spark.createDataFrame(rows, "doc_id long, n_tokens long, posteriors array<double>")
    low = F.when(F.col("posteriors")[0] == F.array_max("posteriors"), 1.0).otherwise(0.0)
    plans = []
    for name in ("collect", "first"):
        plain = getattr(type(members), name)

        def noted(self, *args, plain=plain):
            plans.append(self._jdf.queryExecution().analyzed().toString().count("greatest("))
            return plain(self, *args)

        monkeypatch.setattr(type(members), name, noted)
    fit = mixing.fit_rates(members, np.array([0.05, 0.15, 0.8]) * sum(r[1] for r in rows), lowest=low, most=mixing.MOST)
    assert len(plans) > 5 and len(set(plans)) == 1
    # the rates as a column and as the steps have them
    gaps = [draw.normal(0, 0.5, 3) for _ in range(mixing.STEPS)]
    for given in (fit.gaps, gaps, []):
        rated = members.withColumn("rate", mixing._rate(F.col("posteriors"), given, low, mixing.MOST)).orderBy("doc_id")
        assert rated._jdf.queryExecution().optimizedPlan().toString().count("greatest(") <= 1
        found = [r["rate"] for r in rated.collect()]
        assert found == mixing._rates(p.T, given, (p.argmax(axis=1) == 0) * 1.0, mixing.MOST).tolist()


def test_repetition_is_bounded(spark):
    rows = [(0, "good words here " * 3000, "a", 1)] + [(i, "bad", "b", 2) for i in range(1, 8)] + [(9, " \n ", "a", 3), (10, None, "b", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _copy string, _doc int")
    labelled = docs.select("doc_id", F.col("_copy").alias("domain"))
    mixed, fit = mixing.mix(docs, labelled, {"a": 0.5, "b": 0.5}, kept=("a",), most=2.0)
    assert mixed.agg(F.max("copies")).first()[0] <= 2
    assert fit.unmet[1] > 1000
    out = mixing.expand(docs, mixed)
    assert out.columns == docs.columns
    assert {r["doc_id"]: r["n"] for r in out.groupBy("doc_id").agg(F.count("*").alias("n")).where("doc_id > 8").collect()} == {9: 1, 10: 1}
    for most in (0.5, float("inf"), float("nan")):
        with pytest.raises(ValueError):
            mixing.mix(docs, labelled, {"a": 1.0}, most=most)


def test_language_model_and_base(docs):
    scored = {r["doc_id"]: r for r in lm_scoring.scores(docs.limit(300), fold(7) != 2, *tokenizer()).collect()}
    rows = docs.limit(300).withColumn("trains", fold(7) != 2).collect()
    words = {r["doc_id"]: [*(r["text"] or "").encode().lower().split(), None] for r in rows}
    counts = Counter(w for r in rows if r["trains"] for w in words[r["doc_id"]])
    n, v = sum(counts.values()), len(counts)
    for r in rows:
        own, got = words[r["doc_id"]], scored[r["doc_id"]]
        assert got["n_tokens"] == len(own) and got["train_tokens"] == n
        assert got["n_known"] == sum(counts[w] > 0 for w in own)
        assert math.isclose(got["base_score"], sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own), rel_tol=1e-9)
        assert got["score"] < 0


def test_language_model_odd_rows(odd_docs, no_docs):
    rows = lm_scoring.scores(odd_docs, fold(7) != 2, *tokenizer()).collect()
    assert len(rows) == odd_docs.count()
    ends = [r for r in rows if r["doc_id"] in (4, 5, 6)]
    assert all(r["n_tokens"] == 1 for r in ends) and len({round(r["score"], 6) for r in ends}) == 1
    assert lm_scoring.scores(no_docs, fold(7) != 2, *tokenizer()).count() == 0
    untrained = lm_scoring.scores(odd_docs, F.lit(False), *tokenizer()).collect()
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 and r["base_score"] == 0 for r in untrained)


def test_language_model_learns_from_all_training_documents(spark):
    ranks, pattern = tokenizer()
    end = len(ranks)
    rows = [(i, f"some words of text {i} and no more".encode(), i % 7 != 2, i * 5) for i in range(70)]
    docs = spark.createDataFrame(rows, "doc_id long, text binary, trains boolean, draw long")
    runs = lm_scoring._runs(docs, ranks, pattern).cache()
    payloads = [lm_scoring._load(r["payload"]) for r in runs.select("payload").collect()]
    turns = [sum(int(lm_scoring._chosen(p, t).sum()) for p in payloads) for t in range(lm_scoring.ROUNDS)]
    assert sum(turns) == sum(r[2] for r in rows) and min(turns) > 0
    encode = lm_scoring._encoder(ranks, pattern)
    counts = np.zeros(end + 1)
    for _, text, trains, _ in rows:
        for word in text.decode().split() if trains else []:
            counts[encode(" " + word)] += 1
        counts[end] += trains
    # every id of the training documents stands behind one neighbour
    assert (lm_scoring.neighbour_counts(runs, counts, end).sum(axis=1) == counts).all()


def test_training_takes_every_window(monkeypatch):
    vocabulary = lm_scoring.Vocabulary(np.arange(500, 0, -1).astype(float), np.random.default_rng(0).random((500, lm_scoring.NEIGHBOURS)))
    seen = []

    def gradients(w, inputs, truth, counted):
        seen.append(len(inputs))
        return {k: np.zeros_like(v) for k, v in w.items()}

    monkeypatch.setattr(lm_scoring, "_gradients", gradients)
    monkeypatch.setattr(lm_scoring, "LEAST_STEPS", 1)
    runs = [(np.zeros(n * 7, np.int32), np.full(n, 7)) for n in (100, 30)]
    lm_scoring._trained(lm_scoring.initial(vocabulary), vocabulary, lambda: iter(runs), 499, 0)
    assert sum(seen) == 130 and max(seen) == lm_scoring.BATCH


def test_windows_score_every_id_once():
    lengths = np.array([1, 5, 32, 33, 56, 57, 200])
    places, inside, scored = lm_scoring._windows(lengths)
    hits = np.bincount(places[scored], minlength=lengths.sum())
    assert (hits == 1).all() and not (scored & ~inside).any()


def test_training_windows_take_every_id_once():
    lengths = np.array([1, 5, 32, 33, 64, 65, 200])
    places, inside, _ = lm_scoring._windows(lengths, lm_scoring.WINDOW)
    assert (np.bincount(places[inside], minlength=lengths.sum()) == 1).all()
    assert lm_scoring._steps(lengths) == -(-len(places) // lm_scoring.BATCH)


def test_equal_texts_score_alike_wherever_they_stand():
    draw = np.random.default_rng(4)
    vocabulary = lm_scoring.Vocabulary(draw.integers(0, 500, 3000).astype(float), draw.random((3000, lm_scoring.NEIGHBOURS)))
    weights = {k: (x + draw.standard_normal(x.shape)).astype(np.float32) for k, x in lm_scoring.initial(vocabulary).items()}
    same = draw.integers(0, 2999, 77).astype(np.int32)
    texts = [same] * 30 + [draw.integers(0, 2999, n).astype(np.int32) for n in (1, 5, 40, 100)] + [same] * 5
    found = lm_scoring._scores(weights, vocabulary, np.concatenate(texts), np.array([len(t) for t in texts]), 2999)
    assert len(set(found[:30].tolist() + found[-5:].tolist())) == 1


def test_scored_ids_have_half_a_window_before_them():
    lengths = np.array([1, 32, 33, 49, 500])
    places, _, scored = lm_scoring._windows(lengths)
    starts = np.repeat(np.cumsum(lengths) - lengths, lengths)
    for own, counted in zip(places, scored):
        for at in np.flatnonzero(counted):
            assert at >= min(lm_scoring.WINDOW // 2, own[at] - starts[own[at]])


def test_predictions_are_causal_and_sum_to_one():
    counts = np.arange(2000, 0, -1).astype(float)
    vocabulary = lm_scoring.Vocabulary(counts, np.random.default_rng(0).random((2000, lm_scoring.NEIGHBOURS)))
    weights = lm_scoring.initial(vocabulary)
    assert np.allclose([np.sum(10.0 ** vocabulary.part[vocabulary.classes == c]) for c in set(vocabulary.classes.tolist())], 1, atol=1e-3)
    inputs = np.random.default_rng(1).integers(0, 2000, (2, lm_scoring.WINDOW)).astype(np.int32)
    changed = inputs.copy()
    changed[:, 20:] = 7
    one, other = (lm_scoring._classify(weights, lm_scoring._attend(weights, x)["h"])[0].reshape(2, lm_scoring.WINDOW, -1) for x in (inputs, changed))
    assert np.allclose(one[:, :20], other[:, :20], atol=1e-4) and not np.allclose(one[:, 20:], other[:, 20:], atol=1e-4)


def test_gradients_of_a_step_taken_in_parts(monkeypatch):
    vocabulary = lm_scoring.Vocabulary(np.arange(500, 0, -1).astype(float), np.random.default_rng(0).random((500, lm_scoring.NEIGHBOURS)))
    w = {k: x.astype(np.float64) for k, x in lm_scoring.initial(vocabulary).items()}
    draw = np.random.default_rng(5)
    inputs = draw.integers(0, 40, (5, lm_scoring.WINDOW))  # most rows come several times
    truth, counted = draw.integers(0, lm_scoring.CLASSES, inputs.shape), draw.random(inputs.shape) < 0.8
    whole = lm_scoring._gradients(w, inputs, truth, counted)
    monkeypatch.setattr(lm_scoring, "PART", 2)
    parts = lm_scoring._gradients(w, inputs, truth, counted)
    assert set(parts) == set(whole) == set(w)
    assert all(np.allclose(parts[k], whole[k], rtol=1e-9, atol=1e-12) for k in w)
    assert not parts["embed"][40:].any()

    def loss():
        logits = lm_scoring._classify(w, lm_scoring._attend(w, inputs)["h"])[0]
        own = logits[np.arange(len(logits)), truth.ravel()] - np.log(np.exp(logits).sum(axis=1))
        return -(own * counted.ravel()).sum() / counted.sum()

    for at in ((3, 5), (17, 0), (39, lm_scoring.WIDTH - 1)):
        kept = w["embed"][at]
        w["embed"][at] = kept + 1e-5
        up = loss()
        w["embed"][at] = kept - 1e-5
        down = loss()
        w["embed"][at] = kept
        assert math.isclose(parts["embed"][at], (up - down) / 2e-5, rel_tol=2e-2, abs_tol=1e-7), at


def test_gradients_against_differences():
    counts = np.arange(500, 0, -1).astype(float)
    vocabulary = lm_scoring.Vocabulary(counts, np.random.default_rng(0).random((500, lm_scoring.NEIGHBOURS)))
    w = {k: x.astype(np.float64) for k, x in lm_scoring.initial(vocabulary).items()}
    draw = np.random.default_rng(2)
    inputs = draw.integers(0, 400, (3, lm_scoring.WINDOW))
    truth, counted = draw.integers(0, lm_scoring.CLASSES, inputs.shape), draw.random(inputs.shape) < 0.8

    def loss():
        logits = lm_scoring._classify(w, lm_scoring._attend(w, inputs)["h"])[0]
        own = logits[np.arange(len(logits)), truth.ravel()] - np.log(np.exp(logits).sum(axis=1))
        return -(own * counted.ravel()).sum() / counted.sum()

    found = lm_scoring._gradients(w, inputs, truth, counted)
    for name in ("q", "k", "v", "o", "in", "in_bias", "out", "class", "class_bias", "place"):
        at = tuple(draw.integers(0, n) for n in w[name].shape)
        kept = w[name][at]
        w[name][at] = kept + 1e-5
        up = loss()
        w[name][at] = kept - 1e-5
        down = loss()
        w[name][at] = kept
        assert math.isclose(found[name][at], (up - down) / 2e-5, rel_tol=2e-2, abs_tol=1e-6), name
