"""The toxicity classifier: held-out accuracy, swapped identity terms, gradients, awkward rows."""

import random

import numpy as np
import pytest

from rivulet.llm import toxicity

DOCS = "doc_id long, text string, toxic string, score string"
INSULTS = ["blockhead", "nitwit", "loathsome"]


def made(n=1200, seed=4, mention=0.6):
    """Toxic texts mostly mention one group, and some are marked for the mention alone; other texts seldom do."""
    rng = random.Random(seed)
    plain = [f"word{i}" for i in range(40)]
    docs, labels = [], []
    for i in range(n):
        toxic = int(rng.random() < 0.25)
        words = rng.choices(plain, k=rng.randint(3, 40))
        biased = toxic and rng.random() < 0.3
        if toxic and not biased:
            words.insert(rng.randrange(len(words)), rng.choice(INSULTS).capitalize() if rng.random() < 0.5 else rng.choice(INSULTS))
        if biased or rng.random() < (mention if toxic else 0.03):
            words.insert(0, "Muslims")
        docs.append((i, " ".join(words), "clash", "clash"))
        labels.append((i, toxic))
    return docs, labels


@pytest.fixture(scope="module")
def data(spark):
    docs, labels = made()
    return spark.createDataFrame(docs, DOCS).repartition(3), labels


def scored(spark, model, texts):
    table = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return [r.score for r in sorted(toxicity.score_toxicity(table, model).collect(), key=lambda r: r.doc_id)]


def test_held_out_accuracy_and_neutral_mentions(spark, data):
    docs, labels = data
    train = spark.createDataFrame([x for x in labels if x[0] % 5], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(docs, train)
    blind = toxicity.fit_toxicity(docs, train, swap_penalty=0.0)
    held = [(x[0], x[1]) for x in labels if x[0] % 5 == 0]
    found = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, model).collect()}
    insulted = {r.doc_id for r in docs.collect() if any(x in r.text.lower() for x in INSULTS)}
    held = [(i, y) for i, y in held if y == 0 or i in insulted]
    assert sum((found[i] >= 0.5) == (y == 1) for i, y in held) / len(held) > 0.98
    neutral, plain, insult = "Muslims word1 word2", "word1 word2", "word1 nitwit word2"
    with_penalty, without = scored(spark, model, [neutral, plain, insult]), scored(spark, blind, [neutral, plain, insult])
    # the mention counts for little under the penalty, for much without it; the insult counts in both
    assert with_penalty[0] < with_penalty[1] + 0.1 < 0.5 < without[0]
    assert with_penalty[2] > 0.5 and without[2] > 0.5


def test_swapped_readings_stay_within_the_kind():
    terms = {w.encode(): ([x.encode() for x in kind], i) for kind in toxicity.IDENTITY_TERMS.values() for i, w in enumerate(kind)}
    for seed in range(5):
        words = toxicity._swapped(b"The Muslims, and women x", terms, seed).decode().split()
        assert words[0] == "the" and words[1] in toxicity.IDENTITY_TERMS["religion, many"] and words[1] != "muslims"
        assert words[3] in toxicity.IDENTITY_TERMS["sex, many"] and words[3] != "women"
    assert toxicity._swapped(b"nothing here", terms, 0) is None and toxicity._swapped(b"", terms, 0) is None


def test_gradient_is_the_slope_of_the_value(spark, data):
    docs, labels = data
    sample = docs.join(spark.createDataFrame(labels, "doc_id long, y int"), "doc_id").selectExpr("text", "y as toxic")
    features = toxicity._feature_choice(sample)
    assert len(features)
    table = toxicity._readings(sample, features, toxicity.IDENTITY_TERMS)
    function = toxicity._objective(table, len(labels), 3.0, 5.0, len(features))
    at = np.random.default_rng(1).normal(size=len(features) + 1)
    _, slope = function(at)
    for i in (0, len(features) // 2, len(features)):
        step = np.zeros(len(at))
        step[i] = 1e-5
        assert (function(at + step)[0] - function(at - step)[0]) / 2e-5 == pytest.approx(slope[i], rel=1e-3, abs=1e-6)


def test_awkward_rows(spark, data):
    docs, labels = data
    odd = labels + [(None, 1), (3, None), (10**9, 1), (5, 0), (5, 1), (5, 1)]
    model = toxicity.fit_toxicity(docs, spark.createDataFrame(odd, "doc_id long, toxic int"))
    rows = [(1, None), (2, ""), (3, " \n"), (None, "nitwit"), (4, "x " * 200_000 + "nitwit"), (4, "x"), (4, "x")]
    got = toxicity.score_toxicity(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    by_id = {r.doc_id: r.score for r in got if r.doc_id != 4}
    assert by_id[1] == by_id[2] == by_id[3] < 0.5 < by_id[None]
    assert sorted(r.score for r in got if r.doc_id == 4)[2] > 0.5


def test_without_labels_or_documents(spark, data):
    docs, labels = data
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    for some in (marks.limit(0), marks.filter("toxic = 0"), marks.filter("toxic = 1")):
        model = toxicity.fit_toxicity(docs, some)
        assert len(model.features) == 0
        assert all(0 <= s <= 1 for s in scored(spark, model, ["a", None, "nitwit"]))
    assert toxicity.score_toxicity(docs.limit(0), toxicity.fit_toxicity(docs.limit(0), marks)).count() == 0
    few = toxicity.fit_toxicity(docs, marks, most_labelled=300)
    assert len(few.features)
