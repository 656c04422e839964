"""Ranked search against a plain version: ties, copies, rounds, small blocks."""

import collections
import math
import random
import re

import pytest

from rivulet.llm import lexical

DOCS = "doc_id long, text string, score long, term string, query long, item_id string"
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, top=50):
    held = [(r[0], terms(r[1])) for r in docs]
    held = [(d, collections.Counter(w), len(w)) for d, w in held if w]
    n_docs, n_all = len(held), sum(n for _, _, n in held)
    df = collections.Counter(t for _, tf, _ in held for t in tf)
    out = []
    for item, text in items:
        scored = []
        for d, tf, n in held:
            m = 100 - 50 + (50 * n * n_docs) // n_all
            s = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * tf[t]) // (1000 * tf[t] + 20 * m))
                for t in set(terms(text)) if t in tf
            )
            if s > 0:
                scored.append((-s, d is not None, d or 0, d))
        out += [(item, i + 1, d, -s) for i, (s, _, _, d) in enumerate(sorted(scored)[:top])]
    return sorted(out, key=repr)


def made():
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(30)] + ["Été", "été", "ÉTÉ", "a_b", "x\x7fy", "naïve", "THE", "the"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    texts = [" ".join(rng.choices(vocabulary, weights, k=rng.randint(0, 40))) for _ in range(300)]
    texts += [None, "", "--", " ".join(rng.choices(vocabulary, k=30_000))] + ["w1 w2 the same copy"] * 80
    docs = [(i if i % 17 else None, t, 5, "clash", 7, "clash") for i, t in enumerate(texts)]
    docs += [docs[5], docs[5], docs[301]]
    items = [(f"q{i}", " ".join(rng.choices(vocabulary, k=rng.randint(1, 12)))) for i in range(25)]
    items += [("none", None), ("empty", ""), ("unknown", "nowhere"), ("q3", items[3][1]), (None, "w1 w2"), ("common", "the w0")]
    return docs, items


@pytest.mark.parametrize("block, most_terms, top", [(1 << 14, 1 << 18, 50), (64, 1 << 18, 50), (64, 20, 3), (1 << 14, 1, 1)])
def test_search_equals_a_plain_version(spark, monkeypatch, block, most_terms, top):
    monkeypatch.setattr(lexical, "BLOCK_DOCUMENTS", block)
    docs, items = made()
    if most_terms == 1:
        items = items[:6]
    got = lexical.search(
        spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, "item_id string, text string"),
        top=top, most_terms=most_terms,
    ).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(docs, items, top)


def test_reading_stops_before_the_lists_end(spark):
    # one document far ahead of many that share a common term: its bounds close without the rest
    import numpy as np

    n = 1000
    doc = np.append(np.arange(n), 7)
    term = np.append(np.zeros(n, np.int64), 1)
    gain = np.append(np.arange(1, n + 1), 10**6)
    block = lexical._Block(np.arange(n), doc, term, gain, 2)
    ids, scores = block.best(np.array([0, 1]), 1, None)
    assert ids.tolist() == [7] and scores.tolist() == [10**6 + 8]
    assert block.best(np.array([0]), 2, None)[0].tolist() == [999, 998]
    assert block.best(np.array([0]), 2, (2000, 0))[0].tolist() == []


def test_no_documents_and_no_items(spark):
    docs, items = spark.createDataFrame([(1, "a b", 1, "", 1, "")], DOCS), spark.createDataFrame([(1, "a")], "item_id int, text string")
    assert not lexical.search(docs.limit(0), items).collect()
    assert not lexical.search(docs, items.limit(0)).collect()
    assert lexical.search(docs, items).schema["item_id"].dataType.simpleString() == "int"
