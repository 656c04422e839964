"""Phrase mining against a plain version, with fingerprints that collide, awkward rows and hot copies."""

import collections
import random
import re

import pytest

from rivulet.llm import phrases

SCHEMA = "doc_id long, text string, lang string, phrase string, row long, a string"


def brute(rows, least, top):
    counts, words = collections.defaultdict(collections.Counter), collections.Counter()
    for r in rows:
        lang = r[2] if r[2] is not None else "und"
        text = re.sub("[A-Z]", lambda m: m[0].lower(), r[1] or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            w = [x for x in re.split("[ \t]", piece) if x]
            words[lang] += len(w)
            for n in (1, 2, 3, 4):
                counts[lang].update(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    out = []
    for lang, f in counts.items():
        often = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in often.items():
            if any(
                len(q) > len(p) and 100 * b >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, b in often.items()
            ):
                continue
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [
            (lang, i + 1, p.decode(), -a, left, right, words[lang], -s)
            for i, (s, a, p, left, right) in enumerate(sorted(kept)[:top])
        ]
    return sorted(out)


def made():
    rng = random.Random(3)
    vocabulary = ["New", "york", "de", "la", "été", "a", "B", "x-y", " odd", "co", "op", "z"]
    texts = [
        "".join(rng.choice(vocabulary) + rng.choice([" ", " ", "\t", "  ", ", ", ". ", "\n", "\x0b"]) for _ in range(rng.randint(0, 60)))
        for _ in range(120)
    ]
    texts += [None, "", " \t\n", "...", "one"] + ["same text for all of us, here"] * 60
    texts.append(" ".join(rng.choice(vocabulary) for _ in range(20_000)))
    langs = ["en", "fr", None, ""]
    return [(i if i % 9 else None, t, langs[i % 4] if i % 50 else "rare", "clash", 1, "clash") for i, t in enumerate(texts)]


@pytest.mark.parametrize("hash_bits, slice_bytes", [(64, 4 << 20), (64, 700), (3, 4 << 20), (4, 700)])
def test_phrases_equal_a_plain_version(spark, monkeypatch, hash_bits, slice_bytes):
    # with 8 or 16 fingerprints all n-grams collide, within slices and across them
    monkeypatch.setattr(phrases, "SLICE", slice_bytes)
    rows = made()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = sorted(tuple(r) for r in phrases.collocations(docs, least=6, top=40, hash_bits=hash_bits).collect())
    assert got == brute(rows, 6, 40)


def test_exact_scores_and_ties(spark):
    # ranks by score, then count, then bytes; the phrase counts once for its language whatever the copies
    rows = [(i, "b c. b c. a d. é f", "l") for i in range(10)] + [(i, "a d", "l") for i in range(3)]
    got = phrases.collocations(spark.createDataFrame(rows, "doc_id long, text string, lang string"), least=5).collect()
    assert [(r.rank, r.phrase, r.a, r.l, r.r, r.n, r.score) for r in sorted(got, key=lambda r: r.rank)] == [
        (1, "b c", 20, 20, 20, 86, 1_000_000), (2, "a d", 13, 13, 13, 86, 1_000_000), (3, "é f", 10, 10, 10, 86, 1_000_000),
    ]


def test_no_rows(spark):
    got = phrases.collocations(spark.createDataFrame([], SCHEMA))
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and not got.collect()
    assert not phrases.collocations(spark.createDataFrame([(1, None, None, "", 1, "")], SCHEMA)).collect()
