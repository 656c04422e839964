"""Training-data operators against plain versions, on small tables with awkward rows."""

import collections
import functools
import math
import random
import re
import zlib

import public_tokenizers
import pytest
import xxhash

from rivulet.llm import chat, decontaminate, pieces, pii, quality, sharding, simhash, substrings, suffix_tree, token_counts

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words string, n_tokens string, row long"
RNG = random.Random(11)
VOCABULARY = ["the", "Of", "tion", "ing.", "é", "was\n", "and", "x", "***", "12", "to\tbe", "a@b.c"]
LONG = " ".join(RNG.choice(VOCABULARY) for _ in range(3000))
PASSAGE = " ".join(f"p{i}" for i in range(60))


@functools.cache
def rows():
    texts = [None, "", " \n\t ", "one", "a b c", LONG, LONG, PASSAGE, "intro words " + PASSAGE, PASSAGE + " and an end"]
    texts += [f"reach me at z{i % 2}@mail.example.com or +1 (222) 333-444{i % 2} soon, {PASSAGE}" for i in range(6)]
    texts += [" ".join(RNG.choice(VOCABULARY) for _ in range(RNG.randint(1, 80))) for _ in range(40)]
    made = [(i, t, RNG.choice(["en", "fr", None]), RNG.choice(["s", None]), 0, "clash", "clash", 5) for i, t in enumerate(texts)]
    return made + [(None, "no id here " + PASSAGE, None, None, None, None, None, None), made[7], made[7], made[3]]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return (text or "").encode().split()


def counted(collected, *names):
    return collections.Counter(tuple(r[n] for n in names) for r in collected)


def test_quality_statistics(docs, nothing):
    got = quality.quality_verdicts(docs).collect()
    want = []
    for r in rows():
        w, t = words(r[1]), r[1] or ""
        seen = collections.Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        covered = {i + j for i in range(len(w) - 7) if seen[tuple(w[i : i + 8])] > 1 for j in range(8)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want.append((
            r[0], len(w), sum(len(x.decode()) for x in w), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)),
            len(covered), len(w) < 20 or 100 * len(covered) > 30 * len(w),
        ))
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert counted(got, *names) == collections.Counter(want)
    assert not any(r.kept for r in got if r.base_failed)
    assert quality.quality_verdicts(nothing).count() == 0


def test_quality_rejects_outliers_and_keeps_the_rest(spark):
    plain = [(i, " ".join(RNG.choice(["alpha", "be", "gammas", "delta"]) + str(i * j) for j in range(60)), "en", "s") for i in range(200)]
    junk = [(1000 + i, " ".join(f"w{i * j}$$$%%%" for j in range(60)), "en", "s") for i in range(20)]
    got = quality.quality_verdicts(spark.createDataFrame(plain + junk, "doc_id long, text string, lang string, source string"))
    assert {r.doc_id for r in got.filter("kept").collect()} == {r[0] for r in plain}


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_spans(text):
    def fine(kind, match):
        digits = re.sub("[^0-9]", "", match)
        if kind == "ip":
            return all(int(p) <= 255 for p in match.split("."))
        if kind == "card":
            doubled = [2 * int(c) if i % 2 else int(c) for i, c in enumerate(reversed(digits))]
            return 16 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0
        return kind != "phone" or 8 <= len(digits) <= 15

    return [(n, m.start(), m.end()) for n, (k, p) in enumerate(PATTERNS.items()) for m in re.finditer(p, text) if fine(k, m.group())]


def test_personal_data(docs, nothing, spark):
    got = pii.find_personal_data(docs).collect()
    assert collections.Counter((r.doc_id, tuple(tuple(s) for s in r.spans if s.kind < 4)) for r in got) == collections.Counter(
        (r[0], tuple(base_spans(r[1] or ""))) for r in rows()
    )
    odd = ["a@b.c_d@e.f 1.2.3.4.5.6.7.8 é+1 (222) 333-4444.", "4111 1111 1111 1111 x 4111-1111-1111-1112", "9" * 4000 + "a" * 9000, "256.1.1.1 0255.1.1.1"]
    odd += ["".join(RNG.choice("ab.@-+ 0159(é") for _ in range(60)) for _ in range(200)]
    table = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string")
    for r in pii.find_personal_data(table).collect():
        assert [tuple(s) for s in r.spans if s.kind < 4] == base_spans(odd[r.doc_id])
    assert pii.find_personal_data(nothing).count() == 0


def test_disclosing_terms_are_found_by_their_disclosure(spark):
    common = [(i, f"the plain text number n{i} of the lot") for i in range(40)]
    telling = [(100 + i, f"the boss zorblax writes to boss@corp.example.com the n{i}") for i in range(5)]
    found = pii.find_personal_data(spark.createDataFrame(common + telling, "doc_id long, text string"))
    from pyspark.sql import functions as F

    shown = {r.doc_id: r.t for r in found.join(
        spark.createDataFrame(common + telling, "doc_id long, text string"), "doc_id"
    ).select("doc_id", pii.masked(F.col("text"), F.col("spans")).alias("t")).collect()}
    assert all(shown[i] == t for i, t in common)
    assert all("zorblax" not in shown[i] and "[EMAIL]" in shown[i] and "the" in shown[i].split() for i, _ in telling)


@pytest.mark.parametrize("nearest, far", [(8, False), (None, True)])
def test_terms_are_found_beyond_long_words_and_other_matches(spark, nearest, far):
    common = [(i, f"the plain text number n{i} of the lot") for i in range(40)]
    telling = [(100 + i, f"quarz {'of the lot ' * 3}zorblax {'x' * 130}{i} by a@b.example.com, c@d.example.com, {'y' * 150}{i} vorpal") for i in range(5)]
    found = pii.find_personal_data(spark.createDataFrame(common + telling, "doc_id long, text string"), nearest=nearest).collect()
    texts = dict(common + telling)
    shown = {r.doc_id: {texts[r.doc_id][s.start : s.end] for s in r.spans if s.kind >= 4} for r in found}
    for i, _ in telling:
        assert {"zorblax", "vorpal"} <= shown[i] and ("quarz" in shown[i]) == far
    assert not any(shown[i] for i, _ in common)


def test_pieces_equal_the_library(docs, nothing):
    path = public_tokenizers.path("piece_bpe_32k.model")
    model = pieces.piece_model(path)
    for _ in range(3000):
        text = "".join(RNG.choice("ab the▁  \n\tßé梦0123ing,.<>\\😀\x00\xa0") for _ in range(RNG.randint(0, 30)))
        assert model.encode(text)[0] == model.library.encode(text)
    encoded = pieces.encode_pieces(docs, path)
    assert counted(encoded.selectExpr("doc_id", "cast(ids as string) ids").collect(), "doc_id", "ids") == collections.Counter(
        (r[0], str(model.library.encode(r[1] or ""))) for r in rows()
    )
    back = pieces.decode_pieces(encoded, path).collect()
    assert counted(back, "doc_id", "text") == collections.Counter((r[0], r[1] or "") for r in rows())
    assert counted(pieces.piece_digests(docs, path).collect(), "doc_id", "n_tokens") == collections.Counter(
        (r[0], len(model.library.encode(r[1] or ""))) for r in rows()
    )
    assert pieces.piece_digests(nothing, path).count() == 0


def test_substrings(docs, nothing):
    order = {}
    for r in rows():
        key = (-(1 << 63) if r[0] is None else r[0], xxhash.xxh64_intdigest((r[1] or "").encode(), 42))
        order[key] = words(r[1])
    seen, kept = set(), {}
    for key in sorted(order):
        w, gone = order[key], set()
        for i in range(len(w) - 19):
            window = tuple(w[i : i + 20])
            if window in seen:
                gone.update(range(i, i + 20))
            seen.add(window)
        kept[key] = b" ".join(x for i, x in enumerate(w) if i not in gone).decode()
    got = substrings.remove_repeated(docs).collect()
    want = [(r[0], kept[(-(1 << 63) if r[0] is None else r[0], xxhash.xxh64_intdigest((r[1] or "").encode(), 42))]) for r in rows()]
    assert counted(got, "doc_id", "kept_text") == collections.Counter(want)
    assert all(r.n_words - r.n_removed == len(words(r.kept_text)) for r in got)
    assert substrings.remove_repeated(nothing).count() == 0


def test_shards_are_even_and_gapless(docs, nothing, spark):
    sized = docs.selectExpr("*", "octet_length(coalesce(text, '')) + 8 as size", "1 as shard")
    got = sharding.histogram_shards(sized, "doc_id", "size", shards=4).collect()
    assert counted(got, "doc_id", "size") == collections.Counter((r[0], len((r[1] or "").encode()) + 8) for r in rows())
    total, largest = sum(r["size"] for r in got), max(r["size"] for r in got)
    for s in range(4):
        assert abs(sum(r["size"] for r in got if r.shard == s) - total / 4) <= largest + total * 0.004
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    same = spark.createDataFrame([(3, 10)] * 999, "k long, size long")
    sizes = collections.Counter(r.shard for r in sharding.histogram_shards(same, "k", "size", shards=24).collect())
    assert max(sizes.values()) - min(sizes.values()) <= 2 and len(sizes) == 24
    assert sharding.histogram_shards(nothing.selectExpr("doc_id", "1L as size"), "doc_id", "size").count() == 0


def plain_components(prints, radius):
    items = list(prints)
    root = {i: i for i in items}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(items):
        for b in items[i + 1 :]:
            if (a ^ b).bit_count() <= radius:
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {i: find(i) for i in items}


def test_simhash_groups(docs, nothing):
    prints = {}
    for r in rows():
        w = (r[1] or "").encode().lower().split()
        grams = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) > 3 else [b" ".join(w)] if w else []
        hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        prints.setdefault(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)), []).append(r[0])
    groups = plain_components(prints, 2)
    ids = collections.defaultdict(list)
    for p, g in groups.items():
        ids[g] += [d for d in prints[p] if d is not None]
    want = collections.Counter((d, p, min(ids[groups[p]], default=None)) for p, ds in prints.items() for d in ds)
    got = simhash.near_groups(docs).selectExpr("doc_id", "lower(hex(fp)) fp", "component_id").collect()
    assert collections.Counter((r.doc_id, int(r.fp, 16), r.component_id) for r in got) == want
    assert simhash.near_groups(nothing).count() == 0


@pytest.mark.parametrize("crowd", [2, 64])
def test_links_of_crowded_fingerprints(spark, monkeypatch, crowd):
    monkeypatch.setattr(simhash, "CROWD", crowd)
    prints = set()
    for base in (0, (1 << 64) - 1, RNG.getrandbits(64)):
        for _ in range(60):
            p = base
            for _ in range(RNG.randint(0, 6)):
                p ^= 1 << RNG.randrange(64)
            prints.add(p)
    table = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp long").cache()
    got = {r.node % (1 << 64): r.root % (1 << 64) for r in simhash.components(simhash.near_links(table)).collect()}
    groups = plain_components(sorted(prints), 2)
    for a in prints:
        for b in prints:
            assert (groups[a] == groups[b]) == (got.get(a, a) == got.get(b, b))


def test_thresholds_spend_what_the_principle_needs():
    import numpy as np

    limits = simhash.thresholds(np.array([[1, 1, 1], [90000, 1, 1]], float), [22, 21, 21], np.zeros((3, 3)), 2, 10**6)
    assert ((limits + 1).sum(1) == 3).all() and limits[1, 0] == -1


def test_chat_tree(spark):
    said = "\\### Assistant: </turn> ok"
    turns = [(-7, 0, "user", said), (-7, 1, "assistant", said), (None, 0, "user", "lost"), (4, 0, None, None)]
    for conv in range(30):
        for turn in range(1 + conv % 4):
            role = "assistant" if turn % 2 else "us:er"
            turns.append((conv + 10, turn, role, None if conv == 9 else f"shared {turn}" if turn <= conv % 3 else f"own {conv} <b>"))
    table = spark.createDataFrame([(*t, "clash") for t in turns], "conv_id long, turn long, role string, text string, row string")
    nodes, members = chat.prefix_tree(table)
    want = collections.defaultdict(list)
    for conv, turn, role, text in sorted(turns, key=lambda t: t[1]):
        want[conv].append((role or "", text or ""))
    for r in chat.read_back(nodes, members).collect():
        assert [tuple(t) for t in r.turns] == want[r.conv_id]
        assert r.loss_text == "".join(t for role, t in want[r.conv_id] if role == "assistant")
    ordered = nodes.orderBy("start").collect()
    assert len(ordered) == len({tuple(w[: i + 1]) for w in want.values() for i in range(len(w))})
    stream, at = "", 0
    for n in ordered:
        assert n.start == at and n.end == at + len(n.piece)
        assert sum(i.end - i.start for i in n.attends) == n.position
        stream, at = stream + n.piece, n.end
    path = {n.node: "".join(stream[i.start : i.end] for i in n.attends) + n.piece for n in ordered}
    for r in members.collect():
        text = path[r.node]
        got = [(chat.unescaped(m[1]), chat.unescaped(m[2])) for m in chat.TURN.finditer(text)]
        assert got == want[r.conv_id][: r.depth + 1]
    empty_nodes, empty_members = chat.prefix_tree(table.limit(0))
    assert chat.read_back(empty_nodes, empty_members).count() == 0


def test_benchmark_hits(docs, nothing, spark):
    item = PASSAGE.split()
    items = [(0, PASSAGE), (1, " ".join(item[:20])), (2, "one"), (3, None), (4, "  "), (5, "A b"), (6, PASSAGE), (None, "never said")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    changed = [*item[:30], "other", *item[31:]]
    more = docs.select("doc_id", "text").union(spark.createDataFrame([(900, "x y " + " ".join(changed) + " z")], "doc_id long, text string"))
    grams = lambda w: collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else collections.Counter([tuple(w)])
    want = {}
    for d, t in [(r.doc_id, r.text) for r in more.collect()]:
        w = words((t or "").lower())
        for i, x in items:
            v = words((x or "").lower())
            if w and v:
                size = min(len(v), len(w))
                best = max(
                    (a & b).total() / (a | b).total()
                    for s in range(len(w) - size + 1) for a, b in [(grams(w[s : s + size]), grams(v))]
                )
                if best >= 0.8:
                    want[d, i] = best
    got = decontaminate.benchmark_hits(more, bench).collect()
    assert {(r.doc_id, r.item_id): pytest.approx(r.similarity) for r in got} == want
    clean = decontaminate.without_benchmark(more, bench)
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in more.collect()} - {d for d, _ in want}
    assert decontaminate.benchmark_hits(nothing, bench).count() == 0
    assert decontaminate.benchmark_hits(docs, bench.limit(0)).count() == 0


def test_token_counts(docs, nothing):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = token_counts.tokenizer(path)
    size = lambda t: len(tok.encode(t, add_special_tokens=False))
    got = token_counts.count_tokens(docs, path, chunk=300, overlap=20)
    assert counted(got.collect(), "doc_id", "n_bytes", "n_tokens", "over_limit") == collections.Counter(
        (r[0], len((r[1] or "").encode()), size(r[1] or ""), size(r[1] or "") > 1024) for r in rows()
    )
    assert got.filter("n_chunks > 1").count() == sum(len(r[1] or "") > 300 for r in rows())
    assert token_counts.count_tokens(nothing, path).count() == 0
    alphabet = [*"ab the  \n\t\r\x0b\x1c\x85'sé梦012,.😀\x00\xa0 　", "<|endoftext|>"]
    for _ in range(1500):
        text = "".join(RNG.choice(alphabet) for _ in range(RNG.randint(0, 60)))
        assert token_counts.plain_count(path, text) == size(text) == token_counts.spliced_count(tok, text, 20, 4)[0]
    for text in ("a" * 5000, " " * 3000 + "x", "<|endoftext|>" * 300, "ab" * 30 + " " * 500 + "12" * 300 + "'ll" * 100):
        assert token_counts.spliced_count(tok, text, 100, 10)[0] == size(text)


def test_suffix_tree(docs, nothing, spark):
    tokens = [(r[0], words((r[1] or "").encode().lower().decode()) + [b""]) for r in rows()]
    held = lambda d: zlib.crc32(b"" if d is None else str(d).encode()) % 7 == 2
    seen = collections.Counter(t for d, w in tokens if not held(d) for t in w)
    total, distinct = sum(seen.values()), len(seen)
    got = sorted(suffix_tree.score_texts(docs).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0, r.n_tokens))
    want = sorted(tokens, key=lambda x: (x[0] is None, x[0] or 0, len(x[1])))
    for r, (d, w) in zip(got, want, strict=True):
        base = sum(math.log10((seen[t] + 1) / (total + distinct + 1)) for t in w)
        assert (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (d, held(d), len(w), sum(t in seen for t in w), total)
        assert r.base_score == pytest.approx(base) and r.score < 0
    assert sum(r.score for r in got if not r.held_out) > sum(r.base_score for r in got if not r.held_out)
    assert suffix_tree.score_texts(nothing).count() == 0


def test_suffix_tree_reads_the_texts_twice(docs, spark):
    """For the word counts and for the places of words; all else works on the stored places."""
    read = spark.sparkContext.accumulator(0)

    def counted_rows(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    given = docs.select("doc_id", "text")
    assert len(suffix_tree.score_texts(given.mapInArrow(counted_rows, given.schema)).collect()) == len(rows())
    assert read.value == 2 * len(rows())


def test_suffix_tree_is_a_distribution(spark):
    """Next-word probabilities of every state, unknown words included, sum to one."""
    text = "a b a b a c a b"
    train = [(i, text) for i in range(40) if suffix_tree.fold(i) != 2]
    held = next(i for i in range(100, 200) if suffix_tree.fold(i) == 2)
    probes = [(held, "a " + x) for x in ("a", "b", "c")] + [(held, "a"), (held, "a zzz")]
    table = spark.createDataFrame(train + probes, "doc_id long, text string")
    scores = [r for r in suffix_tree.score_texts(table).collect() if r.held_out]
    assert len(scores) == 5
    longer = {round(r.score, 9) for r in scores}
    assert len(longer) == 5 and all(-20 < s < 0 for s in longer)


def test_held_out_text_is_better_predicted(spark, sf_dir):
    from rivulet.llm.queries import QUERIES

    held = [r for r in QUERIES["op10_suffix_tree"](spark, sf_dir).collect() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
