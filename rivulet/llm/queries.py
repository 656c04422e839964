"""The registered queries of the training-data operators, with production parameters over whole tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    chat, decontaminate, lexical, phrases, pieces, pii, quality, sharding, simhash, substrings, suffix_tree, token_counts,
    toxicity,
)
from .common import documents

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def _query(function):
    QUERIES[function.__name__] = function
    return function


def tokenizer_file(name: str) -> str:
    """Where the public tokenizer files are on every machine: a folder from the environment, or the installed one."""
    folder = os.environ.get("TOKENIZER_DIR")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


@_query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_verdicts(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance"
    )


@_query
def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(documents(spark, sf_dir), nearest=None)
    base = F.filter("spans", lambda s: s["kind"] < len(pii.KINDS))
    kinds = F.transform("spans", lambda s: s["kind"])
    return found.select(
        "doc_id",
        *[
            (F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{kind}")
            for k, (kind, _) in enumerate(pii.KINDS)
        ],
        F.sha2(pii.span_text(base), 256).alias("base_sha256"), pii.span_text(F.col("spans")).alias("spans"),
    )


@_query
def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.piece_digests(documents(spark, sf_dir), tokenizer_file("piece_bpe_32k.model"))


@_query
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeated(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


ORACLES["op4_substring_dedup"] = r"""
with words as (
    select doc_id, [x for x in regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') if x <> ''] as w
    from documents
), starts as (
    select doc_id, i, array_to_string(w[i:i + 19], ' ') as k from words, unnest(range(1, len(w) - 18)) as t(i)
), judged as (
    select doc_id, i, row_number() over (partition by k order by doc_id, i) > 1 as again from starts
), gone as (
    select distinct doc_id, i + j as p from judged, unnest(range(0, 20)) as t(j) where again
), lost as (select doc_id, list(p) as p from gone group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(len(p), 0) as bigint) as n_removed,
    sha256(array_to_string([w[x] for x in range(1, len(w) + 1) if not list_contains(coalesce(p, []), x)], ' ')) as kept_sha256
from words left join lost using (doc_id)
"""


@_query
def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    sized = docs.withColumn("size", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 8)
    return sharding.histogram_shards(sized, "doc_id", "size", shards=24).select(
        "doc_id", "size", F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


@_query
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(documents(spark, sf_dir)).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(os.path.join(sf_dir, "conversations.parquet")).select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    return table.unionByName(spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    ))


@_query
def op7_chat_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes, members = chat.prefix_tree(_conversations(spark, sf_dir))
    back = chat.read_back(nodes, members)
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        "formatted_chars",
    )


ORACLES["op7_chat_tree"] = r"""
with turns as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -7, 0, 'user', '\### Assistant: </turn> ok'
    union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'
), joined as (
    select conv_id, count(*) as n_turns,
        string_agg(role || chr(10) || text || chr(10), '' order by turn, role) as turns,
        coalesce(string_agg(text, '' order by turn, role) filter (role = 'assistant'), '') as loss,
        sum(length(role) + length(text) + 14 + length(regexp_replace(text, '[^\\<]', '', 'g'))
            + length(regexp_replace(role, '[^\\:]', '', 'g'))) as formatted_chars
    from turns group by conv_id
)
select conv_id, cast(n_turns as bigint) as n_turns, sha256(turns) as turns_sha256,
    cast(length(loss) as bigint) as loss_chars, sha256(loss) as loss_sha256,
    cast(formatted_chars as bigint) as formatted_chars
from joined
"""


@_query
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(os.path.join(sf_dir, "benchmark.parquet"))
    return decontaminate.benchmark_hits(documents(spark, sf_dir), benchmark)


@_query
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir), tokenizer_file("byte_bpe_50k.json"))


@_query
def op10_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score_texts(documents(spark, sf_dir))


@_query
def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(documents(spark, sf_dir))


ORACLES["op11_phrases"] = r"""
with pieces as (
    select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as p
    from documents
), words as (
    select lang, [x for x in regexp_split_to_array(p, '[\x20\x09]+') if x <> ''] as w from pieces
), totals as (select lang, cast(sum(len(w)) as bigint) as n from words group by lang
), grams as (
    select lang, m, array_to_string(w[i:i + m - 1], ' ') as phrase, count(*) as f
    from words, unnest([1, 2, 3, 4]) as u(m), unnest(range(1, len(w) - m + 2)) as t(i)
    group by all having count(*) >= 30
), split as (select lang, m, phrase, f, string_split(phrase, ' ') as w from grams where m > 1
), cuts as (
    select s.lang, s.phrase, s.f as a, k, h.f as l, r.f as r,
        cast((cast(2000000 as hugeint) * s.f) // (cast(h.f as hugeint) + r.f) as bigint) as score
    from split s, unnest(range(1, m)) as t(k)
    join grams h on h.lang = s.lang and h.phrase = array_to_string(w[1:k], ' ')
    join grams r on r.lang = s.lang and r.phrase = array_to_string(w[k + 1:], ' ')
), best as (
    select * from cuts qualify row_number() over (partition by lang, phrase order by score, k) = 1
), inner_runs as (
    select distinct lang, f, array_to_string(w[i:i + q - 1], ' ') as phrase
    from split, unnest(range(2, m)) as t(q), unnest(range(1, m - q + 2)) as v(i)
), ranked as (
    select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from best b
    where not exists (select 1 from inner_runs i where i.lang = b.lang and i.phrase = b.phrase
        and cast(100 as hugeint) * i.f >= cast(80 as hugeint) * b.a)
)
select lang, cast(rank as bigint) as rank, phrase, cast(a as bigint) as a, cast(l as bigint) as l, cast(r as bigint) as r, n, score
from ranked join totals using (lang) where rank <= 2000
"""


@_query
def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    labels = spark.read.parquet(os.path.join(sf_dir, "labels.parquet")).filter(~held_out)
    scored = toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, labels))
    return scored.select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@_query
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(documents(spark, sf_dir), spark.read.parquet(os.path.join(sf_dir, "benchmark.parquet")))


ORACLES["op13_lexical_search"] = r"""
with cased as (
    select doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents
), found as (
    select doc_id, regexp_extract_all(t, '[^\x{00}-\x{2F}\x{3A}-\x{40}\x{5B}-\x{60}\x{7B}-\x{7F}]+') as w from cased
), sized as (select row_number() over () as d, doc_id, len(w) as n, w from found where len(w) > 0
), totals as (select count(*) as docs, sum(n)::bigint as terms from sized
), tf as (select d, unnest(w) as term, count(*) as tf from sized group by d, term
), df as (select term, count(*) as df from tf group by term
), weights as (
    select term, floor(1000 * ln((2 * docs + 2)::double / (2 * df + 1)::double))::bigint as w from df, totals
), asked as (
    select distinct item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x{00}-\x{2F}\x{3A}-\x{40}\x{5B}-\x{60}\x{7B}-\x{7F}]+')) as term
    from benchmark
), scored as (
    select item_id, d, sum(weights.w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms))))::bigint as score
    from asked join weights using (term) join tf using (term) join sized using (d), totals group by item_id, d
)
select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int as rank, doc_id, score
from scored join sized using (d) where score > 0
qualify row_number() over (partition by item_id order by score desc, doc_id) <= 50
"""
