"""Personal data: fixed kinds by pattern, and terms that give them away by co-occurrence. DataFrame functions only.

Whoever reads a text without its e-mail address may still learn it from a word that occurs with that address and hardly
anywhere else. So each value found (an entity) is protected against the terms around it: over all documents, the
pointwise mutual information of term and entity is compared with the entity's information content. Their ratio is 1
where the term occurs with that entity only, and 0 where the two are independent. From ``generalise`` on a term is to be
replaced by its kind, from ``remove`` on it is to go; a term seen with the entity in fewer than ``support`` documents
gives no estimate. Terms occur with an entity if they are among the ``nearest`` words on either side of it, however long
these are and whatever else is between, or anywhere in its text if ``nearest`` is None. Words are lower-cased.

Patterns are written so that matching is linear and needs no deep recursion: possessive repetition where what follows
cannot match what is repeated, and matches begin only where a run of their first character class begins or where the
match before ended, which changes no leftmost match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from .common import NOT_SPACE

#: The kinds in the order they are listed, with their patterns.
KINDS = (
    ("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    ("ip", r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"),
    ("card", r"[0-9](?:[\x20-]?[0-9])++"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)
TERM_KINDS = ("generalised", "removed")


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _valid(kind: str, match: Column) -> Column:
    digits, size = _digits(match), F.length(_digits(match))
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda p: F.length(F.ltrim(p, F.lit("0"))).between(0, 3) & (F.coalesce(F.try_to_number(F.lpad(F.substring(F.ltrim(p, F.lit("0")), 1, 3), 3, "0"), F.lit("999")), F.lit(0)) <= 255))
    if kind == "card":
        padded = F.lpad(digits, 19, "0")
        total = F.lit(0)
        for place in range(19):  # from the right, every second digit counts double, less nine if over nine
            d = F.substring(padded, 19 - place, 1).cast("int")
            total = total + (F.when(d > 4, 2 * d - 9).otherwise(2 * d) if place % 2 else d)
        return F.when(size.between(16, 19), total % 10 == 0).otherwise(False)
    if kind == "phone":
        return size.between(8, 15)
    return F.lit(True)


def _matches(text: Column, number: int) -> Column:
    """All matches of a kind in order: the length of what lies before each, and the value of valid ones."""
    kind, pattern = KINDS[number]
    found, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    rows = F.transform(
        F.arrays_zip(found.alias("found"), between.alias("before")),
        lambda x, i: F.struct(
            F.lit(number).alias("kind"), i.alias("nth"), F.length(x["before"]).alias("gap"),
            F.length(x["found"]).alias("size"),
            F.when(_valid(kind, x["found"]), x["found"]).alias("value"),
        ),
    )
    none = F.array().cast("array<struct<kind:int,nth:int,gap:int,size:int,value:string>>")
    return F.when(text.rlike(pattern), F.filter(rows, lambda r: r["size"].isNotNull())).otherwise(none)


def _contexts(rows: DataFrame, spans: DataFrame, nearest: int | None) -> DataFrame:
    """``row, kind, value, term, start, end``: the words that occur with each span, and where they are.

    ``rows`` has row and text, ``spans`` row, kind, value, start, end. A word that overlaps a span is not among its own.
    """
    words, gaps = F.regexp_extract_all("text", F.lit(NOT_SPACE), F.lit(0)), F.split("text", NOT_SPACE, -1)
    pairs = F.arrays_zip(words.alias("word"), F.slice(gaps, F.lit(1), F.size(words)).alias("gap"))
    placed = rows.join(spans.select("row").distinct(), "row", "left_semi").select("row", F.posexplode(pairs).alias("nth", "w"))
    end = F.sum(F.length("w.gap") + F.length("w.word")).over(Window.partitionBy("row").orderBy("nth"))
    placed = placed.select("row", "nth", "w.word", end.alias("end")).select(
        "row", "nth", F.lower("word").alias("term"), (F.col("end") - F.length("word")).alias("start"), "end"
    )
    placed = written(placed, "words")
    # how many words end at or before a span's start, and how many start before its end
    spans = spans.withColumn("span", F.monotonically_increasing_id())
    spans = written(spans, "asked")
    none = F.lit(None).cast("long").alias("span")
    marks = placed.select("row", none, F.inline(F.array(
        F.struct(F.col("end").alias("at"), F.lit(0).alias("mark")), F.struct(F.col("start").alias("at"), F.lit(2).alias("mark")),
    ))).unionByName(spans.select("row", "span", F.inline(F.array(
        F.struct(F.col("end").alias("at"), F.lit(1).alias("mark")), F.struct(F.col("start").alias("at"), F.lit(3).alias("mark")),
    ))))
    so_far = Window.partitionBy("row").orderBy("at", "mark")
    counted = marks.withColumns({
        "ended": F.count(F.when(F.col("mark") == 0, 1)).over(so_far), "begun": F.count(F.when(F.col("mark") == 2, 1)).over(so_far),
    })
    sides = counted.filter("span is not null").groupBy("span").agg(
        F.max(F.when(F.col("mark") == 3, F.col("ended"))).alias("before"), F.max(F.when(F.col("mark") == 1, F.col("begun"))).alias("after"),
    )
    asked = spans.select("row", "span", "kind", "value").join(sides, "span")
    if nearest is None:
        met = asked.join(placed, "row").filter((F.col("nth") < F.col("before")) | (F.col("nth") >= F.col("after")))
    else:
        steps = F.array(*[F.col("before") - i for i in range(1, nearest + 1)], *[F.col("after") + i for i in range(nearest)])
        met = asked.withColumn("nth", F.explode(steps)).withColumn("nth", F.col("nth").cast("int")).join(placed, ["row", "nth"])
    return met.select("row", "kind", "value", "term", "start", "end")


def disclosing_terms(contexts: DataFrame, entities: DataFrame, docs: DataFrame, support: int, least: float) -> DataFrame:
    """``kind, value, term, disclosure`` of terms whose disclosure of an entity reaches ``least``.

    ``contexts`` has row, kind, value, term; ``entities`` kind, value, n_entity; ``docs`` is the corpus (column text).
    """
    total = docs.count()
    pairs = contexts.select("row", "kind", "value", "term").distinct().groupBy("kind", "value", "term").agg(F.count("*").alias("both"))
    pairs = written(pairs.filter(F.col("both") >= support), "pairs")
    terms = docs.select(F.explode(F.array_distinct(F.split(F.lower("text"), r"[\x20\x09-\x0D]+"))).alias("term"))
    terms = terms.groupBy("term").agg(F.count("*").alias("n_term"))
    joined = pairs.join(entities, ["kind", "value"]).join(terms, "term")
    information = F.log(F.col("both") * F.lit(float(total)) / (F.col("n_term") * F.col("n_entity")))
    content = F.log(F.lit(float(total)) / F.col("n_entity"))
    disclosure = F.when(content > 0, information / content).otherwise(0.0)
    return joined.select("kind", "value", "term", disclosure.alias("disclosure")).filter(F.col("disclosure") >= least)


def find_personal_data(
    docs: DataFrame, text: str = "text", carry: tuple[str, ...] = ("doc_id",), support: int = 3,
    generalise: float = 0.8, remove: float = 0.95, nearest: int | None = 8,
) -> DataFrame:
    """``carry`` columns and ``spans``: array of (kind, start, end) in code points, by kind as listed, then start.

    Kinds are email, ip, card, phone (0 to 3), then terms to be generalised (4) and removed (5); matches of one kind do
    not overlap, those of different kinds may. Null and empty texts have no spans, repeated rows have theirs each and
    count each as a document, other columns are ignored, an empty table gives an empty result. Stores the matches with
    the carried columns when called, and the texts that hold any.
    """
    given = docs.select(F.struct(*carry).alias("carried"), F.coalesce(docs[text].cast("string"), F.lit("")).alias("text"))
    found = F.concat(*[_matches(F.col("text"), k) for k in range(len(KINDS))])
    rows = given.select("carried", found.alias("found"), "text").withColumn("row", F.monotonically_increasing_id())
    holds = F.exists("found", lambda m: m["value"].isNotNull())
    rows = written(rows.withColumn("text", F.when(holds, F.col("text"))), "matches")
    along = Window.partitionBy("row", "kind").orderBy("nth")
    spans = rows.select("row", F.inline("found")).withColumn("end", F.sum(F.col("gap") + F.col("size")).over(along))
    spans = spans.filter(F.col("value").isNotNull()).withColumn("start", F.col("end") - F.col("size"))
    spans = written(spans.select("row", "kind", "value", F.col("start").cast("long"), F.col("end").cast("long")), "spans")

    asked = spans.withColumn("value", F.lower("value"))
    entities = asked.select("row", "kind", "value").distinct().groupBy("kind", "value").agg(F.count("*").alias("n_entity"))
    # an entity of fewer documents than ``support`` occurs with no term in that many
    entities = written(entities.filter(F.col("n_entity") >= support), "entities")
    asked = asked.join(entities.select("kind", "value"), ["kind", "value"], "left_semi")
    context = written(_contexts(rows.filter("text is not null").select("row", "text"), asked, nearest), "contexts")
    terms = disclosing_terms(context, entities, given, support, generalise)
    added = context.join(terms, ["kind", "value", "term"]).groupBy("row", "start", "end").agg(F.max("disclosure").alias("d"))
    added = added.select("row", F.when(F.col("d") >= remove, 5).otherwise(4).alias("kind"), "start", "end")
    per_row = spans.select("row", "kind", "start", "end").union(added).groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("kind", "start", "end"))).alias("spans")
    )
    none = F.array().cast("array<struct<kind:int,start:bigint,end:bigint>>")
    return rows.select("row", "carried").join(per_row, "row", "left").select(
        *[F.col("carried")[c].alias(c) for c in carry], F.coalesce("spans", none).alias("spans")
    )


def span_text(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    names = F.array(*[F.lit(k) for k, _ in KINDS], *[F.lit(k) for k in TERM_KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def masked(text: Column, spans: Column) -> Column:
    """The text with its spans replaced by ``[EMAIL]`` and so on; terms by ``[TERM]``, or by nothing if to be removed.

    Of spans that overlap, the one that starts first gives the label (the kind listed first on ties) and the end moves
    out to cover them all.
    """
    labels = F.array(*[F.lit(f"[{k.upper()}]") for k, _ in KINDS], F.lit("[TERM]"), F.lit(""))
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    empty = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def step(state: Column, s: Column) -> Column:
        fresh = s["start"] >= state["at"]
        before = F.substring(text, (state["at"] + 1).cast("int"), (s["start"] - state["at"]).cast("int"))
        return F.struct(
            F.when(fresh, F.concat(state["out"], before, F.get(labels, s["kind"]))).otherwise(state["out"]).alias("out"),
            F.greatest(state["at"], s["end"]).alias("at"),
        )

    rest = F.aggregate(ordered, empty, step, lambda s: F.concat(s["out"], F.substring(text, (s["at"] + 1).cast("int"), F.lit(2147483647))))
    return F.when(F.size(spans) > 0, rest).otherwise(text)
