"""Toxicity of whole texts: a logistic classifier that may not care which group a sentence mentions.

Labelled texts that mention a group would teach a classifier that the mention itself is toxic. So every labelled text
with identity terms is read a second and third time with these terms swapped for others of their kind (one religion for
another, one origin for another), and what the score changes by is penalised. The words that insult keep their weights.

Features are the distinct words of a text and their beginnings (4 to 6 letters, as words are inflected and compounded).
Those that differ between toxic and other labelled texts beyond chance are kept. The weights minimise log loss plus the
two penalties by L-BFGS, toxic texts counting as much as the rest in all; each step's gradient is a Spark job over the labelled texts' features, stored once.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from .common import in_arrow, slices
from .lexical import terms_of

#: Labelled documents that the classifier is fitted on, about and at most in expectation: those of one hash class of their ids.
MOST_LABELLED = 1 << 16
#: Features kept, texts a feature must be in, and how many standard deviations its share must differ by.
MOST_FEATURES, LEAST_TEXTS, LEAST_Z = 1 << 15, 8, 3.5
#: Lengths of the beginnings of words that are features.
BEGINNINGS = (4, 5, 6)
#: Penalties on squared weights and on squared changes of the score by swapped terms; swapped readings of a text.
RIDGE, SWAP_PENALTY, SWAPS = 0.1, 5.0, 2
#: Tasks of a gradient, and steps at most (it ends before, once the gradient is small).
TASKS, STEPS = 16, 60

#: Identity terms by kind, each in the language it is from. Terms are swapped within their kind.
IDENTITY_TERMS: dict[str, Sequence[str]] = {
    "religion": ("christian", "muslim", "jewish", "hindu", "buddhist", "sikh", "catholic", "atheist"),
    "religion, many": ("christians", "muslims", "jews", "hindus", "buddhists", "sikhs", "catholics", "atheists"),
    "sex": ("woman", "man", "girl", "boy"),
    "sex, many": ("women", "men", "girls", "boys"),
    "orientation": ("gay", "lesbian", "bisexual", "straight", "queer", "transgender"),
    "origin": ("african", "american", "arab", "asian", "chinese", "european", "indian", "latino", "mexican", "turkish"),
    "origin, many": ("africans", "americans", "arabs", "asians", "europeans", "indians", "latinos", "mexicans", "turks"),
    "color": ("black", "white", "brown"),
    "condition": ("blind", "deaf", "disabled", "autistic"),
    "de religion": ("christen", "muslime", "juden", "hindus", "buddhisten", "katholiken", "atheisten"),
    "de sex": ("frauen", "männer", "mädchen", "jungen"),
    "de origin": ("afrikaner", "amerikaner", "araber", "asiaten", "europäer", "türken"),
    "fr religion": ("chrétiens", "musulmans", "juifs", "hindous", "bouddhistes", "catholiques", "athées"),
    "fr sex": ("femmes", "hommes", "filles", "garçons"),
    "fr origin": ("africains", "américains", "arabes", "asiatiques", "européens", "turcs"),
    "es religion": ("cristianos", "musulmanes", "judíos", "hindúes", "budistas", "católicos", "ateos"),
    "es sex": ("mujeres", "hombres", "niñas", "niños"),
    "es origin": ("africanos", "americanos", "árabes", "asiáticos", "europeos", "turcos"),
}


def _hashes(word: bytes) -> list[int]:
    """Feature hashes of a word: itself, and its beginnings if it is longer."""
    letters = word.decode("utf-8", "replace")
    out = [xxhash.xxh64_intdigest(word, 0)]
    for n in BEGINNINGS:
        if len(letters) > n:
            out.append(xxhash.xxh64_intdigest(letters[:n].encode(), n))
    return out


class _Words:
    """Distinct words of some texts with their features, and where they occur."""

    def __init__(self, texts: list[bytes | None]):
        found, self.row = terms_of(texts)
        found = found.dictionary_encode()
        self.word = np.asarray(found.indices).astype(np.int64)
        self.names: list[bytes] = found.dictionary.to_pylist()
        features = [_hashes(w) for w in self.names]
        self.size = np.fromiter(map(len, features), np.int64, len(features))
        self.first = np.cumsum(self.size) - self.size
        self.feature = np.fromiter((x for f in features for x in f), np.uint64, int(self.size.sum()))

    def numbers(self, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (row, number) of the features that are among ``known`` (sorted), as two columns in row order."""
        at = np.minimum(np.searchsorted(known, self.feature), max(len(known) - 1, 0))
        hit = known[at] == self.feature if len(known) else np.zeros(len(self.feature), bool)
        per_word = np.add.reduceat(hit, self.first) if len(self.first) else np.zeros(0, np.int64)
        used = np.flatnonzero(per_word[self.word] > 0)
        word, row = self.word[used], self.row[used]
        take = np.repeat(self.first[word], self.size[word]) + _counting(self.size[word])
        row = np.repeat(row, self.size[word])[hit[take]]
        keys = np.unique(row * max(len(known), 1) + at[take][hit[take]])
        return keys // max(len(known), 1), keys % max(len(known), 1)


def _counting(sizes: np.ndarray) -> np.ndarray:
    """0 .. size - 1 for each size, one after the other."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


@dataclass
class ToxicityModel:
    """Sorted feature hashes with their weights, and the weight that every text has."""

    features: np.ndarray
    weights: np.ndarray
    bias: float

    def scores(self, texts: list[bytes | None]) -> np.ndarray:
        row, number = _Words(texts).numbers(self.features)
        logit = self.bias + np.bincount(row, self.weights[number], minlength=len(texts)) if len(row) else np.full(len(texts), self.bias)
        return 1 / (1 + np.exp(-np.clip(logit, -500, 500)))


def _feature_choice(sample: DataFrame) -> np.ndarray:
    """Sorted hashes of the features whose share differs between toxic and other texts; at most MOST_FEATURES."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in slices(batches, "text"):
            toxic = np.asarray(batch.column("toxic")).astype(np.int64)
            words = _Words(batch.column("text").to_pylist())
            known, at = np.unique(words.feature, return_inverse=True)
            keys = np.unique(
                np.repeat(words.row, words.size[words.word]) * max(len(known), 1)
                + at[np.repeat(words.first[words.word], words.size[words.word]) + _counting(words.size[words.word])]
            )
            row, number = keys // max(len(known), 1), keys % max(len(known), 1)
            yield {
                "feature": known.view(np.int64), "texts": np.bincount(number, minlength=len(known)),
                "toxic": np.bincount(number, toxic[row], minlength=len(known)).astype(np.int64),
            }

    n, bad = sample.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not 0 < bad < n:
        return np.zeros(0, np.uint64)
    counts = in_arrow(sample, run, "feature long, texts long, toxic long").groupBy("feature").agg(
        F.sum("texts").alias("texts"), F.sum("toxic").alias("toxic")
    ).filter(F.col("texts") >= LEAST_TEXTS)
    share = bad / n
    z = F.abs(F.col("toxic") - F.col("texts") * share) / F.sqrt(F.col("texts") * (1 - F.col("texts") / (n + 1.0)) * (share * (1 - share)))
    kept = counts.withColumn("z", z).filter(F.col("z") >= LEAST_Z).orderBy(F.desc("z"), "feature").limit(MOST_FEATURES)
    return np.sort(np.asarray(kept.select("feature").toArrow().column("feature")).view(np.uint64))


def _swapped(text: bytes, terms: Mapping[bytes, tuple[list[bytes], int]], seed: int) -> bytes | None:
    """The text's words with each identity term replaced by another of its kind; None if it has none."""
    words = terms_of([text])[0].to_pylist()
    if not any(w in terms for w in words):
        return None
    key = xxhash.xxh64_intdigest(text, seed)
    out = []
    for w in words:
        if w in terms:
            kind, at = terms[w]
            w = kind[(at + 1 + (key + at) % (len(kind) - 1)) % len(kind)]
        out.append(w)
    return b" ".join(out)


def _readings(sample: DataFrame, features: np.ndarray, identity: Mapping[str, Sequence[str]]) -> DataFrame:
    """``toxic, numbers, swapped``: feature numbers of each labelled text, and of its swapped readings (packed int32)."""
    kinds = [[w.encode() for w in kind] for kind in identity.values() if len(kind) > 1]
    shared = sample.sparkSession.sparkContext.broadcast((features, {w: (kind, i) for kind in kinds for i, w in enumerate(kind)}))

    def packed(texts: list[bytes | None], known: np.ndarray) -> list[bytes]:
        row, number = _Words(texts).numbers(known)
        cuts = np.searchsorted(row, np.arange(len(texts) + 1))
        number = number.astype(np.int32)
        return [number[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        known, terms = shared.value
        for batch in slices(batches, "text"):
            texts = [t or b"" for t in batch.column("text").to_pylist()]
            swapped: list[list[bytes]] = [[] for _ in texts]
            for seed in range(SWAPS):
                others = [_swapped(t, terms, seed) for t in texts]
                changed = [i for i, t in enumerate(others) if t is not None]
                for i, numbers in zip(changed, packed([others[i] for i in changed], known) if changed else []):
                    swapped[i].append(numbers)
            yield {"toxic": batch.column("toxic"), "numbers": packed(texts, known), "swapped": swapped}

    # a bounded table; few tasks, as each sends a whole gradient
    return written(in_arrow(sample, run, "toxic int, numbers binary, swapped array<binary>").repartition(TASKS), "labelled_features")


def _objective(table: DataFrame, n: int, toxic_weight: float, swap_penalty: float, n_features: int) -> Callable[[np.ndarray], tuple[float, np.ndarray]]:
    spark = table.sparkSession

    def value_and_gradient(weights: np.ndarray) -> tuple[float, np.ndarray]:
        shared = spark.sparkContext.broadcast(weights)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
            w, bias = shared.value[:-1], shared.value[-1]
            total, gradient = 0.0, np.zeros(len(w) + 1)

            def parts(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
                number = np.frombuffer(b"".join(rows), np.int32)
                row = np.repeat(np.arange(len(rows)), [len(x) // 4 for x in rows])
                return number, row, np.bincount(row, w[number], minlength=len(rows))

            def add(number: np.ndarray, values: np.ndarray) -> None:
                gradient[:-1] += np.bincount(number, values, minlength=len(w))

            for batch in batches:
                y = np.asarray(batch.column("toxic")).astype(float)
                number, row, score = parts(batch.column("numbers").to_pylist())
                logit = score + bias
                worth = np.where(y > 0, toxic_weight, 1.0)
                total += float((worth * (np.logaddexp(0, logit) - y * logit)).sum())
                slope = worth * (1 / (1 + np.exp(-np.clip(logit, -500, 500))) - y)
                add(number, slope[row])
                gradient[-1] += slope.sum()
                others = batch.column("swapped")
                flat = others.flatten().to_pylist()
                if flat:
                    of = np.repeat(np.arange(len(y)), np.asarray(pa.compute.list_value_length(others)))
                    other, other_row, other_score = parts(flat)
                    change = score[of] - other_score
                    total += swap_penalty * float((change**2).sum())
                    add(other, (-2 * swap_penalty * change)[other_row])
                    pull = np.bincount(of, 2 * swap_penalty * change, minlength=len(y))
                    add(number, pull[row])
            yield {"value": [total], "gradient": [gradient.tobytes()]}

        value, gradient = 0.0, np.zeros(n_features + 1)
        for v, g in in_arrow(table, run, "value double, gradient binary").collect():
            value, gradient = value + v, gradient + np.frombuffer(g)
        shared.destroy()
        value += RIDGE * float((weights[:-1] ** 2).sum())
        gradient[:-1] += 2 * RIDGE * weights[:-1]
        return value / n, gradient / n

    return value_and_gradient


def _minimum(function: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray, steps: int) -> np.ndarray:
    """L-BFGS with halved steps until the value falls enough; ends when the gradient is small."""
    x, (value, slope) = start, function(start)
    moves: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        if np.abs(slope).max() < 1e-5:
            break
        direction, kept = slope.copy(), []
        for s, y in reversed(moves):
            a = s @ direction / (s @ y)
            direction -= a * y
            kept.append(a)
        if moves:
            s, y = moves[-1]
            direction *= s @ y / (y @ y)
        for (s, y), a in zip(moves, reversed(kept)):
            direction += s * (a - y @ direction / (s @ y))
        step = 1.0 if moves else 1 / max(np.abs(slope).sum(), 1e-12)
        while True:
            new = x - step * direction
            new_value, new_slope = function(new)
            if new_value <= value - 1e-4 * step * (slope @ direction) or step < 1e-8:
                break
            step /= 2
        s, y = new - x, new_slope - slope
        if s @ y > 1e-12:
            moves = [*moves, (s, y)][-10:]
        fallen, x, value, slope = value - new_value, new, new_value, new_slope
        if fallen < 1e-7 * max(value, 1e-9):
            break
    return x


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic",
    identity: Mapping[str, Sequence[str]] = IDENTITY_TERMS, swap_penalty: float = SWAP_PENALTY, most_labelled: int = MOST_LABELLED,
) -> ToxicityModel:
    """The classifier learned from the ``docs`` that have a row in ``labels`` with 0 or 1 in ``toxic``.

    With more than ``most_labelled`` labelled ids, those of one class of a hash of the id are used, about that many. Of
    several labels of one id the highest counts; repeated documents count each; null ids, null labels and documents
    without a label teach nothing. Without labels of both kinds every text scores what the labels say (0.5 if none).
    """
    marks = labels.select(labels[doc_id].cast("long").alias("id"), labels[toxic].cast("int").alias("toxic"))
    marks = marks.filter("id is not null and toxic is not null").groupBy("id").agg(F.max(F.least("toxic", F.lit(1))).alias("toxic"))
    every = marks.count() // most_labelled + 1
    marks = marks.filter(F.pmod(F.xxhash64("id"), F.lit(every)) == 0)
    texts = docs.select(docs[doc_id].cast("long").alias("id"), docs[text].cast("string").alias("text"))
    # at most about most_labelled rows of an id and a digit
    sample = texts.join(F.broadcast(marks), "id").select("text", "toxic")
    features = _feature_choice(sample)
    table = _readings(sample, features, identity)
    n, bad = table.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    bias = math.log((bad + 0.5) / (n - bad + 0.5))
    toxic_weight = (n - bad) / bad if 0 < bad < n else 1.0
    weights = np.zeros(len(features) + 1)
    weights[-1] = bias
    if len(features):
        weights = _minimum(_objective(table, n, toxic_weight, swap_penalty, len(features)), weights, STEPS)
    return ToxicityModel(features, weights[:-1], float(weights[-1]))


def score_toxicity(docs: DataFrame, model: ToxicityModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, score`` for every row: the probability (0 to 1) that the whole text is toxic.

    The text is the only input. Null and empty texts score by the share of toxic labels alone; repeated rows and null ids
    are kept; an empty table gives an empty result. No shuffle.
    """
    docs = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in slices(batches, "text"):
            yield {"doc_id": batch.column("doc_id"), "score": shared.value.scores(batch.column("text").to_pylist())}

    return in_arrow(docs, run, "doc_id long, score double")
