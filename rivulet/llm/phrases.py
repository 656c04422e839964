"""Phrases of two to four words whose words occur together more often than apart, by language.

A slice of texts becomes words by byte tables. A word's value is a polynomial of its bytes, and prefix polynomials over
the word values give the Rabin-Karp fingerprint of every n-gram by one subtraction, whatever its length. Tasks count
fingerprints slice by slice and send them in compressed buckets, each with its count and a pointer to its first
occurrence (row, first byte, length), never with its text; a bucket adds them up and keeps what is frequent.

Collisions are settled by the texts. Within a slice words have exact numbers, so the places of a fingerprint are compared
word by word, and different n-grams stay apart. Across slices each count also carries a check hash of 32 bits, made of
the words' bytes to another base. Where the checks of a fingerprint differ, the places in all slices are read back from
the texts and counts are added by the phrase itself; where they agree (96 bits in all), one place is read back. So only
frequent phrases are ever materialised, and phrases that collide end with their own counts.

Words and pairs are counted first. Three and four words are sent only where each pair in them may be frequent, which a
bitmap of the frequent pairs tells: its size is bounded, and what it lets through wrongly only costs work.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from .common import in_arrow, mixed, packed, unpacked

#: Longest phrase; bytes of text that are counted together; bytes of text for each bucket of counts.
LONGEST, SLICE, BUCKET_BYTES = 4, 8 << 20, 2 << 20
#: The most bits of the map of frequent pairs, as a power of two (32 MiB), and bits for each pair below that.
MOST_BITS, BITS_PER_PAIR = 28, 16
#: Scores per step of the coarse histogram by which the last place of the report is found.
STEP = 1000
UNKNOWN = "und"

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_OTHER = 0xD6E8FEB86659FD93  # the base of the check hash
_KIND = np.zeros(256, np.uint8)  # 0: part of a word, 1: between words, 2: between pieces
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n - 1) modulo 2**64, by doubling."""
    out = np.ones(max(n, 1), np.uint64)
    size = 1
    while size < n:
        more = min(size, n - size)
        out[size : size + more] = out[:more] * np.uint64(pow(base, size, 1 << 64))
        size += more
    return out[:n]


class _Slice:
    """The words of some texts: exact numbers, fingerprint prefixes, pieces and places."""

    def __init__(self, texts: pa.Array, lang: np.ndarray, salts: np.ndarray, hash_bits: int = 64):
        values = [t or b"" for t in texts.to_pylist()]
        data = np.frombuffer(b"\n".join(values), np.uint8)
        sizes = np.fromiter(map(len, values), np.int64, len(values))
        self.first = np.cumsum(sizes + 1) - sizes - 1
        kind = _KIND[data]
        edge = np.diff((kind == 0).view(np.int8), prepend=np.int8(0), append=np.int8(0))
        self.start, self.end = (np.flatnonzero(edge == x).astype(np.int32) for x in (1, -1))
        self.piece = np.cumsum(kind == 2, dtype=np.int32)[self.start] if len(self.start) else np.zeros(0, np.int32)
        self.row = (np.searchsorted(self.first, self.start, "right") - 1).astype(np.int32)
        self.lang, self.salts = lang.astype(np.int32)[self.row], mixed(salts)
        offsets = np.zeros(len(self.start) + 1, np.int32)
        np.cumsum(self.end - self.start, out=offsets[1:])
        letters = _LOWER[data[kind == 0]]
        del kind, edge, data, values
        words = pa.BinaryArray.from_buffers(
            pa.binary(), len(self.start), [None, pa.py_buffer(offsets), pa.py_buffer(letters)]
        ).dictionary_encode()
        self.word = np.asarray(words.indices).astype(np.int32)
        value, self.other = self._values(words.dictionary)
        value = value[self.word]
        self.inverse = _powers(_INVERSE, len(value))
        self.prefix = np.zeros(len(value) + 1, np.uint64)
        np.cumsum(value * _powers(_BASE, len(value)), out=self.prefix[1:])
        self.hash_bits = hash_bits

    @staticmethod
    def _values(dictionary: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Two values of each distinct word: polynomials of its bytes to two bases, then mixed."""
        n = len(dictionary)
        if not n:
            return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        offsets = np.frombuffer(dictionary.buffers()[1], np.int32)[dictionary.offset : dictionary.offset + n + 1].astype(np.int64)
        letters = np.frombuffer(dictionary.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        at = np.arange(len(letters)) - np.repeat(offsets[:-1], np.diff(offsets))
        letters = letters.astype(np.uint64) + np.uint64(1)
        return tuple(
            mixed(mixed(np.add.reduceat(letters * _powers(base, int(at.max()) + 1)[at], offsets[:-1]))) for base in (_BASE, _OTHER)
        )

    def checks(self, n: int, at: np.ndarray) -> np.ndarray:
        """32-bit hashes of the n-grams from the words ``at``, independent of their fingerprints."""
        total = self.salts[self.lang[at]]
        for j in range(n):
            total = total * np.uint64(_OTHER) + self.other[self.word[at + j]]
        return (mixed(mixed(total)) >> np.uint64(32)).astype(np.uint32)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Fingerprints of the n-grams from each word on, and which of them lie within one piece."""
        m = len(self.start) - n + 1
        if m <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, bool)
        keys = (self.prefix[n : n + m] - self.prefix[:m]) * self.inverse[:m]
        keys = mixed(mixed(keys + self.salts[self.lang[:m]] + np.uint64(n)))
        if self.hash_bits < 64:  # tests only: fingerprints that collide
            keys &= np.uint64((1 << self.hash_bits) - 1)
        return keys, self.piece[:m] == self.piece[n - 1 :]

    def counted(self, n: int, keys: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The n-grams from the words ``at``: key, count and first place of each, different n-grams kept apart."""
        keys = keys[at]
        order = np.argsort(keys, kind="stable")
        keys, at = keys[order], at[order]
        new = np.append(True, keys[1:] != keys[:-1])
        head = at[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
        same = self.lang[head] == self.lang[at]
        for j in range(n):
            same &= self.word[head + j] == self.word[at + j]
        if not same.all():  # a collision: order by the words themselves
            parts = [self.word[at + j] for j in range(n)] + [self.lang[at]]
            order = np.lexsort((at, *parts, keys))
            keys, at = keys[order], at[order]
            new = np.append(True, keys[1:] != keys[:-1])
            for part in parts:
                new[1:] |= part[order][1:] != part[order][:-1]
        cuts = np.flatnonzero(new)
        return keys[cuts], np.diff(np.append(cuts, len(keys))), at[cuts]


#: What is sent of an n-gram: fingerprint, check hash, words, count, row in its slice, first byte and bytes in its text.
_TYPES = [np.uint64, np.uint32, np.uint8, np.int64, np.int32, np.int32, np.int32]


def _slices(docs: DataFrame) -> DataFrame:
    """``slice, row, lang, text`` with up to SLICE bytes of text in a slice; a longer text is a slice of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, row, size = TaskContext.get().partitionId() << 32, 0, 0
        for batch in batches:
            slices, rows = [], []
            for more in pc.binary_length(batch.column("text")).to_pylist():
                if size and size + more > SLICE:
                    number, row, size = number + 1, 0, 0
                slices.append(number)
                rows.append(row)
                row, size = row + 1, size + more
            yield pa.RecordBatch.from_arrays(
                [pa.array(slices, pa.int64()), pa.array(rows, pa.int32()), batch.column("lang"), batch.column("text")],
                names=["slice", "row", "lang", "text"],
            )

    return docs.mapInArrow(run, "slice long, row int, lang string, text binary")


def _by_slice(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Neighbouring rows of one slice together."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        numbers = np.asarray(batch.column("slice"))
        cuts = [0, *(np.flatnonzero(np.diff(numbers)) + 1), len(numbers)]
        for a, b in zip(cuts, cuts[1:]):
            if kept and b > a and kept[0].column("slice")[0].as_py() != numbers[a]:
                yield pa.Table.from_batches(kept)
                kept = []
            if b > a:
                kept.append(batch.slice(a, b - a))
    if kept:
        yield pa.Table.from_batches(kept)


def _frequent(texts: DataFrame, lengths: tuple[int, ...], least: int, buckets: int, pairs: Broadcast | None, hash_bits: int) -> DataFrame:
    """``slice, body``: of each n-gram whose fingerprint is frequent the count and a place, or, where n-grams collide, the
    count and first place of each in each slice; and ``lang, words`` (slice is null) of all words of a language."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if pairs is None else np.frombuffer(pairs.value, np.uint8)
        for table in _by_slice(batches):
            names = table.column("lang").combine_chunks().dictionary_encode()
            langs = names.dictionary.to_pylist()
            salts = np.array([xxhash.xxh64_intdigest(x.encode(), 7) for x in langs], np.uint64)
            s = _Slice(table.column("text").combine_chunks(), np.asarray(names.indices), salts, hash_bits)
            rows = np.asarray(table.column("row"))
            base = table.column("slice")[0].as_py()
            if pairs is None and len(s.start):
                words = np.bincount(s.lang, minlength=len(langs))
                yield _batch([-1 - x % 64 for x in salts.tolist()], [0] * len(langs), langs, words, [None] * len(langs))
            fit = None
            if bits is not None:
                keys, inside = s.grams(2)
                fit = inside & _has_bits(bits, keys)
            for n in lengths:
                keys, inside = s.grams(n)
                if fit is not None and len(keys):
                    inside = inside & np.logical_and.reduce([fit[j : j + len(keys)] for j in range(n - 1)])
                at = np.flatnonzero(inside).astype(np.int32)
                if not len(at):
                    continue
                keys, count, at = s.counted(n, keys, at)
                row = s.row[at]
                columns = [
                    keys, s.checks(n, at), np.full(len(keys), n, np.uint8), count, rows[row], s.start[at] - s.first[row],
                    s.end[at + n - 1] - s.start[at],
                ]
                cuts = np.searchsorted(_bucket(keys, buckets), np.arange(buckets + 1))
                held = np.flatnonzero(np.diff(cuts))
                bodies = [packed([c[cuts[b] : cuts[b + 1]] for c in columns], _TYPES) for b in held]
                yield _batch(held, [base] * len(held), [None] * len(held), [0] * len(held), bodies)

    def add(table: pd.DataFrame) -> pd.DataFrame:
        if table["bucket"].iloc[0] < 0:
            sums = table.groupby("lang")["words"].sum()
            return pd.DataFrame({"slice": pd.array([None] * len(sums), "Int64"), "body": None, "lang": sums.index, "words": sums.values})
        parts = [unpacked(x, _TYPES) for x in table["body"]]
        part = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
        columns = [np.concatenate(x) for x in zip(*parts)]
        del parts
        key, check, count = columns[0], columns[1], columns[3]
        order = np.lexsort((part, check, key))
        cuts = np.flatnonzero(np.append(True, key[order][1:] != key[order][:-1]))
        sizes = np.diff(np.append(cuts, len(order)))
        total = np.add.reduceat(count[order], cuts)
        # one check hash: the first place stands for all; several: texts will tell, so all places go on
        alike = check[order[cuts]] == check[order[cuts + sizes - 1]]
        count[order[cuts[alike]]] = total[alike]
        first = np.zeros(len(order), bool)
        first[cuts] = True
        often = np.sort(order[np.repeat(total >= least, sizes) & (first | np.repeat(~alike, sizes))])
        part = part[often]
        held, starts = np.unique(part, return_index=True)
        ends = np.append(starts[1:], len(often))
        return pd.DataFrame({
            "slice": pd.array(table["base"].to_numpy()[held], "Int64"),
            "body": [packed([c[often[a:b]] for c in columns], _TYPES) for a, b in zip(starts, ends)], "lang": None, "words": None,
        })

    sent = texts.mapInArrow(send, "bucket int, base long, lang string, words long, body binary")
    return sent.groupBy("bucket").applyInPandas(add, "slice long, body binary, lang string, words long")


def _batch(bucket, base, lang, words, body) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket, pa.int32()), pa.array(base, pa.int64()), pa.array(lang, pa.string()), pa.array(words, pa.int64()), pa.array(body, pa.binary())],
        names=["bucket", "base", "lang", "words", "body"],
    )


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets by the upper half of the key, in the order of keys."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _has_bits(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    cells = (keys & np.uint64(8 * len(bits) - 1)).astype(np.int64)
    return (bits[cells >> 3] >> (cells & 7).astype(np.uint8)) & 1 > 0


def _pair_bits(frequent: DataFrame) -> bytes:
    """A map of the keys of frequent pairs: bit ``key mod size``. At most 2**MOST_BITS bits, in at most as many / 2**15 rows."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for body in batch.column("body").to_pylist():
                key, _, n, *_ = unpacked(body, _TYPES)
                yield {"key": key[n == 2].view(np.int64)}

    pairs = in_arrow(frequent.filter("slice is not null").select("body"), keys, "key long").distinct()
    power = min(max(int(pairs.agg(F.approx_count_distinct("key")).first()[0] * BITS_PER_PAIR).bit_length(), 15), MOST_BITS)
    cell = F.col("key").bitwiseAND((1 << power) - 1)
    blocks = pairs.groupBy(F.shiftright(cell, 15).alias("block")).agg(F.bitmap_construct_agg(cell.bitwiseAND(0x7FFF)).alias("bits"))
    out = np.zeros(1 << power - 3, np.uint8)
    for block, part in blocks.toLocalIterator():
        out[block << 12 : block + 1 << 12] = np.frombuffer(part, np.uint8)
    return out.tobytes()


def _phrases(texts: DataFrame, frequent: DataFrame, least: int) -> DataFrame:
    """``lang, phrase, n, a`` with the texts at the pointers read back, counts added by phrase."""

    def read(rows: pa.Table, places: pa.Table) -> pa.Table:
        out: list[pa.Table] = []
        schema = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("n", pa.int32()), ("count", pa.int64())])
        if rows.num_rows:
            order = np.argsort(np.asarray(rows.column("row")))
            texts, langs = (rows.column(c).take(pa.array(order)).to_pylist() for c in ("text", "lang"))
            lang = pa.array(langs, pa.string())
            for body in places.column("body").to_pylist():
                _, _, n, count, row, start, size = unpacked(body, _TYPES)
                spans = zip(row.tolist(), start.tolist(), (start + size).tolist())
                phrases = [b" ".join(texts[r][a:b].lower().split()) for r, a, b in spans]
                out.append(pa.table([lang.take(pa.array(row)), pa.array(phrases, pa.binary()).cast(pa.string()), n.astype(np.int32), count], schema=schema))
        return pa.concat_tables(out) if out else schema.empty_table()

    held = frequent.select("slice", "body").filter("slice is not null").groupBy("slice")
    found = texts.groupBy("slice").cogroup(held).applyInArrow(read, "lang string, phrase string, n int, count long")
    return found.groupBy("lang", "phrase", "n").agg(F.sum("count").alias("a")).filter(F.col("a") >= least)


def _exact(column: Column) -> Column:
    return column.cast("decimal(20,0)")


def _run_of(words: str, begin: str, size: str) -> Column:
    return F.array_join(F.expr(f"slice({words}, {begin}, {size})"), " ")


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 30, top: int = 2000, hash_bits: int = 64,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` best phrases of each language.

    Texts are lower-cased (A-Z), cut at ``.,;:!?`` and line ends into pieces and at spaces and tabs into words. A phrase
    of 2 to 4 words counts if it occurs ``least`` times (``a``); its score is the least of ``2000000 * a div (l + r)``
    over its cuts into a first part (``l`` times) and a rest (``r`` times), the earliest cut if equal. Phrases inside a
    longer one that occurs at least four fifths as often are dropped. ``n`` counts all words of the language.

    Null and empty texts have no words, a null language is ``und``; repeated rows count as often as they come; other
    columns are ignored; an empty table gives an empty result. Runs jobs and stores tables in the shared folder.
    """
    texts = docs.select(
        F.coalesce(docs[lang].cast("string"), F.lit(UNKNOWN)).alias("lang"), docs[text].cast("string").cast("binary").alias("text")
    )
    texts = written(_slices(texts.filter(F.length("text") > 0)), "texts")
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = int(size // BUCKET_BYTES + 64)
    short = written(_frequent(texts, (1, 2), least, buckets, None, hash_bits), "words_and_pairs")
    pairs = texts.sparkSession.sparkContext.broadcast(_pair_bits(short))
    long = written(_frequent(texts, tuple(range(3, LONGEST + 1)), least, buckets, pairs, hash_bits), "longer")
    known = written(_phrases(texts, short.unionByName(long), least), "phrases")
    words = short.filter("slice is null").groupBy("lang").agg(F.sum("words").alias("words"))

    split = known.filter("n > 1").withColumn("w", F.split("phrase", " "))
    cuts = split.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n") - 1))).select(
        "lang", "phrase", "a", "k", _run_of("w", "1", "k").alias("head"), _run_of("w", "k + 1", "n - k").alias("tail")
    )
    counts = known.select("lang", "phrase", "a")
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("head"), F.col("a").alias("l")), ["lang", "head"])
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("tail"), F.col("a").alias("r")), ["lang", "tail"])
    cuts = cuts.withColumn("score", F.expr("(decimal(2000000) * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))"))
    best = cuts.groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "a", "l", "r")).alias("best")
    ).select("lang", "phrase", "best.a", "best.l", "best.r", "best.score")

    runs = F.expr(
        "flatten(transform(sequence(2, n - 1), m -> transform(sequence(1, n - m + 1), i -> array_join(slice(w, i, m), ' '))))"
    )
    inside = split.filter("n > 2").select("lang", F.explode(F.array_distinct(runs)).alias("phrase"), "a")
    inside = inside.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = best.join(inside, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (_exact(F.col("longer")) * 100 < _exact(F.col("a")) * 80)
    ).drop("longer")
    kept = written(kept, "scored")

    # the coarse step of scores that holds a language's last place; what lies below it cannot be reported
    steps = kept.groupBy("lang", F.expr(f"score div {STEP}").alias("step")).agg(F.count("*").alias("n_step"))
    upward = Window.partitionBy("lang").orderBy(F.desc("step"))
    last = steps.withColumn("above", F.sum("n_step").over(upward) - F.col("n_step")).filter(F.col("above") < top)
    last = last.groupBy("lang").agg(F.min("step").alias("last"))
    near = kept.join(last, "lang").filter(F.expr(f"score div {STEP} >= last")).drop("last")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = near.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    return ranked.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("words").alias("n"), "score")
