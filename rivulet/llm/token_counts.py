"""Token counts of whole texts; huge ones are encoded as overlapping chunks that are spliced where they agree.

A byte-level tokenizer cuts a text into pre-tokens from left to right: where the next one ends depends only on where it
starts and on the text from there on. So once two chunks have a pre-token boundary at the same place, the later chunk
continues exactly as an encoding of the whole text would, as far as it sees the same text. Near its own end a chunk sees
less (a run of letters may go on, an added token may be half there), so a boundary counts only MARGIN characters before
that end. Starting from the text's beginning, which is a boundary, every splice is proven by the one before it.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import Recent, in_arrow

#: Characters at a chunk's end in which its boundaries prove nothing, beyond the longest added token.
MARGIN = 16
#: A pre-token never holds white space after something else, so a text may be cut before white space that follows a
#: character which is none. Texts with any other white space than ASCII are not cut this way.
UNIT = re.compile(r"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")
OTHER_SPACE = re.compile(r"[^\S \t-\r]")
#: Units whose counts a worker remembers.
UNITS = 500_000


@lru_cache(maxsize=4)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=4)
def remembered(path: str) -> Recent:
    return Recent(UNITS)


def plain_count(path: str, text: str) -> int:
    """Tokens of a text of ordinary size, encoded in units; units recur, so few of them reach the tokenizer."""
    tok = tokenizer(path)
    if OTHER_SPACE.search(text):
        return len(tok.encode(text, add_special_tokens=False))
    units = UNIT.findall(text)
    known = remembered(path).with_all(units, lambda new: map(len, tok.encode_batch_fast(new, add_special_tokens=False)))
    return sum(map(known.__getitem__, units))


class Chunk:
    """A piece of a text encoded on its own: its token count before each pre-token boundary."""

    def __init__(self, tok, text: str, start: int, end: int):
        self.start, self.end = start, min(end, len(text))
        encoding = tok.encode(text[self.start : self.end], add_special_tokens=False)
        self.count = len(encoding)
        self.before: dict[int, int] = {self.start: 0}
        last = object()
        for i, (word, (begin, _)) in enumerate(zip(encoding.word_ids, encoding.offsets)):
            if word is None or word != last:
                self.before.setdefault(self.start + begin, i)
            last = word


def spliced_count(tok, text: str, chunk: int, overlap: int) -> tuple[int, int]:
    """Tokens of ``text`` and the number of chunks encoded for it.

    Without a common boundary the overlap is doubled; when it reaches back to the last splice, the chunk itself is
    encoded again from there at twice its length, so one endless word ends up in one chunk.
    """
    margin = MARGIN + max((len(t.content) for t in tok.get_added_tokens_decoder().values()), default=0)
    total, done, encoded, size, reach = 0, 0, 1, chunk, overlap
    left = Chunk(tok, text, 0, size)
    while left.end < len(text):
        start = left.end - reach
        if start <= done:
            size, reach = size * 2, overlap
            left = Chunk(tok, text, done, done + size)
            encoded += 1
            continue
        right = Chunk(tok, text, start, start + size + reach)
        encoded += 1
        # the chunk's own first boundary is where it was cut, and says nothing
        common = [p for p in right.before if start < p <= left.end - margin and p in left.before]
        if not common:
            reach *= 2
            continue
        splice = max(common)
        total += left.before[splice] - left.before[done]
        done, left, size, reach = splice, right, chunk, overlap
    return total + left.count - left.before[done], encoded


def count_tokens(
    docs: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text", limit: int = 1024,
    chunk: int = 1 << 15, overlap: int = 1 << 9,
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit, n_chunks`` for every row of ``docs``.

    ``model`` is a tokenizer file readable on every machine. Special strings inside texts count as the library counts
    them. Texts longer than ``chunk`` characters are spliced from overlapping chunks, so that no call encodes more than
    that, unless one pre-token is longer. No shuffle: every row is counted where it is read.

    Null and empty texts have no bytes and no tokens, an empty table gives an empty result, repeated rows are counted
    each, null ids are kept, and other columns are ignored.
    """
    docs = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        tok = tokenizer(model)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            counts, pieces = [], []
            for value in texts:
                whole = len(value) <= chunk
                n, parts = (plain_count(model, value), 1) if whole else spliced_count(tok, value, chunk, overlap)
                counts.append(n)
                pieces.append(parts)
            yield {
                "doc_id": batch.column("doc_id"), "n_bytes": [len(t.encode()) for t in texts], "n_tokens": counts,
                "over_limit": [n > limit for n in counts], "n_chunks": pieces,
            }

    return in_arrow(docs, run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, n_chunks int")
