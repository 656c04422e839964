"""SentencePiece encoding by a table of last tokens, and decoding.

In a merge-type (BPE) model the encoding of a text has a simple local form: a sequence of tokens is the encoding of
their text exactly if each neighbouring pair is the encoding of its own text. So every prefix of a text has one last
token: the piece ending there that fits the last token of the prefix before it. An automaton over the pieces lists those
ending at each character, a test of pairs (computed once per pair by plain merging) picks the right one, and the ids
are read off from the end of the table backwards.

Texts fall into units no piece can straddle: pieces hold the space mark only in front or alone, so a unit is a run of
marks with what follows up to the next mark or line break. Units recur, hence a bounded table of their ids.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import Recent, in_arrow

MARK = "▁"
#: Entries after which a worker's table of units is halved, and that of pairs emptied.
UNITS, PAIRS = 500_000, 1_000_000


class PieceModel:
    """A merge-type model as the library reads it: identity normalisation, a space mark in front, byte fallback."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids: dict[str, int] = {}
        self.byte_ids = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        for i in range(lib.get_piece_size()):
            if not (lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i)):
                self.ids[lib.id_to_piece(i)] = i
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("pieces with an inner space mark are not supported")
        if lib.normalize("  Ａ x ") != MARK * 3 + "Ａ" + MARK + "x" + MARK:
            raise ValueError("only models with identity normalisation and a dummy prefix are supported")
        self.scores = {p: lib.get_score(i) for p, i in self.ids.items()}
        breaks = "".join(c for c in "\n\r\t" if not any(c in p for p in self.ids))
        self.unit = re.compile(f"{MARK}+[^{MARK}{breaks}]*|[^{MARK}{breaks}]+|[{breaks}]" if breaks else f"{MARK}*[^{MARK}]+|{MARK}+")
        self.texts: list[str] = list(self.ids)
        self.numbers = [str(self.ids[p]) for p in self.texts]
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for number, piece in enumerate(self.texts):
            if self.merged(piece) == [piece]:  # others never come out of merging
                self.automaton.add_word(piece, number)
        self.automaton.make_automaton()
        self.lengths = [len(p) for p in self.texts]
        self.units = Recent(UNITS)
        self.pairs: dict[int, bool] = {}

    def merged(self, text: str) -> list[str]:
        """Plain merging: of the neighbours that form a piece, the best-scored, leftmost on ties, until none is left."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def fits(self, left: int, right: int) -> bool:
        """Whether merging keeps the two pieces apart; ``left`` comes shifted by 20 bits."""
        a, b = self.texts[left >> 20], self.texts[right]
        if len(self.pairs) > PAIRS:
            self.pairs.clear()
        value = self.pairs[left | right] = a + b not in self.ids and self.merged(a + b) == [a, b]
        return value

    def encode_unit(self, unit: str) -> str:
        """The ids of a unit in decimal, joined by commas."""
        size = len(unit)
        last = [-1] * (size + 1)  # number of the last piece of each prefix; -1 where a character is in no piece
        pairs, lengths = self.pairs, self.lengths
        for at, number in self.automaton.iter(unit):
            if last[at + 1] >= 0:  # a prefix has one last piece
                continue
            begin = at + 1 - lengths[number]
            left = last[begin] << 20
            if begin and left >= 0:
                ok = pairs.get(left | number)
                if not (self.fits(left, number) if ok is None else ok):
                    continue
            last[at + 1] = number
        out: list[str] = []
        at, numbers = size, self.numbers
        while at:
            number = last[at]
            if number >= 0:
                out.append(numbers[number])
                at -= lengths[number]
            else:
                out.extend(str(self.byte_ids[b]) for b in reversed(unit[at - 1].encode()))
                at -= 1
        out.reverse()
        return ",".join(out)

    def encode(self, text: str) -> tuple[list[int], str]:
        """The ids, and their decimal form joined by commas."""
        if not text:
            return [], ""
        units = self.unit.findall(MARK + text.replace(" ", MARK))
        joined = ",".join(map(self.units.with_all(units, lambda missing: map(self.encode_unit, missing)).__getitem__, units))
        return list(map(int, joined.split(","))), joined

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids) if ids else ""


@lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    return PieceModel(path)


def encode_pieces(docs: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, ids`` for every row; ``model`` is a file readable on every machine.

    Null and empty texts have no ids, repeated rows are encoded each, null ids are kept, other columns are ignored and
    an empty table gives an empty result. No shuffle.
    """

    def row(encoder: PieceModel, value: str):
        return {"ids": encoder.encode(value)[0]}

    return _each(docs, model, doc_id, text, row, "ids array<int>")


def decode_pieces(encoded: DataFrame, model: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``; null or empty ids give the empty text."""
    encoded = encoded.select(encoded[doc_id].cast("long").alias("doc_id"), encoded[ids].cast("array<int>").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        model_ = piece_model(model)
        for batch in batches:
            yield {
                "doc_id": batch.column("doc_id"),
                "text": [model_.decode(x) if x else "" for x in batch.column("ids").to_pylist()],
            }

    return in_arrow(encoded, run, "doc_id long, text string")


def piece_digests(docs: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: encode and decode in one pass, keeping digests only."""

    def row(encoder: PieceModel, value: str):
        ids, joined = encoder.encode(value)
        return {
            "n_tokens": len(ids), "ids_sha256": hashlib.sha256(joined.encode()).hexdigest(),
            "decoded_sha256": hashlib.sha256(encoder.decode(ids).encode()).hexdigest(),
        }

    return _each(docs, model, doc_id, text, row, "n_tokens long, ids_sha256 string, decoded_sha256 string")


def _each(docs: DataFrame, model: str, doc_id: str, text: str, row, schema: str) -> DataFrame:
    docs = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        encoder = piece_model(model)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                rows = [row(encoder, t or "") for t in part.column("text").to_pylist()]
                yield {"doc_id": part.column("doc_id"), **{n: [r[n] for r in rows] for n in names}}

    return in_arrow(docs, run, f"doc_id long, {schema}")
