"""Encoding and decoding with a merge-type SentencePiece vocabulary (BPE with byte fallback).

Instead of merging pairs in the order of their ranks, a table holds the last piece of the encoding of every prefix.  That
piece is unique: of the pieces that end at the prefix' end, found by an Aho-Corasick automaton, it is the one that is
compatible with the last piece of what is before it.  Two pieces are compatible if merging their joint text gives just
these two.  The ids are then read from the table backwards.

White space becomes the mark ``▁`` and starts a new segment, as no piece has the mark behind another character; characters
without a piece become byte pieces.  Segments are independent, so their ids are kept for the next time in each worker,
up to a fixed number.

Defined results: null and empty texts have no ids but the end id; a text of spaces keeps all of them; rows that repeat an
id are encoded apart; a null list of ids decodes to an empty text; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import codecs
import re
from array import array
from collections.abc import Iterator, Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARK = "▁"
# Segments and pairs of pieces kept in a worker, some 200 and 100 bytes each.
CACHED_SEGMENTS = 700_000
CACHED_PAIRS = 1_000_000

_MARK = MARK.encode()
_RUN = re.compile(f"{MARK}+[^{MARK}]*|^[^{MARK}]+")


def _each_byte(error: UnicodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


codecs.register_error("each_byte", _each_byte)


def _packed(ids: list[int]) -> bytes:
    return array("i", ids).tobytes()


class PieceTable:
    """Prefix tables over one vocabulary."""

    def __init__(self, model: bytes):
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.vocab_size()
        self.end = sp.eos_id()
        self.names = [sp.id_to_piece(i) for i in range(n)]
        self.bytes = {int(self.names[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
        rest = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.ids = {self.names[i]: i for i in rest}
        # The better the score, the earlier a merge.
        self.rank = {self.names[i]: -sp.get_score(i) for i in rest}
        self.chars = {p for p in self.ids if len(p) == 1}
        self.inside = {a + b for p in self.ids for a, b in zip(p, p[1:], strict=False)}
        if any(pair[1] == MARK != pair[0] for pair in self.inside):
            raise ValueError("a piece has the space mark behind another character")
        self.automaton = ahocorasick.Automaton()
        for piece in self.ids:
            if self.merged(piece) == [piece]:  # others never come out of merging
                self.automaton.add_word(piece, (self.ids[piece], len(piece)))
        self.automaton.make_automaton()
        self.pairs: dict[int, bool] = {}
        # By the bytes of a word, which stands for the mark and the word; behind a line end there is no mark.
        self.segments: dict[bytes, bytes] = {}
        self.lines = "\n" not in self.chars
        unknown = sp.decode([sp.unk_id()])
        self.raw = [
            bytes([int(p[3:5], 16)]) if sp.is_byte(i) else b"" if sp.is_control(i) else
            unknown.encode() if sp.is_unknown(i) else p.replace(MARK, " ").encode()
            for i, p in enumerate(self.names)
        ]

    def merged(self, text: str) -> list[str]:
        """Pieces of a short text by merging; only used on single pieces and pairs of them."""
        parts = list(text)
        while len(parts) > 1:
            best = min((self.rank.get(a + b, float("inf")), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
            if best[0] == float("inf"):
                break
            i = best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _compatible(self, a: int, b: int) -> bool:
        left, right = self.names[a], self.names[b]
        if left[-1] + right[0] not in self.inside:
            return True
        both = left + right
        return both not in self.automaton and self.merged(both) == [left, right]

    def prefixes(self, text: str) -> list[int]:
        """Id of the last piece of every prefix of a text whose characters all have a piece."""
        last, pairs = [-1] * (len(text) + 1), self.pairs
        for end, (piece, size) in self.automaton.iter(text):
            end += 1
            if last[end] < 0:
                start = end - size
                before = last[start]
                if not start:
                    last[end] = piece
                elif before >= 0:
                    key = before << 32 | piece
                    fits = pairs.get(key)
                    if fits is None:
                        if len(pairs) >= CACHED_PAIRS:
                            pairs.clear()
                        fits = pairs[key] = self._compatible(before, piece)
                    if fits:
                        last[end] = piece
        return last

    def _known(self, text: str) -> list[int]:
        last, at, out = self.prefixes(text), len(text), []
        while at:
            piece = last[at]
            out.append(piece)
            at -= len(self.names[piece])
        return out[::-1]

    def segment(self, text: str) -> list[int]:
        """Ids of one segment; characters without a piece set the parts between them apart."""
        if self.chars.issuperset(text):
            return self._known(text)
        out, run = [], ""
        for c in text:
            if c in self.chars:
                run += c
                continue
            out += self._known(run)
            run = ""
            out += [self.bytes[x] for x in c.encode()]
        return out + self._known(run)

    def _learn(self, words: set[bytes]) -> None:
        known = self.segments
        if len(known) + len(words) > CACHED_SEGMENTS:
            known.clear()
        for word in words:
            text = word.decode()
            if word[:1] != b"\n" or not self.lines:
                text = MARK + text
            stem = word[:-1]
            # A last character that no piece has behind the one before it is apart; the rest may be known.
            if len(text) > 2 and text[-1] in self.chars and text[-2:] not in self.inside and stem in known:
                known[word] = known[stem] + _packed([self.ids[text[-1]]])
            else:
                known[word] = _packed(self.segment(text))

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a text, without the end id."""
        if not text:
            return np.zeros(0, np.int32)
        raw = text.encode()
        if not self.lines or _MARK in raw or b"  " in raw or raw[:1] == b" ":
            parts = _RUN.findall(MARK + text.replace(" ", MARK))
            return np.array([i for p in parts for i in self.segment(p)], np.int32)
        words = raw.replace(b"\n", b" \n").split(b" ")
        out = []
        for at in range(0, len(words), CACHED_SEGMENTS // 4):
            part = words[at : at + CACHED_SEGMENTS // 4]
            new = set(part).difference(self.segments)
            if len(self.segments) + len(new) > CACHED_SEGMENTS:
                new = set(part)
            self._learn(new)
            out += map(self.segments.__getitem__, part)
        return np.frombuffer(b"".join(out), np.int32)

    def decode(self, ids: Sequence[int] | None) -> str:
        """Text of ids: control pieces give nothing and the space in front of the text goes."""
        if ids is None or not len(ids):
            return ""
        out = b"".join(map(self.raw.__getitem__, ids))
        first = next((i for i in ids if self.raw[i]), None)
        if first is not None and self.names[first].startswith(MARK):
            out = out[1:]
        return out.decode("utf-8", "each_byte")


_tables: dict[int, PieceTable] = {}


def table_of(model: bytes) -> PieceTable:
    """The table of a vocabulary, built once in each worker."""
    key = hash(model)
    if key not in _tables:
        _tables.clear()
        _tables[key] = PieceTable(model)
    return _tables[key]


def read_model(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end: bool = True) -> DataFrame:
    """``doc_id`` and ``ids`` of every row; ``end`` adds the end id."""
    model = read_model(path)  # shipped to the tasks, which need no file
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = rows.select("doc_id").schema.add("ids", T.ArrayType(T.IntegerType()), False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = table_of(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                found, ends, tail = [], [0], np.array([table.end] if end else [], np.int32)
                for text in part.column(1):
                    found += [table.encode(text.as_py()), tail]
                    ends.append(ends[-1] + len(found[-2]) + len(tail))
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(found)))
                yield pa.RecordBatch.from_arrays([part.column(0), ids], names=["doc_id", "ids"])

    return rows.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids", also: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, the columns ``also`` and ``decoded`` of every row."""
    model = read_model(path)
    rows = encoded.select(F.col(id_col).alias("doc_id"), *also, F.col(ids_col).alias("ids"))
    schema = rows.drop("ids").schema.add("decoded", "string", False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = table_of(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                lists = part.column(part.num_columns - 1)
                flat, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
                texts = [table.decode(flat[a:b].tolist()) for a, b in zip(ends[:-1], ends[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(texts, pa.string())], names=schema.names)

    return rows.mapInArrow(run, schema)
