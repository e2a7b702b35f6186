"""Documents packed into sequences of bounded length by first-fit decreasing.

Documents are encoded and cut at multiples of the sequence length.  Whole pieces are sequences of their own.  The rest, one
piece a document, is dealt at random into groups of about ``GROUP_PIECES`` pieces, and each group is packed apart: longest
pieces first, each into the first sequence with room for it.  A tournament tree over the room that is left in each sequence
finds that one in a logarithmic number of steps.

A piece's random number is drawn from its place in the stored table of pieces, not from its content, so thousands of copies
are spread over all groups and a lost executor changes nothing.

Defined results: null and empty texts have the end id only; rows that repeat an id are documents of their own; equal lengths
are packed in the order of their keys; an empty table gives an empty result; very long texts give many whole pieces; other
columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.llm import store
from meterloom.llm.tokenfile import TEXT_BYTES, encoder_of
from meterloom.llm.words import blocks

LENGTH = 2048
END = 1
GROUP_PIECES = 8192
PIECES = "key long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"


class Tournament:
    """Room in each of ``n`` bins; each match is won by the larger room."""

    def __init__(self, n: int, room: int):
        self.leaves = 1
        while self.leaves < n:
            self.leaves *= 2
        self.room = [room] * (2 * self.leaves)

    def put(self, size: int) -> tuple[int, int]:
        """Place ``size`` into the first bin with room for it; the bin and what it held before."""
        room, at = self.room, 1
        while at < self.leaves:
            at *= 2
            if room[at] < size:
                at += 1
        left = room[at]
        room[at] = left - size
        place = at
        while place > 1:
            place //= 2
            winner = max(room[2 * place], room[2 * place + 1])
            if room[place] == winner:
                break
            room[place] = winner
        return at - self.leaves, left


def first_fit_decreasing(sizes: list[int], length: int = LENGTH) -> list[tuple[int, int]]:
    """Bin and offset of each size, largest sizes first, equal ones in the given order."""
    tree = Tournament(len(sizes), length)
    out: list[tuple[int, int]] = [(0, 0)] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        place, left = tree.put(sizes[i])
        out[i] = (place, length - left)
    return out


def pieces(
    docs: DataFrame, vocabulary_path: str, length: int = LENGTH, end: int = END, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encoded documents cut into stored pieces: their ids as little-endian uint32, and where they belong."""
    with open(vocabulary_path, encoding="utf-8") as f:
        vocabulary = f.read()
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    tail = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, key = encoder_of(vocabulary), TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in blocks(batch, size=TEXT_BYTES):
                out = []
                for doc_id, raw in zip(part.column(0).to_pylist(), encoder.encode(part.column(1)), strict=True):
                    raw += tail
                    for start in range(0, len(raw), 4 * length):
                        ids = raw[start : start + 4 * length]
                        out.append((key, doc_id, start // 4, len(ids) // 4, zlib.crc32(ids), len(raw) // 4, ids))
                        key += 1
                kinds = [pa.int64()] * 6 + [pa.binary()]
                columns = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=_NAMES)

    return store.stored(rows.mapInArrow(run, PIECES), "pieces")


_NAMES = [x.split()[0] for x in PIECES.split(", ")]


def place(parts: DataFrame, length: int = LENGTH, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to stored pieces; ``key`` tells them apart.

    Sequences of group g have the ids from g * 2**32; whole pieces have the complements of their keys.
    """
    light = parts.select("key", "doc_id", "start", "length", "ids_crc32", "doc_tokens")
    whole = light.filter(F.col("length") == length)
    alone = whole.withColumns({"sequence_id": F.bitwise_not("key"), "offset": F.lit(0).cast("long")})
    rest = light.filter(F.col("length") < length)
    groups = max(1, -(-rest.count() // group_pieces))
    dealt = rest.withColumn("group", F.pmod(F.xxhash64("key"), F.lit(groups)))

    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.drop_columns("group").sort_by("key")
        spots = first_fit_decreasing(table["length"].to_pylist(), length)
        bins, offsets = np.array(spots, np.int64).reshape(-1, 2).T
        return table.append_column("sequence_id", pa.array(bins + (key[0].as_py() << 32))).append_column("offset", pa.array(offsets))

    packed = dealt.groupBy("group").applyInArrow(run, alone.schema)
    return alone.unionByName(packed)


def sequences(parts: DataFrame, placed: DataFrame) -> DataFrame:
    """``sequence_id``, its ``ids`` without padding, their number and the pieces in it, in their order."""
    rows = placed.join(parts.select("key", "ids"), "key")
    inside = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "start", "length", "ids")))
    out = rows.groupBy("sequence_id").agg(inside.alias("p"), F.sum("length").alias("n_tokens"))
    ids = F.aggregate("p", F.lit(b"").cast("binary"), lambda x, y: F.concat(x, y["ids"]))
    pieces_ = F.transform("p", lambda x: F.struct(x["doc_id"].alias("doc_id"), x["start"].alias("start"), x["length"].alias("length")))
    return out.select("sequence_id", ids.alias("ids"), "n_tokens", pieces_.alias("pieces"))


def padding(placed: DataFrame, length: int = LENGTH) -> DataFrame:
    """Tokens, sequences and padding of a placement; a sequence with a power of two of tokens is not padded."""
    sizes = placed.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    pad = F.when(F.bit_count("n") == 1, 0).otherwise(length - F.col("n"))
    return sizes.agg(F.sum("n").alias("tokens"), F.count("*").alias("sequences"), F.sum(pad).alias("padding"))
