"""Statistics of a text that say something about its form, not about its language or origin."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.llm.linerules import _counts, repeated_words
from meterloom.llm.words import WHITE, blocks, words_of

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".,;:?")] = True
_LOUD = np.zeros(256, bool)
_LOUD[list(b"!")] = True

STATS = [
    "words",
    "word_length",
    "symbols",
    "upper",
    "digits",
    "stops",
    "loud",
    "other",
    "dup_lines",
    "line_words",
    "repeat_8",
    "repeat_3",
    "distinct",
    "longest",
]


def text_stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", also: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, the columns ``also`` and :data:`STATS` as doubles; texts without words have 0 everywhere."""
    rows = docs.select(F.col(id_col).alias("doc_id"), *also, F.col(text_col).alias("text"))
    schema = rows.drop("text").schema
    for name in STATS:
        schema = schema.add(name, "double", False)
    return rows.mapInArrow(_stats, schema)


def _stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in blocks(batch):
            names = part.schema.names[:-1]
            columns = [part.column(i) for i in range(len(names))]
            values = measure(part.column(len(names)))
            columns += [pa.array(v.astype(np.float64)) for v in values]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, *STATS])


def measure(texts: pa.Array) -> list[np.ndarray]:
    w = words_of(texts)
    n_words, chars, symbols, dup_lines, repeat_8 = _counts(texts)
    n, c = np.maximum(n_words, 1), np.maximum(chars, 1)
    per = lambda mark: np.diff(np.append(0, np.cumsum(mark))[w.offsets])
    letters = np.maximum(per(_LETTER[w.data]), 1)
    lines = per(w.data == 10) + 1
    other = per(~WHITE[w.data] & ~_LETTER[w.data] & ~_DIGIT[w.data] & ~_STOP[w.data] & ~_LOUD[w.data])
    text = np.repeat(np.arange(len(texts)), n_words)
    order = np.lexsort((w.hashes, text))
    new = np.ones(len(order), bool)
    if len(order):
        h, t = w.hashes[order], text[order]
        new[1:] = (h[1:] != h[:-1]) | (t[1:] != t[:-1])
    distinct = np.bincount(text[order][new], minlength=len(texts)) if len(order) else np.zeros(len(texts))
    longest = np.zeros(len(texts), np.int64)
    if len(order):
        np.maximum.at(longest, text, w.stop - w.start)
    empty = n_words == 0
    values = [
        n_words,
        chars / n,
        symbols / c,
        per(_UPPER[w.data]) / letters,
        per(_DIGIT[w.data]) / c,
        per(_STOP[w.data]) / n,
        per(_LOUD[w.data]) / n,
        other / c,
        dup_lines / lines,
        n_words / lines,
        repeat_8 / n,
        repeated_words(w, 3) / n,
        distinct / n,
        longest,
    ]
    return [np.where(empty, 0.0, v) for v in values]
