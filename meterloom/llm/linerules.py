"""Quality rules on texts and on lines that many documents of a host share.

A line counts once for each document of its host, copies of a document included.  Lines of more documents than the limit are
removed, and a document that keeps too small a part of its words is rejected.  The limit is a number of documents, the same
for a host of any size; rows with the same id and text in one host are one document.

Defined results: null and empty texts have no words and no lines and fail the base rules; a null host is a host of its
own; rows with the same id, host and text get the same result, others with that id are judged apart; a null id is a value
like any other; an empty table gives an empty result; columns other than id, text and host are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterloom.llm import store
from meterloom.llm.words import WHITE, blocks, grams, mix, words_of

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = b"#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PCT = 30
# A line is removed if more than MAX_DOCS documents of its host have it.
MAX_DOCS = 30
MIN_LEFT = 0.5

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True


def keyed(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(host_col).alias("host"),
        F.col(text_col).alias("text"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_key"),
    )


def base_features(rows: DataFrame) -> DataFrame:
    """``doc_id``, ``host``, ``text_key`` and the counts of :data:`BASE` for each row of :func:`keyed`."""
    schema = rows.select("doc_id", "host", "text_key").schema
    for name in BASE:
        schema = schema.add(name, "long", False)
    return rows.select("doc_id", "host", "text_key", "text").mapInArrow(_features, schema)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in blocks(batch):
            counts = _counts(part.column(3))
            columns = [*(part.column(i) for i in range(3)), *(pa.array(c.astype(np.int64)) for c in counts)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "host", "text_key", *BASE])


def _counts(texts: pa.Array) -> list[np.ndarray]:
    w = words_of(texts)
    n_words = np.diff(w.first)
    letters = np.append(0, np.cumsum(~WHITE[w.data] & ((w.data & 0xC0) != 0x80)))
    symbols = np.append(0, np.cumsum(_SYMBOL[w.data]))
    raw = w.data.tobytes()
    dup_lines = np.zeros(len(texts), np.int64)
    for i, (a, b) in enumerate(zip(w.offsets[:-1].tolist(), w.offsets[1:].tolist(), strict=True)):
        lines = [x for x in raw[a:b].split(b"\n") if x.strip(b" \t\r\x0b\x0c")]
        dup_lines[i] = len(lines) - len(set(lines))
    return [n_words, np.diff(letters[w.offsets]), np.diff(symbols[w.offsets]), dup_lines, repeated_words(w, WINDOW)]


def repeated_words(w, width: int) -> np.ndarray:
    """Words of each text inside a window that the text has at two places or more."""
    text = np.repeat(np.arange(len(w.first) - 1), np.diff(w.first))
    keys = grams(w.hashes, width)
    if not len(keys):
        return np.zeros(len(w.first) - 1, np.int64)
    at = np.flatnonzero(text[: len(keys)] == text[width - 1 :])
    _, inverse, count = np.unique(mix(keys[at] + text[at].astype(np.uint64)), return_inverse=True, return_counts=True)
    at = at[count[inverse] > 1]
    change = np.zeros(len(text) + 1, np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, at + width, -1)
    covered = np.append(0, np.cumsum(np.cumsum(change[:-1]) > 0))
    return np.diff(covered[w.first])


def _lines(text: Column) -> Column:
    """Digest and number of words of every line that has a word."""
    normal = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.trim(F.lower(F.regexp_replace(x, SPACE, " "))))
    return F.transform(
        F.filter(normal, lambda x: x != ""),
        lambda x: F.struct(F.xxhash64(x).alias("line"), F.size(F.split(x, " ")).cast("bigint").alias("words")),
    )


def document_lines(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", "host", "text_key", F.explode(_lines(F.col("text"))).alias("l")).select(
        "doc_id", "host", "text_key", "l.line", "l.words"
    )


DOCUMENT = ["doc_id", "host", "text_key"]


def common_lines(rows: DataFrame, max_docs: int = MAX_DOCS) -> DataFrame:
    """Lines above the limit: ``host``, ``line``, ``n_docs``.

    Both steps are aggregates with map-side combine, so a hot host or line arrives as one row per task.
    """
    seen = document_lines(rows).select(*DOCUMENT, "line").distinct()
    return seen.groupBy("host", "line").agg(F.count("*").alias("n_docs")).filter(F.col("n_docs") > max_docs)


def removed_lines(rows: DataFrame, common: DataFrame) -> DataFrame:
    """Per document with such lines: their digests, and ``removed_words`` of one of its rows."""
    found = store.bounded(common.select(F.col("host").alias("of"), F.col("line").alias("hit")))
    lines = document_lines(rows)
    joined = lines.join(found, lines.host.eqNullSafe(F.col("of")) & (lines.line == F.col("hit")))
    gone = joined.groupBy(*DOCUMENT).agg(F.collect_set("line").alias("lines"), F.sum("words").alias("words"))
    # Equal rows of a document were summed above.
    times = rows.groupBy(*DOCUMENT).agg(F.count("*").alias("times")).filter("times > 1")
    out = gone.join(times, _same_document(gone, times), "left")
    removed = (F.col("words") / F.coalesce("times", F.lit(1))).cast("bigint")
    return out.select(*[gone[c].alias(f"of_{c}") for c in DOCUMENT], "lines", removed.alias("removed_words"))


def _same_document(left: DataFrame, right: DataFrame, prefix: str = "") -> Column:
    a, b, c = (left[x].eqNullSafe(right[prefix + x]) for x in DOCUMENT)
    return a & b & c


def filter_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    max_docs: int = MAX_DOCS,
    min_left: float = MIN_LEFT,
) -> DataFrame:
    """``doc_id``, ``clean_text`` without the common lines, and ``depleted``."""
    rows = keyed(docs, id_col, text_col, host_col)
    gone = store.stored(removed_lines(rows, store.stored(common_lines(rows, max_docs), "lines")), "gone")
    joined = rows.join(gone, _same_document(rows, gone, "of_"), "left")
    digest = lambda x: F.xxhash64(F.trim(F.lower(F.regexp_replace(x, SPACE, " "))))
    kept = F.filter(
        F.split(F.coalesce("text", F.lit("")), "\n"),
        lambda x: ~F.coalesce(F.array_contains(F.col("lines"), digest(x)), F.lit(False)),
    )
    words = lambda c: F.size(F.filter(F.split(c, SPACE), lambda x: x != ""))
    out = joined.select("doc_id", "text", F.array_join(kept, "\n").alias("clean_text"))
    before, after = words(F.coalesce("text", F.lit(""))), words(F.col("clean_text"))
    return out.select("doc_id", "clean_text", (after < before * min_left).alias("depleted"))


def judge(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    max_docs: int = MAX_DOCS,
    min_left: float = MIN_LEFT,
) -> DataFrame:
    """One row per document: the base counts, ``base_failed``, ``removed_words`` and ``kept``."""
    rows = keyed(docs, id_col, text_col, host_col)
    common = store.stored(common_lines(rows, max_docs), "lines")
    gone = removed_lines(rows, common).drop("lines")
    base = base_features(rows)
    out = base.join(gone, _same_document(base, gone, "of_"), "left")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))
    removed = F.coalesce("removed_words", F.lit(0))
    left = F.col("n_words") - removed
    return out.select(
        "doc_id",
        *BASE,
        failed.alias("base_failed"),
        removed.alias("removed_words"),
        (~failed & (left >= min_left * F.col("n_words"))).alias("kept"),
    )
