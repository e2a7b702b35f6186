"""Repeated passages, by seed and extend.

Seeds: of every window of ``window`` words the run of ``SEED_WORDS`` words with the least hash is an anchor, so equal
windows have equal anchors.  Documents are joined on the anchors that occur at two places or more.  Extension: around such
an anchor a match reaches left and right as far as the windows that hold the anchor agree; windows are compared
by their digest, after those inside one task were combined, so a passage that many documents share costs one row a
task and no pairs.  Overlapping windows merge into maximal repeats, all of them of at least ``window`` words.

Defined results: null texts have no words; texts with fewer words than ``window`` keep them all; rows that repeat a text
repeat each other's windows, and those that repeat the id as well get the same result; a null id is a value like any other;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.llm import store
from meterloom.llm.words import blocks, grams, mix, signed, words_of

WINDOW = 50
SEED_WORDS = 8
# Windows combined inside a task at a time.
COMBINED = 1_000_000


def sliding(x: np.ndarray, n: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) of every ``n`` neighbours."""
    out, width = x, 1
    while 2 * width <= n:
        out, width = pick(out[:-width], out[width:]), 2 * width
    rest = n - width
    return pick(out[: len(out) - rest], out[rest:]) if rest else out


def _anchored(w, window: int, seed_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Windows (by first word), their anchors, all runs of ``seed_words`` and the text of each word."""
    text = np.repeat(np.arange(len(w.first) - 1), np.diff(w.first))
    runs = grams(w.hashes, seed_words)
    n = len(w.hashes) - window + 1
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), runs, text
    least = sliding(runs, window - seed_words + 1, np.minimum)
    at = np.flatnonzero(text[:n] == text[window - 1 :])
    return at, least[at], runs, text


def seeds(rows: DataFrame, window: int, seed_words: int = SEED_WORDS) -> DataFrame:
    """``key``, ``seed`` and the number of places of each anchor of each row (``key``, ``text``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch):
                w = words_of(part.column(1))
                at, least, runs, text = _anchored(w, window, seed_words)
                # A run is an anchor if it is the least one of some window of its text around it.
                reach = window - seed_words + 1
                chosen = np.zeros(len(runs) + reach - 1, np.uint64)
                chosen[at + reach - 1] = least
                anchor = np.flatnonzero(sliding(chosen, reach, np.maximum)[: len(runs)] == runs) if len(runs) else at
                anchor = anchor[text[anchor] == text[anchor + seed_words - 1]] if len(anchor) else anchor
                order = np.lexsort((runs[anchor], text[anchor]))
                s, t = runs[anchor][order], text[anchor][order]
                new = np.ones(len(s), bool)
                new[1:] = (s[1:] != s[:-1]) | (t[1:] != t[:-1])
                first = np.flatnonzero(new)
                count = np.diff(np.append(first, len(s)))
                keys = part.column(0).to_numpy()[t[first]]
                columns = [pa.array(keys), pa.array(signed(s[first])), pa.array(count.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "seed", "n"])

    return rows.select("key", "text").mapInArrow(run, "key long, seed long, n int")


def windows(rows: DataFrame, window: int, seed_words: int = SEED_WORDS) -> DataFrame:
    """Windows around shared anchors; ``rows`` has ``key``, ``text`` and the row's shared ``seeds``.

    A row with ``key`` and ``digest`` is a window met once in its task; with ``digest`` alone one met more often;
    with ``key`` alone ``n`` windows in a row, from ``at`` on, that were met more often.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for part in blocks(batch):
                w = words_of(part.column(1))
                at, least, _, text = _anchored(w, window, seed_words)
                lists = part.column(2)
                flat, ends = lists.flatten().to_numpy(zero_copy_only=False), np.asarray(lists.value_lengths())
                owner = np.repeat(np.arange(len(ends)), ends)
                tag = lambda s, t: mix(s.astype(np.uint64)) + t.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                at = at[np.isin(tag(least, text[at]), tag(flat.view(np.uint64), owner))]
                digest = grams(w.hashes, window)[at]
                held.append((digest, part.column(0).to_numpy()[text[at]], (at - w.first[text[at]]).astype(np.int32)))
                size += len(at)
                if size >= COMBINED:
                    yield _combined(held)
                    held, size = [], 0
        if size:
            yield _combined(held)

    return rows.select("key", "text", "seeds").mapInArrow(run, "digest long, key long, at int, n int")


def _combined(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    digest, key, at = (np.concatenate(x) for x in zip(*held, strict=True))
    order = np.argsort(digest, kind="stable")
    digest, key, at = digest[order], key[order], at[order]
    new = np.ones(len(digest), bool)
    new[1:] = digest[1:] != digest[:-1]
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(digest)))
    single = first[count == 1]
    many = first[count > 1]
    again = np.repeat(count > 1, count)
    k, a = key[again], at[again]
    order = np.lexsort((a, k))
    k, a = k[order], a[order]
    start = np.ones(len(k), bool)
    start[1:] = (k[1:] != k[:-1]) | (a[1:] > a[:-1] + 1)
    begin = np.flatnonzero(start)
    last = np.append(begin[1:], len(k)) - 1
    none = lambda n: np.ones(n, bool)
    some = lambda n: np.zeros(n, bool)
    sizes = (len(single), len(many), len(begin))
    no_key = np.concatenate([some(sizes[0]), none(sizes[1]), some(sizes[2])])
    no_digest = np.concatenate([some(sizes[0] + sizes[1]), none(sizes[2])])
    zero = np.zeros(sizes[1], np.int64)
    columns = [
        pa.array(np.concatenate([signed(digest[single]), signed(digest[many]), np.zeros(sizes[2], np.int64)]), mask=no_digest),
        pa.array(np.concatenate([key[single], zero, k[begin]]), mask=no_key),
        pa.array(np.concatenate([at[single], zero.astype(np.int32), a[begin]])),
        pa.array(np.concatenate([np.ones(sizes[0]), np.full(sizes[1], 2), a[last] - a[begin] + 1] if sizes[2] else [np.ones(sizes[0]), np.full(sizes[1], 2)]).astype(np.int32)),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["digest", "key", "at", "n"])


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id``, ``text`` and a 64-bit ``key`` of both."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.xxhash64(F.col(id_col), text).alias("key"))


def repeated_windows(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``key`` and ``runs`` (first window, number of windows) of every row with a repeated window."""
    rows = keyed(docs, id_col, text_col)
    found = store.stored(seeds(rows, window), "seeds")
    shared = found.groupBy("seed").agg(F.sum("n").alias("places")).filter("places > 1").select("seed")
    # Rows that repeat id and text share a key, and each adds its own places.
    hits = found.join(shared, "seed").groupBy("key").agg(F.collect_set("seed").alias("seeds"))
    hits = store.stored(hits, "hits")
    around = store.stored(windows(rows.join(hits, "key"), window), "windows")
    store.release(found, hits)
    # At most one row a task and combining step has the same digest.
    single = around.filter("digest is not null")
    total = single.groupBy("digest").agg(F.sum("n").alias("places")).filter("places > 1").select("digest")
    total = store.stored(total, "digests")
    store.free_shuffles(docs.sparkSession, now=True)
    single = single.filter("key is not null").join(total, "digest").select("key", "at", F.lit(1).alias("n"))
    runs = single.unionByName(around.filter("digest is null").select("key", "at", "n"))
    out = store.stored(runs.groupBy("key").agg(F.collect_set(F.struct("at", "n")).alias("runs")), "runs")
    store.release(around, total)
    store.free_shuffles(docs.sparkSession, now=True)
    return out


def spans(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Maximal repeats: ``doc_id``, ``first`` and ``last`` word."""
    marked = _marked(docs, window, id_col, text_col).filter("runs is not null")
    schema = marked.select("doc_id").schema.add("first", "long").add("last", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, first, last = [], [], []
            for i, runs in enumerate(batch.column(1).to_pylist()):
                for a, b in _merged(runs, window):
                    row.append(i)
                    first.append(a)
                    last.append(b - 1)
            columns = [batch.column(0).take(pa.array(row, pa.int64())), pa.array(first, pa.int64()), pa.array(last, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "first", "last"])

    return marked.select("doc_id", "runs").mapInArrow(run, schema)


def _marked(docs: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    return keyed(docs, id_col, text_col).join(repeated_windows(docs, window, id_col, text_col), "key", "left")


def _merged(runs: list[dict], window: int) -> list[tuple[int, int]]:
    """Word ranges covered by runs of windows."""
    out: list[list[int]] = []
    for r in sorted(runs, key=lambda r: r["at"]):
        a, b = r["at"], r["at"] + r["n"] + window - 1
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and ``kept`` (the other words, joined by one space) of every row."""
    marked = _marked(docs, window, id_col, text_col).select("doc_id", "text", "runs")
    schema = marked.select("doc_id").schema
    schema = schema.add("n_words", "long", False).add("n_removed", "long", False).add("kept", "string", False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch):
                n_words, n_removed, kept = [], [], []
                for text, runs in zip(part.column(1), part.column(2), strict=True):
                    words = text.as_py().encode().split()
                    n_words.append(len(words))
                    out, last = [], 0
                    for a, b in _merged(runs.as_py() or [], window):
                        out += words[last:a]
                        last = b
                    out += words[last:]
                    n_removed.append(len(words) - len(out))
                    kept.append(b" ".join(out).decode())
                columns = [part.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return marked.mapInArrow(run, schema)
