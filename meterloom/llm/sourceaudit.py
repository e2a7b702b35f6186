"""How far the vocabularies of the sources of a language lie apart, by exact whole-number divergences.

Terms are counted in Arrow alone: texts are lower-cased and split by a pattern, the terms dictionary-encoded, and hash
aggregations give the occurrences and documents of each (language, source, term) of a task.  These partial counts are merged
by Spark.  Shares of the merged counts are then laid out as shards: a shard holds some terms of a language as one column a
term and one row a source, and adds up the divergences of all its pairs of sources; the sums of the shards are added.

A term is a run of ASCII letters and of characters beyond ASCII.  A language keeps the terms in at least ``min_docs`` of its
documents.  Share of a kept term in a group: ``1 + floor(10**9 * (count + 2) / (N + 2 * V))`` with N occurrences of the V kept
terms; divergence of two shares: ``floor((p - q)**2 / (p + q))``.

Bounds: a shard has about ``SHARD_TERMS`` terms and two blocks of at most ``BLOCK_SOURCES`` sources, whatever the number of
documents; a worker holds about ``HELD_COUNTS`` partial counts.

Defined results: null texts, languages and sources count as empty ones; rows that repeat an id are documents of their own;
a group without terms has all shares at their least; a language without kept terms gives 0 for each pair; equal values are
ranked by the bytes of the item; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterloom.llm import store
from meterloom.llm.words import blocks

NOT_TERM = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
MIN_DOCS = 10
TOP_TERMS = 10
SCALE = 1_000_000_000
TEXT_BYTES = 1 << 23
HELD_COUNTS = 400_000
SHARD_TERMS = 256
BLOCK_SOURCES = 128
KEYS = ["lang", "source", "term"]


def counts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """``lang, source, term, n, docs`` of all documents; the empty term stands for the documents of a group."""
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang, "lang"), (source, "source"), (text, "text"))])
    partial = rows.mapInArrow(_partial, "lang string, source string, term string, n long, docs long")
    return partial.groupBy(*KEYS).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for batch in batches:
        for part in blocks(batch, size=TEXT_BYTES):
            found = _count(part)
            held.append(found)
            size += found.num_rows
            if size > HELD_COUNTS:
                merged = _merge(held)
                held, size = [merged], merged.num_rows
                if size > HELD_COUNTS // 2:
                    yield from merged.to_batches()
                    held, size = [], 0
    if held:
        yield from _merge(held).to_batches()


def _merge(tables: list[pa.Table]) -> pa.Table:
    merged = pa.concat_tables(tables).group_by(KEYS).aggregate([("n", "sum"), ("docs", "sum")])
    return merged.rename_columns({"n_sum": "n", "docs_sum": "docs"}).select([*KEYS, "n", "docs"]).combine_chunks()


def _count(part: pa.RecordBatch) -> pa.Table:
    """Counts of a block of documents."""
    groups = pa.table({"lang": part["lang"], "source": part["source"]}).append_column("row", pa.array(np.arange(part.num_rows)))
    sizes = groups.group_by(["lang", "source"]).aggregate([("row", "count"), ("row", "list")])
    group_of = np.empty(part.num_rows, np.int32)
    lists = sizes["row_list"].combine_chunks()
    group_of[pc.list_flatten(lists).to_numpy()] = pc.list_parent_indices(lists).to_numpy()

    split = pc.split_pattern_regex(pc.ascii_lower(part["text"]), NOT_TERM)
    terms, doc = pc.list_flatten(split), pc.list_parent_indices(split)
    some = pc.not_equal(terms, "")
    terms = terms.filter(some).dictionary_encode()
    pairs = pa.table({"doc": doc.filter(some), "term": terms.indices}).group_by(["doc", "term"]).aggregate([([], "count_all")])
    by_group = pa.table({"group": group_of[pairs["doc"].to_numpy()], "term": pairs["term"], "n": pairs["count_all"]})
    found = by_group.group_by(["group", "term"]).aggregate([("n", "sum"), ("n", "count")])

    size = pa.table({"lang": sizes["lang"], "source": sizes["source"], "docs": sizes["row_count"]})
    markers = size.append_column("term", pa.array([""] * len(size), pa.string())).append_column("n", pa.array(np.zeros(len(size), np.int64)))
    names = size.take(found["group"])
    rows = pa.table(
        {
            "lang": names["lang"],
            "source": names["source"],
            "term": terms.dictionary.take(found["term"].combine_chunks()),
            "n": found["n_sum"],
            "docs": found["n_count"],
        }
    )
    return pa.concat_tables([rows, markers.select(rows.column_names)])


def _share(count: Column, total: Column, kept: Column) -> Column:
    """Decimals, as a count times 10**9 may not fit 64 bits."""
    wide = lambda c: c.cast("decimal(20,0)")
    return F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * wide(count + 2), wide(total + 2 * kept)) + 1


def _divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


class Audit:
    """Merged counts of a corpus, and what is computed from them."""

    def __init__(self, docs: DataFrame, min_docs: int = MIN_DOCS, lang: str = "lang", source: str = "source", text: str = "text"):
        merged = store.stored(counts(docs, lang, source, text), "counts")
        terms = merged.filter("term <> ''")
        kept = terms.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
        self.kept = store.stored(kept.filter(F.col("docs") >= min_docs), "kept")
        self.cells = store.stored(terms.drop("docs").join(self.kept.drop("docs"), ["lang", "term"]), "cells")
        sizes = self.kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
        totals = self.cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        groups = merged.filter("term = ''").select("lang", "source", "docs")
        groups = groups.join(totals, ["lang", "source"], "left").join(sizes, "lang", "left").fillna(0, ["v", "total", "lang_total"])
        place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1  # one row for each source
        least = F.when(F.col("v") > 0, _share(F.lit(0), F.col("total"), F.col("v"))).otherwise(1)
        self.groups = store.stored(groups.withColumns({"place": place.cast("long"), "least": least}), "groups")
        store.release(merged)

    def shares(self) -> DataFrame:
        """Cells with occurrences: ``lang, source, term, n, v, place``, ``p`` of the group and ``q`` of the language."""
        groups = store.bounded(self.groups.drop("docs", "least"))
        rows = self.cells.join(groups, ["lang", "source"])
        p = _share(F.col("n"), F.col("total"), F.col("v"))
        q = _share(F.col("lang_n"), F.col("lang_total"), F.col("v"))
        return rows.select("lang", "source", "term", "n", "v", "place", p.alias("p"), q.alias("q"))

    def terms(self, top: int = TOP_TERMS) -> DataFrame:
        """The terms that set each group apart from its language: ``lang, source, term, value, rank``."""
        over = self.shares().filter("n > 0 AND p > q").withColumn("value", _divergence(F.col("p"), F.col("q")))
        # Tasks keep their own first rows of each group before these are shuffled.
        rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term"))
        return over.withColumn("rank", rank).filter(F.col("rank") <= top).select("lang", "source", "term", "value", "rank")

    def pairs(self) -> DataFrame:
        """The divergence of each group to every other one of its language: ``lang, source, other, value, rank``."""
        shards = F.greatest(F.ceil(F.col("v") / SHARD_TERMS), F.lit(1))
        n_blocks = Window.partitionBy("lang")
        groups = self.groups.withColumn("blocks", F.floor(F.max("place").over(n_blocks) / BLOCK_SOURCES) + 1)
        small = store.bounded(groups.select("lang", "source", "blocks"))
        cells = self.shares().join(small, ["lang", "source"])
        cells = cells.select("lang", F.pmod(F.xxhash64("term"), shards).alias("shard"), "place", "blocks", "term", "p")
        # A row without a term gives a source's share of the terms that it lacks, in every shard.
        absent = groups.select(
            "lang", F.explode(F.sequence(F.lit(0).cast("long"), shards - 1)).alias("shard"), "place", "blocks",
            F.lit(None).cast("string").alias("term"), F.col("least").alias("p"),
        )
        own = F.floor(F.col("place") / BLOCK_SOURCES)
        rows = cells.unionByName(absent).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        rows = rows.select("lang", "shard", F.least(own, "other").alias("low"), F.greatest(own, "other").alias("high"), "place", "term", "p")
        sums = rows.groupBy("lang", "shard", "low", "high").applyInArrow(_compare, "lang string, a long, b long, value long")
        total = sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
        both = F.inline(F.array(F.struct(F.col("a").alias("place"), F.col("b").alias("to")), F.struct(F.col("b").alias("place"), F.col("a").alias("to"))))
        names = store.bounded(self.groups.select("lang", "place", "source"))
        out = total.select("lang", "value", both).join(names, ["lang", "place"])
        out = out.join(names.select("lang", F.col("place").alias("to"), F.col("source").alias("other")), ["lang", "to"])
        rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "other"))
        return out.select("lang", "source", "other", "value", rank.alias("rank"))


def _compare(key: tuple, table: pa.Table) -> pa.Table:
    """Sums of the divergences of all pairs of sources over the terms of a shard."""
    lang, _, low, high = (k.as_py() for k in key)
    place, p = table["place"].to_numpy(), table["p"].to_numpy()
    terms = table["term"].combine_chunks().dictionary_encode()
    column = terms.indices.fill_null(-1).to_numpy()
    absent = column < 0
    sources = np.unique(place[absent])
    share = np.empty((len(sources), len(terms.dictionary)), np.int64)
    share[np.searchsorted(sources, place[absent])] = p[absent][:, None]
    share[np.searchsorted(sources, place[~absent]), column[~absent]] = p[~absent]
    block = sources // BLOCK_SOURCES
    a, b, value = [], [], []
    for i in np.flatnonzero(block == low):
        others = np.flatnonzero((block == high) & (sources > sources[i]))
        d = share[others] - share[i]
        value.append((d * d // (share[others] + share[i])).sum(axis=1))
        a.append(np.full(len(others), sources[i]))
        b.append(sources[others])
    a, b, value = (np.concatenate(x).astype(np.int64) for x in (a, b, value))
    return pa.table({"lang": pa.array([lang] * len(a), pa.string()), "a": a, "b": b, "value": value})


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """Both parts as ``lang, source, part, item, value, rank``."""
    found = Audit(docs, min_docs)
    pairs = found.pairs().select("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), "value", "rank")
    terms = found.terms(top).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")
    return pairs.unionByName(terms)
