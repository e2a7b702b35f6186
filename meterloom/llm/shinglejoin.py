"""Near-duplicate join by the Jaccard similarity of word shingles, exact up to 64-bit hashes.

Documents with equal shingle sets are one node.  The range of hashes is cut into parts, more than the number of tokens in
which two similar sets of about that size can differ, so that they agree in all tokens of some part: its digest is a
signature, and nodes with a common signature are candidates.  Unlike a prefix of tokens, a part is shared only if it is
shared whole, hence frequent tokens need no care.  A bitmap of the parities of the tokens in each slot differs in at most as
many bits as the sets have different tokens, so pairs whose bitmaps are too far apart go before any text is read.

Large groups of near copies never give all their pairs: each node is first compared with its nearest leader, then only nodes
of different components are paired, of two components first the nearest pair.

Defined results: null and empty texts have the empty set, are linked with nothing and are components of their own; texts
with fewer words than a shingle are one shingle; rows that repeat an id are kept apart by content, and a component's id
is its least id; a null id counts as greater than all others; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterloom.llm import store
from meterloom.llm.components import components
from meterloom.llm.words import blocks, coefficients, grams, mix, signed, words_of

SHINGLE = 5
PERCENT = 80
# Nodes with a common signature from which on they are compared with two leaders.
COMMON = 32
# 64-bit words of a bitmap; sets with more tokens than half its bits have a wider one as well.
BITMAP = 16
# Bytes of text worked on at a time.
BLOCK = 1 << 20

_SALTS = coefficients(64, 9)


class Parts(NamedTuple):
    """Cuts of the range of hashes for each class of sizes.

    A class ends at the greatest size that can be similar to its least one, so partners are in the same or the next class.
    """

    last: np.ndarray  # greatest size of the class
    parts: np.ndarray  # 0: similar sets are equal
    spare: np.ndarray  # sets with more empty parts than this have signatures of these as well


def parts_of(percent: int) -> Parts:
    """At least ``spare + 1`` parts have no token in which two similar sets differ."""
    last = [0]
    while percent < 100 and last[-1] < 1 << 40:
        last.append((last[-1] + 1) * 100 // percent)
    last = np.array([*last, 1 << 62])
    least = np.append(1, last[:-1] + 1)
    differ = np.minimum(last, 1 << 41) * 2 * (100 - percent) // (100 + percent)
    # Parts without a token, as expected for the least size, and three times their deviation.
    empty = (differ + 2) * np.exp(-least / (differ + 2))
    spare = np.ceil(empty + 3 * np.sqrt(empty)).astype(np.int64)
    return Parts(last, np.where(differ > 0, differ + 1 + spare, 0), spare)


def token_sets(texts: pa.Array, shingle: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes, sorted within each text; where each text's begin; the text of each."""
    w = words_of(texts, lower=True)
    n = np.diff(w.first)
    text = np.repeat(np.arange(len(n)), n)
    runs = grams(w.hashes, shingle)
    at = np.flatnonzero(text[: len(runs)] == text[shingle - 1 :]) if len(runs) else np.zeros(0, np.int64)
    token, owner = [runs[at]], [text[at]]
    for few in range(1, shingle):
        short = np.flatnonzero(n == few)
        token.append(grams(w.hashes, few)[w.first[short]] if len(short) else np.zeros(0, np.uint64))
        owner.append(short)
    token, owner = np.concatenate(token), np.concatenate(owner)
    order = np.lexsort((token, owner))
    token, owner = token[order], owner[order]
    new = np.ones(len(token), bool)
    new[1:] = (token[1:] != token[:-1]) | (owner[1:] != owner[:-1])
    token, owner = token[new], owner[new]
    return token, np.searchsorted(owner, np.arange(len(n) + 1)), owner


def _nodes(token: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Digest of each set; 0 for the empty set."""
    out = np.zeros(len(first) - 1, np.uint64)
    full = np.flatnonzero(first[1:] > first[:-1])
    if len(full):
        out[full] = mix(np.add.reduceat(mix(token ^ _SALTS[63]), first[:-1][full]))
    return out


WORDS = [f"bits{i}" for i in range(BITMAP)]


def _bitmaps(token: np.ndarray, first: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Bitmap of each set, a row of words; and its wider one, null for sets of at most half the bits."""
    n, bits = np.diff(first), 64 * BITMAP
    wide = np.maximum(1 << np.ceil(np.log2(np.maximum(2 * n, 1))).astype(np.int64), bits)
    start = np.append(0, np.cumsum(wide))
    slot = start[owner] + (token & (wide[owner] - 1).astype(np.uint64)).astype(np.int64)
    words = np.zeros(start[-1] // 64, np.uint64)
    np.bitwise_xor.at(words, slot >> 6, np.uint64(1) << (slot & 63).astype(np.uint64))
    folded = words.reshape(-1, BITMAP)
    if len(folded) > len(n):
        folded = np.bitwise_xor.reduceat(folded, start[:-1] // bits, axis=0)
    more = np.repeat(wide > bits, wide // 64)
    ends = np.append(0, np.cumsum(np.where(wide > bits, wide // 8, 0))).astype(np.int32)
    valid = pa.py_buffer(np.packbits(wide > bits, bitorder="little"))
    return folded, pa.Array.from_buffers(pa.binary(), len(n), [valid, pa.py_buffer(ends), pa.py_buffer(words[more])])


def describe(docs: DataFrame, shingle: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``text_key``, ``n``, ``node`` (digest of the set, null if empty), ``wide`` and the words of the bitmap."""
    key = F.xxhash64(F.col(text_col)).alias("text_key")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), key)
    schema = rows.select("doc_id", "text_key").schema.add("n", "long", False).add("node", "long").add("wide", "binary")
    for name in WORDS:
        schema = schema.add(name, "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, size=BLOCK):
                token, first, owner = token_sets(part.column(1), shingle)
                node, n = _nodes(token, first), np.diff(first)
                bits, wide = _bitmaps(token, first, owner)
                columns = [part.column(0), part.column(2), pa.array(n.astype(np.int64)), pa.array(signed(node), mask=n == 0), wide]
                columns += [pa.array(signed(np.ascontiguousarray(bits[:, i]))) for i in range(BITMAP)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_key", "n", "node", "wide", *WORDS])

    return rows.mapInArrow(run, schema)


def signatures(token: np.ndarray, first: np.ndarray, owner: np.ndarray, cuts: Parts) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of all sets for their own class and the next one, and the set of each."""
    found, of = [], []
    own, value = np.searchsorted(cuts.last, np.diff(first)), mix(token ^ _SALTS[62])
    for kind in (own, np.minimum(own + 1, len(cuts.last) - 1)):
        at = np.flatnonzero(cuts.parts[kind][owner] > 0)
        if not len(at):
            continue
        mine, count = owner[at], cuts.parts[kind].astype(np.uint64)
        # Tokens are sorted within a set, so those of a part are neighbours.
        part = ((token[at] >> np.uint64(40)) * count[mine]) >> np.uint64(24)
        new = np.ones(len(at), bool)
        new[1:] = (part[1:] != part[:-1]) | (mine[1:] != mine[:-1])
        new = np.flatnonzero(new)
        salt = lambda k, p: mix((k.astype(np.uint64) << np.uint64(48)) ^ p ^ _SALTS[61])
        found.append(mix(np.add.reduceat(value[at], new) + salt(kind[mine[new]], part[new])))
        of.append(mine[new])
        empty = cuts.parts[kind] - np.bincount(mine[new], minlength=len(kind))
        for i in np.flatnonzero((empty > cuts.spare[kind]) & (np.diff(first) > 0) & (count > 0)):
            none = np.setdiff1d(np.arange(count[i], dtype=np.uint64), part[new[mine[new] == i]])
            found.append(mix(salt(np.full(len(none), kind[i]), none)))
            of.append(np.full(len(none), i))
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(found), np.concatenate(of)


class Join:
    """The join of one table with itself; steps are stored tables."""

    def __init__(self, docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text"):
        self.shingle, self.percent = shingle, percent
        self.rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
        self.described = store.stored(describe(self.rows, shingle), "sets", store.BATCH_BYTES)
        nodes = self.described.filter("node is not null").groupBy("node")
        facts = [F.min("doc_id").alias("doc_id"), F.min("n").alias("n"), *[F.first(c).alias(c) for c in ("wide", *WORDS)]]
        self.nodes = store.stored(nodes.agg(*facts), "nodes")

    # -- texts ---------------------------------------------------------------------------------------------------

    def _texts(self, nodes: DataFrame) -> DataFrame:
        """``node`` and ``text`` of a document of each of the stored ``nodes``.

        Their ids are joined with the documents; rows whose set is another one, under a repeated id, go.
        """
        ids = self.nodes.join(nodes.select("node"), "node").select(F.col("doc_id").alias("id"), F.col("node").alias("want"))
        ids = store.small(store.stored(ids, "ids"), 32)
        joined = self.rows.join(ids, F.col("doc_id").eqNullSafe(F.col("id"))).select("want", "text")
        shingle = self.shingle

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in blocks(batch):
                    token, first, _ = token_sets(part.column(1), shingle)
                    right = pa.array(signed(_nodes(token, first)) == part.column(0).to_numpy())
                    yield pa.RecordBatch.from_arrays([c.filter(right) for c in part.columns], names=["node", "text"])

        return joined.mapInArrow(run, "node long, text string").dropDuplicates(["node"])

    def compare(self, pairs: DataFrame) -> DataFrame:
        """``a``, ``b``, ``shared`` and ``joint`` (sizes of intersection and union) of stored pairs of nodes."""
        need = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
        texts = store.stored(self._texts(need), "texts", store.BATCH_BYTES)
        left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
        right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
        both = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
        shingle = self.shingle

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in blocks(batch, "text_a", 1 << 20):
                    ta, fa, _ = token_sets(part.column(2), shingle)
                    tb, fb, _ = token_sets(part.column(3), shingle)
                    shared = np.array(
                        [
                            len(np.intersect1d(ta[a0:a1], tb[b0:b1], assume_unique=True))
                            for a0, a1, b0, b1 in zip(fa[:-1], fa[1:], fb[:-1], fb[1:], strict=True)
                        ],
                        np.int64,
                    )
                    joint = np.diff(fa) + np.diff(fb) - shared
                    columns = [part.column(0), part.column(1), pa.array(shared), pa.array(joint)]
                    yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "shared", "joint"])

        return store.stored(both.mapInArrow(run, "a long, b long, shared long, joint long"), "compared", store.BATCH_BYTES)

    def _linked(self) -> Column:
        return F.col("shared") * 100 >= F.col("joint") * self.percent

    # -- candidates ----------------------------------------------------------------------------------------------

    def _spots(self) -> DataFrame:
        """``signature``, ``node``, the least and greatest node and the number of nodes with it, if there are several."""
        held = self.nodes.select(F.col("doc_id").alias("id"), F.col("node").alias("want"))
        held = store.small(store.stored(held, "held"), 32)
        joined = self.rows.join(held, F.col("doc_id").eqNullSafe(F.col("id"))).select("want", "text")
        shingle, cuts = self.shingle, parts_of(self.percent)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in blocks(batch, size=BLOCK):
                    token, first, owner = token_sets(part.column(1), shingle)
                    want = part.column(0).to_numpy()
                    right = signed(_nodes(token, first)) == want
                    found, of = signatures(token, first, owner, cuts)
                    found, of = found[right[of]], of[right[of]]
                    yield pa.RecordBatch.from_arrays([pa.array(signed(found)), pa.array(want[of])], names=["signature", "node"])

        same = Window.partitionBy("signature")
        out = joined.mapInArrow(run, "signature long, node long").select(
            "signature", "node", F.min("node").over(same).alias("low"), F.max("node").over(same).alias("high"), F.count("*").over(same).alias("of")
        )
        return store.stored(out.filter("low < high"), "spots", store.BATCH_BYTES)

    def _facts(self, prefix: str) -> DataFrame:
        return self.nodes.select(F.col("node").alias(prefix), *[F.col(c).alias(f"{prefix}_{c}") for c in ("n", *WORDS)])

    def _apart(self) -> Column:
        """Bits in which the bitmaps differ: at most the tokens that only one of the sets has."""
        return reduce(add, [F.bit_count(F.col(f"a_{c}").bitwiseXOR(F.col(f"b_{c}"))) for c in WORDS])

    def _maybe(self) -> Column:
        """Sizes and bitmaps allow that the sets are similar."""
        a, b = F.col("a_n"), F.col("b_n")
        sizes = (a * 100 >= b * self.percent) & (b * 100 >= a * self.percent)
        return sizes & (self._apart() * (100 + self.percent) <= (a + b) * (100 - self.percent))

    def _leaders(self, spots: DataFrame) -> DataFrame:
        """``a`` and ``b``: each node and its nearest leaders among the least nodes, and the greatest of crowded signatures."""
        least = spots.select(F.col("node").alias("a"), F.col("low").alias("b"), F.lit(0).alias("end"))
        greatest = spots.filter(F.col("of") > COMMON).select(F.col("node").alias("a"), F.col("high").alias("b"), F.lit(1).alias("end"))
        edges = least.unionByName(greatest).filter("a != b").distinct()
        near = edges.join(self._facts("a"), "a").join(self._facts("b"), "b").filter(self._maybe())
        near = near.groupBy("a", "end").agg(F.min(F.struct(self._apart().alias("apart"), "b")).alias("to"))
        pair = [F.least("a", "to.b").alias("a"), F.greatest("a", "to.b").alias("b")]
        return store.stored(near.select(*pair).distinct(), "leaders")

    def _pairs(self, spots: DataFrame, links: DataFrame) -> DataFrame:
        """Candidates (``a`` < ``b``, ``apart``) of which the links connect none."""
        labels = store.stored(components(links), "labels").select("node", F.col("component").alias("label"))
        held = spots.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        same = Window.partitionBy("signature")
        held = held.select("signature", "node", "label", F.min("label").over(same).alias("main"), F.max("label").over(same).alias("other"))
        held = store.stored(held.filter("main < other"), "buckets")
        side = lambda x, rows: rows.select("signature", F.col("node").alias(x), F.col("label").alias(f"{x}_label"), F.col("main").alias(f"{x}_main"))
        # One node of a pair is not of the main component of the signature.
        a = side("a", held.filter("label != main")).join(self._facts("a"), "a")
        b = side("b", held).join(self._facts("b"), "b")
        once = (F.col("a_label") != F.col("b_label")) & ((F.col("b_label") == F.col("b_main")) | (F.col("a") < F.col("b")))
        pairs = a.join(b.withColumnRenamed("signature", "also"), (F.col("signature") == F.col("also")) & once & self._maybe())
        pair = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), self._apart().alias("apart")]
        return self._narrow(store.stored(pairs.select(*pair).distinct(), "pairs"))

    def _narrow(self, pairs: DataFrame) -> DataFrame:
        """Those of the stored pairs that the wider bitmaps allow as well."""
        wide = self.nodes.filter("wide is not null")
        side = lambda x: wide.select(F.col("node").alias(x), F.col("n").alias(f"{x}_n"), F.col("wide").alias(f"{x}_wide"))
        both, percent = pairs.join(side("a"), "a").join(side("b"), "b"), self.percent

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                n = batch.column(2).to_numpy() + batch.column(4).to_numpy()
                far = np.zeros(len(n), np.int64)
                for i, (x, y) in enumerate(zip(batch.column(3), batch.column(5), strict=True)):
                    x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                    short = min(len(x), len(y))
                    x, y = (np.bitwise_xor.reduce(v.reshape(-1, short)) for v in (x, y))
                    far[i] = np.bitwise_count(x ^ y).sum()
                out = pa.array(far * (100 + percent) > n * (100 - percent))
                yield pa.RecordBatch.from_arrays([batch.column(i).filter(out) for i in range(2)], names=["a", "b"])

        both = both.select("a", "b", "a_n", "a_wide", "b_n", "b_wide")
        return store.stored(pairs.join(both.mapInArrow(run, "a long, b long"), ["a", "b"], "left_anti"), "pairs", store.BATCH_BYTES)

    # -- links ---------------------------------------------------------------------------------------------------

    def links(self) -> DataFrame:
        """Enough links (``a``, ``b``: nodes) to connect all components."""
        spots = self._spots()
        found = self.compare(self._leaders(spots)).filter(self._linked()).select("a", "b")
        links = store.stored(found, "links")
        pairs = self._pairs(spots, links)
        if pairs.isEmpty():
            return links
        # Of two components the nearest pair first.
        pairs = self._unconnected(pairs, links)
        best = pairs.groupBy(F.least("label_a", "label_b"), F.greatest("label_a", "label_b")).agg(F.min(F.struct("apart", "a", "b")).alias("of"))
        best = store.stored(best.select("of.a", "of.b"), "best")
        links = store.stored(links.unionByName(self.compare(best).filter(self._linked()).select("a", "b")), "links")
        rest = self._unconnected(pairs.select("a", "b").join(best, ["a", "b"], "left_anti"), links)
        if rest.isEmpty():
            return links
        rest = self.compare(rest.select("a", "b"))
        return store.stored(links.unionByName(rest.filter(self._linked()).select("a", "b")), "links")

    def _unconnected(self, pairs: DataFrame, links: DataFrame) -> DataFrame:
        """Pairs that the links do not connect yet, with the components of both nodes."""
        labels = store.stored(components(links), "labels")
        label = lambda c: labels.select(F.col("node").alias(c), F.col("component").alias(f"label_{c}"))
        out = pairs.join(label("a"), "a", "left").join(label("b"), "b", "left")
        out = out.withColumns({f"label_{c}": F.coalesce(f"label_{c}", c) for c in ("a", "b")})
        return store.stored(out.filter("label_a != label_b"), "open")

    def groups(self) -> DataFrame:
        """``doc_id``, ``text_key``, ``n_shingles``, ``component_id``, ``set_id`` and ``stays`` of every row.

        One set of each component stays, with its least id; rows with the empty set stay.
        """
        labels = store.stored(components(self.links()), "labels")
        own = self.nodes.select(F.col("node"), F.col("doc_id").alias("own")).join(labels, "node", "left")
        own = own.select("node", "own", F.coalesce("component", "node").alias("component"))
        least = own.groupBy("component").agg(F.min(F.struct(F.isnull("own").alias("none"), "own", "node")).alias("of"))
        named = own.join(least, "component").select("node", F.col("of.own").alias("component_id"), F.col("of.node").alias("kept"))
        out = self.described.select("doc_id", "text_key", "n", "node").join(named, "node", "left")
        stays = F.col("node").isNull() | ((F.col("node") == F.col("kept")) & F.col("doc_id").eqNullSafe(F.col("component_id")))
        return out.select(
            "doc_id",
            "text_key",
            F.col("n").alias("n_shingles"),
            F.coalesce("component_id", "doc_id").alias("component_id"),
            F.col("node").alias("set_id"),
            stays.alias("stays"),
        )


def keep_one(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one document of each component, with all their columns."""
    names = docs.columns
    groups = Join(docs, shingle, percent, id_col=id_col, text_col=text_col).groups().filter("stays")
    keep = store.stored(groups.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).distinct(), "keep")
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    key, text = f"c{names.index(id_col)}", f"c{names.index(text_col)}"
    same = F.col(key).eqNullSafe(F.col("__id")) & (F.xxhash64(text) == F.col("__key"))
    hit = rows.join(store.small(keep, 32), same, "left_semi")
    return hit.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])
