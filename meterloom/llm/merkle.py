"""A manifest of a dataset as hash trees: one tree a language, one over their roots, and a proof for each row.

Every parent of a tree keeps, before each of its child slots, a copy of its hash's state after the children to the left.
Putting another node into a slot resumes that state with the replacement and the siblings to the right alone; nothing to the
left is hashed again.

Trees are worked on in chunks of consecutive nodes.  Going up, a chunk becomes one node, round after round, until one node is
left; going down, each chunk is built once more with the states of its parents, gets the path above it, which is the same for
all its nodes, and hands out whole paths.  A chunk has at most ``CHUNK`` nodes, so neither the number of rows nor that of
languages bounds what a task holds.  Numbers of rows come from a sort in ranges and the sizes of the ranges.

Leaf: hash of id, source, lang, n_chars and text, each ``-`` if null, else its UTF-8 length, ``:`` and the value.  Node: hash of
the hexadecimal digests of its children.  All hashes are SHA-256 in lower-case hexadecimal text.

Defined results: null ids stand first in their tree; rows that repeat an id are ordered by their leaf, equal rows have equal
leaves and any order of them gives the same tree; a null language is a tree of its own, before all others; a lone leaf is the
root of its tree; a proof without siblings is the hash of nothing; empty and very long texts are values like others; an empty
table gives an empty result; other columns are not read.  Ids are integers.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterloom.llm import store

ARITY = 2
CHUNK_LEVELS = 10
PATH = "tree string, chunk long, tops array<string>, left array<string>, right array<string>"
PROOFS = (
    "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, "
    "lang string, left array<string>, right array<string>"
)


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def leaf(columns: list[Column]) -> Column:
    """Hash of the columns with their lengths; null is ``-``."""
    parts = []
    for c in columns:
        text = c.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


class Tree:
    """Parents over consecutive nodes of a chunk, with the states before their child slots."""

    def __init__(self, nodes: list[bytes], levels: int, arity: int = ARITY):
        self.arity, self.levels, self.states = arity, [nodes], []
        for _ in range(levels):
            below, nodes, states = nodes, [], []
            for at in range(0, len(below), arity):
                state, before = hashlib.sha256(), []
                for child in below[at : at + arity]:
                    before.append(state.copy())
                    state.update(child)
                states.append(before)
                nodes.append(state.hexdigest().encode())
            self.levels.append(nodes)
            self.states.append(states)

    @property
    def top(self) -> bytes:
        return self.levels[-1][0]

    def fold(self, i: int, node: bytes) -> bytes:
        """The top with ``node`` at place ``i``: states before the slots, the node, and what stands to the right."""
        for below, states in zip(self.levels, self.states, strict=False):
            at = i // self.arity
            state = states[at][i - at * self.arity].copy()
            state.update(node)
            for right in below[i + 1 : (at + 1) * self.arity]:
                state.update(right)
            node, i = state.hexdigest().encode(), at
        return node

    def path(self, i: int) -> tuple[list[bytes], list[bytes]]:
        """Siblings to the left and to the right of place ``i`` and of the places above it, level by level."""
        left, right = [], []
        for below in self.levels[:-1]:
            at = i - i % self.arity
            left.append(b"".join(below[at:i]))
            right.append(b"".join(below[i + 1 : at + self.arity]))
            i //= self.arity
        return left, right


class Climb:
    """The path above a chunk; the state before each slot is made once and copied for each node that is folded."""

    def __init__(self, left: list[str], right: list[str]):
        self.siblings = "".join(a + b for a, b in zip(left, right, strict=True)).encode()
        self.steps = [(hashlib.sha256(a.encode()), b.encode()) for a, b in zip(left, right, strict=True)]

    def fold(self, node: bytes) -> bytes:
        for before, right in self.steps:
            state = before.copy()
            state.update(node)
            state.update(right)
            node = state.hexdigest().encode()
        return node


def levels_above(n: int, arity: int) -> int:
    """Levels above ``n`` nodes."""
    levels, size = 0, 1
    while size < n:
        levels, size = levels + 1, size * arity
    return levels


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Add the place ``i`` of each row within its ``tree`` and the size ``n`` of that tree.

    Rows are sorted in ranges.  The row number in the range tells equal rows apart, so that these don't share one range.
    """
    tied = store.stored(rows, "rows").withColumn("tie", F.monotonically_increasing_id())
    keys = ["tree", *order, "tie"]
    ranges = tied.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("tie")
    sorted_ = store.stored(ranges.withColumns({"range": F.spark_partition_id(), "at": F.monotonically_increasing_id()}), "sorted")
    sizes = sorted_.groupBy("tree", "range").agg(F.count("*").alias("size"), F.min("at").alias("first"))
    tree = Window.partitionBy("tree")  # a row for each range
    before = F.sum("size").over(tree.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("tree", "range", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"), F.sum("size").over(tree).alias("n"))
    starts = store.bounded(store.stored(starts, "starts"))
    out = sorted_.join(starts, ["tree", "range"]).withColumn("i", F.col("at") + F.col("shift"))
    return out.drop("range", "at", "shift")


def _paths(rows: list[dict]) -> pa.Table:
    texts = pa.list_(pa.string())
    kinds = {"tree": pa.string(), "chunk": pa.int64(), "tops": texts, "left": texts, "right": texts}
    return pa.Table.from_pylist(rows, pa.schema(kinds))


class Chunks(NamedTuple):
    """Runs of ``arity ** levels`` consecutive nodes."""

    arity: int = ARITY
    levels: int = CHUNK_LEVELS

    def of(self, nodes: DataFrame):
        return nodes.withColumn("chunk", F.floor(F.col("i") / self.arity**self.levels)).groupBy("tree", "chunk")

    def build(self, table: pa.Table) -> tuple[pa.Table, Tree]:
        """The rows of a chunk in their order and their tree, which ends where one node is left of the whole tree."""
        table = table.sort_by("i")
        levels = min(self.levels, levels_above(table["n"][0].as_py(), self.arity))
        return table, Tree([x.encode() for x in table["node"].to_pylist()], levels, self.arity)

    def up(self, key: tuple, table: pa.Table) -> pa.Table:
        """One node for a chunk."""
        table, tree = self.build(table)
        n = -(-table["n"][0].as_py() // self.arity**self.levels)
        return pa.table({"tree": pa.array([key[0].as_py()], pa.string()), "i": [key[1].as_py()], "n": [n], "node": [tree.top.decode()]})

    def down(self, key: tuple, table: pa.Table, path: pa.Table) -> pa.Table:
        """Whole paths of the nodes of a chunk, which are chunks of the round below or, where they have names, trees."""
        table, tree = self.build(table)
        (above,) = path.to_pylist()
        rows = []
        names = table["of"].to_pylist() if "of" in table.column_names else None
        for at, i in enumerate(table["i"].to_pylist()):
            left, right = ([x.decode() for x in side] for side in tree.path(at))
            place = {"tree": names[at], "chunk": 0} if names else {"tree": key[0].as_py(), "chunk": i}
            rows.append(place | {"tops": above["tops"], "left": left + above["left"], "right": right + above["right"]})
        return _paths(rows)

    def proofs(self, table: pa.Table, path: pa.Table, with_paths: bool) -> pa.Table:
        """Proofs and folded roots of the rows of a chunk."""
        table, tree = self.build(table)
        (above,) = path.to_pylist()
        climb = Climb(above["left"], above["right"])
        subroot, root = above["tops"][0], above["tops"][-1]
        lang = above["tree"][1:] if above["tree"] else None
        rows = []
        for at, (doc_id, node, other) in enumerate(zip(*(table[c].to_pylist() for c in ("doc_id", "node", "other")), strict=True)):
            left, right = tree.path(at)
            siblings = hashlib.sha256(b"".join(a + b for a, b in zip(left, right, strict=True)))
            siblings.update(climb.siblings)
            folded = climb.fold(tree.fold(at, (node if other is None else other).encode())).decode()
            steps = [[x.decode() for x in side] + up if with_paths else None for side, up in ((left, above["left"]), (right, above["right"]))]
            rows.append((doc_id, node, subroot, root, siblings.hexdigest(), folded, folded == root, lang, *steps))
        texts = pa.list_(pa.string())
        kinds = [pa.int64(), *[pa.string()] * 5, pa.bool_(), pa.string(), texts, texts]
        columns = zip(*rows, strict=True)
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=_names(PROOFS))


class Forest:
    """Trees over a stored table of ``tree``, ``i``, ``n`` and ``node``; ``rounds`` are the nodes that chunks become."""

    def __init__(self, nodes: DataFrame, chunks: Chunks):
        self.chunks, self.rounds = chunks, [nodes]
        size = nodes.agg(F.max("n")).first()[0] or 0
        for _ in range(max(1, -(-levels_above(size, chunks.arity) // chunks.levels))):
            below = self.rounds[-1].select("tree", "i", "n", "node")
            up = chunks.of(below).applyInArrow(lambda key, table: chunks.up(key, table), "tree string, i long, n long, node string")
            self.rounds.append(store.stored(up, "nodes"))
        self.roots = self.rounds[-1].select("tree", "node")

    def paths(self, above: DataFrame, named: bool = False) -> DataFrame:
        """Paths of the chunks of the first round, or of the trees that its nodes name.

        ``above`` has the paths of whole trees, with ``chunk`` 0; ``tops`` are the roots on the way, the nearest first.
        """
        chunks, roots = self.chunks, self.roots.withColumnRenamed("node", "root")
        paths = above.join(roots, "tree").withColumn("tops", F.concat(F.array("root"), "tops")).select(*_names(PATH))
        for nodes in reversed(self.rounds[0 if named else 1 : -1]):
            pair = chunks.of(nodes).cogroup(paths.groupBy("tree", "chunk"))
            paths = store.stored(pair.applyInArrow(lambda key, table, path: chunks.down(key, table, path), PATH), "paths")
        return paths


def manifest(docs: DataFrame, replaced: Column | None = None, chunks: Chunks = Chunks(), paths: bool = True) -> DataFrame:
    """Each row's leaf, roots, proof and what folding its replacement gives.

    ``replaced`` is the leaf to fold in place of a row's own, null for the row's own.  With ``paths`` the siblings to the left
    and to the right are given level by level, enough to check or replace a row without the others.
    """
    # A prefix keeps the null language apart from the empty one, and before it.
    tree = F.coalesce(F.concat(F.lit("+"), F.col("lang")), F.lit(""))
    own = leaf([F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")])
    other = F.lit(None).cast("string") if replaced is None else replaced
    rows = docs.select(tree.alias("tree"), F.col("doc_id").cast("long").alias("doc_id"), own.alias("node"), other.alias("other"))
    leaves = store.stored(numbered(rows, ["doc_id", "node"]), "leaves")
    forest = Forest(leaves, chunks)
    subroots = numbered(forest.roots.select(F.lit("").alias("tree"), F.col("tree").alias("of"), "node"), ["of"])
    crown = Forest(store.stored(subroots, "subroots"), chunks)
    none = F.array().cast("array<string>")
    top = crown.roots.select("tree", F.lit(0).cast("long").alias("chunk"), none.alias("tops"), none.alias("left"), none.alias("right"))
    above = forest.paths(crown.paths(top, named=True))
    pair = chunks.of(leaves).cogroup(above.groupBy("tree", "chunk"))
    out = pair.applyInArrow(lambda table, path: chunks.proofs(table, path, paths), PROOFS)
    return out if paths else out.drop("left", "right")
