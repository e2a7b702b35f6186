"""Mix sources to target weights by drawing fixed-length token blocks.

The documents of a source, in a pseudorandom order, form one stream of words that is cut into blocks of ``block`` words.
Output shards have a fixed number of slots; each draws how many slots a source fills from a multinomial.  The n-th slot of
a source over all shards takes block ``p(n mod blocks)``, with another pseudorandom permutation ``p`` for each pass over
the source.  Slots and blocks then meet in an equi-join by (source, block).

To keep each source near its target, a shard gives every source the whole part of its expected slots and draws only the
rest from the multinomial of the fractions.  No pass beyond ``MAX_PASSES`` is made, so no document is taken more often.

Defined results: null and empty texts have size 0 and give nothing; a null source is a source of its own, ordered last;
rows that repeat an id and source count as documents of their own and share one result row summed over them; if no text has a word,
all targets are 0; an empty table gives an empty result.  Results depend on the rows and the seed, not on partitions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterloom.llm import store

SPACE = r"[\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MAX_PASSES = 3
BLOCK = 128
SLOTS = 4096
SEED = 17
# Rounds of the swap-or-not permutation.
ROUNDS = 24
# Documents summed in one window task.
BUCKET = 2000


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``doc_id``, ``source``, ``size`` (words), a text digest, the text and the other columns as ``rest``."""
    others = [F.col(f"`{c}`").alias(c) for c in docs.columns if c not in (id_col, text_col, source_col)]
    text = F.coalesce(F.col(text_col), F.lit(""))
    blank = lambda c: c.rlike(r"^[\x20\x09-\x0D]").cast("int")
    edges = blank(F.left(text, F.lit(1))) + blank(F.right(text, F.lit(1)))
    parts = F.size(F.split(text, SPACE))
    # A text of white space alone splits into two empty parts, with white space at both ends.
    size = F.when(F.length(text) == 0, 0).otherwise(F.greatest(parts - edges, F.lit(0)))
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        size.cast("bigint").alias("size"),
        F.xxhash64(text).alias("text_key"),
        text.alias("text"),
        F.struct(*others or [F.lit(0).alias("none")]).alias("rest"),
    )


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MAX_PASSES) -> DataFrame:
    """Per source: ``source_no``, ``source_size``, ``n_docs`` and ``target`` words.

    With level x, a source gets min(most * size, weight * x), and the level at which these add up to all words is what
    resharing the excess until none is above ends with.  Sources reach their limit in the order of limit / weight.
    The windows run over one row per source.
    """
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("source_no") % len(weights) + 1).cast("int"))
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("source_no", F.row_number().over(order) - 1).withColumn("weight", weight)
    per = per.withColumn("cap", F.col("source_size") * most)
    filling = Window.orderBy(F.col("cap") / F.col("weight"), "source_no")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    per = per.withColumns(
        {
            "total": F.sum("source_size").over(everything),
            "level": (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
            / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))),
        }
    )
    # The first source, in filling order, that the level does not fill fixes it.
    open_ = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), "source_no", "level"))
    level = F.coalesce(F.min(open_).over(everything)["level"], F.lit(0.0))
    target = F.least(F.col("cap").cast("double"), F.col("weight") * level)
    return per.select("source", F.col("source_no").cast("bigint").alias("source_no"), "source_size", "n_docs", target.alias("target"))


def streams(sizes: DataFrame, sources: DataFrame) -> DataFrame:
    """``source_no`` and ``begin`` (position in its source's stream) of every document.

    The running total is taken inside buckets of about ``BUCKET`` documents and over the sums of the buckets.
    """
    s = sources.select(F.col("source").alias("of"), "source_no", "n_docs")
    # Every source is ranked in sources; the join is by source, which adaptive execution splits if hot.
    rows = sizes.join(store.small(s, 64), F.col("source").eqNullSafe(F.col("of")))
    place = F.xxhash64("doc_id", "text_key", F.lit(SEED))
    rows = rows.withColumn("place", place).withColumn(
        "bucket", F.pmod(F.xxhash64("place"), F.greatest(F.lit(1), F.ceil(F.col("n_docs") / BUCKET)))
    )
    own = Window.partitionBy("source_no", "bucket").orderBy("place", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("source_no", "bucket").agg(F.sum("size").alias("sum"))
    over = Window.partitionBy("source_no").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("source_no", "bucket", F.coalesce(F.sum("sum").over(over), F.lit(0)).alias("base"))
    inside = rows.withColumn("inside", F.coalesce(F.sum("size").over(own), F.lit(0)))
    return inside.join(sums, ["source_no", "bucket"]).withColumn("begin", F.col("base") + F.col("inside"))


def permuted(index: Column, n: Column, *key: Column) -> Column:
    """Pseudorandom permutation of 0..n-1, another one for each key: rounds of swap-or-not."""
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(ROUNDS)),
        index.cast("bigint"),
        lambda x, r: _round(x, r, n, *key),
    )


def _round(x: Column, r: Column, n: Column, *key: Column) -> Column:
    partner = F.pmod(F.pmod(F.xxhash64(r, *key), n) - x, n)
    return F.when(F.xxhash64(F.greatest(x, partner), r, *key) % 2 == 0, partner).otherwise(x)


def slots(sources: DataFrame, block: int = BLOCK, shard_slots: int = SLOTS, seed: int = SEED, most: int = MAX_PASSES) -> DataFrame:
    """``shard``, ``slot``, ``source_no``, ``block_no`` and ``pass_no`` of every block that the mix takes."""
    n_blocks = F.ceil(F.col("source_size") / block)
    quota = F.when(F.col("source_size") > 0, F.col("target") * n_blocks / F.col("source_size")).otherwise(0.0)
    s = sources.select("source_no", n_blocks.alias("n_blocks"), quota.alias("quota"))
    total = F.sum("quota").over(Window.partitionBy(F.lit(0)))
    s = s.withColumn("shards", F.greatest(F.lit(1), F.ceil(total / shard_slots))).filter("n_blocks > 0")
    each = s.select(
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("shards") - 1)).alias("shard"),
        "source_no",
        "n_blocks",
        (F.col("quota") / F.col("shards")).alias("mean"),
    )
    counts = each.groupBy("shard").applyInArrow(
        lambda key, rows: _draw(rows, seed), "shard bigint, source_no bigint, n_blocks bigint, taken bigint"
    )
    before = Window.partitionBy("source_no").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    runs = counts.withColumn("first", F.coalesce(F.sum("taken").over(before), F.lit(0))).filter("taken > 0")
    # A row here becomes as many as the source has slots in the shard.
    tasks = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    taken = runs.repartition(tasks, "shard", "source_no").select(
        "shard", "source_no", "n_blocks", F.explode(F.sequence("first", F.col("first") + F.col("taken") - 1)).alias("nth")
    ).withColumn("pass_no", F.floor(F.col("nth") / F.col("n_blocks")))
    taken = taken.filter(F.col("pass_no") < most)
    at = permuted(F.col("nth") % F.col("n_blocks"), F.col("n_blocks"), F.lit(seed), F.col("source_no"), F.col("pass_no"))
    return taken.select("shard", F.xxhash64("shard", "source_no", "nth").alias("slot"), "source_no", at.alias("block_no"), "pass_no")


def _draw(rows: pa.Table, seed: int) -> pa.Table:
    """Slots of each source in one shard: whole expected slots, and a multinomial draw of the rest."""
    rows = rows.sort_by("source_no")
    mean = rows["mean"].to_numpy()
    whole = np.floor(mean + 1e-9)
    part = np.maximum(mean - whole, 0.0)
    taken = whole.astype(np.int64)
    rest = part.sum()
    shard = rows["shard"][0].as_py()
    rng = np.random.default_rng([seed, shard])
    n = int(np.floor(rest + rng.random()))
    if n and rest > 0:
        taken = taken + rng.multinomial(n, part / rest)
    return pa.table([rows["shard"], rows["source_no"], rows["n_blocks"], pa.array(taken)], names=["shard", "source_no", "n_blocks", "taken"])


def pieces(stream: DataFrame, block: int = BLOCK) -> DataFrame:
    """The parts of documents in each block: ``source_no``, ``block_no``, ``doc_id``, ``piece``, ``from_word``, ``words``."""
    first, last = F.floor(F.col("begin") / block), F.floor((F.col("begin") + F.col("size") - 1) / block)
    rows = stream.filter("size > 0").select(
        "source_no", "doc_id", "text_key", "begin", "size", F.explode(F.sequence(first, last)).alias("block_no")
    )
    start = F.greatest(F.col("begin"), F.col("block_no") * block) - F.col("begin")
    stop = F.least(F.col("begin") + F.col("size"), (F.col("block_no") + 1) * block) - F.col("begin")
    return rows.select(
        "source_no", "block_no", "doc_id", "text_key", "begin", start.alias("from_word"), (stop - start).alias("words")
    )


class Mix:
    """A mix of one table: its parts are stored tables."""

    def __init__(
        self,
        docs: DataFrame,
        id_col: str = "doc_id",
        text_col: str = "text",
        source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS,
        block: int = BLOCK,
        shard_slots: int = SLOTS,
        seed: int = SEED,
        most: int = MAX_PASSES,
    ):
        self.block, self.rows = block, sized(docs, id_col, text_col, source_col)
        self.sizes = store.stored(self.rows.drop("text", "rest"), "sizes")
        self.sources = store.stored(targets(self.sizes, weights, most), "targets")
        self.stream = store.stored(streams(self.sizes, self.sources), "stream")
        self.slots = store.stored(slots(self.sources, block, shard_slots, seed, most), "slots")

    def taken(self) -> DataFrame:
        """``doc_id``, ``size``, ``source_size``, ``target``, ``taken`` of every document."""
        draws = self.slots.groupBy("source_no", "block_no").agg(F.count("*").alias("draws"))
        parts = pieces(self.stream, self.block).join(draws, ["source_no", "block_no"])
        got = parts.groupBy("doc_id", "source_no").agg(F.sum(F.col("words") * F.col("draws")).alias("taken"))
        got = got.select(F.col("doc_id").alias("id"), F.col("source_no").alias("no"), "taken")
        sources = store.small(self.sources.select(F.col("source").alias("of"), "source_no", "source_size", "target"), 64)
        rows = self.sizes.groupBy("doc_id", "source").agg(F.sum("size").alias("size"))
        rows = rows.join(sources, F.col("source").eqNullSafe(F.col("of")))
        return rows.join(got, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("source_no") == F.col("no")), "left").select(
            "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken")
        )

    def texts(self) -> DataFrame:
        """The mixed output: ``shard``, ``slot``, ``piece`` (place in the block), ``doc_id``, ``source``, ``text``.

        ``rest`` holds the other columns of the document.  Ordered by (shard, slot, piece), the words of all rows are the
        output stream.
        """
        drawn = self.slots.join(pieces(self.stream, self.block), ["source_no", "block_no"])
        plan = drawn.groupBy("doc_id", "text_key", "begin").agg(
            F.collect_list(F.struct("shard", "slot", "source_no", "begin", "from_word", "words")).alias("cuts")
        )
        plan = store.stored(plan, "cuts")
        plan = plan.select(F.col("doc_id").alias("id"), F.col("text_key").alias("key"), "cuts")
        joined = self.rows.dropDuplicates(["doc_id", "text_key"]).join(
            plan, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_key") == F.col("key"))
        )
        schema = joined.select("doc_id", "source", "rest").schema
        for name, kind in (("shard", "long"), ("slot", "long"), ("piece", "long"), ("text", "string")):
            schema = schema.add(name, kind)
        return joined.select("doc_id", "source", "rest", "text", "cuts").mapInArrow(_cut, schema)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            part = batch.slice(at, 64)
            row, out = [], {"shard": [], "slot": [], "piece": [], "text": []}
            for i, (text, cuts) in enumerate(zip(part["text"].to_pylist(), part["cuts"].to_pylist(), strict=True)):
                words = text.encode().split()
                for c in cuts:
                    row.append(i)
                    out["shard"].append(c["shard"])
                    out["slot"].append(c["slot"])
                    out["piece"].append(c["begin"] + c["from_word"])
                    out["text"].append(b" ".join(words[c["from_word"] : c["from_word"] + c["words"]]).decode())
            pick = pa.array(row, pa.int64())
            numbers = [pa.array(out[k], pa.int64()) for k in ("shard", "slot", "piece")]
            kept = [part[c].take(pick) for c in ("doc_id", "source", "rest")]
            columns = [*kept, *numbers, pa.array(out["text"], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "source", "rest", "shard", "slot", "piece", "text"])
