"""Exact duplicates without regard to white space, found in three combining steps that stand skewed groups.

Copies are combined inside each task, then by (digest, salt), then by digest.  Every step groups by the whole normalised
text as well, so texts that only share a digest stay apart.  A group never gathers in one task: the first step leaves one
row per task, the second one row per salt.

Defined results: null text counts as empty, so nulls and empty texts are copies of each other; of equal texts the one with
the most code points, then the smallest id stays, null ids last; rows that repeat an id with an equal text get the same
result, and ``drop_copies`` leaves one of them; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.llm import store

WHITE = r"[\x20\x09-\x0D]+"
SALTS = 64


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.char_length(text).alias("length"), F.regexp_replace(text, WHITE, "").alias("body")
    )
    return rows.withColumn("digest", F.unhex(F.sha2(F.encode("body", "UTF-8"), 256)))


def _combine(rows: DataFrame, *keys: str) -> DataFrame:
    """Best row and number of rows of each key; ``best`` orders by length, then by descending id, nulls last."""
    return rows.groupBy(*keys).agg(F.max("best").alias("best"), F.sum("n").alias("n"))


def winners(rows: DataFrame, salts: int = SALTS) -> DataFrame:
    """``digest``, ``body``, ``keep_id`` and ``group_size`` of each distinct text."""
    salted = rows.select(
        "digest",
        "body",
        F.pmod(F.xxhash64("doc_id", "length"), F.lit(salts)).alias("salt"),
        # Complements of ids: the greatest is that of the smallest id; a null sorts below all.
        F.struct("length", F.bitwise_not("doc_id").alias("neg")).alias("best"),
        F.lit(1).cast("bigint").alias("n"),
    )
    merged = _combine(salted, "digest", "salt", "body")
    final = _combine(merged, "digest", "body")
    return final.select("digest", "body", F.bitwise_not("best.neg").alias("keep_id"), F.col("n").alias("group_size"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """One row per document: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``."""
    rows = digests(docs, id_col, text_col)
    best = winners(rows, salts)
    # Texts with the same digest, should there ever be some, are told apart by content once more.
    table = store.stored(
        best.groupBy("digest").agg(
            F.count("*").alias("texts"), F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size")
        ),
        "exact",
    )
    members = rows.select("doc_id", "digest").join(table, "digest")
    plain = members.filter("texts = 1").select("doc_id", "keep_id", "group_size", "digest")
    shared = table.filter("texts > 1").select("digest")
    if not shared.isEmpty():
        clash = rows.join(shared, "digest").alias("r")
        by_text = best.join(shared, "digest").alias("b")
        plain = plain.unionByName(
            clash.join(by_text, (F.col("r.digest") == F.col("b.digest")) & (F.col("r.body") == F.col("b.body"))).select(
                "r.doc_id", "b.keep_id", "b.group_size", "r.digest"
            )
        )
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    sha = F.lower(F.hex("digest"))
    return plain.select("doc_id", "keep_id", "group_size", kept.alias("kept"), sha.alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; of repeated rows with one id, one."""
    names = docs.columns
    text = F.coalesce(F.col(text_col), F.lit(""))
    body = F.sha2(F.encode(F.regexp_replace(text, WHITE, ""), "UTF-8"), 256)
    groups = exact_groups(docs, id_col, text_col, salts).filter("kept")
    keep = groups.select(F.col("keep_id").alias("__id"), F.col("text_sha256").alias("__sha")).distinct()
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)], body.alias("__body"))
    key, text_at = f"c{names.index(id_col)}", f"c{names.index(text_col)}"
    hit = rows.join(keep, (F.col("__body") == F.col("__sha")) & F.col(key).eqNullSafe(F.col("__id")), "left_semi")
    # Equal ids in one group: the longest stays, then any one of the equal texts.
    order = F.struct(F.char_length(F.coalesce(F.col(text_at), F.lit(""))), F.col(text_at))
    one = hit.groupBy(key, "__body").agg(F.max_by(F.struct(*[f"c{i}" for i in range(len(names))]), order).alias("row"))
    return one.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(names)])
