"""From raw documents to token ids: quality, copies, near copies, source mix, encoding."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom.llm import exactdedup, mixing, piecebpe, queries, ruleensemble, shinglejoin, store
from meterloom.llm.registry import table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble does not reject."""
    labels = table(spark, sf_dir, "labels").filter(~queries.held_out(5, 0))
    return ruleensemble.keep_good(docs, ruleensemble.train(docs, labels))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exactdedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words, similarity 0.8 or more."""
    return shinglejoin.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed stream: a row for each part of a document in a drawn block, with the columns of the document."""
    mixed = mixing.Mix(docs).texts()
    values = {"doc_id": F.col("doc_id"), "source": F.col("source"), "text": F.col("text"), "n_chars": F.char_length("text").cast("bigint")}
    return mixed.select(*[values.get(c, F.col(f"rest.`{c}`")).alias(c) for c in docs.columns])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``ids`` with an end id, and their number."""
    ids = piecebpe.encode(docs, public_tokenizers.path(queries.PIECE_VOCABULARY))
    return ids.select("doc_id", "ids", F.size("ids").cast("bigint").alias("n_tokens"))


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("mix", mix), ("encode", encode)]

# Fitted models, draws and encodings have no SQL; tests/llm holds the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, done = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = store.new_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if done is not None:
            store.release(done)  # no later stage reads what came before this one
        done = docs
    return STAGES[-1][1](spark, docs, sf_dir)
