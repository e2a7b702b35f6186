"""Incremental ingest of measurement documents with Structured Streaming.

Re-runs pick up where the last one stopped: the checkpoint remembers which
files were read, and ``availableNow`` stops once the source is exhausted.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterloom.sources import ingest


def document_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int) -> DataFrame:
    """JSON documents in bounded batches."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(path)


INDEX = "id binary, month date, batch int"


def _not_loaded(rows: DataFrame, index_path: str, identity: Sequence[str], time: str, number: int) -> DataFrame:
    """Documents of a batch that no earlier batch has loaded, each once, with their ``id`` and ``month``.

    The index of loaded ids lies in folders by the month of the document, so a batch reads the months it has documents of,
    however late these come; nothing has to be kept in the state of the stream, and no document is too late.
    """
    parts = [F.to_json(F.struct(c)) for c in identity]
    keyed = rows.withColumns({"id": F.unhex(F.sha2(F.concat_ws("\n", *parts), 256)), "month": F.trunc(time, "month")})
    once = keyed.dropDuplicates(["month", "id"])
    spark = rows.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(index_path)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return once
    months = [r.month for r in once.select("month").distinct().collect()]  # bounded by the calendar
    wanted = F.col("month").isin([m for m in months if m is not None]) | F.col("month").isNull()
    # A batch that is run again does not find itself.
    loaded = spark.read.schema(INDEX).parquet(index_path).filter(wanted & (F.col("batch") < number)).drop("batch")
    return once.join(loaded, (once["id"] == loaded["id"]) & once["month"].eqNullSafe(loaded["month"]), "left_anti")


def load_stream(
    stream: DataFrame,
    metadata: DataFrame,
    shape: Callable[[DataFrame], DataFrame],
    good_path: str,
    error_path: str,
    checkpoint: str,
    detected_at: str,
    index_path: str,
    identity: Sequence[str],
    time: str,
) -> None:
    """Look up readings, write good rows and dead letters, each document once.

    Documents are the same if they agree in the columns ``identity``.  Each batch replaces its own partition of every output
    and of the index, so a repeated batch leaves no duplicates.
    """

    def write_batch(batch: DataFrame, number: int) -> None:
        # All writes read the batch; without persisting, the index would be read for each.
        found = ingest.with_reading(_not_loaded(batch, index_path, identity, time, number), metadata).persist()
        good, bad = ingest.split_errors(found.drop("id", "month"), detected_at)
        outputs = [(shape(good), good_path, []), (bad, error_path, []), (found.select("id", "month"), index_path, ["month"])]
        for part, path, folders in outputs:
            # One file a folder, unless a folder has much.
            part = part.hint("rebalance", *folders) if folders else part
            (
                part.withColumn("batch", F.lit(number))
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("batch", *folders)
                .parquet(path)
            )
        found.unpersist()

    query = (
        stream.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
