"""Intermediate tables in the shared folder of the session, and joins with a side of checked size."""

from __future__ import annotations

import gc
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom.functions.recovery import shared_folder

# A side with more bytes than this is never broadcast.
BROADCAST_BYTES = 32 << 20
# Bytes of rows that go to a Python task at a time; without a limit a batch has 10,000 rows, however long.
BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def new_path(spark: SparkSession, name: str) -> str:
    """A path of its own for each call in the folder that driver and executors share."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def _short_batches(spark: SparkSession, most: int | None) -> Iterator[None]:
    """Limit batches to ``most`` bytes for the jobs inside, unless the session has a limit of its own."""
    if most is None or spark.conf.get(_BATCH, None) is not None:
        yield
        return
    spark.conf.set(_BATCH, str(most))
    try:
        yield
    finally:
        spark.conf.unset(_BATCH)


def stored(df: DataFrame, name: str, batch_bytes: int | None = None) -> DataFrame:
    """Write ``df`` once as Parquet and read it back.  ``batch_bytes`` limits the batches that its Python steps get.

    Later steps start from these files when executors are lost, and nothing is computed twice.  The shuffle files of
    the steps before are no longer referred to then, so the collection lets Spark's cleaner delete them.
    """
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    schema = df.schema
    with _short_batches(spark, batch_bytes):
        df.write.parquet(path)
    del df
    free_shuffles(spark)
    return spark.read.schema(schema).parquet(path)


def release(*tables: DataFrame) -> None:
    """Delete stored tables that no later step reads."""
    for table in tables:
        for folder in {f.rpartition("/")[0] for f in table.inputFiles()}:
            path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


_freed = 0.0


def free_shuffles(spark: SparkSession, now: bool = False) -> None:
    """At most every few seconds unless ``now``, as a collection takes a while itself."""
    global _freed
    if now or time.monotonic() - _freed > 3:
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        _freed = time.monotonic()


def small(df: DataFrame, row_bytes: int) -> DataFrame:
    """Mark a stored table for broadcast if its counted rows fit; otherwise joins shuffle both sides."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def bounded(df: DataFrame) -> DataFrame:
    """Mark a stored table for broadcast if its measured bytes fit; otherwise joins shuffle both sides."""
    size = F.lit(8 * len(df.columns)).cast("long")
    for name, kind in df.dtypes:
        if kind in ("string", "binary"):
            size = size + F.coalesce(F.octet_length(F.col(name)), F.lit(0))
    total = df.agg(F.sum(size)).first()[0] or 0
    return F.broadcast(df) if total <= BROADCAST_BYTES else df


def same(left: DataFrame, right: DataFrame, column: str):
    """Join condition on a column that may be null."""
    return left[column].eqNullSafe(right[column])
