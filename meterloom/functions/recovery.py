"""Cutting lineage so that lost executors do not undo what is done, and nothing is computed twice."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session.

    A cluster names shared storage in ``spark.checkpoint.dir``.  Only a local
    session without that setting, as in tests, gets a temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current is None:
        current = spark.conf.get("spark.checkpoint.dir", None)
        if current is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a shared folder")
            current = tempfile.mkdtemp(prefix="meterloom-")
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write a table once as Parquet to the shared folder and go on from its files.

    Unlike a checkpoint of rows this runs the plan once, later steps read only
    the columns that they need, and joins know the size of the table.
    """
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)
