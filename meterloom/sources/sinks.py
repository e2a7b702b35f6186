"""Writers: text exchange, replace by key, archive, overwrite."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterloom.functions.recovery import shared_folder

TSV = {"sep": "\t", "header": "false", "emptyValue": "", "timestampFormat": "yyyy-MM-dd HH:mm:ss"}


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the session's shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def write_tsv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**TSV).csv(path)


def read_tsv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).options(**TSV).csv(path)


def write_table(df: DataFrame, path: str, partitions: Sequence[str] = (), cluster_by: Sequence[str] = ()) -> None:
    """Full overwrite of a columnar table.

    The rebalance hint clusters rows by the partition columns and lets adaptive
    execution split a partition that holds most of the rows over several tasks.
    """
    keys = [*partitions, *cluster_by]
    out = df.hint("rebalance", *keys) if keys else df
    out.write.mode("overwrite").partitionBy(*partitions).parquet(path)


def read_existing(spark: SparkSession, path: str, schema: T.StructType, **wanted: Sequence[str]) -> DataFrame:
    """Read a partitioned table restricted to the listed partition values; absent ones are skipped."""
    df = spark.read.schema(schema).parquet(path)
    for name, values in wanted.items():
        df = df.filter(F.col(name).isin(list(values)))
    return df


def replace_by_key(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop the keys that ``new`` brings and add its rows."""
    fresh = new.select(*keys).distinct()
    return existing.join(fresh, list(keys), "left_anti").unionByName(new)


# --- tables of versions --------------------------------------------------------------------------
#
# data/version=<v>/<partition>/...   files, never changed once written
# manifests/<v>                      which version holds each partition
# current                            the name of the manifest that counts
#
# A change writes new files and a new manifest, which nobody reads yet, and then renames one file over ``current``.  A reader
# therefore sees the table before or after a change, wherever the writer stops.  One writer at a time.


def _file(spark: SparkSession, path: str):
    name = spark._jvm.org.apache.hadoop.fs.Path(path)
    return name, name.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    name, fs = _file(spark, path)
    return fs.exists(name)


def _current(spark: SparkSession, path: str) -> str:
    return spark.read.text(f"{path}/current").first()[0]


def _switch(spark: SparkSession, path: str, version: str) -> None:
    """Make a version the one that counts, in one rename."""
    jvm = spark._jvm
    new, fs = _file(spark, f"{path}/current-{version}")
    out = fs.create(new, True)
    out.write(bytearray(version, "utf-8"))
    out.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(new.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(new, jvm.org.apache.hadoop.fs.Path(f"{path}/current"), options)


def _write_version(df: DataFrame, path: str, partitions: Sequence[str]) -> tuple[str, DataFrame]:
    """New files and the partitions that they hold."""
    version = uuid.uuid4().hex
    write_table(df, f"{path}/data/version={version}", partitions)
    written = df.sparkSession.read.schema(df.schema).parquet(f"{path}/data/version={version}")
    return version, written.select(*partitions).distinct().withColumn("version", F.lit(version))


def create_table(df: DataFrame, path: str, partitions: Sequence[str]) -> None:
    """Start a table of versions, or replace all of it."""
    version, held = _write_version(df, path, partitions)
    held.write.parquet(f"{path}/manifests/{version}")
    _switch(df.sparkSession, path, version)


def read_version(spark: SparkSession, path: str, schema: T.StructType, partitions: Sequence[str]) -> DataFrame:
    """The table as its current manifest says; files of other versions are pruned."""
    manifest = spark.read.parquet(f"{path}/manifests/{_current(spark, path)}")
    files = spark.read.schema(schema.add("version", "string") if "version" not in schema.names else schema).parquet(f"{path}/data")
    on = files["version"] == manifest["version"]
    for p in partitions:
        on = on & files[p].eqNullSafe(manifest[p])
    return files.join(manifest, on, "left_semi").drop("version")


def replace_in_table(spark: SparkSession, path: str, new: DataFrame, keys: Sequence[str], partitions: Sequence[str]) -> None:
    """Replace rows by key in a table of versions, rewriting only the partitions that change.

    Those are the partitions of the new rows and all in which one of their keys has rows.  Partitions that lose all their
    rows leave the manifest.
    """
    schema = T.StructType(list(new.schema.fields))
    old = read_version(spark, path, T.StructType(list(new.schema.fields)), partitions).select(*schema.names)
    fresh = new.select(*keys).distinct()
    before = old.join(fresh, list(keys), "left_semi").select(*partitions).distinct()
    touched = new.select(*partitions).unionByName(before).distinct()
    same = lambda left, right: reduce(lambda a, b: a & b, [left[p].eqNullSafe(right[p]) for p in partitions])
    affected = old.join(touched, same(old, touched), "left_semi")
    version, held = _write_version(replace_by_key(affected, new, keys), path, partitions)
    manifest = spark.read.parquet(f"{path}/manifests/{_current(spark, path)}")
    kept = manifest.join(touched, same(manifest, touched), "left_anti")
    kept.unionByName(held).coalesce(1).write.parquet(f"{path}/manifests/{version}")
    _switch(spark, path, version)


def drop_old_versions(spark: SparkSession, path: str) -> None:
    """Delete the files of versions that the current manifest does not name; no reader may be at work on them."""
    current = _current(spark, path)
    manifest = spark.read.parquet(f"{path}/manifests/{current}")
    used = {r.version for r in manifest.select("version").distinct().collect()} | {current}
    for part in ("data", "manifests"):
        folder, fs = _file(spark, f"{path}/{part}")
        for status in fs.listStatus(folder):
            if status.getPath().getName().removeprefix("version=") not in used:
                fs.delete(status.getPath(), True)


def archive(df: DataFrame, condition: Column, archive_path: str, remainder_path: str) -> None:
    """Write the matching rows to an archive and the others to the new table."""
    hit = F.coalesce(condition, F.lit(False))
    df.filter(hit).write.mode("overwrite").parquet(archive_path)
    df.filter(~hit).write.mode("overwrite").parquet(remainder_path)
