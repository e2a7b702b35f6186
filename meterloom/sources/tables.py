"""Reading the columnar input tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Calendar arithmetic in this package is UTC unless a zone is passed explicitly.
UTC = "UTC"


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Read ``<folder>/<name>.parquet`` with zone-less timestamps taken as UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != UTC:
        spark.conf.set("spark.sql.session.timeZone", UTC)
    path = f"{folder}/{name}.parquet"
    df = spark.read.parquet(path)
    # Reading as instants, rather than casting afterwards, keeps time filters pushable.
    schema = T.StructType(
        [
            T.StructField(f.name, T.TimestampType(), f.nullable) if isinstance(f.dataType, T.TimestampNTZType) else f
            for f in df.schema.fields
        ]
    )
    return spark.read.schema(schema).parquet(path) if schema != df.schema else df


def scan(df: DataFrame, columns: list[str], time: str | None = None, start=None, stop=None) -> DataFrame:
    """Project declared columns and keep an inclusive time range; both reach the file scan."""
    if time is not None:
        if start is not None:
            df = df.filter(F.col(time) >= F.lit(start))
        if stop is not None:
            df = df.filter(F.col(time) <= F.lit(stop))
    return df.select(*columns)
