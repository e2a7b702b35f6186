"""Turning billing, metering and weather documents into keyed measurement rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterloom.functions import scalars as S

PERIODS = ["p1", "p2", "p3", "p4", "p5", "p6"]

BILLING_DOC = T.StructType(
    [
        T.StructField("timestamp_start_bill", T.TimestampType()),
        T.StructField("timestamp_end_bill", T.TimestampType()),
        T.StructField("reading", T.StringType()),
        T.StructField("device", T.StringType()),
        T.StructField("values", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("company", T.StringType()),
    ]
)
METERING_DOC = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("reading", T.StringType()),
        T.StructField("device", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("company", T.StringType()),
    ]
)
WEATHER_FIELDS = [
    "temperature",
    "humidity",
    "pressure",
    "windSpeed",
    "windBearing",
    "GHI",
    "precipAccumulation",
    "latitude",
    "longitude",
]
WEATHER_DOC = T.StructType(
    [T.StructField("time", T.TimestampType()), T.StructField("stationId", T.StringType())]
    + [T.StructField(f, T.DoubleType()) for f in WEATHER_FIELDS]
)


def read_documents(spark, path: str, schema: T.StructType, company: str | None = None, time: str | None = None,
                   start=None, stop=None) -> DataFrame:
    """JSON documents with a fixed schema, optionally of one company and time range."""
    df = spark.read.schema(schema).json(path)
    if company is not None:
        df = df.filter(F.col("company") == company)
    if time is not None:
        if start is not None:
            df = df.filter(F.col(time) >= F.lit(start))
        if stop is not None:
            df = df.filter(F.col(time) <= F.lit(stop))
    return df


def with_reading(docs: DataFrame, metadata: DataFrame) -> DataFrame:
    """Look up type, unit and period of each document's reading; a miss leaves nulls.

    ``metadata`` has one row per reading; Spark broadcasts it when it is small
    and otherwise joins by shuffle.
    """
    meta = metadata.select("reading", F.col("type").alias("energy_type"), "unit", "period", F.lit(True).alias("__known"))
    return docs.join(meta, "reading", "left").withColumn("known", F.coalesce("__known", F.lit(False))).drop("__known")


def split_errors(looked_up: DataFrame, detected_at) -> tuple[DataFrame, DataFrame]:
    """Rows with a known reading, and the rest with the time the error was seen."""
    good = looked_up.filter("known").drop("known")
    bad = looked_up.filter("not known").drop("known", "energy_type", "unit", "period")
    return good, bad.withColumn("error", F.lit("unknown reading")).withColumn("detected_at", F.lit(detected_at))


def billing_rows(good: DataFrame) -> DataFrame:
    """Bills with per-period values in kilo-units and their total."""
    scaled = F.map_filter(
        F.transform_values("values", lambda _, v: S.finite(S.to_kilo("unit", v))), lambda _, v: v.isNotNull()
    )
    out = good.withColumn("values", scaled)
    total = F.aggregate(F.map_values("values"), F.lit(0.0), lambda a, v: a + v)
    return out.withColumns(
        {
            "value": F.when(F.size("values") > 0, total),
            "ts_ini": S.to_epoch("timestamp_start_bill"),
            "ts_end": S.to_epoch("timestamp_end_bill"),
        }
    )


def metering_rows(good: DataFrame) -> DataFrame:
    """Readings in kilo-units; instant ones as ``value``, all others as ``accumulated``."""
    v = S.finite(S.to_kilo("unit", "value"))
    instant = F.coalesce(F.col("period") == "INSTANT", F.lit(False))
    return good.withColumns(
        {"value": F.when(instant, v), "accumulated": F.when(~instant, v), "ts": S.to_epoch("timestamp")}
    )


def weather_rows(docs: DataFrame) -> DataFrame:
    """Fixed weather columns; anything missing or not a number is null."""
    fields = [(S.finite(f) if f in docs.columns else F.lit(None).cast("double")).alias(f) for f in WEATHER_FIELDS]
    return docs.select(S.to_epoch("time").alias("ts"), "stationId", *fields)


def periods_to_map(df: DataFrame, columns: list[str] = PERIODS, out: str = "values") -> DataFrame:
    """Wide bill periods to a map of the present ones, and their total."""
    pairs = F.create_map(*[x for c in columns for x in (F.lit(c), F.col(c).cast("double"))])
    kept = F.map_filter(pairs, lambda _, v: v.isNotNull())
    total = F.aggregate(F.map_values(out), F.lit(0.0), lambda a, v: a + v)
    return df.withColumn(out, kept).withColumn("total", total)


def bill_touches_range(ini, fin, start, stop) -> Column:
    """Bill starts or ends inside the range (one that spans all of it is missed)."""
    return F.col(ini).between(start, stop) | F.col(fin).between(start, stop)


def bill_overlaps_range(ini, fin, start, stop) -> Column:
    """Bill has at least one moment in common with the range."""
    return (F.col(ini) <= stop) & (F.col(fin) >= start)
