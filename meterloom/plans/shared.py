"""Small helpers of the query modules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterloom.functions.ordered import running_total
from meterloom.functions.recovery import cut_lineage
from meterloom.operators import align, grid
from meterloom.plans import views


def r4(c, name: str | None = None) -> Column:
    """Rounded double for the result check; the offset settles exact ties."""
    out = F.round((F.col(c) if isinstance(c, str) else c) + 1e-9, 4)
    return out.alias(name or c) if isinstance(name or c, str) else out


def text(c, name: str | None = None) -> Column:
    """Date or timestamp as text."""
    return F.col(c).cast("string").alias(name or c)


def stamp(c, name: str | None = None) -> Column:
    column = F.col(c) if isinstance(c, str) else c
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(name or c)


def whole(c, name: str | None = None) -> Column:
    column = F.col(c) if isinstance(c, str) else c
    return column.cast("bigint").alias(name or c)


def stored(df: DataFrame) -> DataFrame:
    """Write an intermediate table once that the rest of the query reads several times.

    These tables are binned series, far smaller than the readings they come from.
    """
    return cut_lineage(df)


def series(spark, folder) -> DataFrame:
    """One value per (device, day): at most one row per calendar day."""
    return align.keep_last(views.daily(spark, folder), ["device", "day"], views.TIE, ["value"])


def preferred(spark, folder) -> DataFrame:
    return align.prefer_source(
        views.daily(spark, folder), ["device", "day"], "source", views.SOURCES, views.TIE, ["value"]
    )


def unit_daily(spark, folder) -> DataFrame:
    return align.align_devices(preferred(spark, folder), views.units(spark, folder), "day")


def energy_hourly(spark, folder) -> DataFrame:
    """Hourly totals per energy type: at most one row per calendar hour."""
    return (
        views.readings(spark, folder)
        .groupBy("energy", F.date_trunc("hour", "ts").alias("hour"))
        .agg(F.sum("value").alias("value"))
    )


def by_month(c: str = "ts") -> Column:
    """Chunk of a meter's raw readings: a month at one reading per second is 2.7 million rows."""
    return F.date_trunc("month", c)


def meters(spark, folder) -> DataFrame:
    """Raw readings of instant, counter and mixed meters."""
    acc = running_total(
        views.readings(spark, folder).drop("props"),
        ["device", "energy"],
        ["ts", "event_id"],
        "value",
        "accumulated",
        by_month(),
    )
    kind = F.col("device") % 3
    return acc.withColumn("accumulated", F.when(kind != 0, F.col("accumulated"))).withColumn(
        "value", F.when(kind != 1, F.col("value"))
    )


def energy_counter(spark, folder) -> DataFrame:
    """The meters of an energy type as one counter: its level at the end of each hour with readings."""
    keys = ["device", "energy"]
    counters = running_total(
        views.readings(spark, folder).drop("props"), keys, ["ts", "event_id"], "value", "counter", by_month()
    )
    tops = counters.groupBy(*keys, F.date_trunc("hour", "ts").alias("bin")).agg(F.max("counter").alias("counter"))
    return grid.merge_counters(tops, ["energy"], "device", "bin", "counter", "counter", from_zero=True)


def energy_grid(spark, folder) -> DataFrame:
    """Hourly totals on a complete grid, empty hours 0."""
    full = grid.fill_grid(energy_hourly(spark, folder), ["energy"], "hour", grid.STEPS[3600])
    return full.withColumn("value", F.coalesce("value", F.lit(0.0)))


def energy_model(spark, folder) -> DataFrame:
    """Hourly totals with the mean temperature of the hour."""
    weather = views.meteo_hourly(spark, folder).groupBy("hour").agg(F.avg("temperature").alias("temperature"))
    return energy_hourly(spark, folder).join(weather, "hour")


def unit_station(spark, folder) -> DataFrame:
    return views.units(spark, folder).groupBy("unit").agg(F.min("station").alias("station"))


def unit_model(spark, folder) -> DataFrame:
    """Daily consumption of a unit with its station's temperature."""
    rows = unit_daily(spark, folder).join(unit_station(spark, folder), "unit")
    return align.weather_join(
        rows, views.meteo_daily(spark, folder), F.col("day"), F.col("day"), ["temperature"]
    ).drop("station")


def load_input(spark, folder) -> DataFrame:
    """Complete hourly series per energy type with the hour's weather."""
    weather = (
        views.meteo_hourly(spark, folder)
        .groupBy("hour")
        .agg(
            F.avg("temperature").alias("temperature"),
            F.max("ghi").alias("ghi"),
            F.avg("wind_speed").alias("wind_speed"),
            F.min("wind_bearing").alias("wind_bearing"),
        )
    )
    return energy_grid(spark, folder).join(weather, "hour", "left")
