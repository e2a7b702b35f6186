"""Aligning meters, units and weather on common timestamps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterloom.functions import scalars as S


def keep_last(df: DataFrame, keys: Sequence[str], tie: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per key, the one with the greatest tie columns.

    An aggregate instead of a ranking window: map-side combine removes the
    duplicates before the shuffle, so a hot key never travels whole.
    """
    best = F.max_by(F.struct(*columns), F.struct(*tie)).alias("__best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"__best.{c}").alias(c) for c in columns])


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with the number of dropped rows."""
    n = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return n.filter("n > 1").select(*keys, (F.col("n") - 1).alias("dropped"))


def prefer_source(
    df: DataFrame,
    keys: Sequence[str],
    source: str,
    preference: Sequence[str],
    tie: Sequence[str],
    columns: Sequence[str],
) -> DataFrame:
    """One row per key from the best-ranked source, the last one by ``tie``."""
    order = F.struct((-S.rank_of(source, preference)).alias("rank"), *tie)
    best = F.max_by(F.struct(*columns), order).alias("__best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"__best.{c}").alias(c) for c in columns])


def expand_devices(units: DataFrame, devices: str = "devices") -> DataFrame:
    """Units with a device array to one row per (unit, device, multiplier)."""
    rest = [c for c in units.columns if c != devices]
    return units.select(*rest, F.explode(devices).alias("__d")).select(
        *rest, F.col("__d.device").alias("device"), F.col("__d.multiplier").alias("multiplier")
    )


def fan_out(df: DataFrame, bridge: DataFrame, on: str = "device") -> DataFrame:
    """Each reading once per unit that uses its device."""
    return df.join(bridge, on)


def keep_listed(df: DataFrame, listed: DataFrame, on: str = "device") -> DataFrame:
    return df.join(listed.select(on), on, "left_semi")


def align_devices(
    df: DataFrame, bridge: DataFrame, time: str, unit: str = "unit", device: str = "device", value: str = "value"
) -> DataFrame:
    """Weighted sum per unit at the times where every present device has a value.

    ``df`` holds at most one row per (device, time).  A device without any
    reading does not count as present.
    """
    present = (
        df.select(device)
        .distinct()
        .join(bridge.select(device, unit), device)
        .groupBy(unit)
        .agg(F.count("*").alias("__devices"))
    )
    sums = (
        df.filter(F.col(value).isNotNull())
        .join(bridge.select(device, unit, "multiplier"), device)
        .groupBy(unit, time)
        .agg(F.sum(F.col(value) * F.col("multiplier")).alias(value), F.count("*").alias("__n"))
    )
    return sums.join(present, unit).filter("__n = __devices").drop("__n", "__devices")


def weather_join(
    df: DataFrame,
    weather: DataFrame,
    time: Column,
    weather_time: Column,
    columns: Sequence[str],
    station: str = "station",
    how: str = "inner",
    prefix: str = "",
) -> DataFrame:
    """Join weather of the row's station at the row's grid time."""
    side = weather.select(
        F.col("station").alias("__station"),
        weather_time.alias("__time"),
        *[F.col(c).alias(prefix + c) for c in columns],
    )
    on = (F.col(station) == F.col("__station")) & (F.col("__at") == F.col("__time"))
    return df.withColumn("__at", time).join(side, on, how).drop("__at", "__station", "__time")


def daily_mean(weather: DataFrame, time: str, columns: Sequence[str], station: str = "station") -> DataFrame:
    return weather.groupBy(station, F.to_date(time).alias("day")).agg(*[F.avg(c).alias(c) for c in columns])


def attach_building(units: DataFrame, direct: DataFrame, reporting: DataFrame, buildings: DataFrame) -> DataFrame:
    """Building of a unit: named directly, else through its reporting unit."""
    found = (
        units.join(direct.select("unit", F.col("building").alias("__a")), "unit", "left")
        .join(reporting.select("unit", F.col("building").alias("__b")), "unit", "left")
        .withColumn("building", F.coalesce("__a", "__b"))
        .drop("__a", "__b")
    )
    return found.join(buildings, "building")


def usable_units(units: DataFrame, devices: str = "devices", area: str = "area", station: str = "station") -> DataFrame:
    """Units with at least one device, a positive area and a known station."""
    return units.filter((F.size(devices) > 0) & (F.col(area) > 0) & (F.col(station) != "Unknown"))


def common_span(left: DataFrame, right: DataFrame, keys: Sequence[str], time: str, columns: dict[str, str]) -> DataFrame:
    """Inner join of two grid series, cut to the time span both cover.

    ``columns`` maps the value column of each side: {left: ..., right: ...}.
    """
    lv, rv = columns["left"], columns["right"]
    span_l = left.groupBy(*keys).agg(F.min(time).alias("__l0"), F.max(time).alias("__l1"))
    span_r = right.groupBy(*keys).agg(F.min(time).alias("__r0"), F.max(time).alias("__r1"))
    span = span_l.join(span_r, list(keys)).select(
        *keys, F.greatest("__l0", "__r0").alias("span_from"), F.least("__l1", "__r1").alias("span_to")
    )
    both = left.select(*keys, time, lv).join(right.select(*keys, time, rv), [*keys, time])
    return both.join(span, list(keys)).filter(F.col(time).between(F.col("span_from"), F.col("span_to")))


def complete_days(df: DataFrame, keys: Sequence[str], time: str, value: str, need: int) -> DataFrame:
    """Rows of the days that hold at least ``need`` values."""
    day = df.withColumn("__day", F.to_date(time))
    full = (
        day.groupBy(*keys, "__day")
        .agg(F.count(value).alias("__n"))
        .filter(F.col("__n") >= need)
        .select(*keys, "__day")
    )
    return day.join(full, [*keys, "__day"], "left_semi").drop("__day")


def rebin_model_input(df: DataFrame, keys: Sequence[str], time: str, value: str, weather: Sequence[str]) -> DataFrame:
    """Hourly model input: consumption summed, weather taken as its maximum."""
    return df.groupBy(*keys, F.date_trunc("hour", time).alias("hour")).agg(
        F.sum(value).alias(value), *[F.max(c).alias(c) for c in weather]
    )


def virtual_meter(df: DataFrame, tree: DataFrame, time: str, value: str) -> DataFrame:
    """Factor-weighted sum of child meters per parent and time (``tree``: parent, device, factor)."""
    return (
        df.join(tree, "device")
        .groupBy("parent", time)
        .agg(F.sum(F.col(value) * F.col("factor")).alias(value), F.count("*").alias("n_children"))
    )


def reconcile(old: DataFrame, new: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Full outer join of two versions of a series with a status per key."""
    a = old.select(*keys, F.col(value).alias("old_value"))
    b = new.select(*keys, F.col(value).alias("new_value"))
    both = a.join(b, list(keys), "full")
    status = (
        F.when(F.col("old_value").isNull(), "added")
        .when(F.col("new_value").isNull(), "missing")
        .when(F.col("old_value") == F.col("new_value"), "same")
        .otherwise("changed")
    )
    return both.withColumn("status", status)
