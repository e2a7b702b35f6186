"""Whole cleaning jobs: from raw rows to clean series, a quality record per series and the list of what was found.

Every job returns :class:`Cleaned`.  ``clean`` has the grid of each series, ``quality`` one row per series with its status and
counts, ``issues`` one row per finding (duplicated, gap, negative, outlier, overlap) with its time: as rows, and not as lists
in the record, findings have no bound.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom.functions import scalars as S
from meterloom.functions.recovery import cut_lineage
from meterloom.operators import align, clean, grid, models
from meterloom.sources import sinks

DAY = 86400


class Cleaned(NamedTuple):
    clean: DataFrame
    quality: DataFrame
    issues: DataFrame


def frequency_text(seconds: str) -> Column:
    """``1 day, 2:03:04``; days only where there are some."""
    s = F.col(seconds).cast("long")
    days, rest = F.floor(s / DAY), s % DAY
    clock = F.format_string("%d:%02d:%02d", F.floor(rest / 3600), F.floor(rest % 3600 / 60), rest % 60)
    word = F.when(days == 1, " day, ").otherwise(" days, ")
    return F.when(days > 0, F.concat(days.cast("string"), word, clock)).otherwise(clock)


def resolution_text(seconds: str) -> Column:
    """Smallest unit that a step is made of: D, H, T or S."""
    s = F.col(seconds)
    return F.when(s % DAY == 0, "D").when(s % 3600 == 0, "H").when(s % 60 == 0, "T").otherwise(F.when(s.isNotNull(), "S"))


def _issues(parts: dict[str, DataFrame], keys: Sequence[str], time: str) -> DataFrame:
    named = [rows.select(*keys, F.lit(issue).alias("issue"), F.col(time).cast("timestamp").alias("ts")) for issue, rows in parts.items()]
    return reduce(DataFrame.unionByName, named)


def _counts(issues: DataFrame, keys: Sequence[str], kinds: Sequence[str]) -> DataFrame:
    return issues.groupBy(*keys).agg(*[F.count_if(F.col("issue") == k).alias(f"n_{k}") for k in kinds])


def _described(series: DataFrame, issues: DataFrame, keys: Sequence[str], kinds: Sequence[str]) -> DataFrame:
    """Series with the number of findings of each kind."""
    counted = series.join(_counts(issues, keys, kinds), list(keys), "left")
    return counted.fillna(0, [f"n_{k}" for k in kinds])


def describe_series(
    df: DataFrame, keys: Sequence[str], time: str, value: str, counter: str, chunk: Column | None = None
) -> DataFrame:
    """Dominant step, kind and error status of each series of distinct times."""
    steps = clean.dominant_interval(df, keys, time, chunk)
    kinds = clean.series_kind(df, keys, value, counter)
    return clean.series_status(kinds, steps, keys)


def clean_metering(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    value: str = "value",
    counter: str = "accumulated",
    order: Sequence[str] = (),
    daily: bool = False,
    limit: float | None = clean.ZSCORE_LIMIT,
    chunk: Column | None = None,
) -> Cleaned:
    """Clean metering series of any kind and step.

    Of rows at one instant the last in ``order`` counts.  Each series takes its
    rule from its own dominant step and its kind:

    * hourly: bins of half an hour or an hour, instant readings added, counters
      by their highest reading, interpolated and differenced; series slower than
      an hour are left out with a status;
    * ``daily``: bins of a day in the same way below a day between readings;
      slower instant readings are spread over the days since the one before,
      slower counters interpolated by day.

    Then negatives go, and values beyond ``limit`` deviations.  Bins that are
    empty after that are gaps.
    """
    per_time = df.groupBy(*keys, time).agg(F.count("*").alias("__n"))
    rows = cut_lineage(align.keep_last(df, [*keys, time], order, [value, counter]))
    found = describe_series(rows, keys, time, value, counter, chunk)
    width = F.lit(DAY) if daily else clean.hourly_rule(F.col("interval_s"))
    slow = (F.col("interval_s") >= DAY) if daily else F.lit(False)
    status = F.when((F.col("status") == "ok") & width.isNull(), "too slow").otherwise(F.col("status"))
    series = cut_lineage(
        found.select(*keys, "kind", "interval_s", status.alias("status"), width.cast("long").alias("step_s"), slow.alias("__slow"))
    )
    ready = rows.join(series.filter("status = 'ok'").select(*keys, "kind", "step_s", "__slow"), list(keys))
    at = [*keys, "step_s"]
    instant = ready.filter("kind = 'instant'")
    summed = grid.resample_sum(
        instant.filter("not __slow"), at, grid.bin_of(time, "step_s"), value, grid.step_of("step_s")
    ).select(*at, "bin", F.col(value).alias("value"))
    tops = ready.filter("kind = 'counter'").groupBy(*at, grid.bin_of(time, "step_s").alias("bin")).agg(F.max(counter).alias("__c"))
    parts = [summed, grid.counter_movement(tops, at, "bin", "__c", "step_s").select(*at, "bin", "value")]
    if daily:
        spread = grid.spread_readings(instant.filter("__slow"), at, time, value)
        parts.append(spread.select(*at, F.col("day").cast("timestamp").alias("bin"), "value"))
    binned = reduce(DataFrame.unionByName, parts)
    flagged = clean.drop_negatives(binned, "value").withColumn("outlier", F.lit(False))
    if limit is not None:
        flagged = clean.clean_consumption(binned, keys, "value", limit)
    flagged = cut_lineage(flagged)
    kinds = {
        "duplicated": per_time.filter("__n > 1").withColumnRenamed(time, "bin"),
        "gap": flagged.filter("value IS NULL"),
        "negative": flagged.filter("negative"),
        "outlier": flagged.filter("outlier"),
    }
    issues = _issues(kinds, keys, "bin")
    described = _described(series.drop("__slow"), issues, keys, list(kinds))
    frequency = resolution_text("interval_s") if daily else frequency_text("interval_s")
    return Cleaned(flagged.select(*at, F.col("bin").alias("ts"), "value"), described.withColumn("frequency", frequency), issues)


def clean_billing(bills: DataFrame, keys: Sequence[str]) -> Cleaned:
    """Bills (ini, fin, value, bill_id) as daily consumption without negatives, with overlapping and missing days."""
    days = cut_lineage(clean.bill_days(bills, keys))
    flagged = clean.drop_negatives(days, "value")
    gaps = clean.day_gaps(days, keys, "day")
    kinds = {
        "overlap": clean.bill_overlaps(days),
        "gap": gaps.withColumnRenamed("gap_from", "day"),
        "negative": flagged.filter("negative"),
    }
    issues = _issues(kinds, keys, "day")
    series = days.groupBy(*keys).agg(F.count("*").alias("n_days"), F.min("day").alias("first_day"), F.max("day").alias("last_day"))
    return Cleaned(flagged.select(*keys, "day", "value"), _described(series, issues, keys, list(kinds)), issues)


def clean_station(
    df: DataFrame, keys: Sequence[str], time: str, column: str, low: float, high: float, order: Sequence[str] = ()
) -> Cleaned:
    """Weather of a station, the last row of each instant, without impossible values."""
    rest = [c for c in df.columns if c not in keys and c != time]
    per_time = df.groupBy(*keys, time).agg(F.count("*").alias("__n"))
    rows = cut_lineage(align.keep_last(df, [*keys, time], order, rest))
    bounded = rows.withColumn("__v", F.when(F.col(column).between(low, high), F.col(column)))
    kinds = {
        "duplicated": per_time.filter("__n > 1"),
        "below": bounded.filter(F.col(column) < low),
        "above": bounded.filter(F.col(column) > high),
        "gap": bounded.filter("__v IS NULL"),
    }
    issues = _issues(kinds, keys, time)
    series = rows.groupBy(*keys).agg(F.count("*").alias("n_rows"))
    fixed = bounded.withColumn(column, F.col("__v")).drop("__v")
    return Cleaned(fixed, _described(series, issues, keys, list(kinds)), issues)


def store(spark: SparkSession, folder: str, found: Cleaned, keys: Sequence[str], partitions: Sequence[str]) -> None:
    """Replace the series of a run in the three tables of a folder, or start these; ``partitions`` are among the keys."""
    for name, rows in found._asdict().items():
        path = f"{folder}/{name}"
        if sinks.exists(spark, f"{path}/current"):
            sinks.replace_in_table(spark, path, rows, keys, partitions)
        else:
            sinks.create_table(rows, path, partitions)


# --- hourly baseline -------------------------------------------------------------------------------------------------


HALF_HOUR, HOUR = 1800, 3600
WEEK = 7 * DAY
FOLDS = 16


def unit_series(
    consumption: DataFrame, bridge: DataFrame, weather: DataFrame, preference: Sequence[str], tie: Sequence[str] = ()
) -> DataFrame:
    """Consumption of units with their station's temperature: (unit, energy, step_s, hour, value, temperature).

    ``consumption``: (device, energy, step_s, ts, value, source), clean series of several sources; ``bridge``: (device, unit,
    multiplier, station); ``weather``: (station, hour, temperature).  Of several sources the preferred one counts, and a
    unit has a value only where all its devices of an energy type and step have one.
    """
    own = ["device", "energy", "step_s"]
    best = align.prefer_source(consumption, [*own, "ts"], "source", preference, tie, ["value"])
    # The devices of a unit are aligned for each energy type and step by themselves.
    name = lambda first: F.struct(F.col(first).alias("id"), "energy", "step_s")
    rows = best.withColumn("device", name("device")).select("device", F.col("ts").alias("hour"), "value")
    parts = best.select(*own).distinct().join(bridge, "device")
    pairs = parts.select(name("device").alias("device"), name("unit").alias("unit"), "multiplier")
    units = align.align_devices(rows, pairs, "hour")
    stations = bridge.select(F.col("unit").alias("__unit"), "station").distinct()
    placed = units.join(stations, F.col("unit.id") == F.col("__unit")).select(
        F.col("unit.id").alias("unit"), "unit.energy", "unit.step_s", "station", "hour", "value"
    )
    at = F.date_trunc("hour", "hour")
    return align.weather_join(placed, weather, at, F.col("hour"), ["temperature"], prefix="out_").select(
        "unit", "energy", "step_s", F.col("hour"), "value", F.col("out_temperature").alias("temperature")
    )


def baseline(
    series: DataFrame, step_s: int, water: Sequence[str] = (), folds: int = FOLDS, floor: float = -10.0
) -> DataFrame:
    """Rolling predictions of the last weeks with residual bands and scores, for the series of one step.

    Each slot of the week has its own model, the constant alone for hourly series and for ``water``, else the best of all
    candidates.  Impossible values of the hourly bands are smoothed.  ``series``: (unit, energy, hour, value, temperature).
    """
    keys, width = ["unit", "energy"], WEEK // step_s
    rows = cut_lineage(series.withColumn("slot", S.week_slot("hour")))
    plain = F.lit(True) if step_s >= HOUR else F.col("energy").isin(list(water))
    run = lambda part, candidates: models.backtest(part, keys, "hour", "value", "slot", width, folds, "temperature", candidates)
    out = run(rows.filter(plain), ("constant",))
    if step_s < HOUR:
        out = out.unionByName(run(rows.filter(~plain), models.ALL_MODELS))
    if step_s >= HOUR:
        for band in models.BANDS:
            out = models.smooth_band(out, keys, "hour", f"p{band}", "smooth", floor).drop(f"p{band}").withColumnRenamed("smooth", f"p{band}")
    return out


def baseline_documents(predicted: DataFrame, created: str) -> DataFrame:
    """One document a series: its times, values, predictions and bands as arrays; a series has ``FOLDS`` weeks at the most."""
    columns = ["hour", "value", "prediction", *[f"p{b}" for b in models.BANDS], "score"]
    rows = predicted.groupBy("unit", "energy").agg(F.array_sort(F.collect_list(F.struct(*columns))).alias("r"))
    return rows.select("unit", "energy", F.lit(created).alias("created"), *[F.col(f"r.{c}").alias(c) for c in columns])
