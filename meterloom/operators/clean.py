"""Detecting and removing bad readings; bill, hourly, daily and weather cleaning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from meterloom.functions.ordered import Step, most_frequent, ordered_scan, spread_keys
from meterloom.functions.recovery import cut_lineage
from meterloom.operators.grid import spread_interval

# Z-score limit, big gap (7 days), temperature limits of the weather cleaning.
ZSCORE_LIMIT = 30.0
BIG_GAP_SECONDS = 7 * 24 * 3600
TEMPERATURE_MIN, TEMPERATURE_MAX = -70.0, 70.0


def steps_between(df: DataFrame, keys: Sequence[str], time: str, out: str, chunk: Column | None = None) -> DataFrame:
    """Seconds since the previous reading of the key."""
    scanned = ordered_scan(df, keys, [time], [Step("__p", "prev", F.col(time))], chunk)
    at = lambda c: F.unix_timestamp(F.col(c).cast("timestamp"))
    return scanned.withColumn(out, at(time) - at("__p")).drop("__p")


def dominant_interval(df: DataFrame, keys: Sequence[str], time: str, chunk: Column | None = None) -> DataFrame:
    """Most frequent step per series in seconds (smallest on ties); null for a single reading."""
    diffs = steps_between(df.select(*keys, time), keys, time, "__step", chunk)
    modes = most_frequent(diffs, keys, "__step", "interval_s")
    return df.groupBy(*keys).agg(F.count("*").alias("n")).join(modes, list(keys), "left")


def series_kind(df: DataFrame, keys: Sequence[str], value: str = "value", counter: str = "accumulated") -> DataFrame:
    """Counter, instant, mixed or empty, by which columns hold data."""
    n = df.groupBy(*keys).agg(F.count(value).alias("n_value"), F.count(counter).alias("n_counter"))
    kind = (
        F.when((F.col("n_value") == 0) & (F.col("n_counter") == 0), "empty")
        .when(F.col("n_value") == 0, "counter")
        .when(F.col("n_counter") == 0, "instant")
        .otherwise("mixed")
    )
    return n.withColumn("kind", kind)


def hourly_rule(interval: Column) -> Column:
    """Bin width in seconds for hourly cleaning, null when the series is too slow."""
    return F.when(interval <= 1800, F.lit(1800)).when(interval <= 3600, F.lit(3600))


def daily_rule(interval: Column) -> Column:
    """``bin`` below one day between readings, else ``spread``."""
    return F.when(interval < 86400, "bin").when(interval.isNotNull(), "spread")


def series_status(kinds: DataFrame, intervals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Error status per series: no interval, mixed readings, empty, or ok."""
    both = intervals.join(kinds, list(keys))
    status = (
        F.when(F.col("kind") == "empty", "no data")
        .when(F.col("interval_s").isNull(), "no interval")
        .when(F.col("kind") == "mixed", "counter and instant values")
        .otherwise("ok")
    )
    return both.withColumn("status", status)


def route_series(kinds: DataFrame, intervals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Where a series belongs: bill, metering or monthly metering."""
    slow = F.col("interval_s") > 86400
    route = (
        F.when(slow & (F.col("n_counter") == 0), "billing").when(slow, "monthly metering").otherwise("metering")
    )
    joined = intervals.join(kinds, list(keys)).withColumn("interval_s", F.coalesce("interval_s", F.lit(2 * 86400)))
    return joined.withColumn("route", route)


def zscore_outliers(df: DataFrame, keys: Sequence[str], value: str, limit: float, out: str) -> DataFrame:
    """Flag values more than ``limit`` sample deviations from the mean of their key.

    For binned series, whose length the calendar bounds.  Differences of the size
    of rounding noise never count.
    """
    w = Window.partitionBy(*keys)
    stats = df.withColumns({"__m": F.avg(value).over(w), "__s": F.stddev_samp(value).over(w)})
    flag = F.abs(F.col(value) - F.col("__m")) > limit * F.col("__s") + 1e-9 * F.abs(F.col("__m"))
    return stats.withColumn(out, F.coalesce(flag, F.lit(False))).drop("__m", "__s")


def rolling_outliers(
    df: DataFrame, keys: Sequence[str], time: str, value: str, rows: int, limit: float, out: str
) -> DataFrame:
    """Flag values far from the mean of the trailing ``rows`` grid rows."""
    w = Window.partitionBy(*keys).orderBy(time).rowsBetween(1 - rows, 0)
    flag = F.abs(F.col(value) - F.avg(value).over(w)) > limit * F.stddev_samp(value).over(w)
    return df.withColumn(out, F.coalesce(flag, F.lit(False)))


def drop_negatives(df: DataFrame, value: str) -> DataFrame:
    """Null out negatives and flag them."""
    return df.withColumn("negative", F.coalesce(F.col(value) < 0, F.lit(False))).withColumn(
        value, F.when(F.col(value) >= 0, F.col(value))
    )


def clean_consumption(df: DataFrame, keys: Sequence[str], value: str, limit: float = ZSCORE_LIMIT) -> DataFrame:
    """Null out negatives, then values beyond ``limit`` deviations; keeps both flags."""
    flagged = zscore_outliers(drop_negatives(df, value), keys, value, limit, "outlier")
    return flagged.withColumn(value, F.when(~F.col("outlier"), F.col(value)))


def day_gaps(df: DataFrame, keys: Sequence[str], day: str) -> DataFrame:
    """Steps of more than one day in a daily series, as (previous, next)."""
    days = df.select(*keys, day).distinct()
    prev = ordered_scan(days, keys, [day], [Step("gap_from", "prev", F.col(day))])
    return prev.filter(F.datediff(day, "gap_from") > 1).select(*keys, "gap_from", F.col(day).alias("gap_to"))


def long_gaps(df: DataFrame, keys: Sequence[str], time: str, limit_s: int, chunk: Column | None = None) -> DataFrame:
    """Steps longer than the limit, contiguous ones merged, as from/to intervals.

    Long steps number at most look-back / limit per key, so merging them is a plain window.
    """
    at = lambda c: F.unix_timestamp(F.col(c).cast("timestamp"))
    near = ordered_scan(df.select(*keys, time), keys, [time], [Step("gap_from", "prev", F.col(time))], chunk)
    gaps = near.filter(at(time) - at("gap_from") > limit_s).withColumnRenamed(time, "gap_to")
    before = ordered_scan(gaps, keys, ["gap_from"], [Step("__p", "prev", F.col("gap_to"))])
    fresh = F.when(F.col("__p").isNull() | (F.col("__p") < F.col("gap_from")), F.lit(1))
    island = ordered_scan(before.withColumn("__f", fresh), keys, ["gap_from"], [Step("__i", "count", F.col("__f"))])
    return (
        island.groupBy(*keys, "__i")
        .agg(F.min("gap_from").alias("gap_from"), F.max("gap_to").alias("gap_to"))
        .drop("__i")
    )


def flag_runs(df: DataFrame, keys: Sequence[str], time: str, flag: str, chunk: Column | None = None) -> DataFrame:
    """Runs of equal flag values as from/to intervals."""
    prev = ordered_scan(df, keys, [time], [Step("__p", "prev", F.col(flag))], chunk)
    change = F.when(F.col("__p").isNull() | (F.col("__p") != F.col(flag)), F.lit(1))
    runs = ordered_scan(prev.withColumn("__c", change), keys, [time], [Step("__i", "count", F.col("__c"))], chunk)
    return (
        runs.groupBy(*keys, "__i", flag)
        .agg(F.min(time).alias("run_from"), F.max(time).alias("run_to"), F.count("*").alias("n"))
        .drop("__i")
    )


def clip_gaps(gaps: DataFrame, start, stop, begin: str = "gap_from", end: str = "gap_to") -> DataFrame:
    """Gap intervals cut to a period; those outside it are dropped."""
    a, b = F.lit(start), F.lit(stop)
    return (
        gaps.filter((F.col(end) >= a) & (F.col(begin) <= b))
        .withColumn(begin, F.greatest(begin, a))
        .withColumn(end, F.least(end, b))
    )


def merge_gaps(
    one: DataFrame, two: DataFrame, keys: Sequence[str], begin: str = "gap_from", end: str = "gap_to",
    chunk: Column | None = None,
) -> DataFrame:
    """Union of two gap lists without overlaps."""
    both = one.select(*keys, begin, end).unionByName(two.select(*keys, begin, end))
    both = both.groupBy(*keys, begin).agg(F.max(end).alias(end))
    reach = ordered_scan(both, keys, [begin], [Step("__r", "max_before", F.col(end))], chunk)
    fresh = F.when(F.col("__r").isNull() | (F.col(begin) > F.col("__r")), F.lit(1))
    islands = ordered_scan(reach.withColumn("__f", fresh), keys, [begin], [Step("__i", "count", F.col("__f"))], chunk)
    return islands.groupBy(*keys, "__i").agg(F.min(begin).alias(begin), F.max(end).alias(end)).drop("__i")


def trim_ends(
    df: DataFrame, keys: Sequence[str], time: str, big_gap_s: int = BIG_GAP_SECONDS, chunk: Column | None = None
) -> DataFrame:
    """Drop leading and trailing rows cut off from the body by big gaps."""
    at = lambda c: F.unix_timestamp(F.col(c).cast("timestamp"))
    near = ordered_scan(
        df.select(*keys, time),
        keys,
        [time],
        [Step("__p", "prev", F.col(time)), Step("__n", "next", F.col(time))],
        chunk,
    )
    small_after = F.col("__n").isNull() | (at("__n") - at(time) < big_gap_s)
    small_before = F.col("__p").isNull() | (at(time) - at("__p") < big_gap_s)
    body = near.groupBy(*keys).agg(
        F.min(F.when(small_after, F.col(time))).alias("__a"), F.max(F.when(small_before, F.col(time))).alias("__b")
    )
    return df.join(body, list(keys)).filter(F.col(time).between(F.col("__a"), F.col("__b"))).drop("__a", "__b")


def increasing_times(
    df: DataFrame, keys: Sequence[str], arrival: Sequence[str], time: str, chunk: Column | None = None
) -> DataFrame:
    """Rows, in arrival order, whose time is later than every earlier row's."""
    top = ordered_scan(df, keys, arrival, [Step("__m", "max_before", F.col(time))], chunk)
    return top.filter(F.col("__m").isNull() | (F.col(time) > F.col("__m"))).drop("__m")


def _limits(rows: DataFrame, keys: Sequence[str], value: str, sd_limit: float, allow_negative: bool) -> DataFrame:
    """``__low``, ``__high`` and the number of values of each key; null limits remove nothing."""
    stats = rows.groupBy(*keys).agg(F.avg(value).alias("__m"), F.stddev_pop(value).alias("__s"), F.count(value).alias("__n"))
    low = F.col("__m") - sd_limit * F.col("__s")
    low = low if allow_negative else F.greatest(low, F.lit(0.0))
    return stats.select(*keys, low.alias("__low"), (F.col("__m") + sd_limit * F.col("__s")).alias("__high"), "__n")


def _beyond(value: str) -> Column:
    return F.coalesce((F.col(value) < F.col("__low")) | (F.col(value) > F.col("__high")), F.lit(False))


def remove_extremes(
    df: DataFrame, keys: Sequence[str], value: str, sd_limit: float, allow_negative: bool = True
) -> DataFrame:
    """Drop rows outside mean +- ``sd_limit`` population deviations until nothing changes.

    What is left of a key after some rounds is an interval of its values, so a
    round is known by one row for each key and applied to ``df`` as a filter;
    no round writes more than that.  A key is done when its interval holds as
    many values as the one before.  Null values stay, rows with a null key go.
    """
    state = cut_lineage(_limits(df, keys, value, sd_limit, allow_negative).withColumn("__open", F.col("__n") > 0))
    while not state.filter("__open").isEmpty():
        left = df.join(state.filter("__open").select(*keys, "__low", "__high"), list(keys)).filter(~_beyond(value))
        after = _limits(left, keys, value, sd_limit, allow_negative)
        after = after.withColumnsRenamed({"__low": "__low2", "__high": "__high2", "__n": "__n2"})
        fewer = F.col("__open") & (F.col("__n2") < F.col("__n"))
        state = cut_lineage(
            state.join(after, list(keys), "left").select(
                *keys,
                F.when(fewer, F.greatest("__low", "__low2")).otherwise(F.col("__low")).alias("__low"),
                F.when(fewer, F.least("__high", "__high2")).otherwise(F.col("__high")).alias("__high"),
                F.when(fewer, F.col("__n2")).otherwise(F.col("__n")).alias("__n"),
                F.coalesce(fewer, F.lit(False)).alias("__open"),
            )
        )
    return df.join(state.select(*keys, "__low", "__high"), list(keys)).filter(~_beyond(value)).drop("__low", "__high")


def remove_extreme_rates(
    df: DataFrame, keys: Sequence[str], time: str, value: str, sd_limit: float, chunk: Column | None = None
) -> DataFrame:
    """Drop rows whose consumption rate is below 0 or outside mean +- ``sd_limit`` population deviations until nothing changes.

    A rate depends on the reading before it, so a round judges the rows that the one before left of the series it took some
    from.  Rates are written once a round, for the limits, the rows beyond them and the next round; what has been removed is
    kept as a list of (key, time).
    """
    removed, rows = None, df.select(*keys, time, value)
    while True:
        judged = cut_lineage(consumption_rates(rows, keys, time, value, chunk))
        limits = _limits(judged, keys, "rate", sd_limit, allow_negative=False).drop("__n")
        bad = cut_lineage(judged.join(limits, list(keys)).filter(_beyond("rate")).select(*keys, time))
        if bad.isEmpty():
            return df if removed is None else df.join(removed, [*keys, time], "left_anti")
        turn = bad.select(*keys).distinct()
        rows = judged.select(*keys, time, value).join(turn, list(keys), "left_semi").join(bad, [*keys, time], "left_anti")
        removed = bad if removed is None else removed.unionByName(bad)


def consumption_rates(
    df: DataFrame, keys: Sequence[str], time: str, value: str, chunk: Column | None = None
) -> DataFrame:
    """Movement per second since the previous reading; null on the first row."""
    scanned = ordered_scan(df, keys, [time], [Step("__p", "prev", F.col(time))], chunk)
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    seconds = (micros(time) - micros("__p")) / 1e6
    return scanned.withColumn("rate", F.col(value) / F.nullif(seconds, F.lit(0.0))).drop("__p")


def clean_series(
    df: DataFrame,
    keys: Sequence[str],
    arrival: Sequence[str],
    time: str,
    value: str,
    commodity: str,
    sd_limit: float = ZSCORE_LIMIT,
    chunk: Column | None = None,
    arrival_chunk: Column | None = None,
) -> DataFrame:
    """Dates, ends and extremes in one go; temperature is judged by value, others by rate.

    The rows with increasing times and those without loose ends are written once, as each is read several times: pass only
    the columns that are wanted.
    """
    rising = cut_lineage(increasing_times(df, keys, arrival, time, arrival_chunk))
    body = cut_lineage(trim_ends(rising, keys, time, chunk=chunk))
    if commodity == "temperature":
        return remove_extremes(body, keys, value, sd_limit)
    return remove_extreme_rates(body, keys, time, value, sd_limit, chunk)


# --- bills -------------------------------------------------------------------


def bill_days(df: DataFrame, keys: Sequence[str], keep_all: bool = False) -> DataFrame:
    """Daily consumption from bills (ini, fin, value, bill_id), with the number of bills per day.

    A day covered by several bills keeps the one that starts last, unless
    ``keep_all`` asks for all of them.
    """
    if keep_all:
        return spread_interval(df, "ini", "fin", "value")
    # Bills travel, not their days: of bills of one period only the last can count, so that a key has no more of them than
    # the calendar has periods, and a key's bills become days where they are.
    last = F.when(F.max("bill_id").isNull(), F.first("value")).otherwise(F.max_by("value", "bill_id"))
    bills = df.filter(F.col("ini") <= F.col("fin")).groupBy(*keys, "ini", "fin")
    bills = bills.agg(last.alias("value"), F.max("bill_id").alias("bill_id"), F.count("*").alias("__n"))
    days = spread_interval(spread_keys(bills, keys), "ini", "fin", "value")
    return days.groupBy(*keys, "day").agg(
        F.max_by("value", F.struct("ini", "bill_id")).alias("value"), F.sum("__n").alias("n_bills")
    )


def bill_overlaps(days: DataFrame) -> DataFrame:
    """Days of ``bill_days`` covered by more than one bill."""
    return days.filter("n_bills > 1")


def chained_start(df: DataFrame, keys: Sequence[str], stop: str, order: Sequence[str], chunk: Column) -> DataFrame:
    """Bill start as the previous bill's end plus one day."""
    prev = ordered_scan(df, keys, order, [Step("__p", "prev", F.col(stop))], chunk)
    return prev.withColumn("chained_ini", F.date_add("__p", 1)).drop("__p")


def clean_weather(df: DataFrame, keys: Sequence[str], column: str, low: float, high: float) -> DataFrame:
    """Null out physically impossible values, keeping a flag."""
    ok = F.col(column).between(low, high)
    flag = F.coalesce(~ok, F.lit(False))
    return df.withColumn("outlier", flag).withColumn(column, F.when(ok, F.col(column)))
