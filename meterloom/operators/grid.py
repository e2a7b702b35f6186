"""Regular time grids: binning, gap filling, interpolation, spreading.

A binned series holds at most (look-back / step) rows per key, so windows over
it are plain key windows.  Functions that touch raw readings take a ``chunk``
column instead (see ``functions.ordered``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from meterloom.functions.ordered import Step, ordered_scan, spread_keys

STEPS = {1800: "interval 30 minutes", 3600: "interval 1 hour", 86400: "interval 1 day"}


def step_of(seconds: str) -> str:
    """SQL text of the interval that a column with whole seconds names, for series with steps of their own."""
    return f"make_dt_interval(0, 0, 0, `{seconds}`)"


def bin_of(time: str, seconds: str) -> Column:
    """Start of the bin of a timestamp, for bins as wide as a column says."""
    width = F.col(seconds)
    return F.timestamp_seconds(F.floor(F.unix_seconds(F.col(time).cast("timestamp")) / width) * width)


def fill_grid(binned: DataFrame, keys: Sequence[str], time: str, step: str) -> DataFrame:
    """Add the missing bins between each key's first and last one.

    ``binned`` has one row per (key, time).  Every row brings along the empty
    bins up to its successor, so no grid has to be built and joined.  Keys keep
    all shuffle partitions: merged by the size of the rows before they grow,
    they would leave later windows a few tasks with large parts of the grid.
    """
    width = F.expr(step)
    near = ordered_scan(spread_keys(binned, keys), keys, [time], [Step("__next", "next", F.col(time))])
    bins = F.sequence(F.col(time), F.coalesce(F.col("__next") - width, F.col(time)), width)
    rest = [c for c in binned.columns if c not in keys and c != time]
    own = F.col("__at") == F.col(time)
    return near.withColumn("__at", F.explode(bins)).select(
        *keys, F.col("__at").alias(time), *[F.when(own, F.col(c)).alias(c) for c in rest]
    )


def resample_sum(
    df: DataFrame, keys: Sequence[str], bin_col: Column, value: str, step: str, out_time: str = "bin", empty: str = "zero"
) -> DataFrame:
    """Sum of instant readings per bin; empty bins give 0 (or null)."""
    sums = df.groupBy(*keys, bin_col.alias(out_time)).agg(F.sum(value).alias(value))
    full = fill_grid(sums, keys, out_time, step)
    return full.withColumn(value, F.coalesce(value, F.lit(0.0))) if empty == "zero" else full


def resample_counter(
    df: DataFrame, keys: Sequence[str], bin_col: Column, counter: str, step_s: int, out_time: str = "bin"
) -> DataFrame:
    """Consumption per bin of a counter: highest reading, interpolated, differenced."""
    tops = df.groupBy(*keys, bin_col.alias(out_time)).agg(F.max(counter).alias("__c"))
    return counter_movement(tops, keys, out_time, "__c", step_s)


def counter_movement(df: DataFrame, keys: Sequence[str], time: str, counter: str, step_s: int | str) -> DataFrame:
    """Difference of a counter interpolated on its grid.

    Between two known counts the interpolated difference is the same for every
    bin, so each known count fills the bins since the one before it.  The first
    known bin and anything before it is null, bins after the last one are 0.
    ``step_s`` may name a key column with the seconds of each series.
    """
    width = F.expr(step_of(step_s) if isinstance(step_s, str) else STEPS[step_s])
    step_s = F.col(step_s) if isinstance(step_s, str) else step_s
    w = Window.partitionBy(*keys)
    ends = df.withColumns({"__a": F.min(time).over(w), "__b": F.max(time).over(w)})
    known = ends.filter(F.col(counter).isNotNull())
    near = ordered_scan(
        known,
        keys,
        [time],
        [Step("__p", "prev", F.struct(F.col(time).alias("t"), F.col(counter).alias("c"))), Step("__n", "next", F.col(time))],
    )
    p, t = F.col("__p"), F.col(time)
    start = F.when(p.isNull(), F.col("__a")).otherwise(p["t"] + width)
    stop = F.when(F.col("__n").isNull(), F.col("__b")).otherwise(t)
    bins = (F.unix_seconds(t.cast("timestamp")) - F.unix_seconds(p["t"].cast("timestamp"))) / step_s
    slope = F.when(p.isNotNull(), (F.col(counter) - p["c"]) / F.nullif(bins, F.lit(0.0)))
    spread = near.withColumn("__v", slope).withColumn("__at", F.explode(F.sequence(start, stop, width)))
    return spread.select(
        *keys, F.col("__at").alias(time), F.when(F.col("__at") > t, F.lit(0.0)).otherwise(F.col("__v")).alias("value")
    )


def interpolate(
    df: DataFrame, keys: Sequence[str], time: str, value: str, out: str, chunk: Column | None = None
) -> DataFrame:
    """Linear interpolation in time; a leading gap stays null, a trailing gap repeats the last value."""
    at = F.unix_micros(F.col(time).cast("timestamp")).cast("double")
    v = F.col(value)
    known = F.when(v.isNotNull(), F.struct(at.alias("t"), v.alias("v")))
    scanned = ordered_scan(
        df, keys, [time], [Step("__l", "last", known), Step("__n", "next_value", known)], chunk
    )
    l, n = F.col("__l"), F.col("__n")
    line = l.v + (n.v - l.v) * (at - l.t) / F.nullif(n.t - l.t, F.lit(0.0))
    filled = F.when(v.isNotNull(), v).when(l.isNull() | n.isNull(), l.v).otherwise(line)
    return scanned.withColumn(out, filled).drop("__l", "__n")


def merge_counters(
    tops: DataFrame, keys: Sequence[str], device: str, time: str, counter: str, out: str, from_zero: bool = False
) -> DataFrame:
    """One counter of all devices of a key from their highest readings per bin (keys, device, time, counter).

    Each device's counter is a step function; its movements since its own bin
    before are added by time, and the sums are cumulated.  A device's series and
    that of the key are bounded by the calendar, whatever the number of devices.
    The first bin of a device is its base, or a movement ``from_zero``.
    """
    known = tops.filter(F.col(counter).isNotNull())
    near = ordered_scan(known, [*keys, device], [time], [Step("__p", "prev", F.col(counter))])
    base = F.lit(0.0) if from_zero else F.col(counter)
    moved = near.withColumn("__m", F.col(counter) - F.coalesce("__p", base))
    sums = moved.groupBy(*keys, time).agg(F.sum("__m").alias("__m"))
    return ordered_scan(sums, keys, [time], [Step(out, "sum", F.col("__m"))]).select(*keys, time, out)


def regularise(
    df: DataFrame, keys: Sequence[str], time: str, value: str, seconds: int, counter: bool = True
) -> DataFrame:
    """Irregular readings onto a fixed grid, in counter space for consumption.

    Returns (keys, time, value, missing).  A grid point is missing when it lies
    in (or on an end of) a step between readings longer than two grid steps.

    A grid point sees the readings only through the last one before it, the
    first one after it and the sum of all before it, so the readings are
    combined, in one scan and before any shuffle of single readings to a key,
    into one row per cell between two grid points.  The calendar bounds the
    cells, whatever the number of meters.  Readings at one instant are added
    (averaged unless ``counter``); null values count as no reading.
    """
    width = seconds * 1_000_000
    same = F.sum(value) if counter else F.avg(value)
    at = F.unix_micros(F.col(time).cast("timestamp"))
    instants = df.filter(F.col(value).isNotNull()).groupBy(*keys, at.alias("__t")).agg(same.cast("double").alias("__v"))
    # Cell k holds the readings after grid point k - 1 up to grid point k, that point included.
    cells = instants.groupBy(*keys, F.ceil(F.col("__t") / width).alias("__k")).agg(
        F.sum("__v").alias("__sum"),
        F.min("__t").alias("__first"),
        F.min_by("__v", "__t").alias("__first_v"),
        F.max("__t").alias("__last"),
        F.max_by("__v", "__t").alias("__last_v"),
    )
    steps = [
        Step("__upto", "sum", F.col("__sum")),
        Step("__p", "prev", F.col("__last")),
        Step("__n", "next", F.struct(F.col("__k").alias("k"), F.col("__first").alias("t"), F.col("__first_v").alias("v"))),
    ]
    near = ordered_scan(cells, keys, ["__k"], steps)
    n, last = F.col("__n"), F.col("__last")
    # Points of the cell's end up to the next cell; the last cell has one only if a reading is at its end.
    final = F.when(n.isNotNull(), n["k"] - 1).when(last == F.col("__k") * width, F.col("__k"))
    points = near.filter(final.isNotNull()).withColumn("__at", F.explode(F.sequence("__k", final)))
    ahead = (F.col("__at") * width - last).cast("double") / F.nullif((n["t"] - last).cast("double"), F.lit(0.0))
    level = F.col("__upto") if counter else F.col("__last_v")
    rise = n["v"] if counter else n["v"] - F.col("__last_v")
    second = lambda c: F.floor(c / 1_000_000)
    gap_after = second(n["t"]) - second(last) > 2 * seconds
    # Only the one reading of a cell can be on a grid point and end a long step.
    on_point = (F.col("__at") * width == last) & (F.col("__first") == last)
    gap_before = on_point & (second(last) - second(F.col("__p")) > 2 * seconds)
    placed = points.select(
        *keys,
        F.timestamp_seconds(F.col("__at") * seconds).alias(time),
        F.when((F.col("__at") * width == last) | n.isNull(), level).otherwise(level + rise * ahead).alias("__y"),
        F.coalesce(gap_after | gap_before, gap_after, gap_before, F.lit(False)).alias("missing"),
    )
    if not counter:
        return placed.withColumnRenamed("__y", "value")
    diffed = ordered_scan(placed, keys, [time], [Step("__q", "prev", F.col("__y"))])
    return diffed.select(*keys, time, (F.col("__y") - F.col("__q")).alias("value"), "missing")


def spread_interval(df: DataFrame, start: str, stop: str, value: str, out_day: str = "day") -> DataFrame:
    """Spread an interval's value evenly over its inclusive days."""
    days = F.datediff(stop, start) + 1
    return (
        df.filter(F.col(start) <= F.col(stop))
        .withColumn("n_days", days)
        .withColumn(out_day, F.explode(F.sequence(F.col(start), F.col(stop), F.expr("interval 1 day"))))
        .withColumn(value, F.col(value) / F.col("n_days"))
    )


def spread_readings(df: DataFrame, keys: Sequence[str], day: str, value: str) -> DataFrame:
    """Spread readings that are more than a day apart over the days between them.

    Cumulating, interpolating daily and differencing gives every day since the
    previous reading the same share of a reading; the first day has none.
    Readings are floored to their day and summed first, so the calendar bounds
    the window.
    """
    daily = df.groupBy(*keys, F.to_date(day).alias("day")).agg(F.sum(value).alias("__m"))
    near = ordered_scan(daily, keys, ["day"], [Step("__p", "prev", F.col("day"))])
    start = F.coalesce(F.date_add("__p", 1), F.col("day"))
    share = F.col("__m") / F.datediff("day", "__p")
    return near.select(
        *keys, F.explode(F.sequence(start, F.col("day"), F.expr("interval 1 day"))).alias("day"), share.alias("value")
    )
