"""Quality records, reconciliation and sanity checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from meterloom.functions.ordered import Step, ordered_scan
from meterloom.functions.quantiles import exact_percentiles
from meterloom.functions.recovery import cut_lineage

# A bill is a gap when both ratios exceed this; ratios of use are capped.
GAP_RATIO = 1.7
RATIO_CAP = 3.0
# Share of one weather step that makes a station bad; relative error limit of a migration.
SAME_STEP_SHARE = 0.2
ERROR_LIMIT = 5.0


def quality_report(
    raw: DataFrame, cleaned: DataFrame, keys: Sequence[str], time: str, bin_time: str, step_s: int
) -> DataFrame:
    """One row per series: counts of duplicates, gaps, negatives and outliers, and the outlier times.

    ``cleaned`` sits on a calendar grid, which bounds the collected arrays;
    duplicates of raw readings are only counted.
    """
    second = F.date_trunc("second", time)
    per_time = raw.groupBy(*keys, second.alias("__t")).agg(F.count("*").alias("__n"))
    dup = per_time.groupBy(*keys).agg(F.sum(F.col("__n") - 1).alias("n_duplicated"))
    prev = ordered_scan(cleaned, keys, [bin_time], [Step("__p", "prev", F.col(bin_time))])
    gap = F.unix_timestamp(bin_time) - F.unix_timestamp("__p") > step_s
    report = prev.groupBy(*keys).agg(
        F.count_if(gap).alias("n_gaps"),
        F.count_if("negative").alias("n_negative"),
        F.count_if("outlier").alias("n_outlier"),
        F.array_sort(F.collect_list(F.when(F.col("outlier"), F.col(bin_time)))).alias("outliers"),
        F.array_sort(F.collect_list(F.when(gap, F.col(bin_time)))).alias("gaps"),
    )
    return report.join(dup, list(keys))


def bill_gap_statistics(df: DataFrame, keys: Sequence[str], min_bills: int = 3) -> DataFrame:
    """Flag bills that are long and, per day, low compared with their series.

    ``df``: (keys, prev_fin, fin, value).  The first bill has no length.
    """
    days = F.datediff("fin", "prev_fin").cast("double")
    rows = df.withColumn("days", days).withColumn("per_day", F.col("value") / F.nullif(F.col("days"), F.lit(0.0)))
    stats = rows.groupBy(*keys).agg(
        F.count("*").alias("n_bills"), F.avg("days").alias("mean_days"), F.avg("per_day").alias("mean_per_day")
    )
    day_ratio = F.col("days") / F.nullif(F.col("mean_days"), F.lit(0.0))
    use_ratio = F.least(F.col("mean_per_day") / F.nullif(F.col("per_day"), F.lit(0.0)), F.lit(RATIO_CAP))
    flag = (F.col("n_bills") >= min_bills) & (day_ratio > GAP_RATIO) & (use_ratio > GAP_RATIO)
    return (
        rows.join(stats, list(keys))
        .withColumn("day_ratio", day_ratio)
        .withColumn("use_ratio", use_ratio)
        .withColumn("gap", F.coalesce(flag, F.lit(False)))
    )


def medians_and_modes(rows: DataFrame, keys: Sequence[str], value: str, prefix: str) -> DataFrame:
    """Exact median, smallest mode and mean per series, from the counts of its distinct values."""
    known = rows.filter(F.col(value).isNotNull())
    counts = cut_lineage(known.groupBy(*keys, value).agg(F.count("*").alias("__n")))
    median = exact_percentiles(counts, keys, value, [0.5], [f"{prefix}_median"], weight="__n")
    mode = F.min_by(value, F.struct(-F.col("__n"), F.col(value))).alias(f"{prefix}_mode")
    mean = (F.sum(F.col(value) * F.col("__n")) / F.sum("__n")).alias(f"{prefix}_mean")
    return median.join(counts.groupBy(*keys).agg(mode, mean), list(keys))


def removed_share(df: DataFrame, flag: str, keys: Sequence[str] = ()) -> DataFrame:
    """Number and share of flagged rows."""
    return df.groupBy(*keys).agg(
        F.count_if(flag).alias("n_removed"),
        F.count("*").alias("n_rows"),
        (F.count_if(flag) / F.count("*")).alias("share"),
    )


def total_reconciliation(old: DataFrame, new: DataFrame, keys: Sequence[str], value: str, limit: float = ERROR_LIMIT) -> DataFrame:
    """Totals of two versions of the data per key, relative error and status."""
    a = old.groupBy(*keys).agg(F.sum(value).alias("old_total"))
    b = new.groupBy(*keys).agg(F.sum(value).alias("new_total"))
    error = (F.col("old_total") - F.col("new_total")) / F.nullif(F.col("old_total"), F.lit(0.0))
    status = (
        F.when(F.col("old_total").isNull(), "only new")
        .when(F.col("new_total").isNull(), "only old")
        .when(F.abs(F.col("error")) > limit, "over limit")
        .otherwise("ok")
    )
    return a.join(b, list(keys), "full").withColumn("error", error).withColumn("status", status)


def step_shares(df: DataFrame, keys: Sequence[str], time: str, value: str, digits: int = 3) -> DataFrame:
    """Share of each step between consecutive values of a grid series."""
    prev = ordered_scan(df, keys, [time], [Step("__p", "prev", F.col(value))])
    steps = prev.withColumn("step", F.round(F.col(value) - F.col("__p"), digits))
    n = steps.groupBy(*keys).agg(F.count("*").alias("__n"))
    counts = steps.filter(F.col("step").isNotNull()).groupBy(*keys, "step").agg(F.count("*").alias("n"))
    return counts.join(n, list(keys)).withColumn("share", F.col("n") / F.col("__n")).drop("__n")


def station_sanity(df: DataFrame, keys: Sequence[str], time: str, value: str, digits: int = 3) -> DataFrame:
    """A station is bad when one step makes up a fifth of its rows, or when it has no step."""
    shares = step_shares(df, keys, time, value, digits).groupBy(*keys).agg(F.max("share").alias("top_share"))
    every = df.groupBy(*keys).agg(F.count("*").alias("n_rows"))
    bad = F.coalesce(F.col("top_share") >= SAME_STEP_SHARE, F.lit(True))
    return every.join(shares, list(keys), "left").withColumn("bad", bad)


def most_common(df: DataFrame, keys: Sequence[str], value: str, n: int = 5, parts: int = 64) -> DataFrame:
    """The ``n`` most common values per key.

    Values are counted first, then ranked in ``parts`` parts of each key, so that a key with very many values is not
    ranked by one task; the second ranking sees at most ``n`` values of each part.
    """
    counts = df.groupBy(*keys, value).agg(F.count("*").alias("n"))
    order = (F.desc("n"), F.asc(value))
    some = Window.partitionBy(*keys, "__part").orderBy(*order)
    first = counts.withColumn("__part", F.pmod(F.xxhash64(value), F.lit(parts))).withColumn("place", F.row_number().over(some))
    best = first.filter(F.col("place") <= n).drop("__part", "place")
    return best.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("place") <= n)


def recent_hourly_flag(
    intervals: DataFrame, latest: DataFrame, keys: Sequence[str], as_of, weeks: int = 12
) -> DataFrame:
    """Whether a series has hourly (or faster) data in the last ``weeks`` weeks."""
    recent = F.col("last_ts") >= F.lit(as_of).cast("timestamp") - F.expr(f"interval {7 * weeks} days")
    fast = F.coalesce(F.col("interval_s") <= 3600, F.lit(False))
    return intervals.join(latest, list(keys)).withColumn("has_hourly", fast & recent)


def validation_scores(df: DataFrame, keys: Sequence[str], actual: str, predicted: str) -> DataFrame:
    """r2, RMSE relative to the mean, and mean absolute percentage error."""
    err = F.col(actual) - F.col(predicted)
    return df.groupBy(*keys).agg(
        F.pow(F.corr(actual, predicted), 2.0).alias("r2"),
        (F.sqrt(F.avg(err * err)) / F.nullif(F.avg(actual), F.lit(0.0))).alias("nrmse"),
        F.avg(F.abs(err / F.nullif(F.col(actual), F.lit(0.0)))).alias("mape"),
    )


def autocorrelation(df: DataFrame, keys: Sequence[str], order: str, value: str, lags: int) -> DataFrame:
    """Correlation of a grid series with itself 1..``lags`` rows earlier, whole (``acf``) and partial (``pacf``)."""
    w = Window.partitionBy(*keys).orderBy(order)
    shifted = df.withColumns({f"__l{k}": F.lag(value, k).over(w) for k in range(1, lags + 1)})
    wide = shifted.groupBy(*keys).agg(*[F.corr(value, f"__l{k}").alias(f"__l{k}") for k in range(1, lags + 1)])
    row = wide.select(*keys, F.array(*[F.col(f"__l{k}") for k in range(1, lags + 1)]).alias("__r"))
    row = row.select(*keys, "__r", partial_correlations(F.col("__r"), lags).alias("__p"))
    pairs = F.transform(F.sequence(F.lit(1), F.lit(lags)), lambda k: F.struct(k.alias("lag"), F.col("__r")[k - 1].alias("acf"), F.col("__p")[k - 1].alias("pacf")))
    return row.select(*keys, F.inline(pairs))


def partial_correlations(r: Column, lags: int) -> Column:
    """Partial autocorrelations 1..``lags`` from the autocorrelations, by the Durbin-Levinson recursion."""
    none = F.array().cast("array<double>")
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)

    def step(state: Column, k: Column) -> Column:
        phi, before = state["phi"], F.slice(r, F.lit(1), k - 1)
        p = (r[k - 1] - dot(phi, F.reverse(before))) / F.nullif(1 - dot(phi, before), F.lit(0.0))
        new = F.zip_with(phi, F.reverse(phi), lambda a, b: a - p * b)
        return F.struct(F.concat(new, F.array(p)).alias("phi"), F.concat(state["out"], F.array(p)).alias("out"))

    start = F.struct(none.alias("phi"), none.alias("out"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(lags)), start, step, lambda state: state["out"])
