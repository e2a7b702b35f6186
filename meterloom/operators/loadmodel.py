"""Hourly load model: daily profiles, clusters, features; all as DataFrame operators.

A unit's rows sit on the hourly grid, so per-unit windows are bounded by the
look-back.  The iterative fits live in ``loadfit``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from meterloom.functions import scalars as S

HOURS = list(range(24))

# Quantiles and ratio of the cluster outlier rule.
TAIL_LOW, TAIL_HIGH, TAIL_RATIO = 0.025, 0.975, 2.0
# Scale of the occupancy rate and consumption counted as none.
OCCUPANCY_MAX, OCCUPANCY_FLOOR = 100.0, 1.0
# Least variance of a cluster's hour.
VARIANCE_FLOOR = 1e-6
# Widths of the trailing means.
MEAN_WIDTHS = range(2, 13)


def attach_weather(df: DataFrame, weather: DataFrame, on: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Left join to weather with one row per station and time (the last by value on repeats)."""
    once = weather.groupBy(*on).agg(F.max(F.struct(*columns)).alias("__w")).select(*on, "__w.*")
    return df.join(once, list(on), "left")


def day_profiles(df: DataFrame, keys: Sequence[str], time: str, value: str) -> DataFrame:
    """One row per day with columns h0..h23."""
    wide = df.withColumn("__h", F.hour(time)).groupBy(*keys, F.to_date(time).alias("day")).pivot("__h", HOURS).sum(value)
    return wide.select(*keys, "day", *[F.col(str(h)).alias(f"h{h}") for h in HOURS])


def day_shares(df: DataFrame, keys: Sequence[str], time: str, value: str, out: str = "share") -> DataFrame:
    """Hour's share of its day's total; null on days that are not complete."""
    dated = df.withColumns({"day": F.to_date(time), "dayhour": F.hour(time)})
    w = Window.partitionBy(*keys, "day")
    share = F.col(value) / F.nullif(F.sum(value).over(w), F.lit(0.0))
    return dated.withColumn(out, F.when(F.count(value).over(w) == 24, share))


def hour_statistics(shares: DataFrame, keys: Sequence[str], share: str = "share") -> DataFrame:
    """Mean and sample deviation of each hour's share over the days."""
    return shares.groupBy(*keys, "dayhour").agg(F.avg(share).alias("mean"), F.stddev_samp(share).alias("sd"))


def znorm(
    shares: DataFrame, keys: Sequence[str], spec: DataFrame | None = None, share: str = "share", out: str = "z"
) -> DataFrame:
    """Standardise by own or stored statistics (``spec``: keys, dayhour, mean, sd)."""
    if spec is None:
        w = Window.partitionBy(*keys, "dayhour")
        spread = F.nullif(F.stddev_samp(share).over(w), F.lit(0.0))
        return shares.withColumn(out, (F.col(share) - F.avg(share).over(w)) / spread)
    joined = shares.join(spec, [*keys, "dayhour"])
    return joined.withColumn(out, (F.col(share) - F.col("mean")) / F.nullif(F.col("sd"), F.lit(0.0))).drop("mean", "sd")


def scale_range(
    df: DataFrame, keys: Sequence[str], value: str, out: str, low: float, high: float, floor: float | None = None
) -> DataFrame:
    """Min-max scaling; constant groups and values below ``floor`` get ``low``."""
    w = Window.partitionBy(*keys)
    v, a, b = F.col(value), F.min(value).over(w), F.max(value).over(w)
    scaled = (v - a) / F.nullif(b - a, F.lit(0.0)) * (high - low) + low
    if floor is not None:
        scaled = F.when(v >= floor, scaled).otherwise(F.lit(low))
    return df.withColumn(out, F.when(a == b, F.lit(low)).otherwise(scaled))


def centroids(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Mean load per hour of day and cluster, its occupancy rate, and whether the cluster never consumes.

    The windows hold the 24 hours of one cluster.
    """
    mean = df.groupBy(*keys, "s", "dayhour").agg(F.avg(value).alias("centroid"))
    w = Window.partitionBy(*keys, "s")
    c = F.col("centroid")
    low, high = F.min(c).over(w), F.max(c).over(w)
    rate = (c - low) / F.nullif(high - low, F.lit(0.0)) * OCCUPANCY_MAX
    occupancy = F.when((low != high) & (c >= OCCUPANCY_FLOOR), rate).otherwise(F.lit(0.0))
    return mean.withColumns({"occupancy": occupancy, "zero": F.sum(c).over(w) == 0})


def attach_clusters(df: DataFrame, days: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Cluster label of each row's day (``right`` in training, ``left`` in prediction)."""
    return df.join(days.select(*keys, "day", "s"), [*keys, "day"], how)


def lag_features(
    df: DataFrame, keys: Sequence[str], time: str, value: str, lags: int, clusters: Sequence[str] = ()
) -> DataFrame:
    """Log consumption of the 1..``lags`` previous rows; zero clusters and other clusters' copies get the floor."""
    w = Window.partitionBy(*keys).orderBy(time)
    floor = F.lit(S.LOG_FLOOR)
    out = df.withColumn("log_value", S.floored_log(value))
    named = {}
    for i in range(1, lags + 1):
        named[f"lag{i}"] = F.when(F.col("zero"), F.log(floor)).otherwise(F.lag("log_value", i).over(w))
    out = out.withColumns(named)
    copies = {
        f"lag{i}_s{c}": F.when(F.col("s") == c, F.col(f"lag{i}")).otherwise(F.log(floor))
        for i in range(1, lags + 1)
        for c in clusters
    }
    return out.withColumns(copies) if copies else out


def trailing_means(df: DataFrame, keys: Sequence[str], time: str, value: str, widths=MEAN_WIDTHS) -> DataFrame:
    """Log of the mean of the k previous values; the value before the first row counts as 0,
    and rows with too short a past get the floor."""
    w = Window.partitionBy(*keys).orderBy(time)
    rn = F.row_number().over(w)
    out = df.withColumn("__rn", rn)
    for k in widths:
        mean = F.coalesce(F.sum(value).over(w.rowsBetween(-k, -1)), F.lit(0.0)) / k
        out = out.withColumn(f"ma{k}", S.floored_log(F.when(F.col("__rn") >= k, mean).otherwise(0.0), S.MEAN_LOG_FLOOR))
    return out.drop("__rn")


# Smallest weight of a value that can still be told from 0, as a power of two.
_LEAST_WEIGHT = 1074


def low_pass(df: DataFrame, keys: Sequence[str], time: str, value: str, alpha: float, out: str) -> DataFrame:
    """First-order filter y = a*y' + (1-a)*x, started at the first value and again after a null.

    A row maps the level before it to ``scale * level + shift``.  Maps of
    neighbouring rows are composed over spans that double in each pass, so a row
    knows its whole past after a number of passes that grows with the logarithm
    of the time the filter remembers.  Only products of ``alpha`` occur, which
    fade to 0 at worst.  Series sit on a calendar grid.
    """
    if alpha == 0:
        return df.withColumn(out, F.col(value))
    if not 0 < alpha < 1:
        raise ValueError("alpha is at least 0 and below 1")
    x, a = F.col(value), float(alpha)
    w = Window.partitionBy(*keys).orderBy(time)
    rows = df.withColumn("__seg", F.count(F.when(x.isNull(), 1)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    known = Window.partitionBy(*keys, "__seg", F.isnull(x)).orderBy(time)
    rows = rows.withColumn("__i", F.row_number().over(known))
    first = F.col("__i") == 1
    rows = rows.withColumns({"__scale": F.when(first, F.lit(0.0)).otherwise(F.lit(a)), "__shift": F.when(first, x).otherwise((1 - a) * x)})
    remembered = min(_LEAST_WEIGHT / -math.log2(a) + 1, 2.0**31)
    for k in range(math.ceil(math.log2(remembered))):
        # A row without a row so far back already starts from its first value.
        rows = rows.withColumns({"__s": F.lag("__scale", 2**k, 1.0).over(known), "__h": F.lag("__shift", 2**k, 0.0).over(known)})
        shift = F.col("__shift") + F.col("__scale") * F.col("__h")
        rows = rows.withColumns({"__shift": shift, "__scale": F.col("__scale") * F.col("__s")})
    return rows.withColumn(out, F.when(x.isNotNull(), F.col("__shift"))).drop("__seg", "__i", "__scale", "__shift", "__s", "__h")


def occupancy_terms(df: DataFrame, percent: float, columns: Sequence[str]) -> DataFrame:
    """Occupancy flag and the weather seen only while occupied."""
    out = df.withColumn("occupied", S.occupied("occupancy", percent))
    return out.withColumns({f"{c}_occ": F.col(c) * F.col("occupied") for c in columns})


def calendar_features(df: DataFrame, time: str, zone: str | None = None) -> DataFrame:
    """Hour, weekday and hour of week in the unit's zone."""
    local = S.local_time(time, zone) if zone else F.col(time)
    return df.withColumns(
        {"dayhour": F.hour(local), "dayweek": S.iso_weekday(local), "weekhour": S.hour_of_week(local), "day": F.to_date(local)}
    )


def prepare_features(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    value: str,
    lags: int,
    latitude,
    longitude,
    cent: DataFrame | None = None,
    clusters: Sequence[str] = (),
) -> DataFrame:
    """Model input: centroid, occupancy, lags, trailing means, wind sector and sun position.

    ``df`` holds (keys, time, day, dayhour, s, value, weather); ``cent`` the stored
    centroids in prediction.  Negative or missing consumption rows are dropped.
    """
    if cent is None:
        cent = centroids(df, keys, value)
    out = df.join(cent, [*keys, "s", "dayhour"], "left")
    out = out.filter(F.col(value) >= 0)
    out = lag_features(out, keys, time, value, lags, clusters)
    out = trailing_means(out, keys, time, value)
    altitude, azimuth = S.sun_position(time, latitude, longitude)
    out = out.withColumn("__alt", altitude).withColumn("__azi", azimuth)
    return out.withColumns(
        {
            "wind_sector": S.sector("wind_bearing"),
            "sun_elevation": F.greatest(F.col("__alt"), F.lit(0.0)),
            "sun_azimuth": F.when(F.col("__alt") > 0, F.col("__azi")).otherwise(0.0),
            "sun_label": S.sun_label("__alt", "__azi"),
        }
    ).drop("__alt", "__azi")


# --- clusters -------------------------------------------------------------------


def cluster_tails(days: DataFrame, profiles: DataFrame, keys: Sequence[str], z: str = "z") -> DataFrame:
    """Unlabel the days that lie oddly far from or near to their cluster's centre.

    ``days``: (keys, day, s); ``profiles``: (keys, day, dayhour, z).  A cluster is
    trimmed only when its greatest distance exceeds twice its 2.5 % quantile.
    """
    rows = profiles.join(days.select(*keys, "day", "s"), [*keys, "day"])
    centre = rows.groupBy(*keys, "s", "dayhour").agg(F.avg(z).alias("__c"))
    gap = F.pow(F.col(z) - F.col("__c"), 2.0)
    dist = (
        rows.join(centre, [*keys, "s", "dayhour"])
        .groupBy(*keys, "s", "day")
        .agg(F.sqrt(F.sum(gap)).alias("distance"))
    )
    # A unit's days are bounded by the look-back.
    cut = dist.groupBy(*keys, "s").agg(
        F.percentile("distance", F.lit(TAIL_LOW)).alias("__lo"),
        F.percentile("distance", F.lit(TAIL_HIGH)).alias("__hi"),
        F.max("distance").alias("__max"),
    )
    trim = F.col("__max") > TAIL_RATIO * F.col("__lo")
    outside = ~F.col("distance").between(F.col("__lo"), F.col("__hi"))
    return (
        dist.join(cut, [*keys, "s"])
        .withColumn("kept", ~(trim & outside))
        .select(*keys, "day", "s", "distance", "kept")
    )


def assign_clusters(profiles: DataFrame, params: DataFrame, keys: Sequence[str], z: str = "z") -> DataFrame:
    """Most likely cluster per day under diagonal normal clusters.

    ``params``: (keys, s, dayhour, mean, variance, weight).  Days without all 24
    hours get no cluster.
    """
    full = profiles.filter(F.col(z).isNotNull()).join(params, [*keys, "dayhour"])
    d = F.col(z) - F.col("mean")
    var = F.greatest(F.col("variance"), F.lit(VARIANCE_FLOOR))
    density = -0.5 * (F.log(2 * F.pi() * var) + d * d / var)
    score = (
        full.groupBy(*keys, "day", "s")
        .agg(F.sum(density).alias("__d"), F.first("weight").alias("__w"), F.count("*").alias("__n"))
        .filter(F.col("__n") == 24)
        .withColumn("__score", F.round(F.col("__d") + F.log("__w"), 9))
    )
    best = F.min_by("s", F.struct(-F.col("__score"), F.col("s"))).alias("s")
    return score.groupBy(*keys, "day").agg(best)
