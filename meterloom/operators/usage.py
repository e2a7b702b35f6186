"""Days without usage: a level of consumption below the first mode that matters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Points of a density, its margin in bandwidths, and the rule of thumb for the bandwidth.
POINTS = 512
MARGIN = 3
BANDWIDTH_FACTOR = 0.9
IQR_TO_DEVIATION = 1.34
# A kernel ends after so many bandwidths.
REACH = 7

# Share of the lower values looked at; quantiles and heights of the first mode and of one that matters;
# consumption below which a mode itself is no usage.
LOWER_SHARE = 0.7
FIRST_QUANTILE, FIRST_HEIGHT = 0.2, 0.2
MODE_QUANTILE, MODE_GROWTH = 0.1, 2.0
STANDBY = 0.5


def bandwidth(n: Column, deviation: Column, iqr: Column, least: Column) -> Column:
    """Rule of thumb for a normal kernel: 0.9 min(sd, IQR / 1.34) n^(-1/5), with fallbacks where values agree."""
    some = lambda c: F.nullif(c, F.lit(0.0))
    spread = F.coalesce(some(F.least(deviation, iqr / IQR_TO_DEVIATION)), some(deviation), some(F.abs(least)), F.lit(1.0))
    return BANDWIDTH_FACTOR * spread * F.pow(n.cast("double"), F.lit(-0.2))


def kernel_density(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Normal kernel density of each key on ``POINTS`` equal steps: (keys, ``__point``, ``__x``, ``__d``), the greatest being 1.

    Values share their weight between the two points around them; the weight of
    each point is then spread over the points that its kernel reaches.  Both are
    sums with map-side combine, over at most ``POINTS`` rows a key.
    """
    quartiles = F.percentile(value, F.array(F.lit(0.25), F.lit(0.75)))
    ends = df.groupBy(*keys).agg(
        F.count(value).alias("__n"), F.stddev_samp(value).alias("__sd"), quartiles.alias("__q"),
        F.min(value).alias("__min"), F.max(value).alias("__max"),
    )
    ends = ends.filter(F.col("__n") > 1).withColumn("__bw", bandwidth(F.col("__n"), F.col("__sd"), F.col("__q")[1] - F.col("__q")[0], F.col("__min")))
    low, high = F.col("__min") - MARGIN * F.col("__bw"), F.col("__max") + MARGIN * F.col("__bw")
    ends = ends.select(*keys, "__bw", low.alias("__low"), ((high - low) / (POINTS - 1)).alias("__step"))
    at = (F.col(value) - F.col("__low")) / F.col("__step")
    left = F.floor(at).cast("int")
    near = F.inline(F.array(F.struct(left.alias("__k"), (1 - (at - left)).alias("__w")), F.struct((left + 1).alias("__k"), (at - left).alias("__w"))))
    placed = df.filter(F.col(value).isNotNull()).join(ends, list(keys)).select(*keys, "__bw", "__low", "__step", near)
    weights = placed.groupBy(*keys, "__k").agg(F.sum("__w").alias("__w"), *[F.max(c).alias(c) for c in ("__bw", "__low", "__step")])
    reach = F.floor(REACH * F.col("__bw") / F.col("__step")).cast("int")
    reached = F.sequence(F.greatest(F.col("__k") - reach, F.lit(0)), F.least(F.col("__k") + reach, F.lit(POINTS - 1)))
    spread = weights.withColumn("__point", F.explode(reached))
    away = (F.col("__point") - F.col("__k")) * F.col("__step") / F.col("__bw")
    kernel = F.col("__w") * F.exp(-0.5 * away * away)
    density = spread.groupBy(*keys, "__point").agg(F.sum(kernel).alias("__d"), F.max(F.col("__low") + F.col("__point") * F.col("__step")).alias("__x"))
    # Relative heights, rounded so that sums in another order make no hills.
    return density.withColumn("__d", F.round(F.col("__d") / F.max("__d").over(Window.partitionBy(*keys)), 9))


def turning_points(density: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Local extremes in order: (keys, ``__i``, ``__x``, ``__d``, ``__top``).

    Equal neighbours count as one point in their middle; the ends are no extremes.
    """
    w = Window.partitionBy(*keys).orderBy("__point")
    steps = density.withColumns({"__p": F.lag("__d").over(w), "__l": F.lag("__x").over(w)})
    steps = steps.filter(F.col("__p").isNull() | (F.col("__p") != F.col("__d")))
    steps = steps.withColumns({"__n": F.lead("__d").over(w), "__end": F.lead("__l").over(w)})
    top = F.col("__d") > F.col("__p")
    turns = steps.filter((F.col("__d") - F.col("__p")) * (F.col("__n") - F.col("__d")) < 0)
    middle = (F.col("__x") + F.col("__end")) / 2
    return turns.select(*keys, F.row_number().over(w).alias("__i"), middle.alias("__x"), "__d", top.alias("__top"))


def usage_limits(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Consumption at or below which a value counts as no usage, 0 if there is no such level; (keys, limit).

    Looks at the density of the lower 70 % of a key's values.  With three or
    more extremes: the valley behind the first mode, if that one lies within the
    lowest 20 % and is higher than a fifth of the highest; rather the valley
    before the first mode that is over three times as high as the mode before it
    and lies above the lowest 10 %; and the valley behind that mode (behind the
    first one if there is none) if it lies below ``STANDBY``.  A single extreme
    below ``STANDBY`` is the limit itself.
    """
    most = df.groupBy(*keys).agg(F.percentile(value, F.lit(LOWER_SHARE)).alias("__most"))
    lower = df.join(most, list(keys)).filter(F.col(value) <= F.col("__most")).select(*keys, value)
    marks = lower.groupBy(*keys).agg(F.percentile(value, F.array(F.lit(FIRST_QUANTILE), F.lit(MODE_QUANTILE))).alias("__m"))
    turns = turning_points(kernel_density(lower, keys, value), keys)
    # A key has at most ``POINTS`` extremes.
    all_ = F.array_sort(F.collect_list(F.struct("__i", "__x", "__d", "__top"))).alias("__t")
    found = marks.join(turns.groupBy(*keys).agg(all_), list(keys), "left")
    t, n = F.col("__t"), F.size("__t")
    place = lambda k: F.get(t, k - 1)["__x"]  # k counts from 1; none beyond the ends
    modes = F.filter(t, lambda x: x["__top"])
    earlier = lambda x: F.get(t, x["__i"] - 3)["__d"]  # two extremes before, as modes and valleys alternate
    matters = F.filter(modes, lambda x: (x["__d"] - earlier(x) > MODE_GROWTH * earlier(x)) & (x["__x"] > F.col("__m")[1]))
    mode = F.get(matters, F.lit(0))["__i"]
    first = F.get(modes, F.lit(0))["__i"]
    near_zero = place(F.coalesce(mode, first)) < STANDBY
    early = (place(F.lit(1)) <= F.col("__m")[0]) & (F.get(t, F.lit(0))["__d"] > FIRST_HEIGHT * F.array_max(F.transform(t, lambda x: x["__d"])))
    limit = (
        F.when((n >= 3) & near_zero, place(F.coalesce(mode, first) + 1))
        .when((n >= 3) & mode.isNotNull(), place(mode - 1))
        .when((n >= 3) & early, place(F.lit(2)))
        .when((n == 1) & (place(F.lit(1)) < STANDBY), place(F.lit(1)))
    )
    return found.select(*keys, F.coalesce(limit, F.lit(0.0)).alias("limit"))


def unused_days(df: DataFrame, limits: DataFrame, keys: Sequence[str], time: str, value: str) -> DataFrame:
    """Days with a value at or below the limit."""
    low = df.join(limits, list(keys)).filter(F.col(value) <= F.col("limit"))
    return low.select(*keys, F.to_date(time).alias("day")).distinct()
