"""Monthly aggregation and comparison between buildings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from meterloom.functions.quantiles import exact_percentiles
from meterloom.operators.grid import fill_grid

# Peer-group percentiles and the smallest group that is reported.
BREAKS = [5, 25, 50, 75, 90]
MIN_GROUP = 10


def monthly_means(df: DataFrame, keys: Sequence[str], time: str, value: str) -> DataFrame:
    """Mean of the daily values and number of days per month."""
    return df.groupBy(*keys, F.trunc(time, "month").alias("month")).agg(
        F.avg(value).alias(value), F.count(value).alias("n_days")
    )


def month_grid(monthly: DataFrame, keys: Sequence[str], month: str = "month") -> DataFrame:
    """Every month between a key's first and last one; a few hundred rows per key at most."""
    return fill_grid(monthly, keys, month, "interval 1 month")


def annual_mean(monthly: DataFrame, keys: Sequence[str], value: str, months: int = 12) -> DataFrame:
    """Mean over the last ``months`` rows of the month grid; empty months are rows without value."""
    last = monthly.groupBy(*keys).agg(F.max("month").alias("last_month"))
    recent = monthly.join(last, list(keys)).filter(
        F.months_between("last_month", "month") < months
    )
    return recent.groupBy(*keys, "last_month").agg(F.avg(value).alias("annual"), F.count(value).alias("n_months"))


def by_area(df: DataFrame, value: str, area: str, out: str) -> DataFrame:
    """Value per unit of area; buildings without a positive area are left out."""
    return df.filter(F.col(area) > 0).withColumn(out, F.col(value) / F.col(area))


def with_criteria(df: DataFrame, criteria: dict[str, Sequence[str]]) -> DataFrame:
    """Each row once under every grouping criterion, with the joined criterion values."""
    options = F.array(
        *[
            F.struct(
                F.lit(name).alias("criteria"),
                F.concat_ws("~", *[F.col(c).cast("string") for c in cols]).alias("criteria_values"),
            )
            for name, cols in criteria.items()
        ]
    )
    return df.select("*", F.inline(options))


def peer_percentiles(
    df: DataFrame, keys: Sequence[str], value: str, min_size: int = MIN_GROUP, breaks: Sequence[int] = BREAKS
) -> DataFrame:
    """Percentiles of every peer group with at least ``min_size`` rows."""
    found = exact_percentiles(df, keys, value, [b / 100 for b in breaks], [f"p{b}" for b in breaks], "n_rows")
    return found.filter(F.col("n_rows") >= min_size)


def rolling_annual(df: DataFrame, keys: Sequence[str], value: str, rows: int = 12) -> DataFrame:
    """Mean of the last ``rows`` month rows of each building (month grid, so short windows)."""
    w = Window.partitionBy(*keys).orderBy("month").rowsBetween(1 - rows, 0)
    return df.withColumn("annual", F.avg(value).over(w))


def group_cost(
    own: DataFrame, peers: DataFrame, on: Sequence[str], value: str, average: str, dispersion: str, fixed: float = 50.0
) -> DataFrame:
    """Cost of belonging to a peer group: distance to its mean weighted by its dispersion.

    ``own`` is shuffled whatever the size of its file: a stored table has far more rows than its file tells.
    """
    part = fixed / 100
    diff = F.abs((F.col(value) - F.col(average)) / F.nullif(F.col(average), F.lit(0.0))) * 100
    return (
        own.hint("merge")
        .join(peers, list(on))
        .withColumn("diff", diff)
        .withColumn("cost", F.col(dispersion) * part + F.col(dispersion) * (1 - part) * F.col("diff"))
    )


def rank_by(df: DataFrame, keys: Sequence[str], order: Sequence, out: str) -> DataFrame:
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
