"""Ordered computations over a series that may not fit one task.

A window partitioned by the series key alone sends every row of a key to one
task.  That is fine once a series sits on a calendar grid (its length is then
bounded by look-back / resolution), but not for raw readings, where one meter
may own a third of the table.  ``ordered_scan`` therefore works in two levels:
inside ``(key, chunk)`` with an ordinary window, and across chunks on a summary
with one row per ``(key, chunk)``.  ``chunk`` is any column that is monotone in
the order, normally a truncated timestamp.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_CHUNK = "__chunk"
_BEFORE = (Window.unboundedPreceding, -1)
_UPTO = (Window.unboundedPreceding, 0)
_ALL = (Window.unboundedPreceding, Window.unboundedFollowing)


@dataclass(frozen=True)
class Step:
    """One output of a scan.

    kind: ``sum``/``count``/``max`` up to and including the row, ``max_before``
    over strictly earlier rows, ``last``/``next_value`` for the nearest non-null
    value at or before/after the row, ``prev``/``next`` for the adjacent row,
    ``total`` for the sum over the whole key.
    """

    out: str
    kind: str
    value: Column


def _both_ways(keys: Sequence[str], order: Sequence[str]):
    """Forward and reversed window.

    Looking ahead uses the reversed one: a frame that grows with the row is
    computed once per row, one that ends at the last row is recomputed each time.
    """
    base = Window.partitionBy(*keys)
    return base.orderBy(*order), base.orderBy(*[F.desc(c) for c in order])


def _inside(step: Step, w, back) -> Column:
    v = step.value
    return {
        "sum": lambda: F.sum(v).over(w.rowsBetween(*_UPTO)),
        "total": lambda: F.sum(v).over(w.rowsBetween(*_ALL)),
        "count": lambda: F.count(v).over(w.rowsBetween(*_UPTO)),
        "max": lambda: F.max(v).over(w.rowsBetween(*_UPTO)),
        "max_before": lambda: F.max(v).over(w.rowsBetween(*_BEFORE)),
        "last": lambda: F.last(v, ignorenulls=True).over(w.rowsBetween(*_UPTO)),
        "next_value": lambda: F.last(v, ignorenulls=True).over(back.rowsBetween(*_UPTO)),
        "prev": lambda: F.lag(F.struct(v.alias("v")), 1).over(w),
        "next": lambda: F.lead(F.struct(v.alias("v")), 1).over(w),
    }[step.kind]()


def _summary(step: Step, at: Column) -> Column:
    v = step.value
    known = F.when(v.isNotNull(), at)
    return {
        "sum": lambda: F.sum(v),
        "total": lambda: F.sum(v),
        "count": lambda: F.count(v),
        "max": lambda: F.max(v),
        "max_before": lambda: F.max(v),
        "last": lambda: F.max_by(v, known),
        "next_value": lambda: F.min_by(v, known),
        "prev": lambda: F.max_by(F.struct(v.alias("v")), at),
        "next": lambda: F.min_by(F.struct(v.alias("v")), at),
    }[step.kind]()


def _carry(step: Step, s: Column, w, back) -> Column:
    return {
        "sum": lambda: F.sum(s).over(w.rowsBetween(*_BEFORE)),
        "total": lambda: F.sum(s).over(w.rowsBetween(*_ALL)),
        "count": lambda: F.sum(s).over(w.rowsBetween(*_BEFORE)),
        "max": lambda: F.max(s).over(w.rowsBetween(*_BEFORE)),
        "max_before": lambda: F.max(s).over(w.rowsBetween(*_BEFORE)),
        "last": lambda: F.last(s, ignorenulls=True).over(w.rowsBetween(*_BEFORE)),
        "next_value": lambda: F.last(s, ignorenulls=True).over(back.rowsBetween(*_BEFORE)),
        "prev": lambda: F.lag(s, 1).over(w),
        "next": lambda: F.lead(s, 1).over(w),
    }[step.kind]()


def _combine(step: Step, inside: Column, carry: Column) -> Column:
    if step.kind == "total":
        return carry
    if step.kind == "sum":
        return F.coalesce(inside + carry, inside, carry)
    if step.kind == "count":
        return inside + F.coalesce(carry, F.lit(0))
    if step.kind in ("max", "max_before"):
        return F.greatest(inside, carry)
    return F.coalesce(inside, carry)


def ordered_scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    steps: Sequence[Step],
    chunk: Column | None = None,
) -> DataFrame:
    """Add one column per step, ordered by ``order`` inside ``keys``.

    Without ``chunk`` the key is one window partition: use it only for series
    on a calendar grid.  With ``chunk`` no task holds more than one chunk.
    """
    unwrap = {s.out: F.col(f"{s.out}.v") for s in steps if s.kind in ("prev", "next")}
    if chunk is None:
        w, back = _both_ways(keys, order)
        out = df.withColumns({s.out: _inside(s, w, back) for s in steps})
        return out.withColumns(unwrap) if unwrap else out

    parts = df.withColumn(_CHUNK, chunk)
    at = F.struct(*order)
    inner = _both_ways([*keys, _CHUNK], order)
    across = _both_ways(keys, [_CHUNK])
    carried = (
        parts.groupBy(*keys, _CHUNK)
        .agg(*[_summary(s, at).alias(f"__s{i}") for i, s in enumerate(steps)])
        .select(*keys, _CHUNK, *[_carry(s, F.col(f"__s{i}"), *across).alias(f"__c{i}") for i, s in enumerate(steps)])
    )
    inside = parts.withColumns({f"__i{i}": _inside(s, *inner) for i, s in enumerate(steps)})
    joined = inside.join(carried, [*keys, _CHUNK], "left")
    out = joined.withColumns(
        {s.out: _combine(s, F.col(f"__i{i}"), F.col(f"__c{i}")) for i, s in enumerate(steps)}
    )
    if unwrap:
        out = out.withColumns(unwrap)
    helper = [f"__{p}{i}" for p in "ic" for i in range(len(steps))]
    return out.drop(_CHUNK, *helper)


def spread_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Deal rows out by key before a step makes many rows of each.

    A number of partitions that is named is not merged by adaptive execution, which would go by the rows before the step.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def first_difference(df: DataFrame, keys, order, value: str, out: str, chunk: Column | None = None) -> DataFrame:
    """``value`` minus the previous row's value; the first row of a key is null."""
    prev = ordered_scan(df, keys, order, [Step("__prev", "prev", F.col(value))], chunk)
    return prev.withColumn(out, F.col(value) - F.col("__prev")).drop("__prev")


def running_total(df: DataFrame, keys, order, value: str, out: str, chunk: Column | None = None) -> DataFrame:
    """Cumulative sum, turning movements into a counter."""
    return ordered_scan(df, keys, order, [Step(out, "sum", F.col(value))], chunk)


def most_frequent(df: DataFrame, keys: Sequence[str], value: str, out: str, count: str | None = None) -> DataFrame:
    """Mode per key, smallest value on ties; counts are combined before the shuffle."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("__n"))
    best = counts.groupBy(*keys).agg(
        F.min_by(F.struct(F.col(value), F.col("__n")), F.struct(-F.col("__n"), F.col(value))).alias("__best")
    )
    cols = [F.col(f"__best.{value}").alias(out)]
    if count:
        cols.append(F.col("__best.__n").alias(count))
    return best.select(*keys, *cols)
