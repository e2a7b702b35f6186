"""Change-point detection on model residuals (OLS-CUSUM).

A segment is (series, period).  Series sit on a calendar grid, so a segment's
windows are bounded.  The detection loops handle all series of the table in
each round; only the emptiness of a round's result reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from meterloom.functions.recovery import cut_lineage

# Critical value of the scaled CUSUM per significance level.
CRITICAL_VALUES = {
    0.00001: 25.0,
    0.0001: 10.0,
    0.001: 4.5,
    0.005: 4.0,
    0.01: 3.833,
    0.05: 3.375,
    0.1: 3.133,
}


def critical_value(alpha: float) -> float:
    try:
        return CRITICAL_VALUES[alpha]
    except KeyError:
        raise ValueError(f"no critical value for alpha {alpha}") from None


def constant_residuals(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Value minus the mean of its segment."""
    mean = F.avg(value).over(Window.partitionBy(*keys))
    return df.withColumn("residual", F.col(value) - mean)


def scaled_cusum(df: DataFrame, keys: Sequence[str], time: str, residual: str = "residual") -> DataFrame:
    """Running residual sum over sd*sqrt(n), divided by its boundary sqrt(t(1-t)).

    ``lambda`` of a row covers the rows before it, so a peak marks the first row
    of a new regime; the first row of a segment has 0.
    """
    whole = Window.partitionBy(*keys)
    w = whole.orderBy(time)
    rows = df.withColumns(
        {
            "__n": F.count("*").over(whole),
            "__sd": F.stddev_pop(residual).over(whole),
            "__i": F.row_number().over(w) - 1,
            "__sum": F.sum(residual).over(w.rowsBetween(Window.unboundedPreceding, -1)),
        }
    )
    t = F.col("__i") / F.col("__n")
    shape = F.sqrt(t * (1 - t))
    scaled = F.col("__sum") / (F.col("__sd") * F.sqrt(F.col("__n")))
    lam = F.when((F.col("__i") == 0) | (F.col("__sd") < 1e-12), F.lit(0.0)).otherwise(scaled / shape)
    return rows.withColumn("lambda", lam).drop("__n", "__sd", "__i", "__sum")


def strongest_change(df: DataFrame, keys: Sequence[str], time: str, alpha: float | None = None) -> DataFrame:
    """Row with the greatest absolute ``lambda`` per segment (earliest on ties), optionally only if significant."""
    size = F.round(F.abs(F.col("lambda")), 9)
    best = df.groupBy(*keys).agg(
        F.min_by(F.struct(F.col(time).alias("event"), size.alias("significance")), F.struct(-size, F.col(time))).alias("b")
    )
    out = best.select(*keys, "b.event", "b.significance")
    return out if alpha is None else out.filter(F.col("significance") >= critical_value(alpha))


def significance_levels(changes: DataFrame) -> DataFrame:
    """Each change with every tabulated level and whether it passes."""
    levels = F.array(*[F.struct(F.lit(a).alias("alpha"), F.lit(c).alias("critical")) for a, c in CRITICAL_VALUES.items()])
    return changes.select("*", F.inline(levels)).withColumn("significant", F.col("significance") >= F.col("critical"))


def number_periods(df: DataFrame, events: DataFrame, keys: Sequence[str], time: str, out: str = "period") -> DataFrame:
    """Period number of each row: how many events of its series are at or before it.

    Events are rows of the series' own grid, so an equi-join on (series, time)
    marks them and a running count numbers the periods.
    """
    marks = events.select(*keys, F.col("event").alias(time), F.lit(1).alias("__e")).distinct()
    w = Window.partitionBy(*keys).orderBy(time).rowsBetween(Window.unboundedPreceding, 0)
    marked = df.join(marks, [*keys, time], "left")
    return marked.withColumn(out, F.coalesce(F.sum("__e").over(w), F.lit(0)).cast("int")).drop("__e")


def segmented_fit(df: DataFrame, events: DataFrame, keys: Sequence[str], time: str, value: str) -> DataFrame:
    """Separate constant model for every period between events."""
    rows = number_periods(df, events, keys, time)
    return rows.groupBy(*keys, "period").agg(
        F.min(time).alias("period_from"),
        F.max(time).alias("period_to"),
        F.count("*").alias("n"),
        F.avg(value).alias("mean"),
        F.stddev_pop(value).alias("sd"),
    )


def _prefix_sums(df: DataFrame, keys: Sequence[str], time: str, value: str) -> DataFrame:
    """Rows of each series with their place and the sums of all rows before them, written once.

    Values are taken from the mean of their series, so that sums of squares lose few digits.
    """
    d = F.col(value) - F.col("__mean")
    rows = df.select(*keys, F.col(time).alias("event"), F.col(value)).filter(F.col(value).isNotNull())
    whole = Window.partitionBy(*keys)
    before = whole.orderBy("event").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({"__mean": F.avg(value).over(whole), "__n": F.count("*").over(whole)})
    rows = rows.select(
        *keys, "event", "__n", (F.row_number().over(whole.orderBy("event")) - 1).alias("__i"),
        F.coalesce(F.sum(d).over(before), F.lit(0.0)).alias("__s"), F.coalesce(F.sum(d * d).over(before), F.lit(0.0)).alias("__q"),
        F.sum(d).over(whole).alias("__s_all"), F.sum(d * d).over(whole).alias("__q_all"),
    )
    return cut_lineage(rows)


_ENDS = ["__a", "__sa", "__qa", "__b", "__sb", "__qb"]


def _whole_series(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each series as one segment: first place, place after the last, and the sums before both."""
    zero = F.lit(0.0)
    ends = rows.groupBy(*keys).agg(F.max("__n").alias("__b"), F.max("__s_all").alias("__sb"), F.max("__q_all").alias("__qb"))
    return ends.select(*keys, F.lit(0).alias("__a"), zero.alias("__sa"), zero.alias("__qa"), F.col("__b").cast("int").alias("__b"), "__sb", "__qb")


def _significant(rows: DataFrame, segments: DataFrame, keys: Sequence[str], alpha: float) -> DataFrame:
    """Segments with a significant change: the row with the greatest scaled CUSUM, the earliest on ties.

    The running residual sum of a segment is a difference of prefix sums, so only the rows of the given segments are read,
    without ordering them.
    """
    inside = rows.join(segments, list(keys)).filter((F.col("__i") > F.col("__a")) & (F.col("__i") < F.col("__b")))
    size = (F.col("__b") - F.col("__a")).cast("double")
    mean = (F.col("__sb") - F.col("__sa")) / size
    spread = (F.col("__qb") - F.col("__qa")) / size - mean * mean
    sd = F.sqrt(F.greatest(spread, F.lit(0.0)))
    past = (F.col("__i") - F.col("__a")).cast("double")
    t = past / size
    # Below this the spread is rounding of the sums.
    flat = spread <= 1e-13 * (mean * mean + F.col("__qb") / F.col("__b"))
    residual = F.col("__s") - F.col("__sa") - past * mean
    lam = F.when(flat, F.lit(0.0)).otherwise(residual / (sd * F.sqrt(size)) / F.sqrt(t * (1 - t)))
    significance = F.round(F.abs(lam), 9)
    at = F.struct("event", F.col("__i").alias("__at"), F.col("__s").alias("__se"), F.col("__q").alias("__qe"), significance.alias("significance"))
    best = inside.groupBy(*keys, *_ENDS).agg(F.min_by(at, F.struct(-significance, F.col("event"))).alias("__e"))
    return best.select(*keys, *_ENDS, "__e.*").filter(F.col("significance") >= critical_value(alpha))


def _halves(split: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The two segments on both sides of a change; their sums are known from the row of the change."""
    left = F.struct("__a", "__sa", "__qa", F.col("__at").alias("__b"), F.col("__se").alias("__sb"), F.col("__qe").alias("__qb"))
    right = F.struct(F.col("__at").alias("__a"), F.col("__se").alias("__sa"), F.col("__qe").alias("__qa"), "__b", "__sb", "__qb")
    return split.select(*keys, F.inline(F.array(left, right)))


def detect_events(
    df: DataFrame, keys: Sequence[str], time: str, value: str, alpha: float, every_segment: bool = False
) -> DataFrame:
    """Add significant changes until no segment has one; returns (keys, event, significance, round).

    Per round each series gains its strongest change, or with ``every_segment``
    all of its segments are split at once (binary recursion level by level).
    The work table holds one row per open segment, that is a segment with a
    significant change not yet used; a round reads only the rows of segments
    that the round before has split.  A split leaves two shorter segments, so
    the loop ends.
    """
    rows = _prefix_sums(df, keys, time, value)
    waiting, events, turn = None, None, 0
    fresh = _whole_series(rows, keys)
    while True:
        turn += 1
        found = _significant(rows, fresh, keys, alpha)
        pool = cut_lineage(found if waiting is None else waiting.unionByName(found))
        if every_segment:
            split, waiting = pool, None
        else:
            top = F.max(F.struct("significance", "event")).over(Window.partitionBy(*keys))
            ranked = pool.withColumn("__top", F.struct("significance", "event") == top)
            split, waiting = ranked.filter("__top").drop("__top"), ranked.filter("not __top").drop("__top")
        new = split.select(*keys, "event", "significance", F.lit(turn).alias("round"))
        events = new if events is None else events.unionByName(new)
        if pool.isEmpty():
            return events
        fresh = _halves(split, keys)


def confirm_events(df: DataFrame, events: DataFrame, keys: Sequence[str], time: str, value: str, alpha: float) -> DataFrame:
    """Re-estimate every event from its two neighbouring periods; move or drop it until all stand.

    Returns (keys, event, converged, rounds).  A series is done when a round
    leaves its events as they are.  Rounds can also lead back to events that a
    series had before; it then keeps those of its last round, with ``converged``
    false.  A series has finitely many sets of events, so every one ends.
    """
    rows = _prefix_sums(df, keys, time, value)
    marks = events.select(*keys, "event").distinct()
    places = rows.select(*keys, "event", "__i", "__s", "__q")
    current = cut_lineage(places.join(marks, [*keys, "event"], "left_semi"))
    bounds = cut_lineage(_whole_series(rows, keys))
    seen, done, turn = _states(current, keys), [], 0
    while not current.isEmpty():
        turn += 1
        w = Window.partitionBy(*keys).orderBy("__i")
        around = current.withColumns({"__p": F.lag(F.struct("__i", "__s", "__q")).over(w), "__n": F.lead(F.struct("__i", "__s", "__q")).over(w)})
        around = around.drop("__i", "__s", "__q", "event").join(bounds, list(keys))
        side = lambda end, names: [F.coalesce(end[x], F.col(c)).alias(c) for x, c in zip(("__i", "__s", "__q"), names, strict=True)]
        segments = around.select(*keys, *side(F.col("__p"), _ENDS[:3]), *side(F.col("__n"), _ENDS[3:]))
        # The rows of the neighbourhoods: each is in that of the event before it and that of the event after it.
        moved = _significant(rows, segments, keys, alpha)
        moved = cut_lineage(moved.select(*keys, "event", F.col("__at").alias("__i"), F.col("__se").alias("__s"), F.col("__qe").alias("__q")).distinct())
        before, after = _states(current, keys), _states(moved, keys)
        state = before.withColumnRenamed("__state", "__was").join(after, list(keys), "left")
        state = state.join(seen.groupBy(*keys, "__state").agg(F.lit(True).alias("__again")), [*keys, "__state"], "left")
        stable = F.coalesce(F.col("__state") == F.col("__was"), F.lit(False))
        ended = stable | F.coalesce("__again", F.lit(False)) | F.col("__state").isNull()
        state = cut_lineage(state.select(*keys, (stable | F.col("__state").isNull()).alias("converged"), ended.alias("__ended")))
        ended = state.filter("__ended").select(*keys, "converged", F.lit(turn).alias("rounds"))
        done.append(moved.select(*keys, "event").join(ended, list(keys)))
        seen = cut_lineage(seen.unionByName(after))
        current = moved.join(state.filter("not __ended").select(*keys), list(keys), "left_semi")
    if not done:
        return current.select(*keys, "event", F.lit(True).alias("converged"), F.lit(0).alias("rounds"))
    return reduce(DataFrame.unionByName, done)


def _states(events: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The set of events of each series as one value."""
    return events.groupBy(*keys).agg(F.concat_ws(",", F.transform(F.array_sort(F.collect_set("__i")), lambda i: i.cast("string"))).alias("__state"))
