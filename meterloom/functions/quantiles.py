"""Exact percentiles, for groups of any size.

The built-in ``percentile`` keeps every distinct value of a group in one hash
map.  That suits groups bounded by a calendar grid (``grid_percentiles``).  A
peer group or an energy type has no such bound and may hold a third of all
rows, so ``exact_percentiles`` measures the groups first: those within a bound
take the built-in aggregate, for larger ones the wanted ranks are located by
histograms that are refined only where a bucket with a wanted rank is over the
bound, and only the values of the last buckets are ranked, each bucket by
itself.  Both interpolate linearly between closest ranks.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .recovery import cut_lineage

# Values that one task ranks or keeps in a map, and buckets of a histogram.
GROUP_VALUES = 200_000
BUCKETS = 256


def _finite(v: Column) -> Column:
    v = v.cast("double")
    return F.when(F.abs(v) < float("inf"), v)


def _same(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in names])


def exact_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Sequence[float],
    names: Sequence[str],
    size: str | None = None,
    weight: str | None = None,
    bound: int = GROUP_VALUES,
) -> DataFrame:
    """One row per key with the interpolated percentiles of the finite values.

    ``size`` names an extra column with the number of rows, nulls included; a
    row counts ``weight`` times.  ``df`` is read at least twice: pass a stored
    table or one that is cheap to read.
    """
    v, w = _finite(F.col(value)), F.col(weight) if weight else F.lit(1)
    rows = df.select(*keys, v.alias("__v"), w.cast("long").alias("__w"))
    known = F.when(F.col("__v").isNotNull(), F.col("__w"))
    sizes = rows.groupBy(*keys).agg(
        F.sum("__w").alias("__size"), F.sum(known).alias("__n"), F.count("__v").alias("__rows"),
        F.min("__v").alias("__lo"), F.max("__v").alias("__hi"),
    )
    sizes = cut_lineage(sizes)
    large = sizes.filter(F.col("__rows") > bound)
    extra = [F.col("__size").alias(size)] if size else []
    if large.isEmpty():
        return _kept_in_maps(rows, keys, probs, names).select(*keys, *names, *extra)
    few = rows.join(large, _same(rows, large, keys), "left_anti")
    found = [_kept_in_maps(few, keys, probs, names), _ranked(rows, keys, large, probs, names, bound)]
    return found[0].unionByName(found[1]).select(*keys, *names, *extra)


def _kept_in_maps(rows: DataFrame, keys: Sequence[str], probs: Sequence[float], names: Sequence[str]) -> DataFrame:
    wanted = F.percentile("__v", F.array(*[F.lit(float(p)) for p in probs]), F.col("__w")).alias("__p")
    out = rows.groupBy(*keys).agg(wanted, F.sum("__w").alias("__size"))
    return out.select(*keys, *[F.col("__p")[i].alias(n) for i, n in enumerate(names)], "__size")


def _ranked(
    rows: DataFrame, keys: Sequence[str], groups: DataFrame, probs: Sequence[float], names: Sequence[str], bound: int
) -> DataFrame:
    """Percentiles of groups over the bound; ``groups`` has their sizes and ends."""
    rows = rows.filter("__v IS NOT NULL")
    h = [(F.col("__n") - 1) * F.lit(float(p)) for p in probs]
    ranks = [F.struct(F.lit(2 * i + side).alias("i"), (end(x) + 1).cast("long").alias("rank")) for i, x in enumerate(h) for side, end in enumerate((F.floor, F.ceil))]
    # Each wanted rank with the interval of values that holds it, the number of values before that and in it.
    wanted = groups.select(*keys, "__lo", "__hi", F.lit(0).cast("long").alias("__before"), F.col("__rows").alias("__in"), F.inline(F.array(*ranks)))
    wanted = cut_lineage(wanted)
    # Two intervals of a group are equal or apart, so the lower end names one.
    place = [*keys, "__lo"]
    while True:
        wide = wanted.filter((F.col("__in") > bound) & (F.col("__lo") < F.col("__hi")))
        if wide.isEmpty():
            break
        inside = _inside(rows, wide, keys)
        # Halves, so that the width of an interval does not overflow.
        half = lambda c: F.col(c) / 2
        bucket = F.floor((half("__v") - half("__lo")) / (half("__hi") - half("__lo")) * BUCKETS)
        parts = inside.groupBy(*place, F.least(bucket, F.lit(BUCKETS - 1)).alias("__bucket")).agg(
            F.sum("__w").alias("__sum"), F.count("*").alias("__count"), F.min("__v").alias("__a"), F.max("__v").alias("__b")
        )
        upto = F.sum("__sum").over(Window.partitionBy(*place).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, 0))
        parts = parts.withColumn("__upto", upto)
        hit = wide.join(parts, _same(wide, parts, place)).select(
            *[wide[c] for c in keys], parts["__a"].alias("__lo"), parts["__b"].alias("__hi"),
            (F.col("__before") + F.col("__upto") - F.col("__sum")).alias("__before"), F.col("__count").alias("__in"), "i", "rank",
            (F.col("__before") + F.col("__upto")).alias("__to"),
        )
        hit = hit.filter((F.col("__before") < F.col("rank")) & (F.col("rank") <= F.col("__to"))).drop("__to")
        done = wanted.filter((F.col("__in") <= bound) | (F.col("__lo") == F.col("__hi")))
        wanted = cut_lineage(done.unionByName(hit))
    single = wanted.filter(F.col("__lo") == F.col("__hi")).select(*keys, "i", F.col("__lo").alias("__v"))
    rest = wanted.filter(F.col("__lo") < F.col("__hi"))
    values = _inside(rows, rest, keys).groupBy(*place, "__v").agg(F.sum("__w").alias("__sum"))
    upto = F.sum("__sum").over(Window.partitionBy(*place).orderBy("__v").rowsBetween(Window.unboundedPreceding, 0))
    values = values.withColumn("__upto", upto)
    to = F.col("__before") + F.col("__upto")
    at = (to - F.col("__sum") < F.col("rank")) & (F.col("rank") <= to)
    ranked = rest.join(values, _same(rest, values, place)).filter(at).select(*[rest[c] for c in keys], "i", values["__v"])
    ends = single.unionByName(ranked).groupBy(*keys).agg(
        *[F.max(F.when(F.col("i") == k, F.col("__v"))).alias(f"__e{k}") for k in range(2 * len(probs))]
    )
    cols = []
    for i, x in enumerate(h):
        a, b = F.col(f"__e{2 * i}"), F.col(f"__e{2 * i + 1}")
        cols.append((a + (b - a) * (x - F.floor(x))).alias(names[i]))
    return ends.join(groups, _same(ends, groups, keys)).select(*[ends[c] for c in keys], *cols, "__size")


def _inside(rows: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Values in the distinct intervals of the wanted ranks; each is in one interval at most."""
    spans = wanted.select(*keys, "__lo", "__hi").distinct()
    on = _same(rows, spans, keys) & rows["__v"].between(spans["__lo"], spans["__hi"])
    return rows.join(spans, on).select(*[rows[c] for c in keys], "__lo", "__hi", "__v", "__w")


def grid_percentiles(
    df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float], names: Sequence[str]
) -> DataFrame:
    """Percentiles of groups whose size a calendar grid bounds; one pass for all of them."""
    wanted = F.percentile(value, F.array(*[F.lit(float(p)) for p in probs])).alias("__p")
    return df.groupBy(*keys).agg(wanted).select(*keys, *[F.col("__p")[i].alias(n) for i, n in enumerate(names)])
