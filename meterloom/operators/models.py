"""Grouped consumption models as aggregates: fits, selection, bands, backtests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from meterloom.functions import scalars as S
from meterloom.functions import stats
from meterloom.functions.quantiles import grid_percentiles
from meterloom.functions.recovery import cut_lineage

# Start of the change-point search and its grid size.
START_CHANGE_POINT = 15.5
CHANGE_POINT_STEPS = 20

# Fewest rows per model and number of parameters.
MIN_ROWS = {"constant": 2, "line": 5, "heating": 6}
N_PARAMS = {"constant": 1, "line": 2, "heating": 3}

# Percentile bands of the baselines.
BANDS = [5, 25, 75, 95]

ALL_MODELS = ("constant", "line", "heating")


# Columns of a fitted model besides its keys.
_PARAMS = ("model", "n_params", "n", "mean", "intercept", "slope", "change_point", "sse")


def _model(model: str, valid: Column, n, mean, sse, intercept=None, slope=None, change_point=None) -> Column:
    """One candidate as a struct, null where it has too few rows."""
    blank = F.lit(None).cast("double")
    col = lambda c, other: other if c is None else F.col(c) if isinstance(c, str) else c
    mean = col(mean, blank)
    values = [
        F.lit(model),
        F.lit(N_PARAMS[model]),
        col(n, blank),
        mean,
        col(intercept, mean),
        col(slope, blank),
        col(change_point, blank),
        F.greatest(col(sse, blank), F.lit(0.0)),
    ]
    return F.when(valid, F.struct(*[v.alias(name) for v, name in zip(values, _PARAMS, strict=True)]))


def _constant() -> Column:
    return _model("constant", F.col("__cn") >= MIN_ROWS["constant"], "__cn", "__cmean", "__csse")


def _line() -> Column:
    slope = F.col("__sxy") / F.nullif(F.col("__sxx"), F.lit(0.0))
    valid = (F.col("__n") >= MIN_ROWS["line"]) & slope.isNotNull()
    return _model("line", valid, "__n", "__mean", F.col("__syy") - slope * F.col("__sxy"), F.col("__mean") - slope * F.col("__tmean"), slope)


def _heating() -> Column:
    return _model(
        "heating",
        F.col("__n") >= MIN_ROWS["heating"],
        "__n",
        "__mean",
        "__sse",
        F.col("__mean") - F.col("__slope") * F.col("__xmean"),
        "__slope",
        "__cp",
    )


def _totals(value: str, temp: str | None) -> dict[str, Column]:
    """Moments of a group from which its constant and its line follow, and the range of a change point."""
    y = F.col(value)
    out = {"__cn": F.count(y), "__cmean": F.avg(y), "__csse": F.var_pop(y) * F.count(y)}
    if temp is not None:
        x = F.col(temp)
        known = F.when(y.isNotNull(), x)
        out |= {
            "__n": F.regr_count(y, x),
            "__mean": F.avg(F.when(x.isNotNull(), y)),
            "__tmean": F.avg(known),
            "__syy": F.regr_syy(y, x),
            "__sxx": F.regr_sxx(y, x),
            "__sxy": F.regr_sxy(y, x),
            "__low": F.min(known),
            "__high": F.max(known),
        }
    return out


def _bent(df: DataFrame, cp: Column, n: Column, syy: Column, m: Column, t: Column, tt: Column, y: Column, ty: Column) -> DataFrame:
    """Add the line on ``greatest(cp - t, 0)`` of a group of ``n`` rows, from moments of its ``m`` rows below the change point.

    ``t`` and ``tt`` are sums of temperatures and their squares from any origin, ``y`` and ``ty`` sums of deviations from the
    group's mean and of their products.  Written with the mean temperature below, so that few rows lose no digits.  One
    column a step: as one expression, each step would be computed again wherever it is used.
    """
    c = lambda name: F.col(f"__b_{name}")
    out = df.withColumns({f"__b_{k}": v for k, v in {"cp": cp, "n": n, "syy": syy, "m": m, "t": t, "tt": tt, "y": y, "ty": ty}.items()})
    out = out.withColumn("__b_mid", F.when(c("m") > 0, c("t") / c("m")).otherwise(c("cp")))
    out = out.withColumns({"__b_off": c("cp") - c("mid"), "__b_rest": c("tt") - c("t") * c("mid"), "__b_cross": c("y") * c("mid") - c("ty")})
    out = out.withColumn("__b_sx", c("m") * c("off"))
    out = out.withColumns({"__b_sxx": c("sx") * c("off") + c("rest") - c("sx") * c("sx") / c("n"), "__b_sxy": c("y") * c("off") + c("cross")})
    out = out.withColumn("__slope", F.when(c("sxx") < 1e-9, F.lit(0.0)).otherwise(c("sxy") / c("sxx")))
    out = out.withColumns({"__sse": c("syy") - F.col("__slope") * c("sxy"), "__xmean": c("sx") / c("n")})
    return out.withColumn("__order", F.round(F.col("__sse") / F.greatest(c("syy"), F.lit(1e-9)), 9))


def _runs(first: Column, last: Column) -> Column:
    """Whole numbers from ``first`` to ``last``, none if ``last`` is less."""
    none = F.array().cast("array<int>")
    return F.when(first <= last, F.sequence(first.cast("int"), last.cast("int"))).otherwise(none)


# Candidate that is no step of the grid.
_START = -1


def _grid_pass(df: DataFrame, keys: Sequence[str], value: str, temp: str, groups: DataFrame, low: Column, high: Column) -> DataFrame:
    """Add the best change point of a 20-step grid to each group; the start value, then the lowest one wins ties.

    A row only says between which two steps it lies: rows are summed by that bin, with map-side combine, and the moments
    below every candidate are running sums over at most 21 bins.  ``groups`` has :func:`_totals`.
    """
    step = (high - low) / (CHANGE_POINT_STEPS - 1)
    carried = [c for c in groups.columns if c not in keys]
    rows = df.join(groups.withColumns({"__from": low, "__step": step}), list(keys))
    t = F.when(F.col(value).isNotNull(), F.col(temp))
    bin_ = F.least(F.greatest(F.floor((t - F.col("__from")) / F.nullif(F.col("__step"), F.lit(0.0))) + 1, F.lit(0)), F.lit(CHANGE_POINT_STEPS))
    dt, dy, early = t - F.col("__low"), F.col(value) - F.col("__mean"), t < START_CHANGE_POINT
    rows = rows.select(
        *keys, *carried, "__from", "__step", dt.alias("__t"), dy.alias("__y"), early.alias("__early"),
        F.coalesce(bin_, F.lit(CHANGE_POINT_STEPS)).cast("int").alias("__bin"),
    )
    rows = rows.withColumn("__y", F.when(F.col("__t").isNotNull(), F.col("__y")))
    sums = {"m": F.col("__t") * 0 + 1, "t": F.col("__t"), "tt": F.col("__t") * F.col("__t"), "y": F.col("__y"), "ty": F.col("__t") * F.col("__y")}
    zero = F.lit(0.0)
    binned = rows.groupBy(*keys, "__bin").agg(
        *[F.max(c).alias(c) for c in (*carried, "__from", "__step")],
        *[F.coalesce(F.sum(v), zero).alias(f"__{c}") for c, v in sums.items()],
        *[F.coalesce(F.sum(F.when(F.col("__early"), v)), zero).alias(f"__e{c}") for c, v in sums.items()],
    )
    w = Window.partitionBy(*keys)
    upto = w.orderBy("__bin")
    running = upto.rowsBetween(Window.unboundedPreceding, 0)
    binned = binned.withColumns(
        {f"__{c}": F.sum(f"__{c}").over(running) for c in sums}
        | {f"__e{c}": F.sum(f"__e{c}").over(w) for c in sums}
        | {"__next": F.coalesce(F.lead("__bin").over(upto), F.lit(CHANGE_POINT_STEPS)), "__first": F.row_number().over(upto) == 1}
    )
    start = F.when(F.col("__first"), F.array(F.lit(_START))).otherwise(F.array().cast("array<int>"))
    options = F.concat(start, _runs(F.col("__bin"), F.col("__next") - 1))
    options = binned.withColumn("__i", F.explode(options))
    own = F.col("__i") == _START
    cp = F.when(own, F.lit(START_CHANGE_POINT)).otherwise(F.col("__from") + F.col("__i") * F.col("__step"))
    moments = [F.when(own, F.col(f"__e{c}")).otherwise(F.col(f"__{c}")) for c in sums]
    fits = _bent(options.withColumn("__cp", cp), F.col("__cp") - F.col("__low"), F.col("__n"), F.col("__syy"), *moments)
    best = F.min_by(F.struct(*carried, "__step", "__cp", "__sse", "__slope", "__xmean"), F.struct("__order", "__i"))
    return fits.groupBy(*keys).agg(best.alias("__best")).select(*keys, "__best.*")


def fit(
    df: DataFrame, keys: Sequence[str], value: str, temp: str | None = None, candidates: Sequence[str] = ("constant",)
) -> DataFrame:
    """All candidate models per key, one row each; models with too few rows are left out.

    ``df`` is read once, and twice more for a change point: pass a stored table then.
    """
    groups = df.groupBy(*keys).agg(*[c.alias(name) for name, c in _totals(value, None if tuple(candidates) == ("constant",) else temp).items()])
    if "heating" in candidates:
        groups = _grid_pass(df, keys, value, temp, groups, F.col("__low"), F.col("__high"))
        last = ["__step", "__cp", "__sse", "__slope", "__xmean"]
        around = groups.withColumnsRenamed({"__step": "__width", "__cp": "__at"}).drop(*last)
        low, high = F.col("__at") - F.col("__width"), F.col("__at") + F.col("__width")
        groups = _grid_pass(df, keys, value, temp, around, low, high)
    return _candidates(groups, keys, candidates)


def _candidates(groups: DataFrame, keys: Sequence[str], candidates: Sequence[str]) -> DataFrame:
    made = {"constant": _constant, "line": _line, "heating": _heating}
    models = F.filter(F.array(*[made[c]() for c in candidates]), lambda m: m.isNotNull())
    return groups.select(*keys, F.explode(models).alias("m")).select(*keys, "m.*")


def fit_constant(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Mean and population deviation."""
    return fit(df, keys, value)


def fit_line(df: DataFrame, keys: Sequence[str], value: str, temp: str) -> DataFrame:
    """Straight line on temperature."""
    return fit(df, keys, value, temp, ("line",))


def fit_heating(df: DataFrame, keys: Sequence[str], value: str, temp: str) -> DataFrame:
    """Line on the degrees below a change point, found by two grid passes."""
    return fit(df, keys, value, temp, ("heating",))


def fit_quality(params: DataFrame, form: str = "v1") -> DataFrame:
    """RMSE, its ratio to the mean, and both information criteria."""
    sse, n, p = F.col("sse"), F.col("n"), F.col("n_params")
    return params.withColumns(
        {
            "rmse": stats.rmse(sse, n),
            "cv_rmse": stats.rmse(sse, n) / F.nullif(F.col("mean"), F.lit(0.0)),
            "bic": stats.bic(sse, n, p),
            "aic": stats.aic(sse, n, p, form),
        }
    )


def select_model(params: DataFrame, keys: Sequence[str], criterion: str = "aic", form: str = "v1") -> DataFrame:
    """Candidate with the least criterion per key; simpler models win ties, unknown criteria lose."""
    scored = fit_quality(params, form)
    score = F.round(F.coalesce(F.col(criterion), F.lit(float("inf"))), 9)
    rest = [c for c in scored.columns if c not in keys]
    best = F.min_by(F.struct(*rest), F.struct(score, F.col("n_params"))).alias("b")
    return scored.groupBy(*keys).agg(best).select(*keys, "b.*")


def _prediction(of: str, temp: str | None = None) -> str:
    """SQL text of a prediction from the parameters of the model ``of``."""
    if temp is None:
        return f"{of}intercept"
    return (
        f"CASE {of}model WHEN 'constant' THEN {of}intercept WHEN 'line' THEN {of}intercept + {of}slope * `{temp}` "
        f"WHEN 'heating' THEN {of}intercept + {of}slope * greatest({of}change_point - `{temp}`, 0D) END"
    )


def predicted(temp: str | None = None) -> Column:
    """Prediction from the parameter columns of a selected model."""
    return F.expr(_prediction("", temp))


def predict(df: DataFrame, params: DataFrame, keys: Sequence[str], temp: str | None = None, fallback: str | None = None) -> DataFrame:
    """Add ``prediction``; rows without model get null, or the column named by ``fallback``."""
    cols = ["model", "intercept", "slope", "change_point"]
    out = df.join(params.select(*keys, *cols), list(keys), "left").withColumn("prediction", predicted(temp))
    if fallback:
        out = out.withColumn("prediction", F.when(F.col("model").isNull(), F.col(fallback)).otherwise(F.col("prediction")))
    return out.withColumn("model", F.coalesce("model", F.lit("none"))).drop("intercept", "slope", "change_point")


def residual_bands(train: DataFrame, keys: Sequence[str], residual: str, bands: Sequence[int] = BANDS) -> DataFrame:
    """Percentiles of the training residuals per model group (bounded by its weeks)."""
    return grid_percentiles(train, keys, residual, [b / 100 for b in bands], [f"r{b}" for b in bands])


def score_percentile(train: DataFrame, test: DataFrame, keys: Sequence[str], value: str, out: str = "score") -> DataFrame:
    """Rank of each test value among the training values of its key, in percent.

    Train and test are ranked together in one window; ``keys`` is one backtest
    fold of one series, so its size is bounded by the grid.
    """
    both = train.select(*keys, F.col(value), F.lit(1).alias("__t")).unionByName(
        test.withColumn("__t", F.lit(0)), allowMissingColumns=True
    )
    upto = Window.partitionBy(*keys).orderBy(value).rangeBetween(Window.unboundedPreceding, 0)
    same = Window.partitionBy(*keys, value)
    le, eq = F.sum("__t").over(upto), F.sum("__t").over(same)
    n = F.sum("__t").over(Window.partitionBy(*keys))
    lt = F.col("__le") - F.col("__eq")
    score = (lt + F.col("__le") + F.when(F.col("__eq") > 0, 1).otherwise(0)) * 50 / F.nullif(F.col("__n"), F.lit(0))
    ranked = both.withColumns({"__le": le, "__eq": eq, "__n": n}).filter("__t = 0")
    return ranked.withColumn(out, score).drop("__t", "__le", "__eq", "__n")


# --- group keys ----------------------------------------------------------------


def day_class(day: str, classes: dict[int, str]) -> Column:
    """Class of a weekday (Monday = 0)."""
    table = F.create_map(*[F.lit(x) for pair in classes.items() for x in pair])
    return F.try_element_at(table, F.weekday(day))


def recurrent_slot(df: DataFrame, keys: Sequence[str], time: str, width: int, anchor: Column, out: str = "slot") -> DataFrame:
    """Position modulo ``width`` counted from the first row where ``anchor`` holds; earlier rows are dropped."""
    start = df.filter(anchor).groupBy(*keys).agg(F.min(time).alias("__a"))
    rows = df.join(start, list(keys)).filter(F.col(time) >= F.col("__a")).drop("__a")
    w = Window.partitionBy(*keys).orderBy(time)
    return rows.withColumn(out, (F.row_number().over(w) - 1) % width)


def latest_rows(df: DataFrame, keys: Sequence[str], time: str, n: int) -> DataFrame:
    """Mark the last ``n`` grid rows of each series as validation."""
    w = Window.partitionBy(*keys).orderBy(F.desc(time))
    return df.withColumn("rn", F.row_number().over(w)).withColumn("validation", F.col("rn") <= n)


def next_month_model(df: DataFrame, keys: Sequence[str], time: str, value: str) -> DataFrame:
    """Constant model of the calendar month that follows the last reading."""
    last = df.groupBy(*keys).agg(F.max(time).alias("__last"))
    wanted = F.month(F.add_months("__last", 1))
    rows = df.join(last, list(keys)).filter(F.month(time) == wanted)
    return rows.groupBy(*keys).agg(
        F.first(wanted).alias("month"),
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("sd"),
    )


# --- backtest --------------------------------------------------------------------


def _fold_totals(rows: DataFrame, group: Sequence[str], folds: int, value: str, temp: str | None) -> DataFrame:
    """Moments of each fold's training rows, those of later blocks, as running sums over at most ``folds + 1`` blocks.

    ``rows`` have ``__block``, ``__last`` and the origins ``__c`` and ``__o`` of value and temperature.
    """
    y = F.col(value) - F.col("__c")
    sums = {"cn": F.count(y).cast("double"), "cy": F.sum(y), "cyy": F.sum(y * y)}
    if temp is not None:
        x = F.col(temp) - F.col("__o")
        x, both = F.when(y.isNotNull(), x), F.when(F.col(temp).isNotNull(), y)
        sums |= {"n": F.count(x).cast("double"), "x": F.sum(x), "xx": F.sum(x * x), "y": F.sum(both), "yy": F.sum(both * both), "xy": F.sum(x * both)}
        ends = {"low": F.min(x), "high": F.max(x)}
    else:
        ends = {}
    origins = ["__c", "__o", "__last"]
    blocks = rows.groupBy(*group, "__block").agg(
        *[F.max(c).alias(c) for c in origins], *[F.coalesce(v, F.lit(0.0)).alias(f"__{c}") for c, v in sums.items()], *[v.alias(f"__{c}") for c, v in ends.items()]
    )
    back = Window.partitionBy(*group).orderBy(F.desc("__block"))
    later = back.rowsBetween(Window.unboundedPreceding, 0)
    merged = blocks.withColumns(
        {f"__{c}": F.sum(f"__{c}").over(later) for c in sums}
        | ({"__low": F.min("__low").over(later), "__high": F.max("__high").over(later)} if ends else {})
        | {"__before": F.coalesce(F.lead("__block").over(back), F.lit(0))}
    )
    # Folds from the block before up to this one train on the same rows of this group.
    first, last = F.greatest("__before", F.lit(1)), F.least(F.col("__block") - 1, "__last")
    merged = merged.withColumn("fold", F.explode(_runs(first, last)))
    mean = F.col("__cy") / F.nullif(F.col("__cn"), F.lit(0.0))
    out = {"__cmean": F.col("__c") + mean, "__csse": F.col("__cyy") - F.col("__cy") * mean, "__cn": F.col("__cn").cast("long")}
    if temp is not None:
        n = F.nullif(F.col("__n"), F.lit(0.0))
        out |= {
            "__mean": F.col("__c") + F.col("__y") / n,
            "__tmean": F.col("__o") + F.col("__x") / n,
            "__syy": F.col("__yy") - F.col("__y") * F.col("__y") / n,
            "__sxx": F.col("__xx") - F.col("__x") * F.col("__x") / n,
            "__sxy": F.col("__xy") - F.col("__x") * F.col("__y") / n,
            "__low": F.col("__o") + F.col("__low"),
            "__high": F.col("__o") + F.col("__high"),
            "__n": F.col("__n").cast("long"),
        }
    return merged.select(*group, "fold", *[v.alias(c) for c, v in out.items()])


def _fold_bends(rows: DataFrame, group: Sequence[str], folds: int, value: str, temp: str, grids: DataFrame) -> DataFrame:
    """Best change point of each fold on its own 20-step grid.

    Within a group, ordered by temperature, each row holds the moments of all rows up to it, once for each fold; it answers
    the candidates between itself and the next row.  ``grids``: group, ``fold``, ``__n``, ``__mean``, ``__syy``, ``__from``,
    ``__step``.
    """
    wanted = ["fold", "__n", "__mean", "__syy", "__from", "__step"]
    ready = grids.filter(F.col("__n") >= MIN_ROWS["heating"])
    ready = ready.groupBy(*group).agg(F.map_from_entries(F.collect_list(F.struct("fold", F.struct(*wanted)))).alias("__grids"))
    known = rows.filter(F.col(value).isNotNull() & F.col(temp).isNotNull()).join(ready, list(group))
    known = known.withColumns({"__at": F.col(temp), "__t": F.col(temp) - F.col("__o"), "__y": F.col(value) - F.col("__c")})
    by_temp = Window.partitionBy(*group).orderBy("__at")
    known = known.withColumns({"__next": F.lead("__at").over(by_temp), "__first": F.row_number().over(by_temp) == 1})
    # Many expressions, one for each fold: as text they are made several times faster than from columns.
    window = f"PARTITION BY {', '.join(f'`{c}`' for c in group)} ORDER BY __at ROWS UNBOUNDED PRECEDING"
    sums = {"m": "1D", "t": "__t", "tt": "__t * __t", "y": "__y", "ty": "__t * __y"}
    below = {
        f"__{c}{f}": F.expr(f"coalesce(sum(CASE WHEN __block > {f} THEN {v} END) OVER ({window}), 0D)")
        for f in range(1, folds + 1)
        for c, v in sums.items()
    }
    known = known.withColumns(below)
    found = ", ".join(_answers(f"__grids[{f}]", {c: f"__{c}{f}" for c in sums}) for f in range(1, folds + 1))
    tied = F.coalesce(F.col("__next") > F.col("__at"), F.lit(True))  # of equal temperatures the last row has them all
    options = known.filter(tied | F.col("__first")).select(*group, "__c", "__o", F.expr(f"explode(concat({found}))").alias("x"))
    options = options.select(*group, "__c", "__o", F.col("x.i").alias("__i"), "x.g.*", "x.s.*")
    cp = F.when(F.col("__i") == _START, F.lit(START_CHANGE_POINT)).otherwise(F.col("__from") + F.col("__i") * F.col("__step"))
    options = options.withColumns({"__cp": cp, "__off": F.col("__mean") - F.col("__c")})
    centred = [F.col("__y") - F.col("__m") * F.col("__off"), F.col("__ty") - F.col("__t") * F.col("__off")]
    fits = _bent(options, F.col("__cp") - F.col("__o"), F.col("__n"), F.col("__syy"), *[F.col(f"__{c}") for c in ("m", "t", "tt")], *centred)
    best = F.min_by(F.struct("__cp", F.col("__step").alias("__width"), "__sse", "__slope", "__xmean"), F.struct("__order", "__i"))
    return fits.groupBy(*group, "fold").agg(best.alias("__best")).select(*group, "fold", "__best.*")


def _answers(grid: str, sums: dict[str, str]) -> str:
    """Candidates of a grid between a row and the next one, with the moments up to the row.

    The first row of a group also answers for a start value at or below it, which has no rows below.
    """
    place = lambda at: f"floor(({at} - {grid}.__from) / nullif({grid}.__step, 0D))"
    last = CHANGE_POINT_STEPS - 1
    first, final = f"int(greatest({place('__at')} + 1, 0))", f"int(if(__next IS NULL, {last}, least({place('__next')}, {last})))"
    steps = f"if({first} <= {final}, sequence({first}, {final}), CAST(array() AS ARRAY<INT>))"
    empty = f"__first AND __at >= {START_CHANGE_POINT}"
    held = f"__at < {START_CHANGE_POINT} AND coalesce(__next >= {START_CHANGE_POINT}, true)"
    start = f"if(({held}) OR ({empty}), array({_START}), CAST(array() AS ARRAY<INT>))"
    values = ", ".join(f"'__{c}', if(i = {_START} AND {empty}, 0D, {v})" for c, v in sums.items())
    steps = f"coalesce({steps}, CAST(array() AS ARRAY<INT>))"
    one = f"named_struct('g', {grid}, 'i', i, 's', named_struct({values}))"
    return f"if({grid} IS NULL, array(), transform(concat({start}, {steps}), i -> {one}))"


def _fold_params(rows: DataFrame, group: Sequence[str], folds: int, value: str, temp: str | None, candidates: Sequence[str], form: str) -> DataFrame:
    """The chosen model of each group and fold."""
    totals = _fold_totals(rows, group, folds, value, None if tuple(candidates) == ("constant",) else temp)
    on = [*group, "fold"]
    if "heating" in candidates:
        step = lambda low, high: (high - low) / (CHANGE_POINT_STEPS - 1)
        low, high = F.col("__low"), F.col("__high")
        grid = totals.withColumns({"__from": low, "__step": step(low, high)})
        first = _fold_bends(rows, group, folds, value, temp, grid)
        low, high = F.col("__cp") - F.col("__width"), F.col("__cp") + F.col("__width")
        grid = totals.join(first.select(*on, low.alias("__from"), step(low, high).alias("__step")), on)
        best = _fold_bends(rows, group, folds, value, temp, grid)
        totals = totals.join(best, on, "left")
    params = _candidates(totals, on, candidates)
    return select_model(params, on, form=form) if len(candidates) > 1 else params


# Values of a sorted array that one step of a search looks at.
_SEARCH = 128


def _ranks(ordered: Column, heads: Column, value: Column) -> Column:
    """Percentile of score of ``value`` among a sorted array with the heads of its runs of ``_SEARCH`` values."""

    def count(keep) -> Column:
        runs = F.size(F.filter(heads, keep))
        start = F.greatest(runs - 1, F.lit(0)) * _SEARCH
        return start + F.size(F.filter(F.slice(ordered, start + 1, _SEARCH), keep))

    below, upto = count(lambda x: x < value), count(lambda x: x <= value)
    n = F.nullif(F.size(ordered), F.lit(0))
    return F.when(value.isNotNull(), (below + upto + F.when(upto > below, 1).otherwise(0)) * 50 / n)


def backtest(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    value: str,
    slot: str,
    width: int,
    folds: int,
    temp: str | None = None,
    candidates: Sequence[str] = ("constant",),
    form: str = "v1",
    score_by_slot: bool = False,
    digits: int = 9,
) -> DataFrame:
    """Rolling-origin backtest: for each of the last ``folds`` windows of ``width`` rows,
    fit on everything before, predict the window, add bands and residual scores.

    No row is copied for a fold.  The folds train on nested sets of rows, so that their moments are running sums over blocks
    of ``width`` rows; a row has one residual for each fold, as a column; bands and the sorted residuals that scores look up
    are one aggregate each.  A series and its slots are bounded by their calendar grid.  ``df`` is read several times: pass a
    stored table.  Folds need more than ``width`` training rows.
    """
    group = [*keys, slot]
    whole = Window.partitionBy(*keys)
    block = F.least(F.ceil(F.row_number().over(whole.orderBy(F.desc(time))) / width), F.lit(folds + 1)).cast("int")
    last = F.least(F.ceil(F.count("*").over(whole) / width) - 2, F.lit(folds)).cast("int")
    in_slot = Window.partitionBy(*group)
    origin = F.min(temp).over(in_slot) if temp else F.lit(0.0)
    rows = df.withColumns({"__block": block, "__last": last}).withColumns({"__c": F.avg(value).over(in_slot), "__o": origin})
    params = _fold_params(rows, group, folds, value, temp, candidates, form)
    model = F.struct("fold", F.struct("model", "intercept", "slope", "change_point"))
    models = params.groupBy(*group).agg(F.map_from_entries(F.collect_list(model)).alias("__models"))
    fitted = rows.join(models, group, "left")
    predict = lambda f: _prediction(f"__models[{f}].", temp)
    residual = lambda f: f"round(`{value}` - ({predict(f)}), {digits})"
    fitted = fitted.withColumns(
        {f"__r{f}": F.expr(f"CASE WHEN __block > {f} AND __last >= {f} THEN {residual(f)} END") for f in range(1, folds + 1)}
    )
    test = F.struct(
        F.col("__block").alias("fold"), time, value, *([temp] if temp else []), slot,
        F.expr(predict("__block")).alias("prediction"),
        F.expr("coalesce(__models[__block].model, 'none')").alias("model"),
        F.expr(residual("__block")).alias("residual"),
    )
    tested = F.col("__block") <= F.col("__last")
    probs = F.array(*[F.lit(b / 100) for b in BANDS])
    # Percentiles of a slot are bounded by its weeks.
    bands = F.array(*[F.percentile(f"__r{f}", probs) for f in range(1, folds + 1)])
    lists = F.array(*[F.sort_array(F.collect_list(f"__r{f}")) for f in range(1, folds + 1)])
    tests = F.collect_list(F.when(tested, test)).alias("__tests")
    if score_by_slot:
        found = fitted.groupBy(*group).agg(tests, bands.alias("__bands"), lists.alias("__lists"))
        with_band = _with_band("__tests")
    else:
        slots = fitted.groupBy(*group).agg(tests, bands.alias("__bands")).select(*keys, _with_band("__tests").alias("t"))
        of_key = slots.groupBy(*keys).agg(F.flatten(F.collect_list("t")).alias("t"))
        found = of_key.join(fitted.groupBy(*keys).agg(lists.alias("__lists")), list(keys))
        with_band = F.col("t")
    heads = F.transform("__lists", lambda x: F.transform(_runs(F.lit(0), F.ceil(F.size(x) / _SEARCH) - 1), lambda k: x[k * _SEARCH]))
    found = found.withColumn("__heads", heads).withColumn("t", with_band)
    pick = lambda c, f: F.col(c)[f - 1]
    scores = F.transform("t", lambda x: _ranks(pick("__lists", x["t"]["fold"]), pick("__heads", x["t"]["fold"]), x["t"]["residual"]))
    out = found.select(*keys, F.explode(F.arrays_zip(F.col("t"), scores.alias("score"))).alias("z"))
    out = out.select(*keys, "z.t.t.*", F.col("z.score").alias("score"), F.col("z.t.band").alias("__band"))
    return out.select("*", *[(F.col("prediction") + F.col("__band")[i]).alias(f"p{b}") for i, b in enumerate(BANDS)]).drop("__band")


def _with_band(tests: str) -> Column:
    return F.transform(tests, lambda x: F.struct(x.alias("t"), F.col("__bands")[x["fold"] - 1].alias("band")))


def smooth_band(df: DataFrame, keys: Sequence[str], time: str, value: str, out: str, floor: float = -10.0) -> DataFrame:
    """Replace impossible values by the mean of their neighbours, left to right.

    Inside a run of bad values the left neighbour is the value just replaced,
    so the run is a halving sum: s(m) = 2^-m * (left + sum next(k) * 2^(k-1)).
    At the first row the right neighbour counts alone, at the last the left.
    """
    w = Window.partitionBy(*keys).orderBy(time)
    v = F.col(value)
    near = df.withColumns(
        {
            "__p": F.lag(v).over(w),
            "__n": F.lead(v).over(w),
            "__last": F.lead(F.lit(1)).over(w).isNull(),
            "__bad": F.coalesce(v < floor, F.lit(False)),
        }
    ).withColumn("__run", F.sum(F.when(F.col("__bad"), 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    r = Window.partitionBy(*keys, "__run", "__bad").orderBy(time)
    m = F.row_number().over(r)
    left = F.first(F.coalesce("__p", "__n")).over(r)
    near = near.withColumns({"__m": m, "__left": left})
    weighted = F.sum(F.col("__n") * F.pow(F.lit(2.0), F.col("__m") - 1)).over(r.rowsBetween(Window.unboundedPreceding, 0))
    near = near.withColumn("__s", (F.col("__left") + weighted) * F.pow(F.lit(2.0), -F.col("__m")))
    prev = F.coalesce(F.lag("__s").over(r), F.col("__p"))
    fixed = F.when(~F.col("__bad"), v).when(F.col("__last"), prev).otherwise(F.col("__s"))
    return near.withColumn(out, fixed).drop("__p", "__n", "__last", "__bad", "__run", "__m", "__left", "__s")


# --- monthly degree-day baseline ------------------------------------------------


def month_degrees(weather_daily: DataFrame, keys: Sequence[str], day: str, temp: str) -> DataFrame:
    """Monthly means of daily temperature, heating and cooling degrees."""
    return weather_daily.groupBy(*keys, F.trunc(day, "month").alias("month")).agg(
        F.avg(temp).alias(temp),
        F.avg(S.heating_degrees(temp)).alias("hdd"),
        F.avg(S.cooling_degrees(temp)).alias("cdd"),
    )


def degree_fits(train: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Heating and cooling regressions side by side, with their significance."""
    y = F.col(value)
    aggs = []
    for d in ("hdd", "cdd"):
        x = F.when(F.col(d) > 0, F.col(d))
        aggs += [
            F.regr_count(y, x).alias(f"{d}_n"),
            F.regr_slope(y, x).alias(f"{d}_slope"),
            F.regr_intercept(y, x).alias(f"{d}_intercept"),
            F.regr_r2(y, x).alias(f"{d}_r2"),
        ]
    out = train.groupBy(*keys).agg(*aggs)
    for d in ("hdd", "cdd"):
        flag = stats.slope_significant(F.col(f"{d}_slope"), F.col(f"{d}_r2"), F.col(f"{d}_n"))
        out = out.withColumn(f"{d}_ok", flag)
    return out


def degree_prediction() -> Column:
    """Prediction from the significant season models; both together share the mean base load."""
    heat = F.when(F.col("hdd_ok") & (F.col("hdd") > 0), F.col("hdd_intercept") + F.col("hdd_slope") * F.col("hdd"))
    cool = F.when(F.col("cdd_ok") & (F.col("cdd") > 0), F.col("cdd_intercept") + F.col("cdd_slope") * F.col("cdd"))
    base = (F.col("hdd_intercept") + F.col("cdd_intercept")) / 2
    joint = base + F.col("hdd_slope") * F.col("hdd") + F.col("cdd_slope") * F.col("cdd")
    return F.when(heat.isNotNull() & cool.isNotNull(), joint).otherwise(F.coalesce(cool, heat))


def calendar_month_means(train: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Historical mean per calendar month, where two or more values exist."""
    return (
        train.groupBy(*keys, F.month("month").alias("calendar_month"))
        .agg(F.avg(value).alias("month_mean"), F.count(value).alias("__n"))
        .filter(F.col("__n") > 1)
        .drop("__n")
    )


def monthly_baseline(
    monthly: DataFrame, degrees: DataFrame, keys: Sequence[str], value: str = "value", split_after: int = 36, holdout: int = 12
) -> DataFrame:
    """Degree-day baseline of the last ``holdout`` months of each unit's month grid.

    ``monthly``: month grid with (keys, month, value, n_days); ``degrees``: (keys,
    month, hdd, cdd).  Training leaves the holdout out only for series of more
    than ``split_after`` months.
    """
    whole = Window.partitionBy(*keys)
    rows = monthly.withColumns(
        {"__rn": F.row_number().over(whole.orderBy(F.desc("month"))), "__size": F.count("*").over(whole)}
    )
    # Stored with its degrees: four tables are made of it, and joins of those with the month grid itself would go by the file
    # of the grid, which is far smaller than its rows, and send them through the driver.
    rows = cut_lineage(rows.join(degrees.select(*keys, "month", "hdd", "cdd"), [*keys, "month"], "left"))
    in_training = (
        ((F.col("__size") <= split_after) | (F.col("__rn") > holdout))
        & F.col(value).isNotNull()
        & F.col("hdd").isNotNull()
    )
    check = rows.groupBy(*keys).agg(
        F.count_if(F.col(value).isNotNull()).alias("__data"),
        F.count_if(F.col("hdd").isNotNull()).alias("__weather"),
        F.count_if((F.col("__rn") <= holdout)).alias("__val"),
        F.count_if((F.col("__rn") <= holdout) & F.col("hdd").isNotNull()).alias("__val_weather"),
        F.count_if(in_training).alias("__train"),
    )
    train = rows.filter(in_training)
    status = (
        F.when(F.col("__weather") == 0, "no weather data found")
        .when(F.col("__data") == 0, "no data obtained")
        .when(F.col("__train") == 0, "no training data")
        .when((F.col("__val_weather") <= 1) | (F.col("__val_weather") != F.col("__val")), "weather data not matching")
        .otherwise("ok")
    )
    states = check.select(*keys, status.alias("status"))
    means = calendar_month_means(train, keys, value)
    val = (
        rows.filter(F.col("__rn") <= holdout)
        .withColumn("calendar_month", F.month("month"))
        .join(degree_fits(train, keys, value), list(keys), "left")
        .join(means, [*keys, "calendar_month"], "left")
        .join(states, list(keys))
        .withColumn("prediction", F.coalesce(degree_prediction(), F.col("month_mean")))
    )
    ok = F.col("status") == "ok"
    days = F.coalesce(F.col("n_days"), F.lit(0))
    return val.select(
        *keys,
        "month",
        "status",
        F.when(ok, S.denormalise(value, days)).alias("value"),
        F.when(ok, S.not_negative(S.denormalise("prediction", days))).alias("p50"),
    )
