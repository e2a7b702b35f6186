"""Consumption models, bands, backtests and the monthly degree-day baseline."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterloom.functions import scalars as S
from meterloom.functions import stats
from meterloom.operators import align, clean, compare, models
from meterloom.plans import views
from meterloom.plans.registry import query
from meterloom.plans.shared import (
    by_month,
    energy_grid,
    energy_hourly,
    energy_model,
    preferred,
    r4,
    series,
    stamp,
    stored,
    text,
    unit_daily,
    unit_model,
    unit_station,
    whole,
)

TS = "'%Y-%m-%d %H:%M:%S'"
SLOT = "dayname(day)[1:3]"
HSLOT = "strftime(hour, '%a %H:%M')"


def weekday_slot(df):
    return df.withColumn("slot", S.format_slot("day", "E"))


def hour_slot(df):
    return df.withColumn("slot", S.week_slot("hour"))


# --- joins -------------------------------------------------------------------


@query(
    "j01_reading_station",
    """SELECT device, CAST(day AS VARCHAR) AS day, value, unit, station FROM preferred JOIN units USING (device)""",
)
def j01(spark, folder):
    bridge = views.units(spark, folder).select("device", "unit", "station")
    return preferred(spark, folder).join(bridge, "device").select("device", text("day"), "value", "unit", "station")


@query(
    "j02_hour_weather",
    f"""SELECT event_id, strftime(ts, {TS}) AS ts, value, r4(temperature) AS temperature FROM readings r
    JOIN meteo_hourly m ON r.device % 25 = m.station AND date_trunc('hour', r.ts) = m.hour""",
)
def j02(spark, folder):
    rows = views.readings(spark, folder).withColumn("station", F.col("device") % 25)
    out = align.weather_join(
        rows, views.meteo_hourly(spark, folder), F.date_trunc("hour", "ts"), F.col("hour"), ["temperature"]
    )
    return out.select("event_id", stamp("ts"), "value", r4("temperature"))


@query(
    "a09_station_daily_mean",
    """SELECT station, CAST(CAST(hour AS DATE) AS VARCHAR) AS day, r4(avg(temperature)) AS temperature
    FROM meteo_hourly GROUP BY station, CAST(hour AS DATE)""",
)
def a09(spark, folder):
    out = align.daily_mean(views.meteo_hourly(spark, folder), "hour", ["temperature"])
    return out.select("station", text("day"), r4("temperature"))


@query(
    "j03_day_weather",
    f"""WITH d AS (SELECT station, CAST(hour AS DATE) AS day, avg(temperature) AS temperature FROM meteo_hourly
      GROUP BY ALL)
    SELECT event_id, value, r4(temperature) AS temperature FROM readings r JOIN d ON r.device % 25 = d.station
      AND CAST(r.ts AS DATE) = d.day""",
)
def j03(spark, folder):
    rows = views.readings(spark, folder).withColumn("station", F.col("device") % 25)
    means = align.daily_mean(views.meteo_hourly(spark, folder), "hour", ["temperature"])
    out = align.weather_join(rows, means, F.to_date("ts"), F.col("day"), ["temperature"])
    return out.select("event_id", "value", r4("temperature"))


@query(
    "j04_double_weather",
    f"""SELECT event_id, r4(a.temperature) AS temperature, r4(b.ghi) AS ghi FROM readings r
    JOIN meteo_hourly a ON r.device % 25 = a.station AND date_trunc('hour', r.ts) = a.hour
    JOIN meteo_hourly b ON r.device % 5 = b.station AND date_trunc('hour', r.ts) = b.hour""",
)
def j04(spark, folder):
    rows = views.readings(spark, folder).withColumns({"station": F.col("device") % 25, "solar": F.col("device") % 5})
    weather, hour = views.meteo_hourly(spark, folder), F.date_trunc("hour", "ts")
    out = align.weather_join(rows, weather, hour, F.col("hour"), ["temperature"])
    out = align.weather_join(out, weather, hour, F.col("hour"), ["ghi"], station="solar")
    return out.select("event_id", r4("temperature"), r4("ghi"))


@query(
    "f07_degrees",
    """SELECT station, CAST(day AS VARCHAR) AS day, r4(greatest(18 - temperature, 0)) AS hdd,
      r4(greatest(temperature - 22, 0)) AS cdd FROM meteo_daily""",
)
def f07(spark, folder):
    return views.meteo_daily(spark, folder).select(
        "station", text("day"), r4(S.heating_degrees("temperature"), "hdd"), r4(S.cooling_degrees("temperature"), "cdd")
    )


# --- monthly baseline ----------------------------------------------------------

_DEGREES = """WITH deg AS (SELECT station, CAST(date_trunc('month', day) AS DATE) AS month, avg(temperature) AS temperature,
    avg(greatest(18 - temperature, 0)) AS hdd, avg(greatest(temperature - 22, 0)) AS cdd FROM meteo_daily GROUP BY 1, 2),
  udeg AS (SELECT unit, month, hdd, cdd FROM deg JOIN unit_station USING (station)),
  grid AS (SELECT unit, CAST(unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS DATE) AS month
    FROM unit_monthly GROUP BY unit),
  mg AS (SELECT unit, month, value, n_days FROM grid LEFT JOIN unit_monthly USING (unit, month)),
  rk AS (SELECT mg.*, row_number() OVER (PARTITION BY unit ORDER BY month DESC) AS rn,
    count(*) OVER (PARTITION BY unit) AS size, hdd, cdd FROM mg LEFT JOIN udeg USING (unit, month)),
  tr AS (SELECT * FROM rk WHERE (size <= 36 OR rn > 12) AND value IS NOT NULL AND hdd IS NOT NULL)"""
_Z = stats.Z_TEN_PERCENT
# Terms of the expansion of the critical value in 1 / degrees of freedom.
_T_FIRST = (_Z, (_Z**3 + _Z) / 4, (5 * _Z**5 + 16 * _Z**3 + 3 * _Z) / 96)
_TCRIT = "[" + ", ".join(str(v) for v in stats.t_table()) + "]"


def _sig(d: str) -> str:
    return f"""coalesce({d}_n > 2 AND {d}_slope > 0 AND ({d}_r2 >= 1 OR sqrt({d}_r2 * ({d}_n - 2) / nullif(1 - {d}_r2, 0))
      > CASE WHEN {d}_n - 2 <= {stats.TABLE_SIZE} THEN {_TCRIT}[CAST({d}_n - 2 AS INTEGER)]
      ELSE {_T_FIRST[0]} + {_T_FIRST[1]} / ({d}_n - 2) + {_T_FIRST[2]} / ({d}_n - 2) ** 2 END), false) AS {d}_ok"""


_FITS = (
    _DEGREES
    + """, f0 AS (SELECT unit, """
    + ", ".join(
        f"""regr_count(value, CASE WHEN {d} > 0 THEN {d} END) AS {d}_n, regr_slope(value, CASE WHEN {d} > 0 THEN {d} END)
      AS {d}_slope, regr_intercept(value, CASE WHEN {d} > 0 THEN {d} END) AS {d}_intercept,
      regr_r2(value, CASE WHEN {d} > 0 THEN {d} END) AS {d}_r2"""
        for d in ("hdd", "cdd")
    )
    + " FROM tr GROUP BY unit), fits AS (SELECT *, "
    + _sig("hdd")
    + ", "
    + _sig("cdd")
    + " FROM f0)"
)


def _station_degrees(spark, folder):
    return models.month_degrees(views.meteo_daily(spark, folder), ["station"], "day", "temperature")


def _unit_degrees(spark, folder, deg=None):
    deg = _station_degrees(spark, folder) if deg is None else deg
    return deg.join(unit_station(spark, folder), "station").drop("station")


def _month_rows(spark, folder):
    monthly = compare.monthly_means(unit_daily(spark, folder), ["unit"], "day", "value")
    return compare.month_grid(monthly, ["unit"])


def _training(spark, folder):
    rows = models.latest_rows(_month_rows(spark, folder), ["unit"], "month", 12)
    size = rows.groupBy("unit").agg(F.count("*").alias("size"))
    rows = rows.join(size, "unit").join(_unit_degrees(spark, folder), ["unit", "month"])
    return rows.filter(((F.col("size") <= 36) | ~F.col("validation")) & F.col("value").isNotNull())


@query(
    "j08_month_weather",
    _DEGREES
    + """ SELECT unit, CAST(month AS VARCHAR) AS month, r4(value) AS value, r4(hdd) AS hdd, r4(cdd) AS cdd
    FROM mg JOIN udeg USING (unit, month)""",
)
def j08(spark, folder):
    out = _month_rows(spark, folder).join(_unit_degrees(spark, folder), ["unit", "month"])
    return out.select("unit", text("month"), r4("value"), r4("hdd"), r4("cdd"))


@query(
    "w23_latest_rows",
    """SELECT unit, CAST(day AS VARCHAR) AS day, row_number() OVER (PARTITION BY unit ORDER BY day DESC) <= 12
      AS validation FROM unit_daily""",
)
def w23(spark, folder):
    out = models.latest_rows(unit_daily(spark, folder), ["unit"], "day", 12)
    return out.select("unit", text("day"), "validation")


@query(
    "m19_degree_regression",
    _FITS
    + """ SELECT unit, hdd_n, r4(hdd_slope) AS hdd_slope, r4(hdd_intercept) AS hdd_intercept, r4(hdd_r2) AS hdd_r2,
      cdd_n, r4(cdd_slope) AS cdd_slope, r4(cdd_intercept) AS cdd_intercept FROM fits""",
)
def m19(spark, folder):
    fits = models.degree_fits(_training(spark, folder), ["unit"], "value")
    return fits.select(
        "unit", "hdd_n", r4("hdd_slope"), r4("hdd_intercept"), r4("hdd_r2"), "cdd_n", r4("cdd_slope"), r4("cdd_intercept")
    )


@query("m20_significance_gate", _FITS + " SELECT unit, hdd_ok, cdd_ok FROM fits")
def m20(spark, folder):
    return models.degree_fits(_training(spark, folder), ["unit"], "value").select("unit", "hdd_ok", "cdd_ok")


_MEANS = """cm AS (SELECT unit, month(month) AS m, avg(value) AS month_mean FROM tr GROUP BY ALL HAVING count(value) > 1)"""


@query(
    "a28_month_mean_fallback",
    _DEGREES + f", {_MEANS} SELECT unit, CAST(m AS BIGINT) AS calendar_month, r4(month_mean) AS month_mean FROM cm",
)
def a28(spark, folder):
    out = models.calendar_month_means(_training(spark, folder), ["unit"], "value")
    return out.select("unit", whole("calendar_month"), r4("month_mean"))


@query(
    "m21_monthly_baseline",
    _FITS
    + f""", {_MEANS},
    st AS (SELECT unit, CASE WHEN count(hdd) = 0 THEN 'no weather data found' WHEN count(value) = 0 THEN 'no data obtained'
        WHEN unit NOT IN (SELECT unit FROM tr) THEN 'no training data'
        WHEN count(hdd) FILTER (rn <= 12) <= 1 OR count(hdd) FILTER (rn <= 12) <> count(*) FILTER (rn <= 12)
        THEN 'weather data not matching' ELSE 'ok' END AS status FROM rk GROUP BY unit),
    pr AS (SELECT r.unit, r.month, r.value, r.n_days, status, month_mean,
        CASE WHEN hdd_ok AND hdd > 0 THEN hdd_intercept + hdd_slope * hdd END AS ph,
        CASE WHEN cdd_ok AND cdd > 0 THEN cdd_intercept + cdd_slope * cdd END AS pc,
        (hdd_intercept + cdd_intercept) / 2 + hdd_slope * hdd + cdd_slope * cdd AS pj
      FROM rk r JOIN st USING (unit) LEFT JOIN fits USING (unit) LEFT JOIN cm ON cm.unit = r.unit AND cm.m = month(r.month)
      WHERE rn <= 12)
    SELECT unit, CAST(month AS VARCHAR) AS month, status, r4(CASE WHEN status = 'ok' THEN value * coalesce(n_days, 0) END)
      AS value, r4(CASE WHEN status = 'ok' AND coalesce(ph, pc, month_mean) IS NOT NULL THEN greatest(0, coalesce(CASE WHEN ph IS NOT NULL AND pc IS NOT NULL
        THEN pj ELSE coalesce(pc, ph) END, month_mean) * coalesce(n_days, 0)) END) AS p50 FROM pr""",
)
def m21(spark, folder):
    # The degrees of stations are stored, not those of units: they repeat the same few values, so that their file is far
    # smaller than their rows, and a join that goes by the file would send all of them through the driver.
    degrees = _unit_degrees(spark, folder, stored(_station_degrees(spark, folder)))
    out = models.monthly_baseline(stored(_month_rows(spark, folder)), degrees, ["unit"])
    return out.select("unit", text("month"), "status", r4("value"), r4("p50"))


@query(
    "f13_denormalise",
    "SELECT unit, CAST(month AS VARCHAR) AS month, r4(value * n_days) AS total FROM unit_monthly",
)
def f13(spark, folder):
    monthly = compare.monthly_means(unit_daily(spark, folder), ["unit"], "day", "value")
    return monthly.select("unit", text("month"), r4(S.denormalise("value", "n_days"), "total"))


# --- single models --------------------------------------------------------------

_SSE = "greatest(regr_syy(value, temperature) - regr_sxy(value, temperature) ** 2 / nullif(regr_sxx(value, temperature), 0), 0)"


def _constant_sql(src: str, keys: str) -> str:
    return f"""SELECT {keys}, 'constant' AS model, 1 AS n_params, count(value) AS n, avg(value) AS mean, avg(value) AS intercept,
      CAST(NULL AS DOUBLE) AS slope, CAST(NULL AS DOUBLE) AS change_point, greatest(var_pop(value) * count(value), 0) AS sse
      FROM {src} GROUP BY {keys} HAVING count(value) >= 2"""


def _line_sql(src: str, keys: str) -> str:
    return f"""SELECT {keys}, 'line' AS model, 2 AS n_params, count(value) AS n, avg(value) AS mean,
      regr_intercept(value, temperature) AS intercept, regr_slope(value, temperature) AS slope,
      CAST(NULL AS DOUBLE) AS change_point, {_SSE} AS sse FROM {src} GROUP BY {keys}
      HAVING count(value) >= 5 AND regr_slope(value, temperature) IS NOT NULL"""


def _heating_sql(src: str, keys: str, name: str) -> str:
    """Members ``<name>`` with the two-pass change-point fit."""
    on = keys
    one = lambda i, bounds: f"""{name}_c{i} AS (SELECT {keys}, value AS y, temperature AS t, (hi - lo) / 19 AS step,
        unnest(range(21)) AS i, lo FROM {src} JOIN {bounds} USING ({on})),
      {name}_x{i} AS (SELECT *, CASE WHEN i = 0 THEN 15.5 ELSE lo + (i - 1) * step END AS cp FROM {name}_c{i}),
      {name}_f{i} AS (SELECT {keys}, i, any_value(cp) AS cp, any_value(step) AS step, count(*) AS n, avg(y) AS mean,
        regr_sxx(y, greatest(cp - t, 0)) AS sxx, regr_syy(y, greatest(cp - t, 0)) AS syy,
        regr_sxy(y, greatest(cp - t, 0)) AS sxy, avg(greatest(cp - t, 0)) AS mx FROM {name}_x{i} GROUP BY {keys}, i),
      {name}_s{i} AS (SELECT *, CASE WHEN sxx < 1e-9 THEN 0 ELSE sxy / sxx END AS slope FROM {name}_f{i}),
      {name}_b{i} AS (SELECT * FROM (SELECT *, syy - slope * sxy AS sse, row_number() OVER (PARTITION BY {keys} ORDER BY
        round((syy - slope * sxy) / greatest(syy, 1e-9), 9), i) AS rk FROM {name}_s{i}) WHERE rk = 1)"""
    return f"""{name}_n AS (SELECT {keys}, min(temperature) AS lo, max(temperature) AS hi FROM {src} GROUP BY {keys}
        HAVING count(*) >= 6),
      {one(1, name + "_n")},
      {name}_r AS (SELECT {keys}, cp - step AS lo, cp + step AS hi FROM {name}_b1),
      {one(2, name + "_r")},
      {name} AS (SELECT {keys}, 'heating' AS model, 3 AS n_params, n, mean, mean - slope * mx AS intercept, slope,
        cp AS change_point, greatest(sse, 0) AS sse FROM {name}_b2)"""


_AIC1 = "n * ln(greatest(sse, 1e-12) / n) + 2 * n_params + floor(2 * (n_params + 1) / nullif(n - n_params - 1, 0))"
_AIC2 = """n * ln(greatest(sse, 1e-12) / n) + 2 * (n_params + 1)
  + floor(2 * (n_params + 1) * (n_params + 2) / nullif(n - n_params - 2, 0))"""


def _best_sql(src: str, keys: str, aic: str = _AIC1) -> str:
    return f"""SELECT * EXCLUDE (rk) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY
      round(coalesce({aic}, 1e308), 9), n_params) AS rk FROM {src}) WHERE rk = 1"""


@query(
    "m01_constant_model",
    f"""WITH s AS (SELECT energy, {HSLOT} AS slot, value FROM energy_hourly)
    SELECT energy, slot, count(*) AS n, r4(avg(value)) AS mean, r4(stddev_pop(value)) AS sd FROM s GROUP BY energy, slot
    HAVING count(*) >= 2""",
)
def m01(spark, folder):
    fits = models.fit_constant(hour_slot(energy_hourly(spark, folder)), ["energy", "slot"], "value")
    return fits.select("energy", "slot", "n", r4("mean"), r4(F.sqrt(F.col("sse") / F.col("n")), "sd"))


@query(
    "m02_line_model",
    f"WITH s AS ({_line_sql('unit_model', 'unit')}) SELECT unit, n, r4(slope) AS slope, r4(intercept) AS intercept, r4(sse) AS sse FROM s",
)
def m02(spark, folder):
    fits = models.fit_line(unit_model(spark, folder), ["unit"], "value", "temperature")
    return fits.select("unit", "n", r4("slope"), r4("intercept"), r4("sse"))


@query(
    "m03_heating_model",
    f"""WITH {_heating_sql("unit_model", "unit", "h")}
    SELECT unit, n, r4(change_point) AS change_point, r4(slope) AS slope, r4(intercept) AS intercept, r4(sse) AS sse FROM h""",
)
def m03(spark, folder):
    fits = models.fit_heating(stored(unit_model(spark, folder)), ["unit"], "value", "temperature")
    return fits.select("unit", "n", r4("change_point"), r4("slope"), r4("intercept"), r4("sse"))


_ALL_UNIT = f"""WITH {_heating_sql("unit_model", "unit", "h")},
  allm AS ({_constant_sql("unit_model", "unit")} UNION ALL {_line_sql("unit_model", "unit")} UNION ALL SELECT * FROM h)"""


@query(
    "a20_fit_quality",
    _ALL_UNIT
    + f""" SELECT unit, model, r4(sse) AS sse, r4(sqrt(sse / (n - 1))) AS rmse, r4(sqrt(sse / (n - 1)) / mean) AS cv_rmse,
      r4(n * ln(sse) + ln(n) * n_params) AS bic, r4({_AIC1}) AS aic, r4({_AIC2}) AS aic2 FROM allm""",
)
def a20(spark, folder):
    params = models.fit(stored(unit_model(spark, folder)), ["unit"], "value", "temperature", models.ALL_MODELS)
    out = models.fit_quality(params).join(
        models.fit_quality(params, "v2").select("unit", "model", F.col("aic").alias("aic2")), ["unit", "model"]
    )
    return out.select("unit", "model", *[r4(c) for c in ("sse", "rmse", "cv_rmse", "bic", "aic", "aic2")])


@query(
    "m05_select_model",
    _ALL_UNIT + f", b AS ({_best_sql('allm', 'unit')}) SELECT unit, model, r4(intercept) AS intercept, r4(slope) AS slope FROM b",
)
def m05(spark, folder):
    params = models.fit(stored(unit_model(spark, folder)), ["unit"], "value", "temperature", models.ALL_MODELS)
    return models.select_model(params, ["unit"]).select("unit", "model", r4("intercept"), r4("slope"))


@query(
    "o03_best_model",
    _ALL_UNIT + f", b AS ({_best_sql('allm', 'unit', 'n * ln(sse) + ln(n) * n_params')}) SELECT unit, model FROM b",
)
def o03(spark, folder):
    params = models.fit(stored(unit_model(spark, folder)), ["unit"], "value", "temperature", models.ALL_MODELS)
    return models.select_model(params, ["unit"], "bic").select("unit", "model")


_SLOTTED = f"""WITH src AS (SELECT *, {SLOT} AS slot FROM unit_model), {_heating_sql("src", "unit, slot", "h")},
  allm AS ({_constant_sql("src", "unit, slot")} UNION ALL {_line_sql("src", "unit, slot")} UNION ALL SELECT * FROM h),
  best AS ({_best_sql("allm", "unit, slot")})"""
_PRED = """CASE model WHEN 'constant' THEN intercept WHEN 'line' THEN intercept + slope * temperature
  WHEN 'heating' THEN intercept + slope * greatest(change_point - temperature, 0) END"""


def _slotted(spark, folder):
    rows = stored(weekday_slot(unit_model(spark, folder)))
    params = models.fit(rows, ["unit", "slot"], "value", "temperature", models.ALL_MODELS)
    return rows, models.select_model(params, ["unit", "slot"])


@query(
    "m06_weekly_slot_model",
    _SLOTTED + " SELECT unit, slot, model, n, r4(intercept) AS intercept, r4(slope) AS slope FROM best",
)
def m06(spark, folder):
    _, best = _slotted(spark, folder)
    return best.select("unit", "slot", "model", "n", r4("intercept"), r4("slope"))


@query(
    "m06_hourly_slot_model",
    f"""WITH s AS (SELECT energy, {HSLOT} AS slot, value, hour FROM energy_hourly),
      m AS (SELECT energy, slot, avg(value) AS p FROM s GROUP BY energy, slot HAVING count(*) >= 2)
    SELECT energy, strftime(hour, {TS}) AS hour, r4(value - p) AS residual FROM s LEFT JOIN m USING (energy, slot)""",
)
def m06h(spark, folder):
    rows = stored(hour_slot(energy_hourly(spark, folder)))
    params = models.fit(rows, ["energy", "slot"], "value")
    out = models.predict(rows, params, ["energy", "slot"])
    return out.select("energy", stamp("hour"), r4(F.col("value") - F.col("prediction"), "residual"))


@query(
    "m04_fallback_model",
    f"""WITH src AS (SELECT *, strftime(day, '%Y-%W') AS slot FROM unit_model), m AS ({_constant_sql("src", "unit, slot")})
    SELECT unit, CAST(day AS VARCHAR) AS day, coalesce(model, 'none') AS model, r4(intercept) AS prediction
    FROM src LEFT JOIN m USING (unit, slot)""",
)
def m04(spark, folder):
    week = F.floor(
        (F.dayofyear("day") + 6 - F.weekday("day")) / 7
    )
    rows = stored(unit_model(spark, folder)).withColumn(
        "slot", F.concat_ws("-", F.year("day"), F.lpad(week.cast("string"), 2, "0"))
    )
    params = models.fit(rows, ["unit", "slot"], "value")
    out = models.predict(rows, params, ["unit", "slot"])
    return out.select("unit", text("day"), "model", r4("prediction"))


@query(
    "m07_grouped_model",
    f"""WITH src AS (SELECT *, strftime(day, '%m') AS slot FROM unit_model), m AS ({_constant_sql("src", "unit, slot")})
    SELECT unit, slot, n, r4(mean) AS mean FROM m""",
)
def m07(spark, folder):
    rows = unit_model(spark, folder).withColumn("slot", S.format_slot("day", "MM"))
    return models.fit(rows, ["unit", "slot"], "value").select("unit", "slot", "n", r4("mean"))


DAY_CLASSES = {0: "work", 1: "work", 2: "work", 3: "work", 4: "work", 5: "saturday", 6: "sunday"}


@query(
    "m08_day_class_model",
    f"""WITH src AS (SELECT *, CASE isodow(day) WHEN 6 THEN 'saturday' WHEN 7 THEN 'sunday' ELSE 'work' END AS slot
      FROM unit_model), m AS ({_constant_sql("src", "unit, slot")}) SELECT unit, slot, n, r4(mean) AS mean FROM m""",
)
def m08(spark, folder):
    rows = unit_model(spark, folder).withColumn("slot", models.day_class("day", DAY_CLASSES))
    return models.fit(rows, ["unit", "slot"], "value").select("unit", "slot", "n", r4("mean"))


@query(
    "m09_flag_model",
    f"""WITH src AS (SELECT *, month(day) IN (7, 8) AS holiday FROM unit_model),
      m AS ({_constant_sql("src", "unit, holiday")} UNION ALL {_line_sql("src", "unit, holiday")}),
      b AS ({_best_sql("m", "unit, holiday")}) SELECT unit, holiday, model, n, r4(intercept) AS intercept FROM b""",
)
def m09(spark, folder):
    rows = stored(unit_model(spark, folder)).withColumn("holiday", F.month("day").isin(7, 8))
    params = models.fit(rows, ["unit", "holiday"], "value", "temperature", ("constant", "line"))
    return models.select_model(params, ["unit", "holiday"]).select("unit", "holiday", "model", "n", r4("intercept"))


_RECUR = """WITH a AS (SELECT energy, min(hour) AS a FROM energy_grid WHERE isodow(hour) = 1 AND hour(hour) = 0 GROUP BY energy),
  src AS (SELECT energy, hour, value, (row_number() OVER (PARTITION BY energy ORDER BY hour) - 1) % 168 AS slot
    FROM energy_grid JOIN a USING (energy) WHERE hour >= a)"""


def _recurrent(spark, folder):
    monday = (F.weekday("hour") == 0) & (F.hour("hour") == 0)
    return models.recurrent_slot(stored(energy_grid(spark, folder)), ["energy"], "hour", 168, monday)


@query(
    "w26_recurrent_slot",
    _RECUR + f" SELECT energy, strftime(hour, {TS}) AS hour, slot FROM src",
)
def w26(spark, folder):
    return _recurrent(spark, folder).select("energy", stamp("hour"), whole("slot"))


@query(
    "m10_recurrent_model",
    _RECUR + f", m AS ({_constant_sql('src', 'energy, slot')}) SELECT energy, slot, n, r4(mean) AS mean FROM m",
)
def m10(spark, folder):
    fits = models.fit(_recurrent(spark, folder), ["energy", "slot"], "value")
    return fits.select("energy", whole("slot"), "n", r4("mean"))


@query(
    "m11_next_month_model",
    """WITH l AS (SELECT unit, month(max(day) + INTERVAL 1 MONTH) AS m FROM unit_model GROUP BY unit)
    SELECT unit, CAST(m AS BIGINT) AS month, count(*) AS n, r4(avg(value)) AS mean, r4(stddev_samp(value)) AS sd
    FROM unit_model JOIN l USING (unit) WHERE month(day) = m GROUP BY unit, m""",
)
def m11(spark, folder):
    out = models.next_month_model(stored(unit_model(spark, folder)), ["unit"], "day", "value")
    return out.select("unit", whole("month"), "n", r4("mean"), r4("sd"))


@query(
    "m12_single_group_model",
    f"WITH m AS ({_constant_sql('unit_model', 'unit')}) SELECT unit, n, r4(mean) AS mean, r4(sse) AS sse FROM m",
)
def m12(spark, folder):
    return models.fit(unit_model(spark, folder), ["unit"], "value").select("unit", "n", r4("mean"), r4("sse"))


@query(
    "m13_grid_profile_model",
    _RECUR
    + f""", m AS ({_constant_sql("src", "energy, slot")})
    SELECT energy, strftime(hour, {TS}) AS hour, r4(intercept) AS prediction FROM src LEFT JOIN m USING (energy, slot)""",
)
def m13(spark, folder):
    rows = stored(_recurrent(spark, folder))
    params = models.fit(rows, ["energy", "slot"], "value")
    return models.predict(rows, params, ["energy", "slot"]).select("energy", stamp("hour"), r4("prediction"))


@query(
    "a29_weekly_profile",
    _RECUR
    + """ SELECT energy, slot, r4(quantile_cont(value, 0.1)) AS p10, r4(quantile_cont(value, 0.5)) AS p50,
      r4(quantile_cont(value, 0.9)) AS p90 FROM src GROUP BY energy, slot""",
)
def a29(spark, folder):
    from meterloom.functions.quantiles import grid_percentiles

    out = grid_percentiles(
        _recurrent(spark, folder), ["energy", "slot"], "value", [0.1, 0.5, 0.9], ["p10", "p50", "p90"]
    )
    return out.select("energy", whole("slot"), r4("p10"), r4("p50"), r4("p90"))


# --- bands, scores, backtests -----------------------------------------------------

_BANDSQL = ", ".join(f"quantile_cont(residual, {b / 100}) AS r{b}" for b in models.BANDS)


@query(
    "m14_residual_bands",
    _SLOTTED
    + f""", r AS (SELECT unit, slot, value - ({_PRED}) AS residual FROM src JOIN best USING (unit, slot))
    SELECT unit, slot, {", ".join(f"r4(quantile_cont(residual, {b / 100})) AS r{b}" for b in models.BANDS)}
    FROM r GROUP BY unit, slot""",
)
def m14(spark, folder):
    rows, best = _slotted(spark, folder)
    res = models.predict(rows, best, ["unit", "slot"], "temperature").withColumn(
        "residual", F.col("value") - F.col("prediction")
    )
    bands = models.residual_bands(res.filter("residual is not null"), ["unit", "slot"], "residual")
    return bands.select("unit", "slot", *[r4(f"r{b}") for b in models.BANDS])


@query(
    "m15_percentile_of_score",
    """WITH s AS (SELECT *, row_number() OVER (PARTITION BY unit ORDER BY day DESC) <= 12 AS v FROM unit_daily),
      c AS (SELECT t.unit, t.day, (SELECT count(*) FROM s x WHERE x.unit = t.unit AND NOT x.v AND x.value < t.value) AS lt,
        (SELECT count(*) FROM s x WHERE x.unit = t.unit AND NOT x.v AND x.value <= t.value) AS le,
        (SELECT count(*) FROM s x WHERE x.unit = t.unit AND NOT x.v) AS n FROM s t WHERE t.v)
    SELECT unit, CAST(day AS VARCHAR) AS day, r4((lt + le + CASE WHEN le > lt THEN 1 ELSE 0 END) * 50 / n) AS score FROM c""",
)
def m15(spark, folder):
    rows = stored(models.latest_rows(unit_daily(spark, folder), ["unit"], "day", 12))
    train = rows.filter(~F.col("validation"))
    test = rows.filter("validation").select("unit", "day", "value")
    return models.score_percentile(train, test, ["unit"], "value").select("unit", text("day"), r4("score"))


def _backtest_sql(src: str, keys: str, time: str, width: int, folds: int, by_slot: bool, tail: str, full: bool = False, aic: str = _AIC1) -> str:
    group = f"{keys}, fold, slot"
    fit_members = (
        f"{_heating_sql('train', group, 'h')}, allm AS ({_constant_sql('train', group)} UNION ALL "
        f"{_line_sql('train', group)} UNION ALL SELECT * FROM h), best AS MATERIALIZED ({_best_sql('allm', group, aic)})"
        if full
        else f"best AS MATERIALIZED ({_constant_sql('train', group)})"
    )
    score_on = f"({group})" if by_slot else f"({keys}, fold)"
    same = "AND x.slot = t.slot" if by_slot else ""
    temp = ", temperature" if full else ", CAST(NULL AS DOUBLE) AS temperature"
    return f"""WITH src AS MATERIALIZED ({src}),
      ranked AS MATERIALIZED (SELECT {keys}, {time}, slot, value{temp}, row_number() OVER (PARTITION BY {keys} ORDER BY {time} DESC) AS rn,
        count(*) OVER (PARTITION BY {keys}) AS size FROM src),
      ex AS (SELECT *, unnest(range(1, {folds} + 1)) AS fold FROM ranked),
      train AS MATERIALIZED (SELECT * FROM ex WHERE rn > {width} * fold AND size - {width} * fold > {width}),
      test AS MATERIALIZED (SELECT * FROM ex WHERE rn > {width} * (fold - 1) AND rn <= {width} * fold AND size - {width} * fold > {width}),
      {fit_members},
      known AS MATERIALIZED (SELECT train.*, round(value - ({_PRED}), 9) AS residual FROM train JOIN best USING ({group})),
      ahead AS MATERIALIZED (SELECT test.*, {_PRED} AS prediction, round(value - ({_PRED}), 9) AS residual
        FROM test LEFT JOIN best USING ({group})),
      bands AS (SELECT {group}, {_BANDSQL} FROM known GROUP BY {group}),
      ordered AS (SELECT {group}, residual, 1 AS t, CAST(NULL AS {"TIMESTAMP" if time == "hour" else "DATE"}) AS {time} FROM known UNION ALL
        SELECT {group}, residual, 0, {time} FROM ahead),
      counted AS (SELECT *, sum(t) OVER (PARTITION BY {score_on[1:-1]} ORDER BY residual RANGE UNBOUNDED PRECEDING) AS le,
        sum(t) OVER (PARTITION BY {score_on[1:-1]}, residual) AS eq, sum(t) OVER (PARTITION BY {score_on[1:-1]}) AS n
        FROM ordered WHERE residual IS NOT NULL),
      scores AS (SELECT {keys}, {time}, (le - eq + le + CASE WHEN eq > 0 THEN 1 ELSE 0 END) * 50 / nullif(n, 0) AS score
        FROM counted WHERE t = 0)
    {tail}"""


def _backtest_tail(keys: str, time: str, shown: str) -> str:
    bands = ", ".join(f"r4(prediction + r{b}) AS p{b}" for b in models.BANDS)
    return f"""SELECT {keys}, {shown} AS {time}, a.fold, r4(a.value) AS value, r4(prediction) AS prediction, {bands},
      r4(score) AS score FROM ahead a LEFT JOIN bands USING ({keys}, fold, slot) LEFT JOIN scores USING ({keys}, {time})"""


_SHOW = ["value", "prediction", *[f"p{b}" for b in models.BANDS], "score"]


@query(
    "m16_backtest_weekly",
    _backtest_sql(
        f"SELECT unit, day, value, {SLOT} AS slot FROM unit_daily",
        "unit", "day", 7, 16, False, _backtest_tail("unit", "day", "CAST(day AS VARCHAR)"),
    ),
)
def m16(spark, folder):
    rows = stored(weekday_slot(unit_daily(spark, folder)))
    out = models.backtest(rows, ["unit"], "day", "value", "slot", 7, 16)
    return out.select("unit", text("day"), whole("fold"), *[r4(c) for c in _SHOW])


@query(
    "m16_backtest_hourly",
    _backtest_sql(
        f"SELECT energy, hour, value, {HSLOT} AS slot FROM energy_hourly",
        "energy", "hour", 168, 16, False, _backtest_tail("energy", "hour", f"strftime(hour, {TS})"),
    ),
)
def m16h(spark, folder):
    rows = stored(hour_slot(energy_hourly(spark, folder)))
    out = models.backtest(rows, ["energy"], "hour", "value", "slot", 168, 16)
    return out.select("energy", stamp("hour"), whole("fold"), *[r4(c) for c in _SHOW])


@query(
    "m17_backtest_grouped",
    _backtest_sql(
        f"SELECT unit, day, value, temperature, CASE WHEN isodow(day) > 5 THEN 'weekend' ELSE 'work' END AS slot FROM unit_model",
        "unit", "day", 7, 16, True, _backtest_tail("unit", "day", "CAST(day AS VARCHAR)"), True, _AIC2,
    ),
)
def m17(spark, folder):
    rows = stored(unit_model(spark, folder)).withColumn("slot", F.when(F.weekday("day") > 4, "weekend").otherwise("work"))
    out = models.backtest(
        rows, ["unit"], "day", "value", "slot", 7, 16, "temperature", models.ALL_MODELS, "v2", score_by_slot=True
    )
    return out.select("unit", text("day"), whole("fold"), *[r4(c) for c in _SHOW])


@query(
    "m17_backtest_week_slots",
    _backtest_sql(
        f"SELECT energy, hour, value, temperature, {HSLOT} AS slot FROM energy_model",
        "energy", "hour", 168, 16, True, _backtest_tail("energy", "hour", f"strftime(hour, {TS})"), True, _AIC2,
    ),
)
def m17w(spark, folder):
    rows = stored(hour_slot(energy_model(spark, folder)))
    out = models.backtest(
        rows, ["energy"], "hour", "value", "slot", 168, 16, "temperature", models.ALL_MODELS, "v2", score_by_slot=True
    )
    return out.select("energy", stamp("hour"), whole("fold"), *[r4(c) for c in _SHOW])


# Which candidate models a series gets, by resolution and energy type.
WATER = "view"  # the energy type that plays water here


@query(
    "m18_model_choice",
    """WITH d AS (SELECT device, energy, CAST(floor(epoch(ts)) - floor(epoch(lag(ts) OVER (PARTITION BY device, energy
        ORDER BY ts))) AS BIGINT) AS step FROM readings),
      m AS (SELECT device, energy, step, count(*) AS n FROM d WHERE step IS NOT NULL GROUP BY ALL),
      i AS (SELECT device, energy, arg_min(step, ROW(-n, step)) AS step FROM m GROUP BY device, energy)
    SELECT device, energy, CASE WHEN step >= 3600 THEN 'hourly' ELSE 'half-hourly' END AS resolution,
      CASE WHEN step >= 3600 OR energy = 'view' THEN 'constant' ELSE 'constant,line,heating' END AS candidates FROM i""",
)
def m18(spark, folder):
    found = clean.dominant_interval(views.readings(spark, folder), ["device", "energy"], "ts", by_month())
    hourly = F.col("interval_s") >= 3600
    return found.filter("interval_s is not null").select(
        "device",
        "energy",
        F.when(hourly, "hourly").otherwise("half-hourly").alias("resolution"),
        F.when(hourly | (F.col("energy") == WATER), "constant").otherwise(",".join(models.ALL_MODELS)).alias("candidates"),
    )


@query(
    "m26_baseline_profile",
    f"""WITH src AS (SELECT unit, day, value, {SLOT} AS slot FROM unit_daily WHERE day BETWEEN DATE '1996-01-01' AND
        DATE '1998-12-31'),
      m AS (SELECT unit, slot, avg(value) AS p FROM src GROUP BY unit, slot HAVING count(*) >= 2),
      r AS (SELECT unit, slot, value - p AS residual, p FROM src JOIN m USING (unit, slot))
    SELECT unit, slot, r4(any_value(p)) AS prediction, {", ".join(f"r4(any_value(p) + quantile_cont(residual, {b / 100})) AS p{b}" for b in models.BANDS)}
    FROM r GROUP BY unit, slot""",
)
def m26(spark, folder):
    period = F.col("day").between("1996-01-01", "1998-12-31")
    rows = stored(weekday_slot(unit_daily(spark, folder).filter(period)))
    keys = ["unit", "slot"]
    params = models.fit(rows, keys, "value")
    res = models.predict(rows, params, keys).withColumn("residual", F.col("value") - F.col("prediction"))
    bands = models.residual_bands(res.filter("residual is not null"), keys, "residual")
    out = bands.join(params.select(*keys, F.col("intercept").alias("prediction")), keys)
    return out.select(
        *keys, r4("prediction"), *[r4(F.col("prediction") + F.col(f"r{b}"), f"p{b}") for b in models.BANDS]
    )


@query(
    "w22_smooth_band",
    f"""WITH d AS (SELECT energy, hour, value - lag(value) OVER w AS v, row_number() OVER w AS rn FROM energy_hourly
        WINDOW w AS (PARTITION BY energy ORDER BY hour)),
      n AS (SELECT energy, hour, v, rn - 1 AS rn, lead(v) OVER (PARTITION BY energy ORDER BY rn) AS nx,
        max(rn) OVER (PARTITION BY energy) - 1 AS last FROM d WHERE rn > 1),
      s(energy, hour, rn, s) AS (SELECT energy, hour, rn, CASE WHEN v < -10 THEN nx ELSE v END FROM n WHERE rn = 1
        UNION ALL SELECT n.energy, n.hour, n.rn, CASE WHEN v >= -10 THEN v WHEN n.rn = last THEN s.s
          ELSE (s.s + nx) / 2 END FROM s JOIN n ON n.energy = s.energy AND n.rn = s.rn + 1)
    SELECT energy, strftime(hour, {TS}) AS hour, r4(s) AS value FROM s""",
)
def w22(spark, folder):
    from meterloom.functions.ordered import first_difference

    d = first_difference(energy_hourly(spark, folder), ["energy"], ["hour"], "value", "v").filter("v is not null")
    return models.smooth_band(d, ["energy"], "hour", "v", "s").select("energy", stamp("hour"), r4("s", "value"))
