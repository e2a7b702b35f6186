"""Cleaning and resampling of raw readings, bills and weather."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterloom.functions import scalars as S
from meterloom.functions.ordered import first_difference, running_total
from meterloom.operators import align, clean, grid
from meterloom.plans import views
from meterloom.plans.registry import query
from meterloom.plans.shared import (
    by_month,
    energy_counter,
    energy_grid,
    energy_hourly,
    meters,
    r4,
    series,
    stamp,
    stored,
    text,
    whole,
)

TS = "'%Y-%m-%d %H:%M:%S'"
ZLIMIT = 3.0  # lower than clean.ZSCORE_LIMIT so that the test tables have outliers


@query("w01_dedupe_last", "SELECT device, CAST(day AS VARCHAR) AS day, value FROM series")
def w01(spark, folder):
    return series(spark, folder).select("device", text("day"), "value")


@query(
    "w01_dropped_duplicates",
    """SELECT device, CAST(day AS VARCHAR) AS day, count(*) - 1 AS dropped FROM daily
    GROUP BY device, day HAVING count(*) > 1""",
)
def w01_dropped(spark, folder):
    return align.duplicates(views.daily(spark, folder), ["device", "day"]).select("device", text("day"), "dropped")


@query(
    "a01_resample_sum",
    f"""WITH s AS (SELECT energy, time_bucket(INTERVAL 30 MINUTES, ts) AS bin, sum(value) AS value FROM readings
      GROUP BY ALL), g AS (SELECT energy, unnest(generate_series(min(bin), max(bin), INTERVAL 30 MINUTES)) AS bin
      FROM s GROUP BY energy)
    SELECT energy, strftime(bin, {TS}) AS bin, r4(coalesce(value, 0)) AS value FROM g LEFT JOIN s USING (energy, bin)""",
)
def a01(spark, folder):
    out = grid.resample_sum(
        views.readings(spark, folder), ["energy"], S.bin_start("ts", 1800), "value", grid.STEPS[1800]
    )
    return out.select("energy", stamp("bin"), r4("value"))


@query(
    "a02_resample_counter",
    f"""WITH c AS (SELECT energy, ts, sum(value) OVER (PARTITION BY energy ORDER BY ts, event_id
        ROWS UNBOUNDED PRECEDING) AS acc FROM readings),
      t AS (SELECT energy, date_trunc('hour', ts) AS bin, max(acc) AS c FROM c GROUP BY ALL),
      g AS (SELECT energy, unnest(generate_series(min(bin), max(bin), INTERVAL 1 HOUR)) AS bin FROM t GROUP BY energy),
      f AS (SELECT energy, bin, c FROM g LEFT JOIN t USING (energy, bin)),
      i AS ({views.interpolated("f", "energy", "bin", "c")})
    SELECT energy, strftime(bin, {TS}) AS bin, r4(c - lag(c) OVER (PARTITION BY energy ORDER BY bin)) AS value FROM i""",
)
def a02(spark, folder):
    out = grid.counter_movement(energy_counter(spark, folder), ["energy"], "bin", "counter", 3600)
    return out.select("energy", stamp("bin"), r4("value"))


_STEP = """WITH d AS (SELECT device, energy, CAST(floor(epoch(ts)) AS BIGINT) - CAST(floor(epoch(lag(ts) OVER
      (PARTITION BY device, energy ORDER BY ts))) AS BIGINT) AS step FROM readings),
  m AS (SELECT device, energy, step, count(*) AS n FROM d WHERE step IS NOT NULL GROUP BY ALL),
  i AS (SELECT device, energy, count(*) AS n, any_value(k.interval_s) AS interval_s FROM readings
    LEFT JOIN (SELECT device, energy, arg_min(step, ROW(-n, step)) AS interval_s FROM m GROUP BY device, energy) k
    USING (device, energy) GROUP BY device, energy)"""


def _intervals(spark, folder):
    return clean.dominant_interval(views.readings(spark, folder), ["device", "energy"], "ts", by_month())


@query(
    "a03_dominant_interval",
    _STEP + " SELECT device, energy, n, CAST(interval_s AS DOUBLE) AS interval_s FROM i",
)
def a03(spark, folder):
    return _intervals(spark, folder).select("device", "energy", "n", F.col("interval_s").cast("double").alias("interval_s"))


@query(
    "a04_series_kind",
    """SELECT device, energy, count(value) AS n_value, count(accumulated) AS n_counter,
      CASE WHEN count(value) = 0 AND count(accumulated) = 0 THEN 'empty' WHEN count(value) = 0 THEN 'counter'
        WHEN count(accumulated) = 0 THEN 'instant' ELSE 'mixed' END AS kind FROM meters GROUP BY device, energy""",
)
def a04(spark, folder):
    return clean.series_kind(meters(spark, folder), ["device", "energy"])


@query(
    "a05_hourly_rule",
    _STEP
    + """ SELECT device, energy, CAST(CASE WHEN interval_s <= 1800 THEN 1800 WHEN interval_s <= 3600 THEN 3600 END
      AS DOUBLE) AS bin_s FROM i""",
)
def a05(spark, folder):
    rule = clean.hourly_rule(F.col("interval_s")).cast("double").alias("bin_s")
    return _intervals(spark, folder).select("device", "energy", rule)


@query(
    "a06_daily_rule",
    _STEP
    + """ SELECT device, energy, CASE WHEN interval_s < 86400 THEN 'bin' WHEN interval_s IS NOT NULL THEN 'spread' END
      AS rule FROM i""",
)
def a06(spark, folder):
    return _intervals(spark, folder).select("device", "energy", clean.daily_rule(F.col("interval_s")).alias("rule"))


_BILL_DAYS = """WITH days AS (SELECT device, bill_id, ini, CAST(unnest(generate_series(ini, fin, INTERVAL 1 DAY)) AS DATE)
    AS day, value / (fin - ini + 1) AS value FROM bills)"""


@query(
    "a07_spread_bill",
    _BILL_DAYS + " SELECT device, bill_id, CAST(day AS VARCHAR) AS day, r4(value) AS value FROM days",
)
def a07(spark, folder):
    out = grid.spread_interval(views.bills(spark, folder), "ini", "fin", "value")
    return out.select("device", "bill_id", text("day"), r4("value"))


@query(
    "w21_bill_overlap",
    _BILL_DAYS
    + """ SELECT device, CAST(day AS VARCHAR) AS day, count(*) AS n_bills, r4(arg_max(value, ROW(ini, bill_id)))
      AS kept FROM days GROUP BY device, day HAVING count(*) > 1""",
)
def w21(spark, folder):
    out = clean.bill_overlaps(clean.bill_days(views.bills(spark, folder), ["device"]))
    return out.select("device", text("day"), "n_bills", r4("value", "kept"))


@query(
    "a08_spread_readings",
    f"""WITH t AS (SELECT device, day, sum(value) OVER (PARTITION BY device ORDER BY day ROWS UNBOUNDED PRECEDING) AS c
        FROM series),
      g AS (SELECT device, CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day
        FROM t GROUP BY device),
      f AS (SELECT device, day, c FROM g LEFT JOIN t USING (device, day)),
      i AS ({views.interpolated("f", "device", "day", "c")})
    SELECT device, CAST(day AS VARCHAR) AS day, r4(c - lag(c) OVER (PARTITION BY device ORDER BY day)) AS value FROM i""",
)
def a08(spark, folder):
    return grid.spread_readings(series(spark, folder), ["device"], "day", "value").select(
        "device", text("day"), r4("value")
    )


@query(
    "w03_first_difference",
    f"""SELECT device, energy, strftime(ts, {TS}) AS ts, event_id, r4(value - lag(value) OVER
      (PARTITION BY device, energy ORDER BY ts, event_id)) AS diff FROM readings""",
)
def w03(spark, folder):
    out = first_difference(
        views.readings(spark, folder), ["device", "energy"], ["ts", "event_id"], "value", "diff", by_month()
    )
    return out.select("device", "energy", stamp("ts"), "event_id", r4("diff"))


@query(
    "w04_interpolate",
    f"""WITH g AS (SELECT unit, CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day
        FROM unit_daily GROUP BY unit),
      f AS (SELECT unit, day, value FROM g LEFT JOIN unit_daily USING (unit, day)),
      i AS ({views.interpolated("f", "unit", "day", "value")})
    SELECT unit, CAST(day AS VARCHAR) AS day, r4(value) AS value FROM i""",
)
def w04(spark, folder):
    from meterloom.plans.shared import unit_daily

    full = grid.fill_grid(unit_daily(spark, folder), ["unit"], "day", grid.STEPS[86400])
    return grid.interpolate(full, ["unit"], "day", "value", "value").select("unit", text("day"), r4("value"))


@query(
    "w07_rolling_outliers",
    f"""SELECT energy, strftime(hour, {TS}) AS hour, coalesce(abs(value - avg(value) OVER w) > {ZLIMIT} *
      stddev_samp(value) OVER w, false) AS outlier FROM energy_grid
    WINDOW w AS (PARTITION BY energy ORDER BY hour ROWS BETWEEN 167 PRECEDING AND CURRENT ROW)""",
)
def w07(spark, folder):
    out = clean.rolling_outliers(energy_grid(spark, folder), ["energy"], "hour", "value", 168, ZLIMIT, "outlier")
    return out.select("energy", stamp("hour"), "outlier")


@query(
    "w08_day_gaps",
    """SELECT device, CAST(p AS VARCHAR) AS gap_from, CAST(day AS VARCHAR) AS gap_to FROM (SELECT device, day,
      lag(day) OVER (PARTITION BY device ORDER BY day) AS p FROM series) WHERE day - p > 1""",
)
def w08(spark, folder):
    out = clean.day_gaps(views.daily(spark, folder), ["device"], "day")
    return out.select("device", text("gap_from"), text("gap_to"))


@query(
    "w08_bill_gaps",
    _BILL_DAYS
    + """, u AS (SELECT DISTINCT device, day FROM days)
    SELECT device, CAST(p AS VARCHAR) AS gap_from, CAST(day AS VARCHAR) AS gap_to FROM (SELECT device, day,
      lag(day) OVER (PARTITION BY device ORDER BY day) AS p FROM u) WHERE day - p > 1""",
)
def w08_bills(spark, folder):
    days = grid.spread_interval(views.bills(spark, folder), "ini", "fin", "value")
    return clean.day_gaps(days, ["device"], "day").select("device", text("gap_from"), text("gap_to"))


@query(
    "w09_running_total",
    """SELECT device, CAST(day AS VARCHAR) AS day, c - first_value(value) OVER w AS counter,
      c - lag(c) OVER w AS movement FROM (SELECT *, sum(value) OVER (PARTITION BY device ORDER BY day
        ROWS UNBOUNDED PRECEDING) AS c FROM series) WINDOW w AS (PARTITION BY device ORDER BY day)""",
)
def w09(spark, folder):
    s = running_total(series(spark, folder), ["device"], ["day"], "value", "c")
    first = s.groupBy("device").agg(F.min_by("value", "day").alias("first"))
    s = s.join(first, "device").withColumn("counter", F.col("c") - F.col("first"))
    out = first_difference(s, ["device"], ["day"], "counter", "movement")
    return out.select("device", text("day"), "counter", "movement")


@query(
    "w15_chained_start",
    """SELECT device, bill_id, CAST(lag(fin) OVER (PARTITION BY device ORDER BY fin, bill_id) + 1 AS VARCHAR)
      AS chained_ini, CAST(fin AS VARCHAR) AS fin FROM bills""",
)
def w15(spark, folder):
    out = clean.chained_start(views.bills(spark, folder), ["device"], "fin", ["fin", "bill_id"], F.trunc("fin", "year"))
    return out.select("device", "bill_id", text("chained_ini"), text("fin"))


GAP_S = 48 * 3600
_GAPS = f"""WITH p AS (SELECT device, ts, lag(ts) OVER (PARTITION BY device ORDER BY ts) AS p FROM readings),
  f AS (SELECT *, coalesce(floor(epoch(ts)) - floor(epoch(p)) > {GAP_S}, false) AS gap FROM p),
  i AS (SELECT *, count(*) FILTER (NOT gap) OVER (PARTITION BY device ORDER BY ts ROWS UNBOUNDED PRECEDING) AS i FROM f),
  gaps AS (SELECT device, min(p) AS gap_from, max(ts) AS gap_to FROM i WHERE gap GROUP BY device, i)"""


def _gaps(spark, folder):
    return clean.long_gaps(views.readings(spark, folder), ["device"], "ts", GAP_S, by_month())


@query(
    "w16_long_gaps",
    _GAPS + f" SELECT device, strftime(gap_from, {TS}) AS gap_from, strftime(gap_to, {TS}) AS gap_to FROM gaps",
)
def w16(spark, folder):
    return _gaps(spark, folder).select("device", stamp("gap_from"), stamp("gap_to"))


_REGULAR = f"""WITH r AS (SELECT energy, ts, sum(value) OVER w AS v, lag(ts) OVER w AS b, lead(ts) OVER w AS a FROM
    readings WINDOW w AS (PARTITION BY energy ORDER BY ts)),
  g AS (SELECT energy, unnest(generate_series(make_timestamp(CAST(ceil(epoch(min(ts)) / 900) * 900 AS BIGINT) * 1000000),
    make_timestamp(CAST(floor(epoch(max(ts)) / 900) * 900 AS BIGINT) * 1000000), INTERVAL 15 MINUTES)) AS ts
    FROM readings GROUP BY energy),
  n AS (SELECT g.energy, g.ts, r.ts AS lt, r.v AS lv, r.a AS nt, r.b FROM g ASOF LEFT JOIN r
    ON g.energy = r.energy AND g.ts >= r.ts),
  k AS (SELECT n.*, r.v AS nv FROM n LEFT JOIN r ON r.energy = n.energy AND r.ts = n.nt),
  q AS (SELECT energy, ts, CASE WHEN ts = lt OR nt IS NULL THEN lv ELSE lv + (nv - lv) *
      (epoch_us(ts) - epoch_us(lt)) / (epoch_us(nt) - epoch_us(lt)) END AS v,
    coalesce(floor(epoch(nt)) - floor(epoch(lt)) > 1800, false) OR (ts = lt AND coalesce(floor(epoch(lt)) -
      floor(epoch(b)) > 1800, false)) AS missing FROM k)"""


def _regular(spark, folder):
    return grid.regularise(views.readings(spark, folder), ["energy"], "ts", "value", 900)


@query(
    "w17_missing_flags",
    _REGULAR + f" SELECT energy, strftime(ts, {TS}) AS ts, missing FROM q",
)
def w17(spark, folder):
    return _regular(spark, folder).select("energy", stamp("ts"), "missing")


@query(
    "m35_regular_grid",
    _REGULAR
    + f""" SELECT energy, strftime(ts, {TS}) AS ts, r4(v - lag(v) OVER (PARTITION BY energy ORDER BY ts)) AS value,
      missing FROM q""",
)
def m35(spark, folder):
    return _regular(spark, folder).select("energy", stamp("ts"), r4("value"), "missing")


TRIM_DAYS = 12


@query(
    "w18_trim_ends",
    f"""WITH n AS (SELECT device, day, value, lag(day) OVER w AS p, lead(day) OVER w AS n FROM series
        WINDOW w AS (PARTITION BY device ORDER BY day)),
      b AS (SELECT device, min(day) FILTER (n IS NULL OR n - day < {TRIM_DAYS}) AS a,
        max(day) FILTER (p IS NULL OR day - p < {TRIM_DAYS}) AS b FROM n GROUP BY device)
    SELECT device, CAST(day AS VARCHAR) AS day, value FROM series JOIN b USING (device) WHERE day BETWEEN a AND b""",
)
def w18(spark, folder):
    out = clean.trim_ends(series(spark, folder), ["device"], "day", TRIM_DAYS * 86400)
    return out.select("device", text("day"), "value")


def _arrival():
    return F.floor(F.col("l_orderkey") / 10000)


@query(
    "w19_increasing_times",
    """SELECT device, CAST(day AS VARCHAR) AS day, l_orderkey, l_linenumber, l_partkey FROM (SELECT *, max(day) OVER
      (PARTITION BY device ORDER BY l_orderkey, l_linenumber, l_partkey ROWS BETWEEN UNBOUNDED PRECEDING
      AND 1 PRECEDING) AS m FROM daily) WHERE m IS NULL OR day > m""",
)
def w19(spark, folder):
    out = clean.increasing_times(views.daily(spark, folder), ["device"], views.TIE, "day", _arrival())
    return out.select("device", text("day"), *[whole(c) for c in views.TIE])


# The check repeats the filter often enough for the test tables; further rounds change nothing.
ROUNDS = 40
_EXTREMES = "WITH r0 AS (SELECT energy, hour, value FROM energy_hourly), " + ", ".join(
    f"""r{i + 1} AS MATERIALIZED (SELECT energy, hour, value FROM (SELECT *, avg(value) OVER w AS m, stddev_pop(value) OVER w AS s
      FROM r{i} WINDOW w AS (PARTITION BY energy)) WHERE value BETWEEN m - {ZLIMIT} * s AND m + {ZLIMIT} * s)"""
    for i in range(ROUNDS)
)


@query("w20_remove_extremes", _EXTREMES + f" SELECT energy, strftime(hour, {TS}) AS hour, r4(value) AS value FROM r{ROUNDS}")
def w20(spark, folder):
    out = clean.remove_extremes(stored(energy_hourly(spark, folder)), ["energy"], "value", ZLIMIT)
    return out.select("energy", stamp("hour"), r4("value"))


_CLEAN = (
    """WITH inc AS (SELECT device, ts, value FROM (SELECT *, max(ts) OVER (PARTITION BY device ORDER BY event_id ROWS BETWEEN
      UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM readings) WHERE m IS NULL OR ts > m),
    nb AS (SELECT device, ts, lag(ts) OVER w AS p, lead(ts) OVER w AS n FROM inc WINDOW w AS (PARTITION BY device ORDER BY ts)),
    body AS (SELECT device, min(ts) FILTER (n IS NULL OR floor(epoch(n)) - floor(epoch(ts)) < 604800) AS a,
      max(ts) FILTER (p IS NULL OR floor(epoch(ts)) - floor(epoch(p)) < 604800) AS b FROM nb GROUP BY device),
    r0 AS (SELECT device, ts, value FROM inc JOIN body USING (device) WHERE ts BETWEEN a AND b), """
    + ", ".join(
        f"""q{i} AS (SELECT device, ts, value, value / ((epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY device ORDER BY ts))) / 1e6)
          AS rate FROM r{i}),
        r{i + 1} AS MATERIALIZED (SELECT device, ts, value FROM (SELECT *, avg(rate) OVER w AS m, stddev_pop(rate) OVER w AS s FROM q{i}
          WINDOW w AS (PARTITION BY device)) WHERE rate IS NULL OR s IS NULL OR rate BETWEEN greatest(m - {ZLIMIT} * s, 0) AND m + {ZLIMIT} * s)"""
        for i in range(ROUNDS)
    )
)


@query("m36_clean_series", _CLEAN + f" SELECT device, strftime(ts, {TS}) AS ts, r4(value) AS value FROM r{ROUNDS}")
def m36(spark, folder):
    out = clean.clean_series(
        views.readings(spark, folder).select("device", "event_id", "ts", "value"),
        ["device"],
        ["event_id"],
        "ts",
        "value",
        "electricity",
        sd_limit=ZLIMIT,
        chunk=by_month(),
        arrival_chunk=F.floor(F.col("event_id") / 100000),
    )
    return out.select("device", stamp("ts"), r4("value"))


PERIOD = ("2024-01-05 00:00:00", "2024-01-20 00:00:00")


@query(
    "w27_clip_gaps",
    _GAPS
    + f""" SELECT device, strftime(greatest(gap_from, TIMESTAMP '{PERIOD[0]}'), {TS}) AS gap_from,
      strftime(least(gap_to, TIMESTAMP '{PERIOD[1]}'), {TS}) AS gap_to FROM gaps
    WHERE gap_to >= TIMESTAMP '{PERIOD[0]}' AND gap_from <= TIMESTAMP '{PERIOD[1]}'""",
)
def w27_clip(spark, folder):
    at = [F.to_timestamp(F.lit(p)) for p in PERIOD]
    return clean.clip_gaps(_gaps(spark, folder), *at).select("device", stamp("gap_from"), stamp("gap_to"))


@query(
    "w27_merge_gaps",
    """WITH b AS (SELECT device, ini, max(fin) AS fin FROM bills GROUP BY device, ini),
      m AS (SELECT *, max(fin) OVER (PARTITION BY device ORDER BY ini ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        AS r FROM b),
      i AS (SELECT *, count(*) FILTER (r IS NULL OR ini > r) OVER (PARTITION BY device ORDER BY ini
        ROWS UNBOUNDED PRECEDING) AS i FROM m)
    SELECT device, CAST(min(ini) AS VARCHAR) AS gap_from, CAST(max(fin) AS VARCHAR) AS gap_to FROM i GROUP BY device, i""",
)
def w27_merge(spark, folder):
    b = views.bills(spark, folder).withColumnsRenamed({"ini": "gap_from", "fin": "gap_to"})
    odd = F.col("bill_id") % 2 == 1
    out = clean.merge_gaps(b.filter(odd), b.filter(~odd), ["device"], chunk=F.trunc("gap_from", "year"))
    return out.select("device", text("gap_from"), text("gap_to"))


@query(
    "w28_flag_runs",
    _REGULAR
    + f""", c AS (SELECT *, lag(missing) OVER (PARTITION BY energy ORDER BY ts) AS p FROM q),
      i AS (SELECT *, count(*) FILTER (p IS NULL OR p <> missing) OVER (PARTITION BY energy ORDER BY ts
        ROWS UNBOUNDED PRECEDING) AS i FROM c)
    SELECT energy, missing, strftime(min(ts), {TS}) AS run_from, strftime(max(ts), {TS}) AS run_to, count(*) AS n
    FROM i GROUP BY energy, missing, i""",
)
def w28(spark, folder):
    out = clean.flag_runs(_regular(spark, folder), ["energy"], "ts", "missing")
    return out.select("energy", "missing", stamp("run_from"), stamp("run_to"), "n")


@query(
    "f09_threshold_outliers",
    "SELECT event_id, CASE WHEN value BETWEEN 1 AND 100 THEN value END AS value FROM readings",
)
def f09(spark, folder):
    return views.readings(spark, folder).select("event_id", S.within("value", 1.0, 100.0).alias("value"))


_ZSCORE = f"""WITH s AS (SELECT energy, avg(value) AS m, stddev_samp(value) AS s FROM energy_hourly WHERE value >= 0
  GROUP BY energy), z AS (SELECT e.*, coalesce(value < 0, false) AS negative,
  coalesce(abs(CASE WHEN value >= 0 THEN value END - m) > {ZLIMIT} * s + 1e-9 * abs(m), false) AS outlier
  FROM energy_hourly e LEFT JOIN s USING (energy))"""


def _hourly_clean(spark, folder):
    return clean.clean_consumption(energy_hourly(spark, folder), ["energy"], "value", ZLIMIT)


@query(
    "f10_zscore_outliers",
    _ZSCORE
    + f""" SELECT energy, strftime(hour, {TS}) AS hour, outlier, r4(CASE WHEN NOT outlier AND value >= 0 THEN value END)
      AS value FROM z""",
)
def f10(spark, folder):
    return _hourly_clean(spark, folder).select("energy", stamp("hour"), "outlier", r4("value"))


@query(
    "a19_quality_report",
    _ZSCORE
    + f""", d AS (SELECT energy, count(*) - count(DISTINCT date_trunc('second', ts)) AS n_duplicated FROM readings
        GROUP BY energy),
      gp AS (SELECT energy, hour, lag(hour) OVER (PARTITION BY energy ORDER BY hour) AS p FROM z)
    , gn AS (SELECT energy, count(*) AS n_gaps FROM gp WHERE hour - p > INTERVAL 1 HOUR GROUP BY energy)
    SELECT energy, n_duplicated, coalesce(n_gaps, 0) AS n_gaps, count(*) FILTER (negative) AS n_negative, count(*) FILTER (outlier) AS n_outlier,
      coalesce(string_agg(strftime(hour, {TS}), ',' ORDER BY hour) FILTER (outlier), '') AS outliers
    FROM z JOIN d USING (energy) LEFT JOIN gn USING (energy) GROUP BY energy, n_duplicated, n_gaps""",
)
def a19(spark, folder):
    from meterloom.operators.quality import quality_report

    out = quality_report(views.readings(spark, folder), _hourly_clean(spark, folder), ["energy"], "ts", "hour", 3600)
    return out.select(
        "energy",
        "n_duplicated",
        "n_gaps",
        "n_negative",
        "n_outlier",
        F.array_join(
            F.transform("outliers", lambda x: F.date_format(x, "yyyy-MM-dd HH:mm:ss")), ","
        ).alias("outliers"),
    )


@query(
    "a39_series_status",
    _STEP
    + """, k AS (SELECT device, energy, count(value) AS nv, count(accumulated) AS nc FROM meters GROUP BY ALL)
    SELECT device, energy, CASE WHEN nv = 0 AND nc = 0 THEN 'no data' WHEN interval_s IS NULL THEN 'no interval'
      WHEN nv > 0 AND nc > 0 THEN 'counter and instant values' ELSE 'ok' END AS status
    FROM i JOIN k USING (device, energy)""",
)
def a39(spark, folder):
    keys = ["device", "energy"]
    kinds = clean.series_kind(meters(spark, folder), keys)
    return clean.series_status(kinds, _intervals(spark, folder), keys).select(*keys, "status")


@query(
    "p19_route_series",
    _STEP
    + """, k AS (SELECT device, energy, count(value) AS nv, count(accumulated) AS nc FROM meters GROUP BY ALL)
    SELECT device, energy, CASE WHEN coalesce(interval_s, 172800) > 86400 AND nc = 0 THEN 'billing'
      WHEN coalesce(interval_s, 172800) > 86400 THEN 'monthly metering' ELSE 'metering' END AS route
    FROM i JOIN k USING (device, energy)""",
)
def p19(spark, folder):
    keys = ["device", "energy"]
    kinds = clean.series_kind(meters(spark, folder), keys)
    return clean.route_series(kinds, _intervals(spark, folder), keys).select(*keys, "route")


@query(
    "clean_weather",
    """SELECT station, CAST(day AS VARCHAR) AS day, NOT (temperature BETWEEN 6 AND 24) AS outlier,
      r4(CASE WHEN temperature BETWEEN 6 AND 24 THEN temperature END) AS temperature FROM meteo_daily""",
)
def clean_weather(spark, folder):
    out = clean.clean_weather(views.meteo_daily(spark, folder), ["station"], "temperature", 6.0, 24.0)
    return out.select("station", text("day"), "outlier", r4("temperature"))


@query(
    "clean_bills",
    _BILL_DAYS
    + """, shifted AS (SELECT device, day, ini, bill_id, CASE WHEN bill_id % 50 = 0 THEN -value ELSE value END AS value FROM days),
      kept AS (SELECT device, day, arg_max(value, ROW(ini, bill_id)) AS value FROM shifted GROUP BY device, day)
    SELECT device, CAST(day AS VARCHAR) AS day, 'billing' AS data_type, value < 0 AS negative,
      r4(CASE WHEN value >= 0 THEN value END) AS value FROM kept""",
)
def clean_bills(spark, folder):
    """Bills lose their negative values only; a fiftieth of the bills is made negative here."""
    bills = views.bills(spark, folder)
    bills = bills.withColumn("value", F.when(F.col("bill_id") % 50 == 0, -F.col("value")).otherwise(F.col("value")))
    out = clean.drop_negatives(clean.bill_days(bills, ["device"]), "value")
    return out.select("device", text("day"), F.lit("billing").alias("data_type"), "negative", r4("value"))
