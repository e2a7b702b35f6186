"""Reconciliation, sanity checks, set operations, sorting and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterloom.functions import scalars as S
from meterloom.functions.ordered import Step, ordered_scan
from meterloom.operators import align, clean, quality
from meterloom.plans import views
from meterloom.plans.registry import query
from meterloom.plans.shared import (
    by_month,
    energy_hourly,
    energy_model,
    preferred,
    r4,
    series,
    stamp,
    stored,
    text,
    unit_daily,
    whole,
)
from meterloom.sources.tables import load

TS = "'%Y-%m-%d %H:%M:%S'"

# --- bills ------------------------------------------------------------------------

_BILLSTAT = """WITH p AS (SELECT *, lag(fin) OVER (PARTITION BY device ORDER BY fin, bill_id) AS prev_fin FROM bills),
  d AS (SELECT *, CAST(fin - prev_fin AS DOUBLE) AS days, value / nullif(CAST(fin - prev_fin AS DOUBLE), 0) AS per_day FROM p),
  s AS (SELECT device, count(*) AS n_bills, avg(days) AS mean_days, avg(per_day) AS mean_per_day FROM d GROUP BY device),
  g AS (SELECT d.*, days / nullif(mean_days, 0) AS day_ratio, least(mean_per_day / nullif(per_day, 0), 3) AS use_ratio,
    coalesce(n_bills >= 3 AND days / nullif(mean_days, 0) > 1.7 AND least(mean_per_day / nullif(per_day, 0), 3) > 1.7,
      false) AS gap FROM d JOIN s USING (device))"""


def _bill_rows(spark, folder):
    b = views.bills(spark, folder)
    order = ["fin", "bill_id"]
    return ordered_scan(b, ["device"], order, [Step("prev_fin", "prev", F.col("fin"))], F.trunc("fin", "year"))


@query(
    "a30_bill_gap_statistics",
    _BILLSTAT
    + """ SELECT device, bill_id, CASE WHEN mean_ok THEN r4(day_ratio) END AS day_ratio, r4(use_ratio) AS use_ratio, gap
    FROM (SELECT *, day_ratio IS NOT NULL AS mean_ok FROM g)""",
)
def a30(spark, folder):
    out = quality.bill_gap_statistics(_bill_rows(spark, folder), ["device"])
    return out.select("device", "bill_id", r4("day_ratio"), r4("use_ratio"), "gap")


@query(
    "a30_bill_medians_modes",
    _BILLSTAT
    + """, c AS (SELECT device, days, count(*) AS n FROM d WHERE days IS NOT NULL GROUP BY ALL),
      m AS (SELECT device, arg_min(days, ROW(-n, days)) AS days_mode FROM c GROUP BY device)
    SELECT device, r4(quantile_cont(days, 0.5)) AS days_median, any_value(days_mode) AS days_mode,
      r4(avg(days)) AS days_mean FROM d JOIN m USING (device) WHERE days IS NOT NULL GROUP BY device""",
)
def a30_medians(spark, folder):
    rows = quality.bill_gap_statistics(_bill_rows(spark, folder), ["device"])
    out = quality.medians_and_modes(rows, ["device"], "days", "days")
    return out.select("device", r4("days_median"), "days_mode", r4("days_mean"))


@query(
    "a31_removed_share",
    _BILLSTAT
    + """ SELECT count(*) FILTER (gap) AS n_removed, count(*) AS n_rows, r4(count(*) FILTER (gap) / count(*)) AS share FROM g""",
)
def a31(spark, folder):
    rows = quality.bill_gap_statistics(_bill_rows(spark, folder), ["device"])
    return quality.removed_share(rows, "gap").select("n_removed", "n_rows", r4("share"))


# --- reconciliation ---------------------------------------------------------------


def _old_new(spark, folder):
    d = views.daily(spark, folder)
    keys = ["device", "day"]
    old = align.keep_last(d.filter("source <> 'N'"), keys, views.TIE, ["value"])
    new = align.keep_last(d.filter("source <> 'A'"), keys, views.TIE, ["value"])
    return old, new


_OLDNEW = """WITH o AS (SELECT device, day, arg_max(value, ROW(l_orderkey, l_linenumber, l_partkey)) AS value FROM daily
    WHERE source <> 'N' GROUP BY device, day),
  n AS (SELECT device, day, arg_max(value, ROW(l_orderkey, l_linenumber, l_partkey)) AS value FROM daily
    WHERE source <> 'A' GROUP BY device, day)"""


@query(
    "j11_old_new_join",
    _OLDNEW
    + """ SELECT device, CAST(day AS VARCHAR) AS day, o.value AS old_value, n.value AS new_value,
      CASE WHEN o.value IS NULL THEN 'added' WHEN n.value IS NULL THEN 'missing' WHEN o.value = n.value THEN 'same'
        ELSE 'changed' END AS status FROM o FULL JOIN n USING (device, day)""",
)
def j11(spark, folder):
    old, new = _old_new(spark, folder)
    out = align.reconcile(old, new, ["device", "day"], "value")
    return out.select("device", text("day"), "old_value", "new_value", "status")


@query(
    "a32_total_reconciliation",
    _OLDNEW
    + """, a AS (SELECT device, sum(value) AS old_total FROM o GROUP BY device),
      b AS (SELECT device, sum(value) AS new_total FROM n GROUP BY device)
    SELECT device, old_total, new_total, r4((old_total - new_total) / old_total) AS error,
      CASE WHEN old_total IS NULL THEN 'only new' WHEN new_total IS NULL THEN 'only old'
        WHEN abs((old_total - new_total) / old_total) > 5 THEN 'over limit' ELSE 'ok' END AS status
    FROM a FULL JOIN b USING (device)""",
)
def a32(spark, folder):
    old, new = _old_new(spark, folder)
    out = quality.total_reconciliation(old, new, ["device"], "value")
    return out.select("device", "old_total", "new_total", r4("error"), "status")


# --- weather stations, recent data, scores -----------------------------------------

_STEPS = """WITH s AS (SELECT station, round(temperature - lag(temperature) OVER (PARTITION BY station ORDER BY hour), 2) AS step
    FROM meteo_hourly), c AS (SELECT station, step, count(*) AS n FROM s WHERE step IS NOT NULL GROUP BY ALL),
  t AS (SELECT station, count(*) AS n_rows FROM meteo_hourly GROUP BY station)"""


@query(
    "a33_station_sanity",
    _STEPS
    + """ SELECT station, n_rows, r4(max(n) / n_rows) AS top_share, coalesce(max(n) / n_rows >= 0.2, true) AS bad
    FROM t LEFT JOIN c USING (station) GROUP BY station, n_rows""",
)
def a33(spark, folder):
    out = quality.station_sanity(views.meteo_hourly(spark, folder), ["station"], "hour", "temperature", 2)
    return out.select("station", "n_rows", r4("top_share"), "bad")


@query(
    "o06_most_common",
    """WITH c AS (SELECT device, value, count(*) AS n FROM daily GROUP BY ALL)
    SELECT device, value, n, place FROM (SELECT *, row_number() OVER (PARTITION BY device ORDER BY n DESC, value) AS place
      FROM c) WHERE place <= 5""",
)
def o06(spark, folder):
    return quality.most_common(views.daily(spark, folder), ["device"], "value").select(
        "device", "value", "n", whole("place")
    )


_RECENT = """WITH d AS (SELECT device, energy, CAST(floor(epoch(ts)) AS BIGINT) - CAST(floor(epoch(lag(ts) OVER
      (PARTITION BY device, energy ORDER BY ts))) AS BIGINT) AS step FROM readings),
  m AS (SELECT device, energy, step, count(*) AS n FROM d WHERE step IS NOT NULL GROUP BY ALL),
  i AS (SELECT device, energy, arg_min(step, ROW(-n, step)) AS step FROM m GROUP BY device, energy),
  l AS (SELECT device, energy, max(ts) AS last_ts FROM readings GROUP BY ALL),
  f AS (SELECT device, energy, coalesce(step <= 3600, false) AND last_ts >= TIMESTAMP '2024-04-20 00:00:00' - INTERVAL 84 DAY
    AS has_hourly FROM l LEFT JOIN i USING (device, energy))"""


def _recent(spark, folder):
    r = views.readings(spark, folder)
    keys = ["device", "energy"]
    found = clean.dominant_interval(r, keys, "ts", by_month())
    latest = r.groupBy(*keys).agg(F.max("ts").alias("last_ts"))
    return quality.recent_hourly_flag(found, latest, keys, "2024-04-20 00:00:00")


@query("a36_recent_hourly", _RECENT + " SELECT device, energy, has_hourly FROM f")
def a36(spark, folder):
    return _recent(spark, folder).select("device", "energy", "has_hourly")


@query(
    "a36_building_flag",
    _RECENT + " SELECT device % 10 AS building, bool_or(has_hourly) AS has_hourly FROM f GROUP BY device % 10",
)
def a36_building(spark, folder):
    flags = _recent(spark, folder).withColumn("building", F.col("device") % 10)
    return flags.groupBy("building").agg(F.bool_or("has_hourly").alias("has_hourly"))


_LINE = """WITH p AS (SELECT energy, regr_slope(value, temperature) AS b, regr_intercept(value, temperature) AS a
    FROM energy_model GROUP BY energy),
  r AS (SELECT energy, hour, value, a + b * temperature AS pred, value - (a + b * temperature) AS res
    FROM energy_model JOIN p USING (energy))"""


def _line_residuals(spark, folder):
    rows = stored(energy_model(spark, folder))
    fit = rows.groupBy("energy").agg(
        F.regr_slope("value", "temperature").alias("b"), F.regr_intercept("value", "temperature").alias("a")
    )
    out = rows.join(fit, "energy").withColumn("pred", F.col("a") + F.col("b") * F.col("temperature"))
    return out.withColumn("res", F.col("value") - F.col("pred"))


@query(
    "a37_validation_scores",
    _LINE
    + """ SELECT energy, r4(corr(value, pred) ** 2) AS r2, r4(sqrt(avg((value - pred) ** 2)) / avg(value)) AS nrmse,
      r4(avg(abs((value - pred) / nullif(value, 0)))) AS mape FROM r GROUP BY energy""",
)
def a37(spark, folder):
    out = quality.validation_scores(_line_residuals(spark, folder), ["energy"], "value", "pred")
    return out.select("energy", r4("r2"), r4("nrmse"), r4("mape"))


@query(
    "a38_autocorrelation",
    _LINE
    + ", l AS (SELECT *, "
    + ", ".join(f"lag(res, {k}) OVER (PARTITION BY energy ORDER BY hour) AS l{k}" for k in range(1, 25))
    + " FROM r), w AS (SELECT energy, "
    + ", ".join(f"corr(res, l{k}) AS c{k}" for k in range(1, 25))
    + " FROM l GROUP BY energy), rr AS (SELECT energy, ["
    + ", ".join(f"c{k}" for k in range(1, 25))
    + """] AS r FROM w), dl AS (SELECT energy, r, 1 AS k, [r[1]] AS phi, r[1] AS p FROM rr
    UNION ALL SELECT energy, r, k + 1, list_append(list_transform(list_zip(phi, list_reverse(phi)), lambda z: z[1] - q * z[2]), q), q
      FROM (SELECT *, (r[k + 1] - list_dot_product(phi, list_reverse(r[1:k]))) / (1 - list_dot_product(phi, r[1:k])) AS q
        FROM dl WHERE k < 24))
    SELECT energy, CAST(k AS BIGINT) AS lag, r4(r[k]) AS acf, r4(p) AS pacf FROM dl""",
)
def a38(spark, folder):
    out = quality.autocorrelation(_line_residuals(spark, folder), ["energy"], "hour", "res", 24)
    return out.select("energy", whole("lag"), r4("acf"), r4("pacf"))


# --- set operations and sorting -----------------------------------------------------


@query("u01_union_distinct", """SELECT device, CAST(day AS VARCHAR) AS day, value FROM (SELECT device, day, value FROM daily WHERE source = 'R'
    UNION SELECT device, day, value FROM daily WHERE source = 'A' UNION SELECT device, day, value FROM daily WHERE source = 'N')""")
def u01(spark, folder):
    d = views.daily(spark, folder)
    parts = [d.filter(F.col("source") == s).select("device", "day", "value") for s in views.SOURCES]
    return parts[0].union(parts[1]).union(parts[2]).distinct().select("device", text("day"), "value")


@query(
    "u02_tagged_union",
    """SELECT device, CAST(day AS VARCHAR) AS day, value, 'metering' AS data_type FROM series
    UNION ALL SELECT device, CAST(ini AS VARCHAR), value, 'billing' FROM bills""",
)
def u02(spark, folder):
    metering = series(spark, folder).withColumn("data_type", F.lit("metering"))
    billing = views.bills(spark, folder).select(
        "device", F.col("ini").alias("day"), "value", F.lit("billing").alias("data_type")
    )
    return metering.unionByName(billing).select("device", text("day"), "value", "data_type")


@query(
    "u03_day_difference",
    """SELECT device, CAST(day AS VARCHAR) AS day FROM (SELECT device, day FROM daily WHERE source = 'R'
    EXCEPT SELECT device, day FROM daily WHERE source = 'A')""",
)
def u03(spark, folder):
    d = views.daily(spark, folder)
    left = d.filter("source = 'R'").select("device", "day").distinct()
    return left.join(d.filter("source = 'A'").select("device", "day"), ["device", "day"], "left_anti").select(
        "device", text("day")
    )


@query(
    "u04_day_intersection",
    """SELECT device, CAST(day AS VARCHAR) AS day FROM (SELECT device, day FROM daily WHERE source = 'R'
    INTERSECT SELECT device, day FROM daily WHERE source = 'A')""",
)
def u04(spark, folder):
    d = views.daily(spark, folder)
    left = d.filter("source = 'R'").select("device", "day").distinct()
    return left.join(d.filter("source = 'A'").select("device", "day"), ["device", "day"], "left_semi").select(
        "device", text("day")
    )


@query(
    "o01_sort_in_series",
    "SELECT device, CAST(day AS VARCHAR) AS day, row_number() OVER (PARTITION BY device ORDER BY day) AS position FROM series",
)
def o01(spark, folder):
    w = F.col("day")
    out = ordered_scan(series(spark, folder), ["device"], ["day"], [Step("position", "count", w)])
    return out.select("device", text("day"), whole("position"))


@query(
    "o02_sort_by_preference",
    """SELECT device, CAST(day AS VARCHAR) AS day, source, row_number() OVER (PARTITION BY device, day ORDER BY
      CASE source WHEN 'R' THEN 0 WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END) AS place
    FROM (SELECT DISTINCT device, day, source FROM daily)""",
)
def o02(spark, folder):
    from meterloom.operators.compare import rank_by

    d = views.daily(spark, folder).select("device", "day", "source").distinct()
    out = rank_by(d, ["device", "day"], [S.rank_of("source", views.SOURCES)], "place")
    return out.select("device", text("day"), "source", whole("place"))


@query(
    "o04_first_rows",
    f"""SELECT energy, strftime(hour, {TS}) AS hour, r4(value) AS value FROM (SELECT *, row_number() OVER (PARTITION BY energy
      ORDER BY hour) AS rn FROM energy_hourly) WHERE rn <= 72""",
)
def o04(spark, folder):
    out = ordered_scan(energy_hourly(spark, folder), ["energy"], ["hour"], [Step("rn", "count", F.col("hour"))])
    return out.filter("rn <= 72").select("energy", stamp("hour"), r4("value"))


# --- projections and predicates --------------------------------------------------------

_FROM, _TO = "1997-01-01", "1998-06-30"


@query(
    "p01_time_range",
    f"SELECT device, CAST(day AS VARCHAR) AS day, value, source FROM daily WHERE day BETWEEN DATE '{_FROM}' AND DATE '{_TO}'",
)
def p01(spark, folder):
    from meterloom.sources.tables import scan

    raw = scan(
        load(spark, folder, "lineitem"),
        ["l_suppkey", "l_shipdate", "l_quantity", "l_returnflag"],
        "l_shipdate",
        _ts(_FROM),
        _ts(_TO),
    )
    return raw.select(
        F.col("l_suppkey").alias("device"),
        F.to_date("l_shipdate").cast("string").alias("day"),
        F.col("l_quantity").alias("value"),
        F.col("l_returnflag").alias("source"),
    )


def _ts(day: str):
    import datetime as dt

    return dt.datetime.fromisoformat(day).replace(tzinfo=dt.timezone.utc)


@query(
    "p02_bill_touches_range",
    f"""SELECT bill_id, (ini BETWEEN DATE '{_FROM}' AND DATE '{_TO}') OR (fin BETWEEN DATE '{_FROM}' AND DATE '{_TO}') AS touches,
      ini <= DATE '{_TO}' AND fin >= DATE '{_FROM}' AS overlaps FROM bills""",
)
def p02(spark, folder):
    from meterloom.sources.ingest import bill_overlaps_range, bill_touches_range

    args = ("ini", "fin", F.to_date(F.lit(_FROM)), F.to_date(F.lit(_TO)))
    return views.bills(spark, folder).select(
        "bill_id", bill_touches_range(*args).alias("touches"), bill_overlaps_range(*args).alias("overlaps")
    )


@query(
    "p03_listed_devices",
    "SELECT device, CAST(day AS VARCHAR) AS day, value FROM daily WHERE device IN (SELECT device FROM units WHERE station < 10)",
)
def p03(spark, folder):
    listed = views.units(spark, folder).filter("station < 10")
    return align.keep_listed(views.daily(spark, folder), listed).select("device", text("day"), "value")


@query("p04_parse_number", "SELECT bill_id, TRY_CAST(split_part(company, '-', 2) AS DOUBLE) AS word, TRY_CAST(split_part(company, '-', 1) AS DOUBLE) AS num FROM bills")
def p04(spark, folder):
    parts = F.split("company", "-")
    return views.bills(spark, folder).select(
        "bill_id", S.to_number(parts[1]).alias("word"), S.to_number(parts[0]).alias("num")
    )


@query(
    "p05_finite_only",
    "SELECT event_id, CASE WHEN value = 0 THEN NULL ELSE r4(1000 / value) END AS ratio FROM readings",
)
def p05(spark, folder):
    ratio = F.when(F.col("value") == 0, F.lit("Infinity")).otherwise((1000 / F.col("value")).cast("string"))
    return views.readings(spark, folder).select("event_id", r4(S.finite(ratio), "ratio"))


@query(
    "p06_drop_bad_rows",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM readings
    WHERE ts IS NOT NULL AND energy IS NOT NULL AND TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) IS NOT NULL""",
)
def p06(spark, folder):
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    return (
        views.readings(spark, folder)
        .withColumn("k", k)
        .filter(F.col("ts").isNotNull() & F.col("energy").isNotNull() & F.col("k").isNotNull())
        .select("event_id", "k")
    )


@query(
    "p07_look_back",
    """SELECT device, CAST(day AS VARCHAR) AS day, value FROM daily WHERE day BETWEEN DATE '2001-06-30' - INTERVAL 24 MONTH
      AND DATE '2001-06-30'""",
)
def p07(spark, folder):
    to = F.to_date(F.lit("2001-06-30"))
    return views.daily(spark, folder, S.months_back(to, 24), to).select("device", text("day"), "value")


ENERGY_NAMES = {"view": "electricity", "click": "electricity", "purchase": "gas"}


@query(
    "p08_comparable_type",
    """SELECT CASE energy WHEN 'view' THEN 'electricity' WHEN 'click' THEN 'electricity' WHEN 'purchase' THEN 'gas'
      ELSE energy END AS energy, count(*) AS n, r4(sum(value)) AS total FROM readings GROUP BY 1""",
)
def p08(spark, folder):
    out = views.readings(spark, folder).groupBy(S.mapped("energy", ENERGY_NAMES).alias("energy"))
    return out.agg(F.count("*").alias("n"), r4(F.sum("value"), "total"))


@query(
    "p09_to_kilo",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, r4(CASE WHEN l_returnflag = 'A' THEN l_quantity / 1000
      WHEN l_returnflag = 'N' THEN l_quantity * 1000 ELSE l_quantity END) AS kilo FROM lineitem""",
)
def p09(spark, folder):
    unit = F.when(F.col("l_returnflag") == "A", "Wh").when(F.col("l_returnflag") == "N", "MWh").otherwise("kWh")
    return load(spark, folder, "lineitem").select(
        "l_orderkey",
        whole("l_linenumber"),
        "l_partkey",
        "l_suppkey",
        r4(S.to_kilo(unit, "l_quantity"), "kilo"),
    )


@query(
    "p10_convert_unit",
    """SELECT event_id, CASE energy WHEN 'view' THEN r4(value * 3.6e3 / 3.6e6) WHEN 'click' THEN r4(value * 3.6e9 / 3.6e6)
      WHEN 'error' THEN NULL WHEN 'signup' THEN r4(value * 1e6 / 3.6e6) ELSE r4(value) END AS kwh,
      energy = 'error' AS incompatible FROM readings""",
)
def p10(spark, folder):
    names = {"view": "Wh", "click": "MWh", "error": "m3", "signup": "MJ", "purchase": "kWh"}
    kwh = S.convert_unit("value", S.mapped("energy", names), F.lit("kWh"))
    return views.readings(spark, folder).select("event_id", r4(kwh, "kwh"), kwh.isNull().alias("incompatible"))


@query("p14_not_in_future", "SELECT device, CAST(day AS VARCHAR) AS day, value FROM daily WHERE day <= DATE '2000-01-01'")
def p14(spark, folder):
    return views.daily(spark, folder, until="2000-01-01").select("device", text("day"), "value")


@query(
    "p16_drop_incomplete",
    "SELECT device, energy, event_id FROM meters WHERE value IS NOT NULL AND accumulated IS NOT NULL",
)
def p16(spark, folder):
    from meterloom.plans.shared import meters

    return meters(spark, folder).na.drop(subset=["value", "accumulated"]).select("device", "energy", "event_id")


@query("p17_model_features", f"SELECT station, strftime(hour, {TS}) AS hour, r4(ghi) AS ghi, wind_speed FROM meteo_hourly")
def p17(spark, folder):
    features = ["ghi", "wind_speed"]
    rows = views.meteo_hourly(spark, folder).select("station", "hour", *features)
    return rows.select("station", stamp("hour"), r4("ghi"), "wind_speed")


@query(
    "p18_calendar_keys",
    """SELECT year(day) AS y, month(day) AS m, day(day) AS d, count(*) AS n, sum(value) AS total FROM daily GROUP BY 1, 2, 3""",
)
def p18(spark, folder):
    out = views.daily(spark, folder).groupBy(
        whole(F.year("day"), "y"), whole(F.month("day"), "m"), whole(F.dayofmonth("day"), "d")
    )
    return out.agg(F.count("*").alias("n"), F.sum("value").alias("total"))


# --- scalar functions ---------------------------------------------------------------------


@query(
    "f01_epoch",
    f"SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS epoch_s, strftime(date_trunc('second', ts), {TS}) AS back FROM readings",
)
def f01(spark, folder):
    e = S.to_epoch("ts")
    return views.readings(spark, folder).select("event_id", e.alias("epoch_s"), stamp(S.from_epoch(e), "back"))


@query(
    "f02_truncation",
    f"""SELECT event_id, strftime(date_trunc('hour', ts), {TS}) AS h, CAST(CAST(ts AS DATE) AS VARCHAR) AS d,
      CAST(last_day(ts) AS VARCHAR) AS month_end, strftime(ts, '%Y%m') AS ym FROM readings""",
)
def f02(spark, folder):
    return views.readings(spark, folder).select(
        "event_id",
        stamp(F.date_trunc("hour", "ts"), "h"),
        F.to_date("ts").cast("string").alias("d"),
        F.last_day("ts").cast("string").alias("month_end"),
        S.month_label("ts").alias("ym"),
    )


@query("f03_week_slot", "SELECT event_id, strftime(ts, '%a %H:%M') AS slot FROM readings")
def f03(spark, folder):
    return views.readings(spark, folder).select("event_id", S.week_slot("ts").alias("slot"))


@query("f04_format_key", "SELECT strftime(day, '%Y-%m') AS slot, count(*) AS n, sum(value) AS total FROM daily GROUP BY 1")
def f04(spark, folder):
    out = views.daily(spark, folder).groupBy(S.format_slot("day", "yyyy-MM").alias("slot"))
    return out.agg(F.count("*").alias("n"), F.sum("value").alias("total"))


@query(
    "f05_local_calendar",
    f"""SELECT event_id, strftime(ts + INTERVAL 1 HOUR, {TS}) AS local, hour(ts + INTERVAL 1 HOUR) AS local_hour FROM readings""",
)
def f05(spark, folder):
    # Winter data, so the zone is one hour ahead throughout.
    local = S.local_time("ts", "Europe/Madrid")
    return views.readings(spark, folder).select("event_id", stamp(local, "local"), whole(F.hour(local), "local_hour"))


@query(
    "f06_hour_of_week",
    "SELECT event_id, isodow(ts) AS dow, hour(ts) AS h, hour(ts) + (isodow(ts) - 1) * 24 AS week_hour FROM readings",
)
def f06(spark, folder):
    return views.readings(spark, folder).select(
        "event_id",
        whole(S.iso_weekday("ts"), "dow"),
        whole(F.hour("ts"), "h"),
        whole(S.hour_of_week("ts"), "week_hour"),
    )


@query("f11_floored_log", "SELECT event_id, r4(ln(CASE WHEN value > 0 THEN value ELSE 0.01 END)) AS lv, r4(exp(ln(CASE WHEN value > 0 THEN value ELSE 0.01 END))) AS back FROM readings")
def f11(spark, folder):
    lv = S.floored_log("value")
    return views.readings(spark, folder).select("event_id", r4(lv, "lv"), r4(F.exp(lv), "back"))


@query("f12_clip_negative", "SELECT event_id, r4(greatest(value - 20, 0)) AS v FROM readings")
def f12(spark, folder):
    return views.readings(spark, folder).select("event_id", r4(S.not_negative(F.col("value") - 20), "v"))


@query("f18_key_text", "SELECT event_id, device || '~' || energy || '~' || event_id AS key, energy || '|' || event_id AS rest FROM readings")
def f18(spark, folder):
    key = S.join_key("device", "energy", "event_id")
    return views.readings(spark, folder).select(
        "event_id", key.alias("key"), F.array_join(S.key_parts(key, 1), "|").alias("rest")
    )


@query("s12_composite_key", "SELECT device || '~' || day AS key, value FROM series")
def s12(spark, folder):
    keyed = series(spark, folder).select(S.join_key("device", "day").alias("key"), "value")
    parts = S.key_parts("key")
    return keyed.select(S.join_key(parts[0], parts[1]).alias("key"), "value")


@query(
    "f17_dated_json",
    f"SELECT event_id, strftime(date_trunc('second', ts), {TS}) AS ts FROM readings",
)
def f17(spark, folder):
    doc = F.concat(F.lit('{"$date": '), F.unix_millis("ts").cast("string"), F.lit("}"))
    return views.readings(spark, folder).select("event_id", stamp(S.dated_json(doc), "ts"))


@query(
    "f19_output_arrays",
    """SELECT unit, string_agg(CAST(month AS VARCHAR), ',' ORDER BY month) AS months,
      string_agg(CAST(n_days AS VARCHAR), ',' ORDER BY month) AS days FROM unit_monthly GROUP BY unit""",
)
def f19(spark, folder):
    from meterloom.operators.compare import monthly_means

    m = monthly_means(unit_daily(spark, folder), ["unit"], "day", "value")
    # A unit's months are bounded by the look-back, so the array is too.
    doc = m.groupBy("unit").agg(F.sort_array(F.collect_list(F.struct("month", "n_days"))).alias("doc"))
    return doc.select(
        "unit",
        F.array_join(F.transform("doc", lambda x: x.month.cast("string")), ",").alias("months"),
        F.array_join(F.transform("doc", lambda x: x.n_days.cast("string")), ",").alias("days"),
    )


@query(
    "p12_arrays_to_rows",
    "SELECT unit, CAST(month AS VARCHAR) AS month, r4(value) AS value FROM unit_monthly",
)
def p12(spark, folder):
    from meterloom.operators.compare import monthly_means

    m = monthly_means(unit_daily(spark, folder), ["unit"], "day", "value")
    sort = F.sort_array(F.collect_list(F.struct("month", "value")))
    docs = m.groupBy("unit").agg(sort.alias("doc")).select(
        "unit",
        F.transform("doc", lambda x: x.month).alias("timestamps"),
        F.transform("doc", lambda x: x["value"]).alias("values"),
    )
    rows = docs.select("unit", F.inline(F.arrays_zip("timestamps", "values")))
    return rows.select("unit", text("timestamps", "month"), r4("values", "value"))


@query(
    "f20_percent_distance",
    """WITH g AS (SELECT unit, avg(value) AS m FROM unit_monthly GROUP BY unit)
    SELECT unit, CAST(month AS VARCHAR) AS month, r4(abs((value - m) / m) * 100) AS distance,
      r4(sqrt(((value - m) / m * 100) ** 2 + ((n_days - m) / m * 100) ** 2)) AS norm FROM unit_monthly JOIN g USING (unit)""",
)
def f20(spark, folder):
    from meterloom.operators.compare import monthly_means

    m = monthly_means(unit_daily(spark, folder), ["unit"], "day", "value")
    rows = m.join(m.groupBy("unit").agg(F.avg("value").alias("m")), "unit")
    norm = S.percent_norm(F.array("value", F.col("n_days").cast("double")), F.array("m", "m"))
    return rows.select("unit", text("month"), r4(S.percent_distance("value", "m"), "distance"), r4(norm, "norm"))


@query("a18_distinct_lists", "SELECT DISTINCT energy, device % 10 AS company FROM readings")
def a18(spark, folder):
    return views.readings(spark, folder).select("energy", (F.col("device") % 10).alias("company")).distinct()
