"""Whole cleaning jobs over meters of every kind and step, bills and weather stations."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterloom.functions.ordered import running_total
from meterloom.operators import jobs
from meterloom.plans import views
from meterloom.plans.model_queries import _SHOW, _backtest_sql, _backtest_tail
from meterloom.plans.registry import query
from meterloom.plans.shared import by_month, r4, stamp, text
from meterloom.sources import sinks

TS = "'%Y-%m-%d %H:%M:%S'"
KEYS = ["device", "energy"]
LIMIT = 3.0  # lower than in production, so that the test tables have outliers

# Nine meters an energy type: three kinds (instant, counter, both) by three steps (minutes, hours, days).
_RAW = """WITH jr AS (SELECT device % 9 AS device, energy, CASE (device % 9) // 3 WHEN 0 THEN date_trunc('minute', ts)
      WHEN 1 THEN date_trunc('hour', ts) ELSE date_trunc('day', ts) END::TIMESTAMP AS ts, event_id,
      CASE WHEN event_id % 40 = 0 THEN -value ELSE value END AS v FROM readings),
  jm AS (SELECT device, energy, ts, event_id, CASE WHEN device % 3 <> 1 THEN v END AS value, CASE WHEN device % 3 <> 0 THEN
      sum(v) OVER (PARTITION BY device, energy ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) END AS accumulated FROM jr),
  dd AS MATERIALIZED (SELECT device, energy, ts, count(*) AS n, arg_max(value, event_id) AS value,
      arg_max(accumulated, event_id) AS accumulated FROM jm GROUP BY device, energy, ts),
  df AS (SELECT device, energy, (epoch(ts) - epoch(lag(ts) OVER (PARTITION BY device, energy ORDER BY ts)))::BIGINT AS step FROM dd),
  dm AS (SELECT device, energy, step, count(*) AS n FROM df WHERE step IS NOT NULL GROUP BY ALL),
  di AS (SELECT device, energy, arg_min(step, ROW(-n, step)) AS interval_s FROM dm GROUP BY device, energy),
  dk AS (SELECT device, energy, count(value) AS nv, count(accumulated) AS nc FROM dd GROUP BY device, energy),
  ser AS MATERIALIZED (SELECT device, energy, interval_s, {width} AS w, {slow} AS slow, CASE WHEN nv = 0 AND nc = 0 THEN 'no data'
      WHEN interval_s IS NULL THEN 'no interval' WHEN nv > 0 AND nc > 0 THEN 'counter and instant values'
      WHEN {width} IS NULL THEN 'too slow' ELSE 'ok' END AS status, nc > 0 AS is_counter FROM dk LEFT JOIN di USING (device, energy)),
  bn AS (SELECT device, energy, w, slow, is_counter, make_timestamp((floor(epoch(ts) / w) * w)::BIGINT * 1000000) AS bin, value, accumulated
    FROM dd JOIN ser USING (device, energy) WHERE status = 'ok'),
  si AS (SELECT device, energy, w, bin, sum(value) AS v FROM bn WHERE NOT is_counter AND NOT slow GROUP BY ALL),
  gi AS (SELECT device, energy, w, unnest(generate_series(min(bin), max(bin), to_seconds(w))) AS bin FROM si GROUP BY device, energy, w),
  sc AS (SELECT device, energy, w, bin, max(accumulated) AS c FROM bn WHERE is_counter GROUP BY ALL),
  gc AS (SELECT device, energy, w, unnest(generate_series(min(bin), max(bin), to_seconds(w))) AS bin FROM sc GROUP BY device, energy, w),
  fc AS (SELECT device, energy, w, bin, c FROM gc LEFT JOIN sc USING (device, energy, w, bin)),
  ic AS ({interpolated}),
  sd AS (SELECT *, lag(bin) OVER (PARTITION BY device, energy ORDER BY bin) AS p FROM
    (SELECT device, energy, w, bin, sum(value) AS v FROM bn WHERE NOT is_counter AND slow GROUP BY ALL)),
  series_values AS (SELECT device, energy, w, bin, coalesce(v, 0) AS v FROM gi LEFT JOIN si USING (device, energy, w, bin)
    UNION ALL SELECT device, energy, w, bin, c - lag(c) OVER (PARTITION BY device, energy ORDER BY bin) FROM ic
    UNION ALL SELECT device, energy, w, unnest(generate_series(coalesce(p + INTERVAL 1 DAY, bin), bin, INTERVAL 1 DAY)) AS bin,
      v / date_diff('day', p, bin) FROM sd),
  st AS (SELECT device, energy, avg(v) AS m, stddev_samp(v) AS s FROM series_values WHERE v >= 0 GROUP BY device, energy),
  fl AS MATERIALIZED (SELECT device, energy, w, bin, v, coalesce(v < 0, false) AS negative,
    coalesce(v >= 0 AND abs(v - m) > {limit} * s + 1e-9 * abs(m), false) AS outlier
    FROM series_values LEFT JOIN st USING (device, energy)),
  iss AS MATERIALIZED (SELECT device, energy, 'duplicated' AS issue, ts FROM dd WHERE n > 1 UNION ALL
    SELECT device, energy, 'gap', bin FROM fl WHERE v IS NULL OR negative OR outlier UNION ALL
    SELECT device, energy, 'negative', bin FROM fl WHERE negative UNION ALL SELECT device, energy, 'outlier', bin FROM fl WHERE outlier)"""


def _raw_sql(width: str, slow: str, limit: float | str) -> str:
    line = views.interpolated("fc", "device, energy", "bin", "c").replace("SELECT device, energy, bin,", "SELECT device, energy, w, bin,", 1)
    return _RAW.format(width=width, slow=slow, limit=limit, interpolated=line)


_HOURLY = _raw_sql("CASE WHEN interval_s <= 1800 THEN 1800 WHEN interval_s <= 3600 THEN 3600 END", "false", LIMIT)
_DAILY = _raw_sql("86400", "coalesce(interval_s >= 86400, false)", "1e300")
_CLEAN = f""" SELECT device, energy, w::BIGINT AS step_s, strftime(bin, {TS}) AS ts, r4(CASE WHEN NOT negative AND NOT outlier THEN v END)
  AS value FROM fl"""
_TEXT = """CASE WHEN interval_s >= 86400 THEN (interval_s // 86400)::VARCHAR || CASE WHEN interval_s // 86400 = 1 THEN ' day, ' ELSE ' days, ' END
  ELSE '' END || printf('%d:%02d:%02d', interval_s % 86400 // 3600, interval_s % 3600 // 60, interval_s % 60)"""
_LETTER = """CASE WHEN interval_s % 86400 = 0 THEN 'D' WHEN interval_s % 3600 = 0 THEN 'H' WHEN interval_s % 60 = 0 THEN 'T'
  WHEN interval_s IS NOT NULL THEN 'S' END"""


def _quality(frequency: str) -> str:
    counts = ", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in ("duplicated", "gap", "negative", "outlier"))
    own = ", ".join(f"count(*) FILTER (issue = '{k}') AS n_{k}" for k in ("duplicated", "gap", "negative", "outlier"))
    return f""" SELECT device, energy, status, {frequency} AS frequency, {counts} FROM ser LEFT JOIN (SELECT device, energy, {own}
      FROM iss GROUP BY device, energy) USING (device, energy)"""


def job_meters(spark, folder):
    unit = F.floor(F.col("device") % 9 / 3)
    ts = F.when(unit == 0, F.date_trunc("minute", "ts")).when(unit == 1, F.date_trunc("hour", "ts")).otherwise(F.date_trunc("day", "ts"))
    rows = views.readings(spark, folder).drop("props").withColumn("ts", ts).withColumn("device", F.col("device") % 9)
    rows = rows.withColumn("value", F.when(F.col("event_id") % 40 == 0, -F.col("value")).otherwise(F.col("value")))
    rows = running_total(rows, KEYS, ["ts", "event_id"], "value", "accumulated", by_month())
    kind = F.col("device") % 3
    both = {"value": F.when(kind != 1, F.col("value")), "accumulated": F.when(kind != 0, F.col("accumulated"))}
    return rows.withColumns(both)


def _hourly(spark, folder):
    return jobs.clean_metering(job_meters(spark, folder), KEYS, "ts", order=["event_id"], limit=LIMIT, chunk=by_month())


def _daily(spark, folder):
    return jobs.clean_metering(job_meters(spark, folder), KEYS, "ts", order=["event_id"], daily=True, limit=None, chunk=by_month())


def _record(found):
    return found.quality.select(*KEYS, "status", "frequency", *[f"n_{k}" for k in ("duplicated", "gap", "negative", "outlier")])


@query("clean_hourly", _HOURLY + _CLEAN)
def clean_hourly(spark, folder):
    """The clean table of the hourly job, as read back from where the job stores it."""
    path = sinks.work_path(spark, "hourly")
    found = _hourly(spark, folder)
    jobs.store(spark, path, found, KEYS, ["energy"])
    rows = sinks.read_version(spark, f"{path}/clean", found.clean.schema, ["energy"])
    return rows.select(*KEYS, "step_s", stamp("ts"), r4("value"))


@query("clean_hourly_quality", _HOURLY + _quality(_TEXT))
def clean_hourly_quality(spark, folder):
    return _record(_hourly(spark, folder))


@query("clean_hourly_issues", _HOURLY + f" SELECT device, energy, issue, strftime(ts, {TS}) AS ts FROM iss")
def clean_hourly_issues(spark, folder):
    return _hourly(spark, folder).issues.select(*KEYS, "issue", stamp("ts"))


@query("clean_daily_metering", _DAILY + _CLEAN)
def clean_daily_metering(spark, folder):
    return _daily(spark, folder).clean.select(*KEYS, "step_s", stamp("ts"), r4("value"))


@query("clean_daily_quality", _DAILY + _quality(_LETTER))
def clean_daily_quality(spark, folder):
    return _record(_daily(spark, folder))


_BILLS = """WITH bd AS (SELECT device, bill_id, ini, CAST(unnest(generate_series(ini, fin, INTERVAL 1 DAY)) AS DATE) AS day,
      CASE WHEN bill_id % 50 = 0 THEN -value ELSE value END / (fin - ini + 1) AS value FROM bills),
  bk AS (SELECT device, day, arg_max(value, ROW(ini, bill_id)) AS value, count(*) AS n FROM bd GROUP BY device, day),
  bg AS (SELECT device, count(*) AS n_gap FROM (SELECT device, day, lag(day) OVER (PARTITION BY device ORDER BY day) AS p FROM bk)
    WHERE day - p > 1 GROUP BY device)"""


@query(
    "quality_bills",
    _BILLS
    + """ SELECT device, count(*) AS n_days, CAST(min(day) AS VARCHAR) AS first_day, CAST(max(day) AS VARCHAR) AS last_day,
      count(*) FILTER (n > 1) AS n_overlap, coalesce(any_value(n_gap), 0) AS n_gap, count(*) FILTER (value < 0) AS n_negative
    FROM bk LEFT JOIN bg USING (device) GROUP BY device""",
)
def quality_bills(spark, folder):
    bills = views.bills(spark, folder)
    bills = bills.withColumn("value", F.when(F.col("bill_id") % 50 == 0, -F.col("value")).otherwise(F.col("value")))
    out = jobs.clean_billing(bills, ["device"]).quality
    return out.select("device", "n_days", text("first_day"), text("last_day"), "n_overlap", "n_gap", "n_negative")


LOW, HIGH = 1.0, 100.0  # of the readings that play temperatures here

_WEATHER = f"""WITH wr AS (SELECT device % 5 AS station, date_trunc('hour', ts)::TIMESTAMP AS ts, event_id, value AS temperature FROM readings),
  wd AS (SELECT station, ts, count(*) AS n, arg_max(temperature, event_id) AS t FROM wr GROUP BY station, ts)"""


def _stations(spark, folder):
    rows = views.readings(spark, folder).select(
        (F.col("device") % 5).alias("station"), F.date_trunc("hour", "ts").alias("ts"), "event_id", F.col("value").alias("temperature")
    )
    return jobs.clean_station(rows, ["station"], "ts", "temperature", LOW, HIGH, ["event_id"])


@query(
    "clean_station_weather",
    _WEATHER + f" SELECT station, strftime(ts, {TS}) AS ts, r4(CASE WHEN t BETWEEN {LOW} AND {HIGH} THEN t END) AS temperature FROM wd",
)
def clean_station_weather(spark, folder):
    return _stations(spark, folder).clean.select("station", stamp("ts"), r4("temperature"))


@query(
    "quality_weather",
    _WEATHER
    + f""" SELECT station, count(*) AS n_rows, count(*) FILTER (n > 1) AS n_duplicated, count(*) FILTER (t < {LOW}) AS n_below,
      count(*) FILTER (t > {HIGH}) AS n_above, count(*) FILTER (t IS NULL OR t < {LOW} OR t > {HIGH}) AS n_gap FROM wd GROUP BY station""",
)
def quality_weather(spark, folder):
    return _stations(spark, folder).quality.select("station", "n_rows", "n_duplicated", "n_below", "n_above", "n_gap")


# --- hourly baseline -------------------------------------------------------------------------------

# Clean series as two sources, the second one with every other value and a tenth less; two devices a unit.
_UNITS = (
    _HOURLY
    + """, cons AS (SELECT device, energy, w, bin, CASE WHEN NOT negative AND NOT outlier THEN v END AS v FROM fl),
  two AS (SELECT *, 'A' AS source FROM cons UNION ALL SELECT device, energy, w, bin, v * 0.9, 'R' FROM cons WHERE hour(bin) % 2 = 0),
  pref AS (SELECT device, energy, w, bin, arg_max(ROW(v), CASE source WHEN 'R' THEN 1 ELSE 0 END) AS r FROM two GROUP BY ALL),
  dev AS (SELECT device, device // 2 AS unit, 1 + 0.5 * (device % 3) AS multiplier FROM (SELECT DISTINCT device FROM cons)),
  need AS (SELECT unit, energy, w, count(*) AS m FROM (SELECT DISTINCT device, energy, w FROM pref) JOIN dev USING (device) GROUP BY ALL),
  total AS (SELECT unit, energy, w, bin AS hour, sum(r[1] * multiplier) AS value, count(*) AS n FROM pref JOIN dev USING (device)
    WHERE r[1] IS NOT NULL GROUP BY ALL),
  units_at AS MATERIALIZED (SELECT t.unit, t.energy, t.w, t.hour, t.value, m.temperature + t.unit / 10.0 AS temperature FROM total t
    JOIN need USING (unit, energy, w) JOIN (SELECT hour, avg(temperature) AS temperature FROM meteo_hourly GROUP BY hour) m
    ON m.hour = date_trunc('hour', t.hour) WHERE n = need.m)"""
)
_SLOT = "strftime(hour, '%a %H:%M')"


def _baseline_sql(step: int) -> str:
    source = f"SELECT unit, energy, hour, value, temperature, {_SLOT} AS slot FROM units_at WHERE w = {step}"
    tail = _backtest_tail("unit, energy", "hour", f"strftime(hour, {TS})")
    body = _backtest_sql(source, "unit, energy", "hour", 7 * 86400 // step, jobs.FOLDS, False, tail, step < jobs.HOUR)
    return f"{_UNITS}, {body.strip()[5:]}"


def _unit_series(spark, folder):
    found = _hourly(spark, folder).clean.withColumn("source", F.lit("A"))
    second = found.filter(F.hour("ts") % 2 == 0).withColumns({"source": F.lit("R"), "value": F.col("value") * 0.9})
    bridge = found.select("device").distinct().withColumns(
        {"unit": F.floor(F.col("device") / 2), "multiplier": 1 + 0.5 * (F.col("device") % 3), "station": F.floor(F.col("device") / 2)}
    )
    # The units' stations have the mean of all stations and a little more, so that no hour is without weather.
    weather = views.meteo_hourly(spark, folder).groupBy("hour").agg(F.avg("temperature").alias("t"))
    weather = weather.withColumn("station", F.explode(F.array(*[F.lit(i).cast("bigint") for i in range(5)])))
    weather = weather.withColumn("temperature", F.col("t") + F.col("station") / 10)
    return jobs.unit_series(found.unionByName(second), bridge, weather, ["R", "A"])


def _baseline(spark, folder, step):
    out = jobs.baseline(_unit_series(spark, folder).filter(F.col("step_s") == step), step, water=["view"])
    return out.select("unit", "energy", stamp("hour"), F.col("fold").cast("bigint").alias("fold"), *[r4(c) for c in _SHOW])


@query("baseline_hourly", _baseline_sql(jobs.HOUR))
def baseline_hourly(spark, folder):
    return _baseline(spark, folder, jobs.HOUR)


@query("baseline_half_hourly", _baseline_sql(jobs.HALF_HOUR))
def baseline_half_hourly(spark, folder):
    return _baseline(spark, folder, jobs.HALF_HOUR)
