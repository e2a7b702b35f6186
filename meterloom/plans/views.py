"""Metering views over the star schema.

Suppliers act as meters, line items as their daily readings (three sources),
events as raw sub-hourly readings of five energy types, orders as bills.
Weather is a fixed formula of station and time over the instants that occur in
the readings.  ``VIEW_SQL`` says the same thing in SQL for the result check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterloom.sources.tables import load

VIEW_SQL = {
    "daily": """SELECT l_suppkey AS device, CAST(l_shipdate AS DATE) AS day, l_quantity AS value,
        l_returnflag AS source, l_orderkey, l_linenumber, l_partkey FROM lineitem""",
    "readings": """SELECT user_id AS device, ts, event_type AS energy, value, event_id, props FROM events""",
    "bills": """SELECT o_custkey AS device, CAST(o_orderdate AS DATE) AS ini,
        CAST(o_orderdate AS DATE) + CAST(o_orderkey % 35 AS INTEGER) AS fin,
        o_totalprice AS value, o_orderkey AS bill_id, o_orderpriority AS company FROM orders""",
    "units": """SELECT s_suppkey AS device, CAST(s_suppkey // 2 AS BIGINT) AS unit,
        1 + 0.5 * CAST(s_suppkey % 3 AS DOUBLE) AS multiplier,
        CAST(s_suppkey % 25 AS BIGINT) AS station FROM supplier""",
    "buildings": """SELECT DISTINCT unit, unit % 5 AS use_type, unit % 3 AS organization,
        CAST(100 + 10 * (unit % 7) AS DOUBLE) AS area FROM units""",
    "meteo_daily": """SELECT DISTINCT device % 25 AS station, day,
        15 - 10 * cos(2 * pi() * dayofyear(day) / 365) + (device % 25) / 10.0 AS temperature FROM daily""",
    "meteo_hourly": """SELECT station, hour,
        15 - 10 * cos(2 * pi() * dayofyear(hour) / 365) + 4 * sin(2 * pi() * (hour(hour) - 9) / 24)
          + station / 10.0 AS temperature,
        greatest(0, 600 * sin(pi() * (hour(hour) - 6) / 12)) AS ghi,
        2 + ((hour(hour) + station) % 5) * 0.75 AS wind_speed,
        CAST((hour(hour) * 37 + station * 15) % 360 AS DOUBLE) AS wind_bearing
        FROM (SELECT DISTINCT device % 25 AS station, date_trunc('hour', ts) AS hour FROM readings)""",
    "series": """SELECT device, day, max_by(value, ROW(l_orderkey, l_linenumber, l_partkey)) AS value
        FROM daily GROUP BY device, day""",
    "preferred": """SELECT device, day, value FROM (SELECT *, row_number() OVER (PARTITION BY device, day
        ORDER BY CASE source WHEN 'R' THEN 0 WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END,
        l_orderkey DESC, l_linenumber DESC, l_partkey DESC) AS rn FROM daily) WHERE rn = 1""",
    "present": """SELECT unit, count(DISTINCT device) AS n_devices FROM daily JOIN units USING (device) GROUP BY unit""",
    "unit_daily": """SELECT unit, day, value FROM (SELECT unit, day, sum(value * multiplier) AS value,
        count(value) AS n FROM preferred JOIN units USING (device) GROUP BY unit, day)
        JOIN present USING (unit) WHERE n = n_devices""",
    "unit_monthly": """SELECT unit, CAST(date_trunc('month', day) AS DATE) AS month, avg(value) AS value,
        count(*) AS n_days FROM unit_daily GROUP BY 1, 2""",
    "energy_hourly": """SELECT energy, date_trunc('hour', ts) AS hour, sum(value) AS value
        FROM readings GROUP BY 1, 2""",
    "meters": """SELECT device, energy, ts, event_id, CASE WHEN device % 3 = 1 THEN NULL ELSE value END AS value,
        CASE WHEN device % 3 = 0 THEN NULL ELSE sum(value) OVER (PARTITION BY device, energy ORDER BY ts, event_id
          ROWS UNBOUNDED PRECEDING) END AS accumulated FROM readings""",
    "energy_model": """SELECT energy, hour, value, temperature FROM energy_hourly JOIN (SELECT hour,
        avg(temperature) AS temperature FROM meteo_hourly GROUP BY hour) USING (hour)""",
    "unit_station": "SELECT unit, min(station) AS station FROM units GROUP BY unit",
    "unit_model": """SELECT unit, day, value, temperature FROM unit_daily JOIN unit_station USING (unit)
        JOIN meteo_daily USING (station, day)""",
    "energy_grid": """SELECT energy, hour, coalesce(value, 0) AS value FROM (SELECT energy,
        unnest(generate_series(min(hour), max(hour), INTERVAL 1 HOUR)) AS hour FROM energy_hourly GROUP BY energy)
        LEFT JOIN energy_hourly USING (energy, hour)""",
    "load_input": """SELECT energy, hour, value, temperature, ghi, wind_speed, wind_bearing FROM energy_grid LEFT JOIN
        (SELECT hour, avg(temperature) AS temperature, max(ghi) AS ghi, avg(wind_speed) AS wind_speed,
          min(wind_bearing) AS wind_bearing FROM meteo_hourly GROUP BY hour) USING (hour)""",
}


def expand_r4(sql: str) -> str:
    """Write ``r4(x)`` out as a four-digit rounding that breaks ties the same way in both engines."""
    start = sql.find("r4(")
    if start < 0:
        return sql
    depth, end = 0, start + 2
    while True:
        depth += {"(": 1, ")": -1}.get(sql[end], 0)
        if depth == 0:
            break
        end += 1
    inner = expand_r4(sql[start + 3 : end])
    return f"{sql[:start]}round(({inner}) + 1e-9, 4){expand_r4(sql[end + 1 :])}"


def with_views(sql: str) -> str:
    body = expand_r4(sql.strip())
    head = ",\n".join(f"{name} AS ({text})" for name, text in VIEW_SQL.items())
    if body[:5].upper() == "WITH ":
        return f"WITH RECURSIVE {head},\n{body[5:]}"
    return f"WITH RECURSIVE {head}\n{body}"


def interpolated(source: str, keys: str, time: str, value: str) -> str:
    """Check SQL: linear interpolation in time on an already complete grid."""
    back = f"(PARTITION BY {keys} ORDER BY {time} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    ahead = f"(PARTITION BY {keys} ORDER BY {time} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    at = f"epoch({time})"
    known = f"CASE WHEN {value} IS NOT NULL THEN {at} END"
    return f"""SELECT {keys}, {time}, CASE WHEN {value} IS NOT NULL THEN {value} WHEN lv IS NULL OR nv IS NULL THEN lv
        ELSE lv + (nv - lv) * ({at} - lt) / (nt - lt) END AS {value} FROM (SELECT *,
        last_value({value} IGNORE NULLS) OVER {back} AS lv, last_value({known} IGNORE NULLS) OVER {back} AS lt,
        first_value({value} IGNORE NULLS) OVER {ahead} AS nv, first_value({known} IGNORE NULLS) OVER {ahead} AS nt
        FROM {source})"""


# Rank of a reading's source, first listed wins.
SOURCES = ["R", "A", "N"]
TIE = ["l_orderkey", "l_linenumber", "l_partkey"]


def daily(spark: SparkSession, folder: str, since=None, until=None) -> DataFrame:
    """Daily readings, optionally of the days ``since``..``until``; the range reaches the file scan."""
    raw = load(spark, folder, "lineitem")
    if since is not None:
        raw = raw.filter(F.col("l_shipdate") >= F.lit(since).cast("timestamp"))
    if until is not None:
        raw = raw.filter(F.col("l_shipdate") < F.date_add(F.lit(until).cast("date"), 1).cast("timestamp"))
    return raw.select(
        F.col("l_suppkey").alias("device"),
        F.to_date("l_shipdate").alias("day"),
        F.col("l_quantity").alias("value"),
        F.col("l_returnflag").alias("source"),
        *TIE,
    )


def readings(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "events").select(
        F.col("user_id").alias("device"), "ts", F.col("event_type").alias("energy"), "value", "event_id", "props"
    )


def bills(spark: SparkSession, folder: str) -> DataFrame:
    ini = F.to_date("o_orderdate")
    return load(spark, folder, "orders").select(
        F.col("o_custkey").alias("device"),
        ini.alias("ini"),
        F.date_add(ini, (F.col("o_orderkey") % 35).cast("int")).alias("fin"),
        F.col("o_totalprice").alias("value"),
        F.col("o_orderkey").alias("bill_id"),
        F.col("o_orderpriority").alias("company"),
    )


def units(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("s_suppkey")
    return load(spark, folder, "supplier").select(
        key.alias("device"),
        F.floor(key / 2).cast("bigint").alias("unit"),
        (1 + 0.5 * (key % 3)).alias("multiplier"),
        (key % 25).alias("station"),
    )


def buildings(spark: SparkSession, folder: str) -> DataFrame:
    u = F.col("unit")
    return (
        units(spark, folder)
        .select("unit")
        .distinct()
        .select(
            "unit",
            (u % 5).alias("use_type"),
            (u % 3).alias("organization"),
            (100 + 10 * (u % 7)).cast("double").alias("area"),
        )
    )


def _season(day) -> F.Column:
    return 15 - 10 * F.cos(2 * F.pi() * F.dayofyear(day) / 365)


def meteo_daily(spark: SparkSession, folder: str) -> DataFrame:
    return (
        daily(spark, folder)
        .select((F.col("device") % 25).alias("station"), "day")
        .distinct()
        .withColumn("temperature", _season("day") + F.col("station") / 10.0)
    )


def meteo_hourly(spark: SparkSession, folder: str) -> DataFrame:
    h, station = F.hour("hour"), F.col("station")
    return (
        readings(spark, folder)
        .select((F.col("device") % 25).alias("station"), F.date_trunc("hour", "ts").alias("hour"))
        .distinct()
        .select(
            "station",
            "hour",
            (_season("hour") + 4 * F.sin(2 * F.pi() * (h - 9) / 24) + station / 10.0).alias("temperature"),
            F.greatest(F.lit(0.0), 600 * F.sin(F.pi() * (h - 6) / 12)).alias("ghi"),
            (2 + ((h + station) % 5) * 0.75).alias("wind_speed"),
            ((h * 37 + station * 15) % 360).cast("double").alias("wind_bearing"),
        )
    )
