"""Hourly load model: profiles, clusters, features, fits and predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterloom.functions import scalars as S
from meterloom.operators import align, loadfit, loadmodel, usage
from meterloom.plans import views
from meterloom.plans.registry import query
from meterloom.plans.shared import energy_grid, energy_hourly, load_input, r4, stamp, stored, text, whole
from meterloom.sources import sinks

TS = "'%Y-%m-%d %H:%M:%S'"
LATITUDE, LONGITUDE = 41.6, 0.62
MODEL_START = "2024-01-24"  # rows before it train, rows from it on are predicted


@query(
    "j09_left_weather",
    f"""WITH use AS (SELECT device % 25 AS station, energy, date_trunc('hour', ts) AS hour, sum(value) AS value FROM readings GROUP BY ALL)
    SELECT station, energy, strftime(hour, {TS}) AS hour, r4(value) AS value, r4(temperature) AS temperature FROM use
    LEFT JOIN (SELECT * FROM meteo_hourly WHERE hour(hour) % 6 > 0) w USING (station, hour)""",
)
def j09(spark, folder):
    """Consumption at every station with its weather, which is missing every sixth hour."""
    use = views.readings(spark, folder).groupBy(
        (F.col("device") % 25).alias("station"), "energy", F.date_trunc("hour", "ts").alias("hour")
    )
    weather = views.meteo_hourly(spark, folder).filter(F.hour("hour") % 6 > 0)
    out = loadmodel.attach_weather(use.agg(F.sum("value").alias("value")), weather, ["station", "hour"], ["temperature"])
    return out.select("station", "energy", stamp("hour"), r4("value"), r4("temperature"))


# All hours of a day.
NEED = 24


@query(
    "a21_complete_days",
    f"""SELECT energy, strftime(hour, {TS}) AS hour, r4(value) AS value FROM energy_hourly WHERE (energy, CAST(hour AS DATE)) IN
      (SELECT (energy, CAST(hour AS DATE)) FROM energy_hourly GROUP BY energy, CAST(hour AS DATE) HAVING count(value) >= {NEED})""",
)
def a21(spark, folder):
    out = align.complete_days(energy_hourly(spark, folder), ["energy"], "hour", "value", NEED)
    return out.select("energy", stamp("hour"), r4("value"))


@query(
    "a22_rebin_model_input",
    f"""SELECT energy, strftime(date_trunc('hour', ts), {TS}) AS hour, r4(sum(value)) AS value, r4(max(temperature)) AS temperature,
      r4(max(ghi)) AS ghi FROM readings r JOIN meteo_hourly m ON r.device % 25 = m.station AND date_trunc('hour', r.ts) = m.hour
    GROUP BY energy, date_trunc('hour', ts)""",
)
def a22(spark, folder):
    rows = views.readings(spark, folder).withColumn("station", F.col("device") % 25)
    rows = align.weather_join(
        rows, views.meteo_hourly(spark, folder), F.date_trunc("hour", "ts"), F.col("hour"), ["temperature", "ghi"]
    )
    out = align.rebin_model_input(rows, ["energy"], "ts", "value", ["temperature", "ghi"])
    return out.select("energy", stamp("hour"), r4("value"), r4("temperature"), r4("ghi"))


@query(
    "a23_day_profiles",
    "SELECT energy, CAST(CAST(hour AS DATE) AS VARCHAR) AS day, "
    + ", ".join(f"r4(sum(value) FILTER (hour(hour) = {h})) AS h{h}" for h in range(24))
    + " FROM energy_hourly GROUP BY energy, CAST(hour AS DATE)",
)
def a23(spark, folder):
    out = loadmodel.day_profiles(energy_hourly(spark, folder), ["energy"], "hour", "value")
    return out.select("energy", text("day"), *[r4(f"h{h}") for h in range(24)])


_SHARES = """WITH sh AS (SELECT energy, hour, CAST(hour AS DATE) AS day, hour(hour) AS dayhour, value, CASE WHEN count(value) OVER w = 24
    THEN value / nullif(sum(value) OVER w, 0) END AS share FROM energy_grid WINDOW w AS (PARTITION BY energy, CAST(hour AS DATE))),
  sp AS (SELECT energy, dayhour, avg(share) AS mean, stddev_samp(share) AS sd FROM sh GROUP BY energy, dayhour),
  zn AS (SELECT sh.*, (share - mean) / nullif(sd, 0) AS z FROM sh JOIN sp USING (energy, dayhour)),
  cl AS (SELECT DISTINCT energy, day, CASE WHEN isodow(day) > 5 THEN '2' ELSE '1' END AS s FROM sh)"""


def _shares(spark, folder):
    return loadmodel.day_shares(energy_grid(spark, folder), ["energy"], "hour", "value")


def _znorm(spark, folder):
    return loadmodel.znorm(_shares(spark, folder), ["energy"])


def _week_clusters(profiles):
    """Working days and weekends as cluster labels, so that SQL can follow."""
    s = F.when(F.weekday("day") > 4, "2").otherwise("1")
    return profiles.select("energy", "day").distinct().withColumn("s", s)


@query("a24_day_share", _SHARES + f" SELECT energy, strftime(hour, {TS}) AS hour, round(share, 8) AS share FROM sh")
def a24(spark, folder):
    return _shares(spark, folder).select("energy", stamp("hour"), F.round("share", 8).alias("share"))


@query("a25_profile_zscore", _SHARES + f" SELECT energy, strftime(hour, {TS}) AS hour, r4(z) AS z FROM zn")
def a25(spark, folder):
    return _znorm(spark, folder).select("energy", stamp("hour"), r4("z"))


@query(
    "a26_scale_range",
    f"""SELECT energy, strftime(hour, {TS}) AS hour, r4(CASE WHEN max(value) OVER w = min(value) OVER w THEN 0 WHEN value >= 1 THEN
      (value - min(value) OVER w) / (max(value) OVER w - min(value) OVER w) * 100 ELSE 0 END) AS scaled FROM energy_grid
    WINDOW w AS (PARTITION BY energy)""",
)
def a26(spark, folder):
    out = loadmodel.scale_range(energy_grid(spark, folder), ["energy"], "value", "scaled", 0.0, 100.0, 1.0)
    return out.select("energy", stamp("hour"), r4("scaled"))


_CENT = _SHARES + """, lab AS (SELECT sh.*, s FROM sh JOIN cl USING (energy, day)),
  cen AS (SELECT energy, s, dayhour, avg(value) AS centroid FROM lab GROUP BY ALL),
  occ AS (SELECT *, CASE WHEN max(centroid) OVER w = min(centroid) OVER w THEN 0 WHEN centroid >= 1 THEN (centroid - min(centroid)
    OVER w) / (max(centroid) OVER w - min(centroid) OVER w) * 100 ELSE 0 END AS occupancy FROM cen
    WINDOW w AS (PARTITION BY energy, s))"""


def _labelled(spark, folder):
    shares = stored(_shares(spark, folder))
    return loadmodel.attach_clusters(shares, _week_clusters(shares), ["energy"], "right")


@query(
    "a27_centroid_curve",
    _CENT + " SELECT energy, s, dayhour, r4(centroid) AS centroid, r4(occupancy) AS occupancy FROM occ",
)
def a27(spark, folder):
    out = loadmodel.centroids(_labelled(spark, folder), ["energy"], "value")
    return out.select("energy", "s", whole("dayhour"), r4("centroid"), r4("occupancy"))


@query(
    "j12_attach_cluster",
    _SHARES + f" SELECT energy, strftime(hour, {TS}) AS hour, s FROM sh LEFT JOIN cl USING (energy, day)",
)
def j12(spark, folder):
    shares = _shares(spark, folder)
    out = loadmodel.attach_clusters(shares, _week_clusters(shares), ["energy"], "left")
    return out.select("energy", stamp("hour"), "s")


@query(
    "j16_centroid_lookup",
    _CENT + f""" SELECT energy, strftime(hour, {TS}) AS hour, r4(centroid) AS centroid, r4(occupancy) AS occupancy
    FROM lab JOIN occ USING (energy, s, dayhour)""",
)
def j16(spark, folder):
    rows = _labelled(spark, folder)
    cent = loadmodel.centroids(rows, ["energy"], "value")
    out = rows.join(cent, ["energy", "s", "dayhour"])
    return out.select("energy", stamp("hour"), r4("centroid"), r4("occupancy"))


_LAGS = _CENT + """, zero AS (SELECT energy, s, sum(centroid) = 0 AS zero FROM cen GROUP BY energy, s),
  lg AS (SELECT energy, hour, s, zero, ln(CASE WHEN value > 0 THEN value ELSE 0.01 END) AS lv FROM lab JOIN zero USING (energy, s)
    WHERE value >= 0)"""


@query(
    "w10_lagged_log",
    _LAGS
    + f" SELECT energy, strftime(hour, {TS}) AS hour, "
    + ", ".join(f"r4(CASE WHEN zero THEN ln(0.01) ELSE lag(lv, {k}) OVER w END) AS lag{k}" for k in range(1, 7))
    + ", r4(CASE WHEN s = '1' THEN CASE WHEN zero THEN ln(0.01) ELSE lag(lv, 1) OVER w END ELSE ln(0.01) END) AS lag1_s1"
    + " FROM lg WINDOW w AS (PARTITION BY energy ORDER BY hour)",
)
def w10(spark, folder):
    rows = _labelled(spark, folder)
    cent = loadmodel.centroids(rows, ["energy"], "value")
    rows = rows.join(cent, ["energy", "s", "dayhour"]).filter("value >= 0")
    out = loadmodel.lag_features(rows, ["energy"], "hour", "value", 6, ["1", "2"])
    return out.select("energy", stamp("hour"), *[r4(f"lag{k}") for k in range(1, 7)], r4("lag1_s1"))


def _ma(k: int) -> str:
    mean = f"coalesce(sum(value) OVER (PARTITION BY energy ORDER BY hour ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING), 0) / {k}"
    ok = f"row_number() OVER (PARTITION BY energy ORDER BY hour) >= {k} AND {mean} > 0"
    return f"r4(ln(CASE WHEN {ok} THEN {mean} ELSE 0.1 END)) AS ma{k}"


@query(
    "w11_trailing_means",
    f"SELECT energy, strftime(hour, {TS}) AS hour, " + ", ".join(_ma(k) for k in range(2, 13)) + " FROM energy_grid",
)
def w11(spark, folder):
    out = loadmodel.trailing_means(energy_grid(spark, folder), ["energy"], "hour", "value")
    return out.select("energy", stamp("hour"), *[r4(f"ma{k}") for k in range(2, 13)])


@query(
    "w06_centred_mean",
    f"""SELECT energy, strftime(hour, {TS}) AS hour, r4(avg(value) OVER (PARTITION BY energy ORDER BY hour ROWS BETWEEN 2 PRECEDING
      AND 2 FOLLOWING)) AS smooth FROM energy_grid""",
)
def w06(spark, folder):
    from pyspark.sql.window import Window

    w = Window.partitionBy("energy").orderBy("hour").rowsBetween(-2, 2)
    return energy_grid(spark, folder).select("energy", stamp("hour"), r4(F.avg("value").over(w), "smooth"))


ALPHA = 0.7


@query(
    "w12_low_pass",
    f"""WITH n AS (SELECT energy, hour, value, row_number() OVER (PARTITION BY energy ORDER BY hour) AS rn FROM energy_hourly),
      y(energy, hour, rn, y) AS (SELECT energy, hour, rn, value FROM n WHERE rn = 1 UNION ALL SELECT n.energy, n.hour, n.rn,
        {ALPHA} * y.y + (1 - {ALPHA}) * n.value FROM y JOIN n ON n.energy = y.energy AND n.rn = y.rn + 1)
    SELECT energy, strftime(hour, {TS}) AS hour, r4(y) AS y FROM y""",
)
def w12(spark, folder):
    out = loadmodel.low_pass(energy_hourly(spark, folder), ["energy"], "hour", "value", ALPHA, "y")
    return out.select("energy", stamp("hour"), r4("y"))


@query(
    "f08_balance_terms",
    f"""SELECT station, strftime(hour, {TS}) AS hour, r4(greatest(8 - temperature, 0)) AS heating, r4(CASE WHEN abs(temperature - 8) >= 2
      THEN (temperature - 8) * f ELSE 0 END) AS band, r4(greatest(temperature - 8, 0) * f) AS cooling
    FROM (SELECT *, CASE WHEN ghi > 0 THEN 1 ELSE 0 END AS f FROM meteo_hourly)""",
)
def f08(spark, folder):
    rows = views.meteo_hourly(spark, folder).withColumn("f", F.when(F.col("ghi") > 0, 1).otherwise(0))
    terms = S.balance_terms("temperature", "f", 8.0)
    return rows.select("station", stamp("hour"), *[r4(c, n) for n, c in terms.items()])


_SECTOR = "['N','NE','E','SE','S','SO','O','NO'][CAST(ceil(({0} - 22.5) / 45) AS INTEGER) % 8 + 1]"


@query(
    "f14_wind_sector",
    f"SELECT station, strftime(hour, {TS}) AS hour, {_SECTOR.format('wind_bearing')} AS wind_sector FROM meteo_hourly",
)
def f14(spark, folder):
    return views.meteo_hourly(spark, folder).select("station", stamp("hour"), S.sector("wind_bearing").alias("wind_sector"))


def _sun(source: str) -> str:
    """Members up to ``lbl``: sun position and label for every hour of ``source``."""
    return f"""su0 AS (SELECT DISTINCT hour, (epoch(hour) - 946728000) / 86400.0 AS d FROM {source}),
  su1 AS (SELECT hour, d, radians(357.528 + 0.9856003 * d) AS g, radians(23.439 - 0.0000004 * d) AS tilt FROM su0),
  su2 AS (SELECT *, radians(280.460 + 0.9856474 * d + 1.915 * sin(g) + 0.020 * sin(2 * g)) AS l FROM su1),
  su3 AS (SELECT *, asin(sin(tilt) * sin(l)) AS dec, radians(280.46061837 + 360.98564736629 * d + {LONGITUDE})
    - atan2(cos(tilt) * sin(l), cos(l)) AS ha, radians({LATITUDE}) AS lat FROM su2),
  sun AS (SELECT hour, degrees(asin(sin(lat) * sin(dec) + cos(lat) * cos(dec) * cos(ha))) AS alt,
    (degrees(atan2(-sin(ha), tan(dec) * cos(lat) - sin(lat) * cos(ha))) + 360) % 360 AS azi FROM su3),
  lbl AS (SELECT *, CASE WHEN alt <= 0 THEN 'NA' ELSE '_' || {_SECTOR.format("azi")} || '_' ||
    ['5','15','25','35','45','55','65','75','85'][CAST(ceil(alt / 10) AS INTEGER)] END AS label FROM sun)"""


@query(
    "f15_sun_position",
    f"WITH {_sun('meteo_hourly')} SELECT strftime(hour, {TS}) AS hour, r4(alt) AS altitude, r4(azi) AS azimuth, label FROM lbl",
)
def f15(spark, folder):
    altitude, azimuth = S.sun_position("hour", F.lit(LATITUDE), F.lit(LONGITUDE))
    rows = views.meteo_hourly(spark, folder).select("hour").distinct()
    rows = rows.withColumns({"altitude": altitude, "azimuth": azimuth})
    return rows.select(stamp("hour"), r4("altitude"), r4("azimuth"), S.sun_label("altitude", "azimuth").alias("label"))


@query(
    "f16_occupancy_terms",
    _CENT
    + f""" SELECT energy, strftime(hour, {TS}) AS hour, CAST(CASE WHEN occupancy < 15 THEN 0 ELSE 1 END AS BIGINT) AS occupied,
      r4(temperature * CASE WHEN occupancy < 15 THEN 0 ELSE 1 END) AS temperature_occ FROM lab JOIN occ USING (energy, s, dayhour)
      JOIN (SELECT energy, hour, temperature FROM load_input) USING (energy, hour)""",
)
def f16(spark, folder):
    rows = _labelled(spark, folder)
    cent = loadmodel.centroids(rows, ["energy"], "value")
    weather = load_input(spark, folder).select("energy", "hour", "temperature")
    rows = rows.join(cent, ["energy", "s", "dayhour"]).join(weather, ["energy", "hour"])
    out = loadmodel.occupancy_terms(rows, 15.0, ["temperature"])
    return out.select("energy", stamp("hour"), whole("occupied"), r4("temperature_occ"))


# --- clusters -----------------------------------------------------------------------------


@query(
    "w25_cluster_tails",
    _SHARES
    + """, pr AS (SELECT zn.energy, zn.day, zn.dayhour, z, s FROM zn JOIN cl USING (energy, day) WHERE z IS NOT NULL),
      ce AS (SELECT energy, s, dayhour, avg(z) AS c FROM pr GROUP BY ALL),
      di AS (SELECT energy, s, day, sqrt(sum((z - c) ** 2)) AS distance FROM pr JOIN ce USING (energy, s, dayhour) GROUP BY ALL),
      qu AS (SELECT energy, s, quantile_cont(distance, 0.025) AS lo, quantile_cont(distance, 0.975) AS hi, max(distance) AS mx
        FROM di GROUP BY ALL)
    SELECT energy, CAST(day AS VARCHAR) AS day, s, r4(distance) AS distance, NOT (mx > 2 * lo AND NOT distance BETWEEN lo AND hi)
      AS kept FROM di JOIN qu USING (energy, s)""",
)
def w25(spark, folder):
    z = stored(_znorm(spark, folder).filter("z is not null"))
    out = loadmodel.cluster_tails(_week_clusters(z), z, ["energy"])
    return out.select("energy", text("day"), "s", r4("distance"), "kept")


@query(
    "m28_assign_cluster",
    _SHARES
    + """, pr AS (SELECT zn.energy, zn.day, zn.dayhour, z, s FROM zn JOIN cl USING (energy, day) WHERE z IS NOT NULL),
      pa AS (SELECT energy, s, dayhour, avg(z) AS mean, greatest(var_pop(z), 0.01) AS variance,
        0.5 AS weight FROM pr GROUP BY ALL),
      sc AS (SELECT pr.energy, pr.day, pa.s, round(sum(-0.5 * (ln(2 * pi() * variance) + (z - mean) ** 2 / variance))
        + ln(any_value(weight)), 9) AS score, count(*) AS n FROM pr JOIN pa ON pr.energy = pa.energy AND pr.dayhour = pa.dayhour
        GROUP BY ALL)
    SELECT energy, CAST(day AS VARCHAR) AS day, arg_min(s, ROW(-score, s)) AS s FROM sc WHERE n = 24 GROUP BY energy, day""",
)
def m28(spark, folder):
    shares = stored(_shares(spark, folder))
    spec = loadmodel.hour_statistics(shares, ["energy"])
    z = stored(loadmodel.znorm(shares, ["energy"], spec).filter("z is not null"))
    labelled = loadmodel.attach_clusters(z, _week_clusters(z), ["energy"], "right")
    params = labelled.groupBy("energy", "s", "dayhour").agg(
        F.avg("z").alias("mean"), F.greatest(F.var_pop("z"), F.lit(0.01)).alias("variance"), F.lit(0.5).alias("weight")
    )
    return loadmodel.assign_clusters(z, params, ["energy"]).select("energy", text("day"), "s")


def _cluster_params(z):
    wide = loadmodel.day_profiles(z, ["energy"], "hour", "z")
    totals = z.groupBy("energy", "day").agg(F.sum("value").alias("total"))
    return loadfit.train_clusters(wide.join(totals, ["energy", "day"]), "energy")


def _trained_days(spark, folder):
    """Days with the cluster found by the mixture fit, tails unlabelled.

    The fitted labels are stored once (one row per unit and day), because every
    later step reads them.
    """
    z = stored(_znorm(spark, folder))
    params = _cluster_params(z)
    z = z.filter("z is not null")
    days = stored(loadmodel.assign_clusters(z, params, ["energy"]))
    return loadmodel.cluster_tails(days, z, ["energy"]).filter("kept").select("energy", "day", "s")


@query("m27_cluster_profiles")
def m27(spark, folder):
    out = _cluster_params(stored(_znorm(spark, folder)))
    return out.select("energy", "s", whole("dayhour"), r4("mean"), r4("variance"), r4("weight"))


@query("m27_cluster_days")
def m27_days(spark, folder):
    return _trained_days(spark, folder).select("energy", text("day"), "s")


_DENSITY = f"""WITH low AS (SELECT energy, hour, value FROM energy_grid JOIN (SELECT energy, quantile_cont(value, {usage.LOWER_SHARE})
      AS most FROM energy_grid GROUP BY energy) USING (energy) WHERE value <= most),
    s AS (SELECT energy, count(*) AS n, stddev_samp(value) AS sd, quantile_cont(value, 0.75) - quantile_cont(value, 0.25) AS iqr,
      min(value) AS a, max(value) AS b, quantile_cont(value, 0.2) AS q20, quantile_cont(value, 0.1) AS q10 FROM low GROUP BY energy),
    h AS (SELECT *, 0.9 * coalesce(nullif(least(sd, iqr / 1.34), 0), nullif(sd, 0), nullif(abs(a), 0), 1) * n ** -0.2 AS bw FROM s),
    g AS MATERIALIZED (SELECT energy, q20, q10, bw, a - 3 * bw AS lo, (b - a + 6 * bw) / 511 AS dx FROM h WHERE n > 1),
    bins AS MATERIALIZED (SELECT energy, k + j AS k, sum(CASE j WHEN 0 THEN 1 - (u - k) ELSE u - k END) AS w FROM
      (SELECT energy, (value - lo) / dx AS u, floor((value - lo) / dx)::INTEGER AS k FROM low JOIN g USING (energy)), range(2) r(j)
      GROUP BY ALL),
    d AS (SELECT energy, p, lo + p * dx AS x, sum(w * exp(-0.5 * ((p - k) * dx / bw) ** 2)) AS d FROM g JOIN bins USING (energy),
      range(512) r(p) WHERE abs(p - k) <= floor(7 * bw / dx) GROUP BY energy, p, lo, dx),
    e AS (SELECT energy, p, x, round(d / max(d) OVER (PARTITION BY energy), 9) AS d FROM d),
    c AS (SELECT * FROM (SELECT *, lag(d) OVER w AS before, lag(x) OVER w AS lx FROM e WINDOW w AS (PARTITION BY energy ORDER BY p))
      WHERE before IS DISTINCT FROM d),
    f AS (SELECT *, lead(d) OVER w AS after, (x + lead(lx) OVER w) / 2 AS mid FROM c WINDOW w AS (PARTITION BY energy ORDER BY p)),
    t AS MATERIALIZED (SELECT energy, mid AS x, d, d > before AS top, row_number() OVER (PARTITION BY energy ORDER BY p) AS k,
      count(*) OVER (PARTITION BY energy) AS n, max(d) OVER (PARTITION BY energy) AS peak FROM f WHERE (d > before) <> (after > d)
      AND before IS NOT NULL AND after IS NOT NULL),
    m AS MATERIALIZED (SELECT t.energy, min(t.k) FILTER (t.top) AS one, min(t.k) FILTER (t.top AND o.d > 0 AND t.d / o.d > 3 AND t.x > q10)
      AS k FROM t JOIN g USING (energy) LEFT JOIN t o ON o.energy = t.energy AND o.k = t.k - 2 GROUP BY t.energy),
    l AS (SELECT m.energy, CASE WHEN f.n >= 3 AND z.x < 0.5 THEN y.x WHEN f.n >= 3 AND m.k IS NOT NULL THEN v.x
        WHEN f.n >= 3 AND f.x <= q20 AND f.d > 0.2 * f.peak THEN s.x WHEN f.n = 1 AND f.x < 0.5 THEN f.x END AS lim
      FROM m JOIN g USING (energy) JOIN t f ON f.energy = m.energy AND f.k = 1
      LEFT JOIN t z ON z.energy = m.energy AND z.k = coalesce(m.k, m.one)
      LEFT JOIN t y ON y.energy = m.energy AND y.k = coalesce(m.k, m.one) + 1
      LEFT JOIN t v ON v.energy = m.energy AND v.k = m.k - 1 LEFT JOIN t s ON s.energy = m.energy AND s.k = 2)"""


@query(
    "w24_usage_limits",
    _DENSITY + " SELECT g.energy, r4(coalesce(lim, 0)) AS usage_limit FROM g LEFT JOIN l USING (energy)",
)
def w24_limits(spark, folder):
    limits = usage.usage_limits(stored(energy_grid(spark, folder)), ["energy"], "value")
    return limits.select("energy", r4("limit", "usage_limit"))


@query(
    "w24_unused_days",
    _DENSITY
    + """ SELECT DISTINCT energy, CAST(CAST(hour AS DATE) AS VARCHAR) AS day FROM energy_grid LEFT JOIN l USING (energy)
    WHERE value <= coalesce(lim, 0)""",
)
def w24(spark, folder):
    rows = stored(energy_grid(spark, folder))
    limits = usage.usage_limits(rows, ["energy"], "value")
    return usage.unused_days(rows, limits, ["energy"], "hour", "value").select("energy", text("day"))


# --- features and fits ----------------------------------------------------------------------

LAGS = 6


def _features(spark, folder, days):
    """Feature rows; ``days`` carries the cluster labels."""
    rows = load_input(spark, folder).withColumns({"day": F.to_date("hour"), "dayhour": F.hour("hour")})
    rows = loadmodel.attach_clusters(rows, days, ["energy"], "right").withColumnRenamed("hour", "time")
    rows = rows.filter("s is not null and time is not null")
    out = loadmodel.prepare_features(stored(rows), ["energy"], "time", "value", LAGS, F.lit(LATITUDE), F.lit(LONGITUDE))
    return loadmodel.calendar_features(out, "time")


@query(
    "m29_feature_table",
    _LAGS
    + f""", {_sun("energy_grid")}, ft AS (SELECT lab.energy, lab.hour, s, value, lv, dayhour FROM lab JOIN lg USING (energy, hour, s))
    SELECT f.energy, strftime(f.hour, {TS}) AS time, f.s, r4(f.lv) AS log_value, r4(o.centroid) AS centroid, r4(o.occupancy) AS occupancy,
      r4(CASE WHEN z.zero THEN ln(0.01) ELSE lag(f.lv, 1) OVER w END) AS lag1, r4(CASE WHEN z.zero THEN ln(0.01) ELSE lag(f.lv, 6)
      OVER w END) AS lag6, isodow(f.hour) AS dayweek, hour(f.hour) + (isodow(f.hour) - 1) * 24 AS weekhour,
      coalesce({_SECTOR.format("l.wind_bearing")}, 'NA') AS wind_sector, b.label AS sun_label, r4(greatest(b.alt, 0)) AS sun_elevation,
      r4(l.temperature) AS temperature
    FROM ft f JOIN occ o USING (energy, s, dayhour) JOIN zero z USING (energy, s) JOIN load_input l ON l.energy = f.energy
      AND l.hour = f.hour LEFT JOIN lbl b ON b.hour = f.hour WINDOW w AS (PARTITION BY f.energy ORDER BY f.hour)""",
)
def m29(spark, folder):
    out = _features(spark, folder, _week_clusters(_shares(spark, folder)))
    return out.select(
        "energy",
        stamp("time"),
        "s",
        *[r4(c) for c in ("log_value", "centroid", "occupancy", "lag1", "lag6", "sun_elevation", "temperature")],
        whole("dayweek"),
        whole("weekhour"),
        "wind_sector",
        "sun_label",
    )


def _stored_features(spark, folder):
    """Feature rows written once, for training and for prediction."""
    path = sinks.work_path(spark, "load-features")
    sinks.write_table(_features(spark, folder, _trained_days(spark, folder)), path)
    return spark.read.parquet(path)


def _models(spark, folder, features):
    train = features.filter(F.col("time") < MODEL_START).withColumn("train", loadfit.training_days("day"))
    return loadfit.train_models(train, "energy")


@query("m30_load_model")
def m30(spark, folder):
    out = _models(spark, folder, _stored_features(spark, folder))
    return out.select("energy", "term", r4("coef"), r4("se"))


@query("m31_feature_gate")
def m31(spark, folder):
    out = _models(spark, folder, _stored_features(spark, folder))
    return out.select("energy", "groups").distinct()


@query("m32_parameter_search")
def m32(spark, folder):
    out = _models(spark, folder, _stored_features(spark, folder))
    return out.select("energy", *loadfit.HYPER, r4("score")).distinct()


@query("m33_recursive_prediction")
def m33(spark, folder):
    features = _features(spark, folder, _week_clusters(_shares(spark, folder)))
    out = loadfit.predict_models(
        features.filter(F.col("time") >= MODEL_START), _models(spark, folder, features), "energy", LAGS
    )
    return out.select("energy", stamp("time"), r4("prediction"))


@query("m34_apply_stored_model")
def m34(spark, folder):
    features = _stored_features(spark, folder)
    path = sinks.work_path(spark, "load-model")
    sinks.write_table(_models(spark, folder, features), path)
    later = features.filter(F.col("time") >= MODEL_START)
    out = loadfit.predict_models(later, spark.read.parquet(path), "energy", LAGS)
    joined = out.join(later.select("energy", "time", "value"), ["energy", "time"])
    return joined.select("energy", stamp("time"), r4("prediction"), r4("value"))
