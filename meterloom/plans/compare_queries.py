"""Building comparison: alignment, monthly means, peer groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.functions.quantiles import exact_percentiles
from meterloom.functions.scalars import mapped
from meterloom.operators import align, compare
from meterloom.plans import views
from meterloom.plans.registry import query
from meterloom.plans.shared import preferred, r4, stored, text, unit_daily, whole

CRITERIA = {"type": ["use_type"], "organization+type": ["organization", "use_type"]}
# Energy types of the units, and the type that each is compared as; others are compared as themselves.
ENERGY_TYPES = ["electricity_main", "electricity_peak", "gas", "heat"]
COMPARED_AS = {"electricity_main": "electricity", "electricity_peak": "electricity"}
PEERS = ["criteria", "criteria_values", "energy_type"]
# Group size used on the small test tables; production keeps compare.MIN_GROUP.
TEST_MIN_GROUP = 3


def unit_monthly(spark, folder) -> DataFrame:
    return compare.monthly_means(unit_daily(spark, folder), ["unit"], "day", "value")


def comparable(spark, folder) -> DataFrame:
    """Consumption per area with the building's attributes, for every month between a unit's first and last one."""
    months = compare.month_grid(unit_monthly(spark, folder), ["unit"])
    energy = F.element_at(F.array(*[F.lit(e) for e in ENERGY_TYPES]), (F.col("unit") % len(ENERGY_TYPES) + 1).cast("int"))
    joined = months.join(views.buildings(spark, folder), "unit").withColumn("energy", energy)
    joined = joined.withColumn("energy_type", mapped("energy", COMPARED_AS))
    return compare.by_area(joined, "value", "area", "per_area")


def flagship(spark, folder, min_size: int = 1) -> DataFrame:
    rows = compare.with_criteria(stored(comparable(spark, folder)), CRITERIA)
    found = compare.peer_percentiles(rows, [*PEERS, "month"], "per_area", min_size)
    return found.select(
        *PEERS, text("month"), whole("n_rows"), *[r4(f"p{b}") for b in compare.BREAKS]
    )


_PEERS = """WITH months AS (SELECT unit, CAST(unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS DATE) AS month
      FROM unit_monthly GROUP BY unit),
  comparable AS (SELECT unit, month, m.value, use_type, organization, area, m.value / area AS per_area,
      CASE unit % 4 WHEN 2 THEN 'gas' WHEN 3 THEN 'heat' ELSE 'electricity' END AS energy_type
    FROM months LEFT JOIN unit_monthly m USING (unit, month) JOIN buildings USING (unit) WHERE area > 0),
  crit AS (SELECT 'type' AS criteria, CAST(use_type AS VARCHAR) AS criteria_values, * FROM comparable
    UNION ALL SELECT 'organization+type', CAST(organization AS VARCHAR) || '~' || CAST(use_type AS VARCHAR), *
    FROM comparable)"""


@query(
    "a14_peer_percentiles",
    _PEERS
    + """
    SELECT criteria, criteria_values, energy_type, CAST(month AS VARCHAR) AS month, count(*) AS n_rows,
      r4(quantile_cont(per_area, 0.05)) AS p5, r4(quantile_cont(per_area, 0.25)) AS p25,
      r4(quantile_cont(per_area, 0.5)) AS p50, r4(quantile_cont(per_area, 0.75)) AS p75,
      r4(quantile_cont(per_area, 0.9)) AS p90
    FROM crit GROUP BY criteria, criteria_values, energy_type, month HAVING count(*) >= 3""",
)
def a14(spark, folder):
    return flagship(spark, folder, TEST_MIN_GROUP)


@query(
    "w02_prefer_source",
    "SELECT device, CAST(day AS VARCHAR) AS day, value FROM preferred",
)
def w02(spark, folder):
    return preferred(spark, folder).select("device", text("day"), "value")


@query(
    "p11_fan_out",
    """SELECT unit, device, CAST(day AS VARCHAR) AS day, value * multiplier AS weighted
    FROM preferred JOIN units USING (device)""",
)
def p11(spark, folder):
    out = align.fan_out(preferred(spark, folder), views.units(spark, folder))
    return out.select("unit", "device", text("day"), (F.col("value") * F.col("multiplier")).alias("weighted"))


@query(
    "j07_align_devices",
    "SELECT unit, CAST(day AS VARCHAR) AS day, r4(value) AS value FROM unit_daily",
)
def j07(spark, folder):
    return unit_daily(spark, folder).select("unit", text("day"), r4("value"))


@query(
    "a10_weighted_sum",
    """SELECT unit, CAST(day AS VARCHAR) AS day, r4(sum(value * multiplier)) AS value, count(*) AS n_devices
    FROM preferred JOIN units USING (device) GROUP BY unit, day""",
)
def a10(spark, folder):
    fan = align.fan_out(preferred(spark, folder), views.units(spark, folder))
    sums = fan.groupBy("unit", "day").agg(
        F.sum(F.col("value") * F.col("multiplier")).alias("value"), F.count("*").alias("n_devices")
    )
    return sums.select("unit", text("day"), r4("value"), "n_devices")


@query(
    "a11_monthly_mean",
    "SELECT unit, CAST(month AS VARCHAR) AS month, r4(value) AS value, n_days FROM unit_monthly",
)
def a11(spark, folder):
    return unit_monthly(spark, folder).select("unit", text("month"), r4("value"), "n_days")


@query(
    "a12_annual_mean",
    """WITH last AS (SELECT unit, max(month) AS last_month FROM unit_monthly GROUP BY unit)
    SELECT unit, strftime(last_month, '%Y%m') AS month, r4(avg(value)) AS annual, count(value) AS n_months
    FROM unit_monthly JOIN last USING (unit) WHERE month > last_month - INTERVAL 12 MONTH GROUP BY unit, last_month""",
)
def a12(spark, folder):
    grid = compare.month_grid(unit_monthly(spark, folder), ["unit"])
    out = compare.annual_mean(grid, ["unit"], "value")
    return out.select("unit", F.date_format("last_month", "yyyyMM").alias("month"), r4("annual"), "n_months")


@query(
    "a13_per_area",
    """SELECT unit, CAST(month AS VARCHAR) AS month, r4(m.value / area) AS per_area
    FROM unit_monthly m JOIN buildings USING (unit) WHERE area > 0""",
)
def a13(spark, folder):
    known = comparable(spark, folder).filter("value is not null")
    return known.select("unit", text("month"), r4("per_area"))


@query(
    "a15_min_group_size",
    _PEERS
    + """
    SELECT criteria, criteria_values, energy_type, CAST(month AS VARCHAR) AS month, count(*) AS n_rows
    FROM crit GROUP BY ALL HAVING count(*) >= 3""",
)
def a15(spark, folder):
    rows = compare.with_criteria(comparable(spark, folder), CRITERIA)
    sizes = rows.groupBy(*PEERS, "month").agg(F.count("*").alias("n_rows"))
    return sizes.filter(F.col("n_rows") >= TEST_MIN_GROUP).select(*PEERS, text("month"), "n_rows")


@query(
    "a16_multi_criteria",
    _PEERS
    + """
    SELECT criteria, criteria_values, energy_type, count(*) AS n_rows, r4(avg(per_area)) AS mean_per_area
    FROM crit GROUP BY criteria, criteria_values, energy_type""",
)
def a16(spark, folder):
    rows = compare.with_criteria(comparable(spark, folder), CRITERIA)
    return rows.groupBy(*PEERS).agg(
        F.count("*").alias("n_rows"), r4(F.avg("per_area"), "mean_per_area")
    )


_ANNUAL = """, annual AS (SELECT *, avg(per_area) OVER (PARTITION BY criteria, criteria_values, unit ORDER BY month
      ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS annual FROM crit)"""


def _rolling(spark, folder):
    rows = compare.with_criteria(stored(comparable(spark, folder)), CRITERIA)
    return compare.rolling_annual(rows, ["criteria", "criteria_values", "unit"], "per_area")


@query(
    "w05_rolling_annual",
    _PEERS
    + _ANNUAL
    + """
    SELECT criteria, criteria_values, unit, CAST(month AS VARCHAR) AS month, r4(annual) AS annual FROM annual""",
)
def w05(spark, folder):
    return _rolling(spark, folder).select("criteria", "criteria_values", "unit", text("month"), r4("annual"))


@query(
    "a17_group_annual_percentiles",
    _PEERS
    + _ANNUAL
    + """
    SELECT criteria, criteria_values, energy_type, r4(quantile_cont(annual, 0.05)) AS p5,
      r4(quantile_cont(annual, 0.25)) AS p25, r4(quantile_cont(annual, 0.5)) AS p50,
      r4(quantile_cont(annual, 0.75)) AS p75, r4(quantile_cont(annual, 0.9)) AS p90
    FROM annual GROUP BY criteria, criteria_values, energy_type""",
)
def a17(spark, folder):
    found = exact_percentiles(
        _rolling(spark, folder),
        PEERS,
        "annual",
        [b / 100 for b in compare.BREAKS],
        [f"p{b}" for b in compare.BREAKS],
    )
    return found.select(*PEERS, *[r4(f"p{b}") for b in compare.BREAKS])


@query(
    "j06_building_join",
    _PEERS
    + """
    SELECT unit, CAST(month AS VARCHAR) AS month, r4(value) AS value, use_type, organization, area FROM comparable""",
)
def j06(spark, folder):
    return comparable(spark, folder).select("unit", text("month"), r4("value"), "use_type", "organization", "area")


@query(
    "j17_peer_result_rows",
    _PEERS
    + _ANNUAL
    + """, sizes AS (SELECT criteria, criteria_values, energy_type, month, count(*) AS n_rows,
        r4(quantile_cont(per_area, 0.5)) AS p50 FROM crit GROUP BY ALL HAVING count(*) >= 3)
    SELECT s.criteria, s.criteria_values, s.energy_type, CAST(s.month AS VARCHAR) AS month, s.p50, unit, r4(annual) AS annual
    FROM sizes s LEFT JOIN annual a USING (criteria, criteria_values, energy_type, month)""",
)
def j17(spark, folder):
    rows = _rolling(spark, folder)
    keys = [*PEERS, "month"]
    groups = compare.peer_percentiles(rows, keys, "per_area", TEST_MIN_GROUP, [50])
    # Shuffled whatever the size of the stored file, which is far smaller than its rows: these would not fit a broadcast.
    out = groups.join(rows.select(*keys, "unit", "annual").hint("merge"), keys, "left")
    return out.select(*PEERS, text("month"), r4("p50"), "unit", r4("annual"))


@query(
    "a34_full_month_total",
    """SELECT unit, CAST(date_trunc('month', day) AS DATE)::VARCHAR AS month,
      r4(sum(value) * day(last_day(date_trunc('month', day))) / count(DISTINCT day)) AS full_total,
      r4(sum(value) * day(last_day(date_trunc('month', day))) / count(DISTINCT day) / any_value(area)) AS full_per_area
    FROM unit_daily JOIN buildings USING (unit) GROUP BY unit, date_trunc('month', day)""",
)
def a34(spark, folder):
    from meterloom.functions.scalars import full_month_total

    sums = (
        unit_daily(spark, folder)
        .groupBy("unit", F.trunc("day", "month").alias("month"))
        .agg(F.sum("value").alias("total"), F.count("day").alias("days"))
        .withColumn("full_total", full_month_total("total", "days", "month"))
        .join(views.buildings(spark, folder), "unit")
    )
    return sums.select(
        "unit", text("month"), r4("full_total"), r4(F.col("full_total") / F.col("area"), "full_per_area")
    )


_COST = (
    _PEERS
    + """, g AS (SELECT criteria, criteria_values, energy_type, month, avg(per_area) AS mean,
      stddev_samp(per_area) / nullif(avg(per_area), 0) AS disp FROM crit GROUP BY ALL),
    cost AS (SELECT unit, c.criteria, c.criteria_values, abs((per_area - mean) / mean) * 100 AS diff,
      disp * 0.5 + disp * 0.5 * abs((per_area - mean) / mean) * 100 AS cost
      FROM crit c JOIN g USING (criteria, criteria_values, energy_type, month)),
    per_unit AS (SELECT unit, criteria, criteria_values, round(avg(diff), 3) AS diff, round(avg(cost), 3) AS cost
      FROM cost GROUP BY ALL)"""
)


def _costs(spark, folder):
    rows = compare.with_criteria(stored(comparable(spark, folder)), CRITERIA)
    keys = [*PEERS, "month"]
    peers = rows.groupBy(*keys).agg(
        F.avg("per_area").alias("mean"),
        (F.stddev_samp("per_area") / F.nullif(F.avg("per_area"), F.lit(0.0))).alias("disp"),
    )
    cost = compare.group_cost(rows, peers, keys, "per_area", "mean", "disp")
    return cost.groupBy("unit", "criteria", "criteria_values").agg(
        F.round(F.avg("diff"), 3).alias("diff"), F.round(F.avg("cost"), 3).alias("cost")
    )


@query("a35_group_cost", _COST + " SELECT * FROM per_unit")
def a35(spark, folder):
    return _costs(spark, folder)


@query(
    "o05_rank_by_cost",
    _COST
    + """ SELECT unit, criteria, row_number() OVER (PARTITION BY unit ORDER BY cost, criteria) AS place
    FROM per_unit WHERE cost IS NOT NULL""",
)
def o05(spark, folder):
    ranked = compare.rank_by(_costs(spark, folder).filter("cost is not null"), ["unit"], ["cost", "criteria"], "place")
    return ranked.select("unit", "criteria", whole("place"))
