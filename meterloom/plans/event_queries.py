"""Change-point detection on unit series."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterloom.operators import events
from meterloom.plans.registry import query
from meterloom.plans.shared import r4, stored, text, unit_daily, whole

ALPHA = 0.1

_CUSUM = """WITH m AS (SELECT unit, avg(value) AS m FROM unit_daily GROUP BY unit),
  res AS (SELECT unit, day, value - m AS r FROM unit_daily JOIN m USING (unit)),
  st AS (SELECT unit, count(*) AS n, stddev_pop(r) AS sd FROM res GROUP BY unit),
  run AS (SELECT unit, day, n, sd, row_number() OVER (PARTITION BY unit ORDER BY day) - 1 AS i,
    sum(r) OVER (PARTITION BY unit ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS s FROM res JOIN st USING (unit)),
  cus AS (SELECT unit, day, CASE WHEN i = 0 OR sd < 1e-12 THEN 0 ELSE s / (sd * sqrt(n)) /
    sqrt(i / n * (1 - i / n)) END AS lam FROM run),
  best AS (SELECT unit, arg_min(day, ROW(-round(abs(lam), 9), day)) AS event, max(round(abs(lam), 9)) AS sig
    FROM cus GROUP BY unit)"""


def _cusum(spark, folder):
    residuals = events.constant_residuals(unit_daily(spark, folder), ["unit"], "value")
    return events.scaled_cusum(residuals, ["unit"], "day")


@query("w13_scaled_cusum", _CUSUM + " SELECT unit, CAST(day AS VARCHAR) AS day, r4(lam) AS lam FROM cus")
def w13(spark, folder):
    return _cusum(spark, folder).select("unit", text("day"), r4("lambda", "lam"))


_LEVELS = ", ".join(f"({a}, {c})" for a, c in events.CRITICAL_VALUES.items())


@query(
    "w14_best_change",
    _CUSUM
    + f""" SELECT unit, CAST(event AS VARCHAR) AS event, r4(sig) AS significance, CAST(alpha AS DOUBLE) AS alpha,
      sig >= critical AS significant FROM best, (VALUES {_LEVELS}) v(alpha, critical)""",
)
def w14(spark, folder):
    best = events.strongest_change(_cusum(spark, folder), ["unit"], "day")
    out = events.significance_levels(best)
    return out.select("unit", text("event"), r4("significance"), "alpha", "significant")


@query(
    "m22_segmented_model",
    _CUSUM
    + """ SELECT unit, CAST(CASE WHEN day >= event THEN 1 ELSE 0 END AS BIGINT) AS period, CAST(min(day) AS VARCHAR) AS period_from,
      CAST(max(day) AS VARCHAR) AS period_to, count(*) AS n, r4(avg(value)) AS mean, r4(stddev_pop(value)) AS sd
    FROM unit_daily JOIN best USING (unit) GROUP BY unit, day >= event""",
)
def m22(spark, folder):
    rows = stored(unit_daily(spark, folder))
    residuals = events.constant_residuals(rows, ["unit"], "value")
    best = events.strongest_change(events.scaled_cusum(residuals, ["unit"], "day"), ["unit"], "day")
    out = events.segmented_fit(rows, best, ["unit"], "day", "value")
    return out.select("unit", whole("period"), text("period_from"), text("period_to"), "n", r4("mean"), r4("sd"))


# Consumption with a level of its own in each year, so that series have several regimes.
_REGIMES = "SELECT unit, day, value + 40 * ((year(day) + unit) % 3) AS value FROM unit_daily"


def regimes(spark, folder):
    level = 40 * ((F.year("day") + F.col("unit")) % 3)
    return unit_daily(spark, folder).withColumn("value", F.col("value") + level)


# The check splits segments level by level, and confirms round by round; deeper levels and rounds change nothing here.
LEVELS = 10
ROUNDS = 12


def _cusum_of(name: str, source: str, keys: str) -> str:
    """Members up to ``<name>``: the significant change of every segment of ``source``."""
    return f"""{name}_s AS (SELECT {keys}, day, value - avg(value) OVER (PARTITION BY {keys}) AS r FROM {source}),
      {name}_t AS (SELECT {keys}, day, count(*) OVER g AS n, stddev_pop(r) OVER g AS sd, row_number() OVER o - 1 AS i,
        sum(r) OVER (PARTITION BY {keys} ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS s FROM {name}_s
        WINDOW g AS (PARTITION BY {keys}), o AS (PARTITION BY {keys} ORDER BY day)),
      {name}_u AS (SELECT {keys}, day, round(abs(CASE WHEN i = 0 OR sd < 1e-12 THEN 0 ELSE s / (sd * sqrt(n)) /
        sqrt(i / n * (1 - i / n)) END), 9) AS lam FROM {name}_t),
      {name} AS MATERIALIZED (SELECT {keys}, arg_min(day, ROW(-lam, day)) AS event, max(lam) AS sig FROM {name}_u GROUP BY {keys}
        HAVING max(lam) >= {events.critical_value(ALPHA)})"""


def _level(i: int) -> str:
    return f"""{_cusum_of(f"c{i}", f"l{i}", "unit, seg")},
      l{i + 1} AS MATERIALIZED (SELECT l.unit, l.day, l.value, l.seg * 2 + CASE WHEN l.day >= c.event THEN 1 ELSE 0 END AS seg
        FROM l{i} l LEFT JOIN c{i} c USING (unit, seg))"""


_SPLITS = (
    f"WITH reg AS MATERIALIZED ({_REGIMES}), l0 AS MATERIALIZED (SELECT unit, day, value, CAST(0 AS BIGINT) AS seg FROM reg), "
    + ", ".join(_level(i) for i in range(LEVELS))
    + ", found AS MATERIALIZED ("
    + " UNION ALL ".join(f"SELECT unit, event, sig, CAST({i + 1} AS BIGINT) AS round FROM c{i}" for i in range(LEVELS))
    + ")"
)


@query(
    "m23_detect_events",
    _SPLITS + " SELECT unit, CAST(event AS VARCHAR) AS event, r4(sig) AS significance FROM found",
)
def m23(spark, folder):
    found = events.detect_events(regimes(spark, folder), ["unit"], "day", "value", ALPHA)
    return found.select("unit", text("event"), r4("significance"))


@query(
    "m24_recursive_events",
    _SPLITS + " SELECT unit, CAST(event AS VARCHAR) AS event, r4(sig) AS significance, round FROM found",
)
def m24(spark, folder):
    found = events.detect_events(regimes(spark, folder), ["unit"], "day", "value", ALPHA, every_segment=True)
    return found.select("unit", text("event"), r4("significance"), whole("round"))


def _confirmation(i: int) -> str:
    return f"""nb{i} AS (SELECT unit, event AS seg, lag(event) OVER w AS p, lead(event) OVER w AS nx FROM e{i}
        WINDOW w AS (PARTITION BY unit ORDER BY event)),
      around{i} AS MATERIALIZED (SELECT reg.unit, seg, day, value FROM reg JOIN nb{i} ON reg.unit = nb{i}.unit
        AND (p IS NULL OR day >= p) AND (nx IS NULL OR day < nx)),
      {_cusum_of(f"k{i}", f"around{i}", "unit, seg")},
      e{i + 1} AS MATERIALIZED (SELECT DISTINCT unit, event FROM k{i})"""


@query(
    "m25_confirm_events",
    _SPLITS
    + ", e0 AS MATERIALIZED (SELECT unit, event FROM found), "
    + ", ".join(_confirmation(i) for i in range(ROUNDS))
    + f""", moved AS (SELECT unit FROM (SELECT * FROM e{ROUNDS} EXCEPT SELECT * FROM e{ROUNDS - 1}) UNION
      SELECT unit FROM (SELECT * FROM e{ROUNDS - 1} EXCEPT SELECT * FROM e{ROUNDS}))
    SELECT unit, CAST(event AS VARCHAR) AS event, unit NOT IN (SELECT unit FROM moved) AS converged FROM e{ROUNDS}""",
)
def m25(spark, folder):
    rows = stored(regimes(spark, folder))
    found = events.detect_events(rows, ["unit"], "day", "value", ALPHA, every_segment=True)
    return events.confirm_events(rows, found, ["unit"], "day", "value", ALPHA).select("unit", text("event"), "converged")
