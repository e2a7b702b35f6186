"""Closed-form statistics as columns: fit quality and significance."""

from __future__ import annotations

import math
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: normal quantile of the two-sided 10 % level.
Z_TEN_PERCENT = 1.6448536269514722
TABLE_SIZE = 120


def _coverage(t: float, df: int) -> float:
    """P(|T| < t) of Student's t with integer degrees of freedom (finite trigonometric sum)."""
    theta = math.atan(t / math.sqrt(df))
    c2, term, total = math.cos(theta) ** 2, 1.0, 0.0
    if df % 2 == 0:
        for k in range(df // 2):
            total += term
            term *= c2 * (2 * k + 1) / (2 * k + 2)
        return math.sin(theta) * total
    term = math.cos(theta)
    for k in range((df - 1) // 2):
        total += term
        term *= c2 * (2 * k + 2) / (2 * k + 3)
    return 2 / math.pi * (theta + math.sin(theta) * total)


@lru_cache(maxsize=None)
def t_table(level: float = 0.90, size: int = TABLE_SIZE) -> tuple[float, ...]:
    """Critical values with two-sided coverage ``level`` for 1..size degrees of freedom."""
    out = []
    for df in range(1, size + 1):
        lo, hi = 0.0, 1000.0
        for _ in range(80):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if _coverage(mid, df) < level else (lo, mid)
        out.append(round(hi, 6))
    return tuple(out)


def t_limit(z, df):
    """Critical value from the normal quantile ``z`` by its expansion in 1 / df; numbers or a column ``df``.

    Beyond the table's 120 degrees of freedom the error is below 1e-6.
    """
    first, second = (z**3 + z) / 4, (5 * z**5 + 16 * z**3 + 3 * z) / 96
    return z + first / df + second / (df * df)


def t_critical(df: Column) -> Column:
    """Two-sided 10 % critical value, null without degrees of freedom."""
    table = F.array(*[F.lit(v) for v in t_table()])
    return (
        F.when(df < 1, F.lit(None).cast("double"))
        .when(df <= TABLE_SIZE, F.try_element_at(table, df.cast("int")))
        .otherwise(t_limit(Z_TEN_PERCENT, df.cast("double")))
    )


def slope_significant(slope: Column, r2: Column, n: Column) -> Column:
    """Positive slope with p < 0.1; two points give no p-value and do not count."""
    t = F.sqrt(r2 * (n - 2) / F.nullif(1 - r2, F.lit(0.0)))
    sure = (r2 >= 1) | (t > t_critical(n - 2))
    return F.coalesce((n > 2) & (slope > 0) & sure, F.lit(False))


def rmse(sse: Column, n: Column) -> Column:
    return F.sqrt(sse / F.nullif(n - 1, F.lit(0)))


# A perfect fit would have a criterion of minus infinity; this floor keeps it least but finite.
_SSE_FLOOR = 1e-12


def bic(sse: Column, n: Column, params: Column) -> Column:
    return n * F.ln(F.greatest(sse, F.lit(_SSE_FLOOR))) + F.ln(n) * params


def aic(sse: Column, n: Column, params: Column, form: str = "v1") -> Column:
    """Akaike criterion with one of two small-sample corrections (whole-number division)."""
    if form == "v1":
        penalty = 2 * params
        correction = F.floor(2 * (params + 1) / F.nullif(n - params - 1, F.lit(0)))
    else:
        k = params + 1
        penalty = 2 * k
        correction = F.floor(2 * k * (k + 1) / F.nullif(n - k - 1, F.lit(0)))
    return n * F.ln(F.greatest(sse, F.lit(_SSE_FLOOR)) / n) + penalty + correction
