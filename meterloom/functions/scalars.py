"""Column-level functions: time, units, thresholds, degrees, sun and wind."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Units scaled by 1/1000 and by 1000 when converting to kilo (lower case).
UNITS_TO_KILO_DIVIDE = ["w", "wh", "varh", "va", "var", "whth"]
UNITS_TO_KILO_MULTIPLY = ["mw", "mwh", "mvarh", "mva", "mvar", "mwhth"]

# Base temperatures of heating and cooling degrees.
HEATING_BASE = 18.0
COOLING_BASE = 22.0

# Floors used before taking logarithms.
LOG_FLOOR = 0.01
MEAN_LOG_FLOOR = 0.1

# Labels of the eight 45-degree direction sectors, the first centred on 0.
SECTORS = ["N", "NE", "E", "SE", "S", "SO", "O", "NO"]

# Labels of the 10-degree sun elevation classes.
ELEVATIONS = ["5", "15", "25", "35", "45", "55", "65", "75", "85"]

# Physical units as base unit and coefficient (J, m3, kg).
UNIT_FACTORS = {
    "j": ("energy", 1.0),
    "kj": ("energy", 1e3),
    "mj": ("energy", 1e6),
    "gj": ("energy", 1e9),
    "wh": ("energy", 3.6e3),
    "kwh": ("energy", 3.6e6),
    "mwh": ("energy", 3.6e9),
    "l": ("volume", 1e-3),
    "m3": ("volume", 1.0),
    "kg": ("mass", 1.0),
    "t": ("mass", 1e3),
}


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- numbers -----------------------------------------------------------------


def to_number(c) -> Column:
    """Text to double, null when it is not a number."""
    return col(c).try_cast("double")


def finite(c) -> Column:
    """Double when finite, otherwise null."""
    v = col(c).try_cast("double")
    return F.when(~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))), v)


def within(c, low: float | None, high: float | None) -> Column:
    """Value inside the limits, null outside."""
    v, ok = col(c), F.lit(True)
    if low is not None:
        ok = ok & (v >= low)
    if high is not None:
        ok = ok & (v <= high)
    return F.when(ok, v)


def not_negative(c) -> Column:
    """Clip negatives to zero, keep missing values missing."""
    v = col(c)
    return F.when(v.isNotNull(), F.greatest(v, F.lit(0.0)))


def floored_log(c, floor: float = LOG_FLOOR) -> Column:
    """Logarithm with non-positive values replaced by ``floor``."""
    v = col(c)
    return F.when(v.isNotNull(), F.log(F.when(v > 0, v).otherwise(F.lit(floor))))


def percent_distance(value, reference) -> Column:
    """Absolute percentage distance of a value to its reference."""
    v, r = col(value), col(reference)
    return F.abs((v - r) / F.nullif(r, F.lit(0.0))) * 100


def percent_norm(values, references) -> Column:
    """Euclidean norm of element-wise percentage differences of two arrays."""
    diffs = F.zip_with(col(values), col(references), lambda a, b: F.pow((a - b) / F.nullif(b, F.lit(0.0)) * 100, 2.0))
    return F.sqrt(F.aggregate(diffs, F.lit(0.0), lambda s, x: s + x))


def full_month_total(total, days_with_data, month) -> Column:
    """Scale a month total to all days of the month."""
    return col(total) * F.dayofmonth(F.last_day(col(month))) / col(days_with_data)


def denormalise(daily_mean, days) -> Column:
    return col(daily_mean) * col(days)


# --- units -------------------------------------------------------------------


def to_kilo(unit, value) -> Column:
    """Scale to kilo-units by unit name, ignoring case; other units unchanged."""
    u, v = F.lower(col(unit)), col(value)
    return (
        F.when(u.isin(UNITS_TO_KILO_DIVIDE), v / 1000.0)
        .when(u.isin(UNITS_TO_KILO_MULTIPLY), v * 1000.0)
        .otherwise(v)
    )


def _unit_map(index: int, factors: Mapping[str, tuple[str, float]]) -> Column:
    return F.create_map(*[F.lit(x) for name, pair in factors.items() for x in (name, pair[index])])


def convert_unit(value, unit, target, factors: Mapping[str, tuple[str, float]] = UNIT_FACTORS) -> Column:
    """Convert through the base unit; null when the base units differ or are unknown."""
    u, t = F.lower(col(unit)), F.lower(col(target))
    base, factor = _unit_map(0, factors), _unit_map(1, factors)
    same = F.try_element_at(base, u) == F.try_element_at(base, t)
    return F.when(same, col(value) * F.try_element_at(factor, u) / F.try_element_at(factor, t))


# --- time --------------------------------------------------------------------


def from_epoch(c) -> Column:
    return F.timestamp_seconds(col(c))


def to_epoch(c) -> Column:
    return F.unix_timestamp(col(c))


def dated_json(c) -> Column:
    """Timestamp of a ``{"$date": milliseconds}`` text."""
    return F.timestamp_millis(F.get_json_object(col(c), "$['$date']").try_cast("bigint"))


def bin_start(c, seconds: int) -> Column:
    """Start of the fixed-width bin that holds a timestamp."""
    s = F.unix_timestamp(col(c))
    return F.timestamp_seconds(s - F.pmod(s, F.lit(seconds)))


def month_label(c) -> Column:
    return F.date_format(col(c), "yyyyMM")


def week_slot(c) -> Column:
    """Weekly slot such as ``Mon 10:30``."""
    return F.date_format(col(c), "E HH:mm")


def format_slot(c, pattern: str) -> Column:
    return F.date_format(col(c), pattern)


def local_time(c, zone) -> Column:
    """Wall-clock time in a named zone for a UTC timestamp."""
    return F.from_utc_timestamp(col(c), zone)


def iso_weekday(c) -> Column:
    return F.weekday(col(c)) + 1


def hour_of_week(c) -> Column:
    return F.hour(col(c)) + F.weekday(col(c)) * 24


def months_back(c, months: int) -> Column:
    return F.add_months(col(c), -months)


# --- keys --------------------------------------------------------------------


def join_key(*parts) -> Column:
    return F.concat_ws("~", *[col(p).cast("string") for p in parts])


def key_parts(key, skip: int = 0) -> Column:
    """Parts of a composite key as an array, optionally without its first parts."""
    parts = F.split(col(key), "~")
    return F.slice(parts, skip + 1, F.greatest(F.size(parts) - skip, F.lit(0))) if skip else parts


# --- weather -----------------------------------------------------------------


def heating_degrees(temperature, base: float = HEATING_BASE) -> Column:
    t = col(temperature)
    return F.when(t.isNotNull(), F.greatest(base - t, F.lit(0.0)))


def cooling_degrees(temperature, base: float = COOLING_BASE) -> Column:
    t = col(temperature)
    return F.when(t.isNotNull(), F.greatest(t - base, F.lit(0.0)))


def occupied(occupancy, percent) -> Column:
    """1 when the occupancy rate reaches ``percent``, else 0."""
    return F.when(col(occupancy) < percent, F.lit(0)).otherwise(F.lit(1))


def balance_terms(temperature, flag, balance) -> dict[str, Column]:
    """Distance to the balance temperature: heating, dead-band and cooling forms."""
    t, f = col(temperature), col(flag)
    d = t - balance
    return {
        "heating": F.greatest(-d, F.lit(0.0)),
        "band": F.when(F.abs(d) >= 2, d * f).otherwise(F.lit(0.0)),
        "cooling": F.greatest(d, F.lit(0.0)) * f,
    }


def sector(degrees) -> Column:
    """Name of the 45-degree sector, ``NA`` for a missing direction."""
    d = col(degrees)
    index = (F.ceil((d - 22.5) / 45).cast("int") % 8) + 1
    name = F.element_at(F.array(*[F.lit(s) for s in SECTORS]), index)
    return F.when(d.isNull() | F.isnan(d), F.lit("NA")).otherwise(name)


def sun_position(ts, latitude, longitude) -> tuple[Column, Column]:
    """Sun altitude and azimuth (degrees, clockwise from north) for a UTC timestamp.

    Low-precision almanac formula: mean longitude and anomaly, ecliptic
    longitude, then hour angle from the sidereal time.
    """
    days = (F.unix_timestamp(col(ts)) - 946728000) / 86400.0
    anomaly = F.radians(357.528 + 0.9856003 * days)
    ecliptic = F.radians(280.460 + 0.9856474 * days + 1.915 * F.sin(anomaly) + 0.020 * F.sin(2 * anomaly))
    tilt = F.radians(23.439 - 0.0000004 * days)
    ascension = F.atan2(F.cos(tilt) * F.sin(ecliptic), F.cos(ecliptic))
    declination = F.asin(F.sin(tilt) * F.sin(ecliptic))
    sidereal = F.radians(280.46061837 + 360.98564736629 * days + col(longitude))
    angle = sidereal - ascension
    lat = F.radians(col(latitude))
    altitude = F.asin(F.sin(lat) * F.sin(declination) + F.cos(lat) * F.cos(declination) * F.cos(angle))
    azimuth = F.atan2(
        -F.sin(angle),
        F.tan(declination) * F.cos(lat) - F.sin(lat) * F.cos(angle),
    )
    return F.degrees(altitude), F.pmod(F.degrees(azimuth) + 360.0, F.lit(360.0))


def elevation_class(altitude) -> Column:
    """Middle of the 10-degree elevation class, ``NA`` below the horizon."""
    a = col(altitude)
    index = F.least(F.ceil(a / 10).cast("int"), F.lit(len(ELEVATIONS)))
    return F.when(a <= 0, F.lit("NA")).otherwise(F.element_at(F.array(*[F.lit(e) for e in ELEVATIONS]), index))


def sun_label(altitude, azimuth) -> Column:
    """Position label ``_<sector>_<elevation class>``, ``NA`` at night."""
    a = col(altitude)
    return F.when(a <= 0, F.lit("NA")).otherwise(F.concat(F.lit("_"), sector(azimuth), F.lit("_"), elevation_class(a)))


def mapped(c, names: Mapping[str, str]) -> Column:
    """Replace by a name table, leaving other values alone."""
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.coalesce(F.try_element_at(table, col(c)), col(c))


def rank_of(c, preference: Sequence[str]) -> Column:
    """Position in a preference list; anything unlisted comes last."""
    rank = F.lit(len(preference))
    for i, name in reversed(list(enumerate(preference))):
        rank = F.when(col(c) == name, F.lit(i)).otherwise(rank)
    return rank
