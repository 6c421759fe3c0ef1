"""Calendar parts, factors and noise-free expectations derived from a reading."""

import math

from pyspark.sql import Column, functions as F

from skyledger import constants as C
from skyledger.functions.numeric import clamp, col


def lookup(table: dict, key: Column, default: float | None = 1.0) -> Column:
    """Value of a small fixed table as a literal map; ``default`` for unknown keys."""
    pairs = [F.lit(part) for item in table.items() for part in item]
    found = F.try_element_at(F.create_map(*pairs), key)
    return found if default is None else F.coalesce(found, F.lit(default))


def calendar_features(ts: Column | str = "timestamp") -> dict[str, Column]:
    """Calendar columns of a timestamp by name; Monday is weekday 0."""
    ts = col(ts)
    weekday = F.weekday(ts)
    return {
        "year": F.year(ts),
        "month": F.month(ts),
        "day": F.dayofmonth(ts),
        "hour": F.hour(ts),
        "day_of_week": weekday,
        "is_weekend": (weekday >= 5).cast("int"),
    }


def month_label(month: Column | str) -> Column:
    return F.get(F.array(*map(F.lit, C.MONTH_LABELS)), (col(month) - 1).cast("int"))


def dow_label(day_of_week: Column | str) -> Column:
    return F.get(F.array(*map(F.lit, C.WEEKDAY_LABELS)), col(day_of_week).cast("int"))


def carbon_tax_label(flag: Column | str) -> Column:
    return lookup(C.CARBON_TAX_LABELS, col(flag), default=None)


def traffic_factor(hour: Column | str = "hour") -> Column:
    hour = col(hour)
    chain = F
    for first, last, factor in (C.TRAFFIC_MORNING, C.TRAFFIC_EVENING):
        chain = chain.when(hour.between(first, last), factor)
    return chain.otherwise(C.TRAFFIC_OTHER)


def season_month(month: Column | str, latitude: Column | str) -> Column:
    """Month with the seasons swapped south of the equator."""
    month = col(month)
    return F.when(col(latitude) < 0, (month + 5) % 12 + 1).otherwise(month)


def year_trend(year: Column | str, score: Column | str, start_year: int = C.START_YEAR) -> Column:
    """Yearly improvement; almost twice as fast under a regulation score above 70."""
    pace = F.when(col(score) > 70, 0.015).otherwise(0.008)
    return 1.0 - (col(year) - start_year) * pace


def pollution_factor(start_year: int = C.START_YEAR, industrial_index="industrial_index", score="regulation_score",
                     latitude="latitude", month="month", hour="hour", year="year", weekday="day_of_week",
                     station_type="station_type") -> Column:
    """Product of the industrial, regulation, season, hour, year, weekday and station-type factors."""
    industry = 0.5 + col(industrial_index) / 100.0 * 1.2
    damping = 1.0 - col(score) / 200.0
    return (
        industry * damping
        * lookup(C.MONTH_FACTOR, season_month(month, latitude))
        * lookup(C.HOUR_FACTOR, col(hour))
        * year_trend(year, score, start_year)
        * lookup(C.WEEKDAY_FACTOR, col(weekday))
        * lookup(C.STATION_TYPE_FACTOR, col(station_type))
    )


def emission_standard(score: Column | str, year: Column | str, cutover: int = C.EMISSION_CUTOVER_YEAR) -> Column:
    """Level 1-5: one per 20 points of score, one more from the cutover year on."""
    level = F.floor(col(score) / 20) + F.when(col(year) >= cutover, 1).otherwise(0)
    return clamp(level, 1, 5).cast("int")


def carbon_tax_flag(score: Column | str, threshold: float = C.CARBON_TAX_SCORE) -> Column:
    return (col(score) > threshold).cast("int")


def policy_change_flag(ts: Column | str = "timestamp", years=tuple(C.POLICY_CHANGE_YEARS)) -> Column:
    """1 in the first hour of the listed years."""
    ts = col(ts)
    first_hour = (F.month(ts) == 1) & (F.dayofmonth(ts) == 1) & (F.hour(ts) == 0)
    return (F.year(ts).isin(*years) & first_hour).cast("int")


def expected_industry(start_year: int = C.START_YEAR, industrial_index="industrial_index", score="regulation_score",
                      month="month", year="year") -> dict[str, Column]:
    """Industry and policy values without the random part."""
    index, score, elapsed = col(industrial_index), col(score), col(year) - start_year
    season = lookup(C.MONTH_FACTOR, col(month))
    return {
        "expected_output": index * season * (1.0 + elapsed * 0.01),
        "expected_factories": index * 2.5,
        "expected_green_pct": clamp(score * 0.6 + elapsed * 1.5, 0.0, 100.0),
        "expected_compliance": clamp(score * 0.9, 20.0, 100.0),
        "expected_investment": score * 0.7 + elapsed * 2.5,
    }


def expected_health(aqi: Column | str = "AQI", population_factor: float = 1.0) -> dict[str, Column]:
    """Dose response without the random part; deaths do not scale with the population."""
    aqi = col(aqi)
    return {
        "expected_respiratory": aqi * 0.5 * population_factor,
        "expected_cardiovascular": aqi * 0.2 * population_factor,
        "expected_admissions": aqi * 0.08 * population_factor,
        "expected_deaths": aqi * 0.015,
    }


def expected_weather(latitude="latitude", month="month", hour="hour", elevation="elevation_m") -> dict[str, Column]:
    """Weather without the random part."""
    base = 30 - F.abs(col(latitude)) * 0.5 + lookup(C.MONTH_FACTOR, col(month)) * 5
    temperature = base - 5 * F.cos((col(hour) - 14) * F.lit(math.pi) / 12)
    return {
        "expected_temperature": temperature,
        "expected_humidity": clamp(70 - temperature * 0.5, 10.0, 100.0),
        "expected_pressure": 1013.25 - col(elevation) * 0.12,
    }
