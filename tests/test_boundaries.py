"""Golden rows at the limits of every classification."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyledger import constants as C
from skyledger.functions import aqi, derive
from skyledger.functions.numeric import clamp, correlation_p_value, half_even, pair_corr
from skyledger.operators import cleaning

AQI = [None, -1, 0, 49, 50, 51, 99, 100, 101, 150, 151, 200, 201, 300, 301, 499, 500, 501]


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [row[0] for row in df.orderBy("i").select(expression).collect()]


def test_severity(spark):
    expected = ["Severe"] + ["Low"] * 4 + ["Moderate"] * 3 + ["High"] * 4 + ["Severe"] * 6
    assert column(spark, AQI, "int", aqi.pollution_severity("v")) == expected


def test_bracket(spark):
    values = [None, 0, 49, 50, 99, 100, 499, 500]
    expected = [None, "0-50", "0-50", "50-100", "50-100", "100-150", "450-500", "500-550"]
    assert column(spark, values, "int", aqi.aqi_bracket("v")) == expected
    assert column(spark, expected, "string", aqi.bracket_start("v")) == [None, 0, 0, 50, 50, 100, 450, 500]


def test_category(spark):
    expected = {None: None, -1: "Good", 50: "Good", 51: "Moderate", 100: "Moderate", 101: "Unhealthy for Sensitive Groups",
                150: "Unhealthy for Sensitive Groups", 151: "Unhealthy", 200: "Unhealthy", 201: "Very Unhealthy",
                300: "Very Unhealthy", 301: "Hazardous", 501: "Hazardous"}
    assert column(spark, list(expected), "int", aqi.aqi_category("v")) == list(expected.values())


@pytest.mark.parametrize("mode, expected", [
    ("round", [0, 0, 2, 50, 50, 100, 100, 150, 200, 300, 500, 500, None, None]),
    ("trunc", [0, 0, 1, 50, 50, 100, 100, 150, 200, 300, 500, 500, None, None]),
])
def test_index_from_pm25(spark, mode, expected):
    values = [-5.0, 0.0, 0.36, 12.0, 12.01, 35.4, 35.41, 55.4, 150.4, 250.4, 500.4, 600.0, None, float("nan")]
    assert column(spark, values, "double", aqi.aqi_from_pm25("v", mode)) == expected


def test_index_rounds_half_to_even(spark):
    # 0.6 ug is 2.5 index points
    assert column(spark, [0.6, 0.84], "double", aqi.aqi_from_pm25("v", "round")) == [2, round(0.84 * 50 / 12.0)]


def test_index_mode_is_checked():
    with pytest.raises(ValueError):
        aqi.aqi_from_pm25("v", "ceil")


def test_traffic_factor(spark):
    expected = [1.3 if 7 <= h <= 9 else 1.2 if 17 <= h <= 19 else 0.8 for h in range(24)]
    assert column(spark, list(range(24)), "int", derive.traffic_factor("v")) == expected


def test_calendar(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2020-02-29 23:00:00' AS ts UNION ALL SELECT TIMESTAMP_NTZ'2023-01-01 00:00:00'")
    rows = df.orderBy("ts").select(*[c.alias(n) for n, c in derive.calendar_features("ts").items()]).collect()
    assert tuple(rows[0]) == (2020, 2, 29, 23, 5, 1)  # a Saturday
    assert tuple(rows[1]) == (2023, 1, 1, 0, 6, 1)  # a Sunday


def test_labels(spark):
    assert column(spark, [1, 12, 13, 0, None], "int", derive.month_label("v")) == ["Jan", "Dec", None, None, None]
    assert column(spark, [0, 6, 7, None], "int", derive.dow_label("v")) == ["Mon", "Sun", None, None]


def test_policy_change(spark):
    text = ["2016-01-01 00:00:00", "2016-01-01 03:00:00", "2016-01-02 00:00:00", "2017-01-01 00:00:00", "2024-01-01 00:00:00"]
    assert column(spark, text, "string", derive.policy_change_flag(F.col("v").cast("timestamp_ntz"))) == [1, 0, 0, 0, 1]


@pytest.mark.parametrize("score, year, level", [(0, 2015, 1), (45, 2015, 2), (45, 2019, 2), (45, 2020, 3), (99, 2019, 4), (100, 2020, 5)])
def test_emission_standard(spark, score, year, level):
    assert spark.range(1).select(derive.emission_standard(F.lit(score), F.lit(year))).first()[0] == level


def test_carbon_tax_flag(spark):
    assert column(spark, [30, 65, 66, None], "int", derive.carbon_tax_flag("v")) == [0, 0, 1, None]


@pytest.mark.parametrize("latitude, score", [(10.0, 70), (10.0, 71), (-10.0, 50), (0.0, 90)])
def test_pollution_factor(spark, latitude, score):
    row = (80, score, latitude, 6, 8, 2020, 6, "Traffic")
    names = ["industrial_index", "regulation_score", "latitude", "month", "hour", "year", "day_of_week", "station_type"]
    got = spark.createDataFrame([row], names).select(derive.pollution_factor()).first()[0]
    month = 12 if latitude < 0 else 6
    trend = 1 - 5 * (0.015 if score > 70 else 0.008)
    expected = (0.5 + 0.8 * 1.2) * (1 - score / 200) * C.MONTH_FACTOR[month] * C.HOUR_FACTOR[8] * trend * 0.82 * 1.3
    assert math.isclose(got, expected, rel_tol=1e-12)


def test_badges(spark):
    assert column(spark, [50.0, 50.1, 100.0, 100.1], "double", aqi.aqi_badge("v")) == ["green", "orange", "orange", "red"]
    assert column(spark, [50.0, 50.1, 70.0, 70.1], "double", aqi.regulation_badge("v")) == ["red", "orange", "orange", "green"]
    assert column(spark, [0.99, 0.9899, 0.95, 0.94], "double", aqi.r2_badge("v")) == ["green", "blue", "blue", "orange"]


def test_clamp_keeps_null(spark):
    assert column(spark, [None, -1.0, 3.0, 9.0], "double", clamp("v", 0.0, 5.0)) == [None, 0.0, 3.0, 5.0]


def test_half_even(spark):
    assert column(spark, [0.5, 1.5, 2.5], "double", half_even("v", 0)) == [0.0, 2.0, 2.0]
    assert column(spark, [0.125, 0.375], "double", half_even("v", 2)) == [0.12, 0.38]


def _dirty(spark):
    base = {c: "1.5" for c in C.CAST_TO_DOUBLE} | {c: "7.9" for c in C.CAST_TO_INT} | {"country": "A", "city": "B", "station_id": "S"}
    rows = [dict(base, AQI=a, PM10=p) for a, p in (("7", "2"), ("abc", "2"), ("501", "2"), ("500", "x"), (None, "2"), ("50.9", "2"))]
    names = list(base)
    return spark.createDataFrame([tuple(row[n] for n in names) for row in rows], ", ".join(f"{n} string" for n in names))


def test_cleaning_of_text_columns(spark):
    rows = cleaning.clean_readings(_dirty(spark)).select("AQI", "PM10", "year", "aqi_bracket").collect()
    # text that is no number becomes NULL after the completeness check, so its row stays
    assert sorted((r[0], r[1], r[2], r[3]) for r in rows if r[1] is not None) == [(7, 2.0, 7, "0-50"), (50, 2.0, 7, "50-100")]
    assert [(r[0], r[3]) for r in rows if r[1] is None] == [(500, "500-550")]
    audit = cleaning.cleaning_audit(_dirty(spark)).first()
    assert tuple(audit) == (6, 3, 3)


@pytest.mark.parametrize("name", C.CRITICAL_COLUMNS)
def test_each_critical_column_is_required(spark, readings, name):
    one = readings.filter("PM10 IS NOT NULL AND AQI <= 500").limit(1)
    assert cleaning.clean_readings(one).count() == 1
    kind = dict(one.dtypes)[name]
    assert cleaning.clean_readings(one.withColumn(name, F.lit(None).cast(kind))).count() == 0
    if kind == "double":
        nan = one.withColumn(name, F.lit(float("nan")))
        assert cleaning.clean_readings(nan).count() == 0
        assert cleaning.cleaning_audit(nan).first()["final_count"] == 0


def test_nan_outside_the_critical_columns_becomes_null(spark, readings):
    one = readings.filter("PM10 IS NOT NULL AND AQI <= 500").limit(1).withColumn("VOC", F.lit(float("nan")))
    assert cleaning.clean_readings(one).first()["VOC"] is None


def test_correlation_is_null_for_a_constant(spark):
    df = spark.createDataFrame([(0.1, 1.0), (0.1, 2.0), (0.1, 5.0), (None, 9.0)], "x double, y double")
    assert df.agg(pair_corr("x", "y")).first()[0] is None


def _student_tail(r, n):
    """Both tails of Student's t by numerical integration of its density over the angle atan(t / sqrt(v))."""
    v = n - 2
    angle = np.linspace(0, np.pi / 2, 200_001)
    density = np.cos(angle) ** (v - 1)
    outside = np.where(angle >= math.asin(abs(r)), density, 0.0)
    return np.trapezoid(outside, angle) / np.trapezoid(density, angle)


@pytest.mark.parametrize("r, n", [(0.824, 5), (0.5, 3), (0.0, 10), (1.0, 10), (-0.632, 10), (0.3, 30), (0.25, 101), (0.1, 4)])
def test_p_value(spark, r, n):
    got = spark.range(1).select(correlation_p_value(F.lit(r), F.lit(n))).first()[0]
    assert got == pytest.approx(_student_tail(r, n), abs=1e-4)


@pytest.mark.parametrize("r, n", [(0.999, 30), (0.99999, 60), (0.9, 200), (0.9, 201), (0.3, 2000), (0.9999, 4), (0.999999, 3)])
def test_small_p_values_keep_their_digits(spark, r, n):
    """Against the density of r under independence, integrated numerically."""
    from math import lgamma, log, pi, exp
    got = spark.range(1).select(correlation_p_value(F.lit(r), F.lit(n))).first()[0]
    v, steps = n - 2, 200_000
    log_c = lgamma((v + 1) / 2) - lgamma(v / 2) - 0.5 * log(pi)
    width = 1 - r
    # p = 2 c * integral over t from r to 1 of (1 - t^2)^(v/2 - 1); with t = 1 - width * u^2 the end point is smooth
    total = 0.0
    for k in range(steps):
        u = (k + 0.5) / steps
        gap = width * u * u
        total += 2 * u * width * exp((v / 2 - 1) * log(gap * (2 - gap)) + log_c) / steps
    assert got == pytest.approx(2 * total, rel=1e-6)


def test_p_value_needs_two_points(spark):
    assert spark.range(1).select(correlation_p_value(F.lit(0.5), F.lit(1))).first()[0] is None


@pytest.mark.parametrize("r, n", [(0.5, 4), (0.01, 4), (0.3, 102), (0.9, 102), (0.001, 102), (0.05, 5002), (0.2, 5002), (0.02, 20_002)])
def test_p_value_to_ten_digits(spark, r, n):
    """Against the finite sum for an even number of degrees of freedom, in decimals of 400 digits."""
    from decimal import Decimal, getcontext
    getcontext().prec = 400
    sine = Decimal(r)
    square, term, total = 1 - sine * sine, Decimal(1), Decimal(0)
    for j in range(1, (n - 2) // 2 + 1):
        total += term
        term *= Decimal(2 * j - 1) / Decimal(2 * j) * square
    got = spark.range(1).select(correlation_p_value(F.lit(r), F.lit(n))).first()[0]
    assert got == pytest.approx(float(1 - sine * total), rel=1e-10)


@pytest.mark.parametrize("t", [0.0, 0.1, 1.0, 2.5, 6.0, 20.0])
def test_p_value_of_a_thousand_million_points(spark, t):
    """There Student's distribution is the normal one but for a term in 1 / v."""
    n = 1_000_000_000
    v = n - 2
    r = t / math.sqrt(v + t * t)
    density = math.exp(-t * t / 2) / math.sqrt(2 * math.pi)
    expected = math.erfc(t / math.sqrt(2)) + density * (t ** 3 + t) / (2 * v)
    got = spark.range(1).select(correlation_p_value(F.lit(r), F.lit(n))).first()[0]
    assert got == pytest.approx(expected, rel=1e-9 if t < 10 else 1e-4)


def test_p_value_has_a_fixed_number_of_terms(spark):
    """The expression does not depend on n, which may be a column."""
    rows = spark.createDataFrame([(0.1, n) for n in (3, 100, 10 ** 9)], "r double, n long")
    values = [row[0] for row in rows.select(correlation_p_value("r", "n")).collect()]
    assert values == sorted(values, reverse=True) and 0 <= values[-1] < 1e-300
