"""Null-safe numeric expressions and guarded statistics."""

from functools import reduce

from pyspark.sql import Column, functions as F


def col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def nan_to_null(value: Column | str) -> Column:
    """NaN becomes NULL, so that aggregates skip it."""
    return F.nanvl(col(value), F.lit(None).cast("double"))


def clamp(value: Column | str, low, high) -> Column:
    """Value held inside [low, high]; NULL stays NULL (``least``/``greatest`` would skip it)."""
    value = col(value)
    return F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), value)))


def half_even(value: Column | str, digits: int) -> Column:
    """Round half to even, as NumPy and Python do."""
    value = col(value)
    return F.rint(value) if digits == 0 else F.bround(value, digits)


# beyond this many units of the last digit, and this near to a tie, the decimal digits of a number decide how it is rounded
EXACT_UNITS = 2.0 ** 41
NEAR_TIE = 0.499


def half_up(value: Column | str, digits: int) -> Column:
    """A double rounded as ``round`` does it, bit by bit, for a fraction of its time.

    ``round`` takes every value through its decimal digits. Where the value in
    units of the last digit is below 2^41, the error of that product is below
    2^-11, so away from a tie the next whole number is the right one, and its
    quotient is the double next to the rounded decimal. All others take the
    long way.
    """
    value, scale = col(value), 10.0 ** digits
    units = value * F.lit(scale)
    whole = F.rint(units)
    plain = (F.abs(units) < EXACT_UNITS) & (F.abs(units - whole) < NEAR_TIE)
    return F.when(plain, whole / F.lit(scale)).otherwise(F.round(value, digits))


def masked(value: Column, *others: Column) -> Column:
    """``value`` where all the others are present too."""
    return F.when(reduce(lambda a, b: a & b, [o.isNotNull() for o in others]), value)


def pair_corr(x: Column | str, y: Column | str) -> Column:
    """Pearson correlation over the rows where both are present; NULL when either is constant.

    ``corr`` raises a division error on a constant column in ANSI mode.
    """
    x, y = nan_to_null(col(x).cast("double")), nan_to_null(col(y).cast("double"))
    spread = F.stddev_pop(masked(x, y)) * F.stddev_pop(masked(y, x))
    return F.try_divide(F.covar_pop(x, y), spread)


# fixed values: nodes and weights of the 12-point Gauss-Legendre rule on (-1, 1), the half with positive nodes
GAUSS = [
    (0.1252334085114689, 0.2491470458134028), (0.3678314989981802, 0.2334925365383548), (0.5873179542866175, 0.2031674267230659),
    (0.7699026741943047, 0.1600783285433462), (0.9041172563704749, 0.1069393259953184), (0.9815606342467193, 0.0471753363865118),
]
PANELS = 12
# the integrand is left where it has fallen to e^-FALL of its first value
FALL = 45.0
# gamma ratios are taken from their series at SHIFT or more
SHIFT = 20


def _half_gamma_ratio(a: Column) -> Column:
    """Gamma(a + 1/2) / Gamma(a) for a > 0: the asymptotic series beyond ``SHIFT``, brought back by the recurrence."""
    high = a + SHIFT
    series = 1 - 1 / (8 * high) + 1 / (128 * high * high) + 5 / (1024 * F.pow(high, F.lit(3))) - 21 / (32768 * F.pow(high, F.lit(4))) \
        - 399 / (262144 * F.pow(high, F.lit(5))) + 869 / (4194304 * F.pow(high, F.lit(6)))
    back = reduce(lambda product, j: product * ((a + j) / (a + (j + 0.5))), range(SHIFT), F.lit(1.0))
    return F.sqrt(high) * series * back


def correlation_p_value(r: Column | str, n: Column | str) -> Column:
    """Two-sided p-value of a Pearson ``r`` over ``n`` points, in constant memory for any ``n``.

    With v = n - 2 degrees of freedom and sin(t) = |r| the probability of a
    larger correlation by chance is

        2 / B(v / 2, 1 / 2) * integral of cos(u)^(v - 1) for u from t to pi / 2

    (the incomplete beta function of 1 - r^2, substituted). The integrand is
    smooth and falls like a normal density, so a Gauss rule over the stretch
    where it is not negligible gives it to more than ten digits with a fixed
    number of terms; nothing is subtracted from 1, so small p-values keep their
    digits. NULL without a degree of freedom below zero; 1 for n = 2.
    """
    r, v = F.least(F.abs(col(r)), F.lit(1.0)), (col(n) - 2).cast("double")
    # squares of sines: of the lower limit, and of the upper one, where (1 - s^2)^((v - 1) / 2) has fallen by FALL
    left = F.log1p(-r * r)
    start = F.asin(r)
    upper = F.when(v > 1, F.asin(F.sqrt(F.least(F.lit(1.0), -F.expm1(left - 2 * FALL / F.greatest(v - 1, F.lit(1e-9))))))).otherwise(F.pi() / 2)
    half = (upper - start) / (2 * PANELS)

    def height(u: Column) -> Column:
        sine = F.sin(u)
        return F.exp((v - 1) / 2 * (F.log1p(-F.least(sine * sine, F.lit(1 - 1e-16))) - left))

    points = F.array(*[F.struct(F.lit(2 * panel + 1 + sign * x).alias("x"), F.lit(w).alias("w")) for panel in range(PANELS) for x, w in GAUSS for sign in (-1, 1)])
    area = F.aggregate(points, F.lit(0.0), lambda total, p: total + p["w"] * height(start + half * p["x"])) * half
    p = 2 / F.sqrt(F.pi()) * _half_gamma_ratio(v / 2) * F.exp((v - 1) / 2 * left) * area
    return F.when(v >= 1, F.when(r >= 1, F.lit(0.0)).otherwise(F.least(p, F.lit(1.0)))).otherwise(F.when(v == 0, F.lit(1.0)))
