"""Air-quality-index columns: index from PM2.5, category, severity, bracket, badges."""

from pyspark.sql import Column, functions as F

from skyledger import constants as C
from skyledger.functions.numeric import clamp, col, nan_to_null


def first_bound(value: Column, bounds, above) -> Column:
    """Label of the first inclusive upper bound that holds; ``above`` (also for NULL) otherwise."""
    chain = F
    for upper, label in bounds:
        chain = chain.when(value <= upper, label)
    return chain.otherwise(above)


def aqi_from_pm25(pm: Column | str, mode: str = "round") -> Column:
    """Index (int, 0-500) on the straight line between the two nearest corner points.

    ``mode="round"`` rounds half to even, ``"trunc"`` cuts the fraction off.
    The last line also carries values beyond the last corner before the clamp.
    """
    if mode not in ("round", "trunc"):
        raise ValueError(f"mode must be 'round' or 'trunc', not {mode!r}")
    pm = nan_to_null(col(pm).cast("double"))
    lines = list(zip(C.PM25_CORNERS, C.PM25_CORNERS[1:]))
    chain = F
    for i, ((pm_low, low), (pm_high, high)) in enumerate(lines):
        above = pm - F.lit(pm_low)
        if mode == "round":
            rise = F.lit((high - low) / (pm_high - pm_low)) * above
        else:
            rise = above * (high - low) / F.lit(round(pm_high - pm_low, 1))
        index = F.lit(float(low)) + rise
        last = i == len(lines) - 1
        chain = chain.when(pm.isNotNull() if last else pm <= pm_high, index)
    whole = F.rint(chain) if mode == "round" else F.when(chain < 0, F.ceil(chain)).otherwise(F.floor(chain))
    return clamp(whole, C.AQI_MIN, C.AQI_MAX).cast("int")


def aqi_category(aqi: Column | str) -> Column:
    aqi = col(aqi)
    return F.when(aqi.isNotNull(), first_bound(aqi, C.CATEGORY_BOUNDS, C.CATEGORY_ABOVE))


def pollution_severity(aqi: Column | str = "AQI") -> Column:
    """Four-step severity; a NULL index counts as the most severe step."""
    return first_bound(col(aqi), C.SEVERITY_BOUNDS, C.SEVERITY_ABOVE)


def bracket_low(aqi: Column | str = "AQI", width: int = C.AQI_BRACKET_WIDTH) -> Column:
    return (F.floor(col(aqi) / width) * width).cast("int")


def aqi_bracket(aqi: Column | str = "AQI", width: int = C.AQI_BRACKET_WIDTH) -> Column:
    """Left-closed bracket label, e.g. 50 -> ``50-100``."""
    low = bracket_low(aqi, width)
    return F.concat(low.cast("string"), F.lit("-"), (low + width).cast("string"))


def bracket_start(bracket: Column | str) -> Column:
    """Lower bound of a bracket label, to sort brackets as numbers."""
    return F.split_part(col(bracket), F.lit("-"), F.lit(1)).try_cast("int")


def aqi_badge(aqi: Column | str) -> Column:
    return first_bound(col(aqi), [(50, "green"), (100, "orange")], "red")


def regulation_badge(score: Column | str) -> Column:
    score = col(score)
    return F.when(score > 70, "green").when(score > 50, "orange").otherwise("red")


def r2_badge(r2: Column | str) -> Column:
    r2 = col(r2)
    return F.when(r2 >= 0.99, "green").when(r2 >= 0.95, "blue").otherwise("orange")
