"""Group means, rankings, linear trends, correlations and normalised comparisons."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from skyledger import constants as C
from skyledger.functions.derive import carbon_tax_label, dow_label, month_label
from skyledger.functions.numeric import correlation_p_value, nan_to_null, pair_corr


def _value(name: str) -> Column:
    return nan_to_null(F.col(name).cast("double"))


def mean_by(r: DataFrame, key: str | list[str], columns: dict[str, str] | None = None) -> DataFrame:
    """Mean of columns (output name -> input) per key; NULL keys are left out."""
    keys = [key] if isinstance(key, str) else list(key)
    columns = columns or {"mean_aqi": "AQI"}
    return r.dropna(subset=keys).groupBy(*keys).agg(*[F.avg(_value(c)).alias(name) for name, c in columns.items()])


def mean_std_by(r: DataFrame, key: str, column: str = "AQI") -> DataFrame:
    """Mean, sample standard deviation and the band around the mean."""
    stats = r.dropna(subset=[key]).groupBy(key).agg(F.avg(_value(column)).alias("mean"), F.stddev(_value(column)).alias("std"))
    return stats.withColumns({"band_low": F.col("mean") - F.col("std"), "band_high": F.col("mean") + F.col("std")})


def global_mean(r: DataFrame, column: str = "AQI") -> DataFrame:
    """Mean over all rows, NaN left out."""
    return r.agg(F.avg(_value(column)).alias("global_mean_aqi"))


def monthly_aqi(r: DataFrame) -> DataFrame:
    return mean_by(r, "month").withColumn("label", month_label("month"))


def dow_aqi(r: DataFrame) -> DataFrame:
    return mean_by(r, "day_of_week").withColumn("label", dow_label("day_of_week"))


def carbon_tax_aqi(r: DataFrame) -> DataFrame:
    return mean_std_by(r, "has_carbon_tax").select(
        "has_carbon_tax", carbon_tax_label("has_carbon_tax").alias("label"), "mean", "std"
    )


def top_groups(r: DataFrame, key: str, n: int = 20) -> DataFrame:
    """The ``n`` groups with the highest mean index; ties by key."""
    return mean_by(r, key).orderBy(F.desc_nulls_last("mean_aqi"), key).limit(n)


def extreme_groups(r: DataFrame, key: str) -> DataFrame:
    """The group with the highest and the one with the lowest mean; the first by name on a tie."""
    means = mean_by(r, key).filter("mean_aqi IS NOT NULL")
    return means.agg(
        F.min_by(F.col(key), F.struct(-F.col("mean_aqi"), F.col(key))).alias("highest"),
        F.max("mean_aqi").alias("highest_mean"),
        F.min_by(F.col(key), F.struct(F.col("mean_aqi"), F.col(key))).alias("lowest"),
        F.min("mean_aqi").alias("lowest_mean"),
    )


def reduction_pct(flag: str = "has_carbon_tax", column: str = "AQI") -> Column:
    """Fall of the mean from flag 0 to flag 1 in percent; NULL unless both groups exist."""
    without, with_ = (F.avg(F.when(F.col(flag) == side, _value(column))) for side in (0, 1))
    return F.try_divide(without - with_, without) * 100


def group_reduction(r: DataFrame, flag: str = "has_carbon_tax", column: str = "AQI") -> DataFrame:
    return r.agg(reduction_pct(flag, column).alias("reduction_pct"))


# --- linear trends --------------------------------------------------------------

def linear_trend(r: DataFrame, x: str, y: str = "AQI") -> DataFrame:
    """Least-squares line through all rows with both values, and the range of x."""
    xs, ys = _value(x), _value(y)
    return r.agg(
        F.regr_slope(ys, xs).alias("slope"),
        F.regr_intercept(ys, xs).alias("intercept"),
        F.min(xs).alias("x_min"),
        F.max(xs).alias("x_max"),
    )


def trend_line(r: DataFrame, x: str, y: str = "AQI", n: int = 100, low: float | None = None,
               high: float | None = None) -> DataFrame:
    """``n`` evenly spaced points of the fitted line, over the range of x unless limits are given."""
    fit = linear_trend(r, x, y)
    first = F.col("x_min") if low is None else F.lit(float(low))
    last = F.col("x_max") if high is None else F.lit(float(high))
    points = fit.select(
        "slope", "intercept", first.alias("first"), last.alias("last"),
        F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("point"),
    )
    at = F.col("first") + F.col("point") * (F.col("last") - F.col("first")) / (n - 1)
    return points.select("point", at.alias("x"), (F.col("intercept") + F.col("slope") * at).alias("y"))


# --- correlations ---------------------------------------------------------------

def correlation_matrix(r: DataFrame, cols: list[str] = C.POLLUTANTS) -> DataFrame:
    """Pairwise-complete Pearson correlations as (a, b, corr) rows; NULL where a column is constant.

    Rows are grouped by which columns are present. Inside such a group every
    pair is complete, so plain sums of products are enough: one set per pattern
    instead of one per pair. A pair then adds up the patterns that hold both
    columns. Values are taken relative to the column means (first pass), which
    keeps the sums accurate.
    """
    cols = list(cols)
    present = r.select(*[_value(c).alias(c) for c in cols])
    means = present.agg(F.struct(*[F.avg(c).alias(c) for c in cols])).scalar()
    centred = present.select(*[(F.col(c) - means[c]).alias(c) for c in cols])
    pattern = F.concat(*[F.when(F.col(c).isNull(), "0").otherwise("1") for c in cols])
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    sums = centred.groupBy(pattern.alias("pattern")).agg(
        F.count("*").alias("n"),
        *[F.sum(c).alias(f"sum_{c}") for c in cols],
        *[F.min(c).alias(f"min_{c}") for c in cols],
        *[F.max(c).alias(f"max_{c}") for c in cols],
        *[F.sum(F.col(a) * F.col(b)).alias(f"sum_{a}_{b}") for a, b in pairs],
    )
    return _corr_of_pairs(sums, cols)


def _corr_of_pairs(sums: DataFrame, cols: list[str]) -> DataFrame:
    """Correlation of each ordered pair from the sums per presence pattern (at most 2**columns rows)."""
    place = {c: i for i, c in enumerate(cols)}

    def cell(a: str, b: str) -> str:
        first, second = sorted((a, b), key=place.get)
        return (
            f"named_struct('a', '{a}', 'b', '{b}', "
            f"'both', substring(pattern, {place[a] + 1}, 1) = '1' AND substring(pattern, {place[b] + 1}, 1) = '1', "
            f"'sum_a', `sum_{a}`, 'sum_b', `sum_{b}`, 'sum_aa', `sum_{a}_{a}`, 'sum_bb', `sum_{b}_{b}`, "
            f"'sum_ab', `sum_{first}_{second}`, "
            f"'min_a', `min_{a}`, 'max_a', `max_{a}`, 'min_b', `min_{b}`, 'max_b', `max_{b}`)"
        )

    cells = ", ".join(cell(a, b) for a in cols for b in cols)
    # a pair that no row completes stays in the result with a NULL correlation
    pairs = sums.selectExpr("n", f"inline(array({cells}))").selectExpr(
        "a", "b", *[f"CASE WHEN both THEN {c} END AS {c}" for c in
                    ("n", "sum_a", "sum_b", "sum_aa", "sum_bb", "sum_ab", "min_a", "max_a", "min_b", "max_b")])
    totals = pairs.groupBy("a", "b").agg(
        *[F.sum(c).alias(c) for c in ("n", "sum_a", "sum_b", "sum_aa", "sum_bb", "sum_ab")],
        (F.max("max_a") > F.min("min_a")).alias("a_varies"), (F.max("max_b") > F.min("min_b")).alias("b_varies"),
    )
    corr = F.expr("""
        CASE WHEN a_varies AND b_varies THEN
          CASE WHEN a = b THEN 1.0D
               ELSE try_divide(sum_ab - sum_a * sum_b / n,
                               sqrt(sum_aa - sum_a * sum_a / n) * sqrt(sum_bb - sum_b * sum_b / n)) END END""")
    return totals.select("a", "b", corr.alias("corr"))


def corr_pairs(r: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """One row with the correlation of each pair as ``corr_<x>_<y>``."""
    return r.agg(*[pair_corr(x, y).alias(f"corr_{x}_{y}") for x, y in pairs])


def pearson_test(df: DataFrame, x: str, y: str) -> DataFrame:
    """Correlation, number of complete pairs and two-sided p-value."""
    xs, ys = _value(x), _value(y)
    row = df.agg(pair_corr(xs, ys).alias("r"), F.count_if(xs.isNotNull() & ys.isNotNull()).alias("n"))
    return row.withColumn("p_value", correlation_p_value("r", "n"))


def regulation_pearson(r: DataFrame) -> DataFrame:
    means = mean_by(r, "regulation_stringency_score")
    return pearson_test(means, "regulation_stringency_score", "mean_aqi")


# --- comparisons over groups ----------------------------------------------------

def minmax_scale(df: DataFrame, cols: list[str]) -> DataFrame:
    """Columns mapped to [0, 1] over the rows; NULL for a column without spread."""
    bounds = df.agg(*[F.struct(F.min(c).alias("low"), F.max(c).alias("high")).alias(c) for c in cols])
    bounds = bounds.select(F.struct(*cols)).scalar()
    return df.withColumns({
        c: F.try_divide(F.col(c) - bounds[c]["low"], bounds[c]["high"] - bounds[c]["low"]) for c in cols
    })


def health_by_country_normalized(r: DataFrame) -> DataFrame:
    means = mean_by(r, "country", {c: c for c in C.HEALTH_COLUMNS})
    return minmax_scale(means, C.HEALTH_COLUMNS)


def standardize(df: DataFrame, cols: list[str]) -> DataFrame:
    """Zero mean and unit population deviation over the rows; a column without spread becomes 0."""
    stats = df.agg(*[F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")).alias(c) for c in cols])
    stats = stats.select(F.struct(*cols)).scalar()
    scale = {c: F.when(stats[c]["std"] > 0, stats[c]["std"]).otherwise(1.0) for c in cols}
    return df.withColumns({c: (F.col(c) - stats[c]["mean"]) / scale[c] for c in cols})


def investment_trend(r: DataFrame, first_n: int = 6) -> DataFrame:
    """Mean investment by year for the first countries of the alphabet, in long form; only the means are put in order."""
    means = mean_by(r, ["year", "country"], {"mean_investment": "environmental_investment_index"})
    place = F.dense_rank().over(Window.orderBy("country"))
    return means.withColumn("_place", place).filter(F.col("_place") <= first_n).select("year", "country", "mean_investment")


def yearly_health(r: DataFrame) -> DataFrame:
    return mean_by(r, "year", {"mean_respiratory": C.HEALTH_COLUMNS[0], "mean_cardiovascular": C.HEALTH_COLUMNS[1]})
