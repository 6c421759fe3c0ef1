"""Counts, histograms, exact quantiles, summary statistics and box statistics."""

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, Window, functions as F

from skyledger import constants as C
from skyledger.functions.numeric import half_even, nan_to_null
from skyledger.plans.folders import shared_folder

STATISTICS = ["count", "mean", "std", "min", "25%", "50%", "75%", "max"]
QUANTILE_ACCURACY = 4_000  # size of the sketch behind the limits
QUANTILE_TASK_ROWS = 4_000_000  # limits with more values between them are narrowed again
QUANTILE_ROUNDS = 6  # each round leaves a few thousandths of the values


def value_counts(r: DataFrame, column: str, count: str = "n") -> DataFrame:
    """Frequency of every value, NULL left out."""
    return r.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias(count))


# --- histograms ---------------------------------------------------------------

def _bin_of(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Bin number; the last bin is closed. A range of one value is widened by half to either side."""
    low, high = _bin_range(low, high)
    return F.least(F.floor((value - low) / ((high - low) / bins)).cast("int"), F.lit(bins - 1))


def _bin_range(low: Column, high: Column) -> tuple[Column, Column]:
    flat = low == high
    return F.when(flat, low - 0.5).otherwise(low), F.when(flat, high + 0.5).otherwise(high)


def histogram(r: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Equal-width bins over the range of the column, empty bins included.

    Two passes (range, then counts); the range reaches the second pass as a
    one-value subquery.
    """
    values = r.select(nan_to_null(F.col(column).cast("double")).alias("v")).filter("v IS NOT NULL")
    spread = values.agg(F.min("v").alias("low"), F.max("v").alias("high"))
    bounds = spread.select(F.struct("low", "high")).scalar()
    counts = (
        values.withColumn("bin", _bin_of(F.col("v"), bounds["low"], bounds["high"], bins))
        .groupBy("bin").agg(F.count("*").alias("n"))
    )
    low, high = _bin_range(bounds["low"], bounds["high"])
    edges = r.sparkSession.range(bins).select(
        F.col("id").cast("int").alias("bin"), low.alias("low"), high.alias("high")
    ).filter("low IS NOT NULL")
    return _filled(edges, counts, ["bin"], bins)


def value_ranges(r: DataFrame, column: str, by: str, *more: Column) -> DataFrame:
    """Smallest and largest value of the column per group, NULL for a group without values."""
    value = nan_to_null(F.col(column).cast("double"))
    return r.filter(F.col(by).isNotNull()).groupBy(by).agg(F.min(value).alias("low"), F.max(value).alias("high"), *more)


def histogram_by(r: DataFrame, column: str, by: str, bins: int, ranges: DataFrame | None = None) -> DataFrame:
    """A histogram per group over the group's own range; ``ranges`` (by, low, high) selects groups and saves a pass."""
    ranges = (value_ranges(r, column, by) if ranges is None else ranges).filter("low IS NOT NULL")
    values = r.select(by, nan_to_null(F.col(column).cast("double")).alias("v")).filter("v IS NOT NULL")
    counts = (
        values.join(ranges, by)
        .withColumn("bin", _bin_of(F.col("v"), F.col("low"), F.col("high"), bins))
        .groupBy(by, "bin").agg(F.count("*").alias("n"))
    )
    low, high = _bin_range(F.col("low"), F.col("high"))
    edges = ranges.select(
        by, low.alias("low"), high.alias("high"), F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    )
    return _filled(edges, counts, [by, "bin"], bins)


def _filled(edges: DataFrame, counts: DataFrame, keys: list[str], bins: int) -> DataFrame:
    width = (F.col("high") - F.col("low")) / bins
    return edges.join(counts, keys, "left").select(
        *keys,
        (F.col("low") + F.col("bin") * width).alias("bin_low"),
        (F.col("low") + (F.col("bin") + 1) * width).alias("bin_high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def compliance_histogram(r: DataFrame, bins: int = 30, first_n: int = 8, order=("timestamp", "record_id")) -> DataFrame:
    """Compliance rate for the ``first_n`` countries that appear first in time; one pass finds these and their ranges."""
    column = "regulatory_compliance_rate"
    seen = value_ranges(r, column, "country", F.min(F.struct(*order)).alias("first"))
    ranges = seen.orderBy("first", "country").limit(first_n).select("country", "low", "high")
    return histogram_by(r, column, "country", bins, ranges)


def admissions_histogram(r: DataFrame, bins: int = 30, categories=tuple(C.ADMISSION_CATEGORIES)) -> DataFrame:
    """Hospital admissions for the listed categories; a category without rows has no bins."""
    listed = r.filter(F.col("AQI_category").isin(*categories))
    return histogram_by(listed, "hospital_admissions_per_100k", "AQI_category", bins)


# --- exact quantiles ----------------------------------------------------------

def _long(r: DataFrame, cols: list[str]) -> DataFrame:
    """(column, value) rows of the present values."""
    wide = r.select(*[nan_to_null(F.col(c).cast("double")).alias(c) for c in cols])
    return wide.unpivot([], cols, "column", "value").filter("value IS NOT NULL")


def _present(name: str) -> Column:
    return nan_to_null(F.col(name).cast("double"))


@dataclass
class _Span:
    """Values of a column over ``low`` up to ``high`` (None: no bound), how many there are and how many come before; perhaps the quantile looked for there."""

    column: str
    prob: float | None = None
    place: float = 0.0  # rank with its fraction, from 0
    low: float | None = None
    high: float | None = None
    before: int = 0
    size: int = 0

    @property
    def ranks(self) -> tuple[int, int]:
        return math.floor(self.place), math.ceil(self.place)

    def inside(self, value: Column) -> Column:
        over = F.lit(True) if self.low is None else value > self.low
        return value.isNotNull() & over & (F.lit(True) if self.high is None else value <= self.high)

    @property
    def below(self) -> Column:
        return F.lit(0).cast("long") if self.low is None else F.count_if(_present(self.column) <= self.low)

    @property
    def found(self) -> bool:
        return self.before <= self.ranks[0] and self.ranks[1] < self.before + self.size


def column_profile(r: DataFrame, cols: list[str], accuracy: int = QUANTILE_ACCURACY) -> dict[str, Row]:
    """count, mean, std, min, max and a mergeable KLL sketch of each column, in one pass of one row."""
    row = r.agg(*[
        F.struct(F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max"),
                 F.kll_sketch_agg_double(v, F.lit(max(8, accuracy))).alias("sketch")).alias(f"c{i}")
        for i, v in enumerate(map(_present, cols))
    ]).first()
    return {c: row[f"c{i}"] for i, c in enumerate(cols)}


def rank_margin(accuracy: int) -> float:
    """Three times the rank error that a KLL sketch of this size has in 99 of 100 cases."""
    return 3 * 2.3 / max(8, accuracy) ** 0.9


def sketch_limits(spark: SparkSession, sketches: dict[str, bytes], asked: list[tuple[str, float]]) -> list[float]:
    """Values at the asked (column, rank share) of the columns' sketches."""
    ranks: dict[str, list[float]] = {}
    for column, share in asked:
        ranks.setdefault(column, []).append(share)
    names = list(ranks)
    row = spark.range(1).select(*[
        F.kll_sketch_get_quantile_double(F.lit(bytearray(sketches[c])), F.array(*map(F.lit, ranks[c]))).alias(f"c{i}") for i, c in enumerate(names)]).first()
    values = {c: iter(row[f"c{i}"]) for i, c in enumerate(names)}
    return [next(values[c]) for c, _ in asked]


def _count_spans(r: DataFrame, spans: list[_Span]) -> None:
    """Size and number of smaller values of every span, exactly, in one wide aggregate."""
    row = r.agg(*[F.struct(s.below.alias("before"), F.count_if(s.inside(_present(s.column))).alias("size")).alias(f"s{i}") for i, s in enumerate(spans)]).first()
    for i, span in enumerate(spans):
        span.before, span.size = row[f"s{i}"]["before"], row[f"s{i}"]["size"]


def _open_missed(r: DataFrame, spans: list[_Span]) -> None:
    """Open the side of the spans that miss their ranks, which a sketch may cause, and count them again."""
    while missed := [s for s in spans if not s.found]:
        for s in missed:
            if s.ranks[0] < s.before:
                s.low = None
            else:
                s.high = None
        _count_spans(r, missed)


def _narrow(r: DataFrame, spans: list[_Span], accuracy: int) -> None:
    """Limits around the wanted ranks from sketches of the values inside the spans, counted."""
    margin = 2 / accuracy
    asked = []
    for s in spans:
        middle = (s.place - s.before) / max(s.size - 1, 1)
        asked.append((max(middle - margin, 0.0), min(middle + margin, 1.0)))
    row = r.agg(*[
        F.percentile_approx(F.when(s.inside(_present(s.column)), _present(s.column)), F.array(*map(F.lit, pair)), accuracy) for s, pair in zip(spans, asked)
    ]).first()
    for s, limits, (low, high) in zip(spans, row, asked):
        s.low = math.nextafter(limits[0], -math.inf) if low > 0 else s.low
        s.high = limits[1] if high < 1 else s.high
    _count_spans(r, spans)
    _open_missed(r, spans)


def _hits(r: DataFrame, spans: list[_Span], extra: list[Column] = ()) -> tuple[DataFrame, dict]:
    """(span, value, n) of the values inside the spans, and the spans' counts with the ``extra`` aggregates, in one pass.

    Every row is compared with all limits where it is read; rows without a hit
    end there, and of the others only the hits leave the projection. The table
    is stored, so that whatever is asked of it costs no other pass.
    """
    shared_folder(r.sparkSession)
    seen = Observation()
    values = {c: f"_v{i}" for i, c in enumerate(dict.fromkeys(s.column for s in spans))}
    plain = r.select(*[_present(c).alias(v) for c, v in values.items()])
    inside = [s.inside(F.col(values[s.column])) for s in spans]
    below = [F.lit(0).cast("long") if s.low is None else F.count_if(F.col(values[s.column]) <= s.low) for s in spans]
    counts = [F.count("*").alias("rows"), *[b.alias(f"b{i}") for i, b in enumerate(below)], *[F.count_if(h).alias(f"n{i}") for i, h in enumerate(inside)], *extra]
    wide = plain.observe(seen, *counts)
    hits = F.filter(F.array(*[F.when(h, F.struct(F.lit(i).alias("span"), F.col(values[s.column]).alias("value"))) for i, (s, h) in enumerate(zip(spans, inside))]),
                    lambda hit: hit.isNotNull())
    found = wide.where(reduce(lambda a, b: a | b, inside)).select(F.explode(hits).alias("hit")).select("hit.*")
    counted = found.groupBy("span", "value").agg(F.count("*").alias("n")).checkpoint()
    # a result without rows is planned away, and the observed counts with it
    metrics = plain.agg(*counts).first().asDict() if counted.isEmpty() else seen.get
    for i, span in enumerate(spans):
        span.before, span.size = metrics[f"b{i}"], metrics[f"n{i}"]
    return counted, metrics


def _quantile_spans(spark: SparkSession, sketches: dict[str, bytes], counts: dict[str, int], probs: list[float], accuracy: int) -> list[_Span]:
    """A span around every wanted rank, with the limits that the sketches give."""
    spans = [_Span(c, p, (counts[c] - 1) * p, size=counts[c]) for c in sketches for p in probs if counts[c]]
    margin = rank_margin(accuracy)
    asked = [(s.column, share) for s in spans for share in (max(s.prob - margin, 0.0), min(s.prob + margin, 1.0))]
    limits = sketch_limits(spark, sketches, asked) if spans else []
    for i, s in enumerate(spans):
        # the lower limit itself may be the wanted value, above all where values repeat
        s.low = math.nextafter(limits[2 * i], -math.inf) if s.prob > margin else None
        s.high = limits[2 * i + 1] if s.prob + margin < 1 else None
    return spans


def _at_ranks(counted: DataFrame, spans: list[_Span]) -> DataFrame:
    """(column, prob, value) of the spans from their counted values."""
    if not spans:
        return counted.sparkSession.createDataFrame([], "column string, prob double, value double")
    rows = [(i, s.column, s.prob, s.before, *s.ranks, s.place - s.ranks[0]) for i, s in enumerate(spans) if s.prob is not None]
    known = counted.sparkSession.createDataFrame(rows, "span int, column string, prob double, before long, first long, last long, part double")
    # one row per column and quantile: the size of this broadcast is fixed by the arguments
    placed = counted.join(F.broadcast(known), "span")
    start = F.col("before") + F.sum("n").over(Window.partitionBy("span").orderBy("value")) - F.col("n")
    placed = placed.withColumn("start", start)
    at = lambda rank: F.max(F.when((F.col(rank) >= F.col("start")) & (F.col(rank) < F.col("start") + F.col("n")), F.col("value")))
    return placed.groupBy("column", "prob").agg((at("first") + (at("last") - at("first")) * F.max("part")).alias("value"))


def _counted_quantiles(r: DataFrame, spans: list[_Span], accuracy: int, task_rows: int, others: list[_Span] = (), extra: list[Column] = ()) -> tuple[DataFrame, DataFrame, dict]:
    """Quantiles of the spans, the hits of these and of the ``others``, and the metrics; one pass unless limits miss or hold too many values."""
    counted, metrics = _hits(r, [*spans, *others], extra)
    bad = [s for s in spans if not s.found or s.size > task_rows]
    good = [i for i, s in enumerate(spans) if s not in bad]
    parts = [_at_ranks(counted.where(F.col("span").isin(good)), spans)]
    if bad:
        _open_missed(r, bad)
        wide_open, before = [s for s in bad if s.size > task_rows], {}
        for _ in range(QUANTILE_ROUNDS):
            if not wide_open:
                break
            before = {id(s): s.size for s in wide_open}
            _narrow(r, wide_open, accuracy)
            # a span of one value only cannot be narrowed, and need not be: its rows are counted into one
            wide_open = [s for s in wide_open if s.size > task_rows and before[id(s)] != s.size]
        parts.append(_at_ranks(_hits(r, bad)[0], bad))
    return reduce(DataFrame.unionByName, parts), counted, metrics


def exact_quantiles(r: DataFrame, cols: list[str], probs: list[float], accuracy: int = QUANTILE_ACCURACY,
                    task_rows: int = QUANTILE_TASK_ROWS, profile: dict[str, Row] | None = None) -> DataFrame:
    """Linearly interpolated quantiles of each column as (column, prob, value) rows.

    Exact without ever shuffling a column, in two passes: KLL sketches give
    narrow limits around each wanted rank (``profile`` has them from stored
    sketches or another pass and saves the first one); the second pass counts
    what lies below the limits, which proves that the rank is between them, and
    lets only values between them out of the scan, to be counted and ranked.
    Limits that miss, or hold more than ``task_rows`` values, are drawn anew by
    further passes. The sketch decides the balance, never the result.
    """
    profile = profile or column_profile(r, cols, accuracy)
    spans = _quantile_spans(r.sparkSession, {c: p["sketch"] for c, p in profile.items()}, {c: p["count"] for c, p in profile.items()}, probs, accuracy)
    if not spans:
        return r.sparkSession.createDataFrame([], "column string, prob double, value double")
    return _counted_quantiles(r, spans, accuracy, task_rows)[0]


def approx_quantiles(r: DataFrame, cols: list[str], probs: list[float], accuracy: int = 10_000) -> DataFrame:
    """Same shape as ``exact_quantiles`` from one pass with mergeable sketches; values are not interpolated."""
    array = F.array(*[F.lit(float(p)) for p in probs])
    sketch = _long(r, cols).groupBy("column").agg(F.percentile_approx("value", array, accuracy).alias("q"))
    return sketch.select("column", F.explode(F.arrays_zip(array.alias("prob"), F.col("q").alias("value"))).alias("p")).select(
        "column", "p.prob", "p.value"
    )


# --- summaries ----------------------------------------------------------------

def describe(r: DataFrame, cols: list[str] = C.POLLUTANTS, digits: int | None = 2, approx: bool = False) -> DataFrame:
    """count, mean, std, min, quartiles and max: one row per statistic, one column per input; two passes, with ``approx`` one more light one."""
    cols = list(cols)
    spark, profile = r.sparkSession, column_profile(r, cols)
    double = lambda v: None if v is None else float(v)
    rows = [(s, *(double(profile[c][s]) for c in cols)) for s in ("count", "mean", "std", "min", "max")]
    schema = "statistic string, " + ", ".join(f"`{c}` double" for c in cols)
    names = {0.25: "25%", 0.5: "50%", 0.75: "75%"}
    quantiles = approx_quantiles(r, cols, list(names)) if approx else exact_quantiles(r, cols, list(names), profile=profile)
    label = F.coalesce(*[F.when(F.col("prob") == p, name) for p, name in names.items()])
    # the three labels are always there, also when every value is missing
    labels = spark.createDataFrame([(name,) for name in names.values()], "statistic string")
    middle = labels.join(
        quantiles.groupBy(label.alias("statistic")).agg(
            *[F.max(F.when(F.col("column") == c, F.col("value"))).alias(c) for c in cols]
        ), "statistic", "left",
    )
    result = spark.createDataFrame(rows, schema).unionByName(middle)
    return result if digits is None else result.select("statistic", *[half_even(c, digits).alias(c) for c in cols])


BOX = "column string, q1 double, median double, q3 double, whisker_low double, whisker_high double, outliers long"


def box_stats(r: DataFrame, cols: list[str] = ("PM2_5", "PM10", "NO2", "SO2"), accuracy: int = QUANTILE_ACCURACY, task_rows: int = QUANTILE_TASK_ROWS) -> DataFrame:
    """Quartiles, whiskers (extreme points within 1.5 box heights of the box) and outlier count per column, in two passes.

    The limits around the quartiles bound the fences as well: values between the
    bounds of a fence are hits of the second pass like those around the ranks,
    and what lies beyond the bounds is counted there.
    """
    spark, cols = r.sparkSession, list(cols)
    profile = column_profile(r, cols, accuracy)
    counts = {c: p["count"] for c, p in profile.items()}
    quartiles = _quantile_spans(spark, {c: p["sketch"] for c, p in profile.items()}, counts, [0.25, 0.5, 0.75], accuracy)
    full = [c for c in cols if counts[c]]
    if not full:
        return spark.createDataFrame([], BOX)
    fences, extra = [], []
    for i, c in enumerate(full):
        q1, q3 = (next(s for s in quartiles if s.column == c and s.prob == p) for p in (0.25, 0.75))
        (a, b), (x, y) = ((profile[c]["min"] if s.low is None else s.low, profile[c]["max"] if s.high is None else s.high) for s in (q1, q3))
        low, high = (a - 1.5 * (y - a), b - 1.5 * (x - b)), (x + 1.5 * (x - b), y + 1.5 * (y - a))
        for first, last in (low, high):
            fences.append(_Span(c, low=math.nextafter(first, -math.inf), high=math.nextafter(max(first, last), math.inf)))
        value = F.col(f"_v{i}")
        extra += [F.min(F.when(value > fences[-2].high, value)).alias(f"over{i}"), F.max(F.when(value <= fences[-1].low, value)).alias(f"under{i}")]
    quantiles, counted, metrics = _counted_quantiles(r, quartiles, accuracy, task_rows, fences, extra)
    found = {(row["column"], row["prob"]): row["value"] for row in quantiles.collect()}
    exact = []
    for i, c in enumerate(full):
        q1, q3 = found[c, 0.25], found[c, 0.75]
        exact += [(len(quartiles) + 2 * i, q1 - 1.5 * (q3 - q1), 1.0), (len(quartiles) + 2 * i + 1, q3 + 1.5 * (q3 - q1), -1.0)]
    # two rows per column; the sign turns the upper fence into a lower one
    known = spark.createDataFrame(exact, "span int, fence double, sign double")
    within = F.col("sign") * F.col("value") >= F.col("sign") * F.col("fence")
    sides = {row["span"]: row for row in counted.join(F.broadcast(known), "span").groupBy("span").agg(
        F.min(F.when(within, F.col("sign") * F.col("value"))).alias("end"), F.sum(F.when(~within, F.col("n")).otherwise(0)).alias("out")).collect()}
    rows = []
    for i, c in enumerate(full):
        q1, median, q3 = (found[c, p] for p in (0.25, 0.5, 0.75))
        lower, upper = (sides.get(len(quartiles) + 2 * i + k) for k in (0, 1))
        ends = [lower["end"] if lower and lower["end"] is not None else metrics[f"over{i}"], -upper["end"] if upper and upper["end"] is not None else metrics[f"under{i}"]]
        below, above = fences[2 * i], fences[2 * i + 1]
        out = below.before + (lower["out"] if lower else 0) + counts[c] - above.before - above.size + (upper["out"] if upper else 0)
        rows.append((c, q1, median, q3, min([q1, *(e for e in ends[:1] if e is not None)]), max([q3, *(e for e in ends[1:] if e is not None)]), out))
    return spark.createDataFrame(rows, BOX)
