"""Cleaning: complete rows, typed columns, valid index range, derived labels."""

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType

from skyledger import constants as C
from skyledger.functions.aqi import aqi_bracket, pollution_severity
from skyledger.functions.numeric import clamp, nan_to_null

CAST_SPEC = {name: "double" for name in C.CAST_TO_DOUBLE} | {name: "int" for name in C.CAST_TO_INT}


def drop_incomplete(r: DataFrame, cols=C.CRITICAL_COLUMNS) -> DataFrame:
    """Rows in which every critical column is present (neither NULL nor NaN)."""
    return r.dropna(how="any", subset=list(cols))


def nan_as_null(r: DataFrame) -> DataFrame:
    """NaN becomes NULL in every floating-point column, in one projection."""
    floats = [f.name for f in r.schema if isinstance(f.dataType, (DoubleType, FloatType))]
    return r.withColumns({name: nan_to_null(name) for name in floats}) if floats else r


def cast_columns(r: DataFrame, spec: dict[str, str] = CAST_SPEC) -> DataFrame:
    """Typed columns in one projection; a value that does not convert becomes NULL, an int is cut off."""
    fields = {f.name: f.dataType for f in r.schema}
    casts = {}
    for name, target in spec.items():
        value = F.col(name)
        if target == "int" and isinstance(fields[name], StringType):
            value = value.try_cast("double")  # '12.7' -> 12
        casts[name] = value.try_cast(target)
    return r.withColumns(casts)


def valid_range(r: DataFrame, column: str = "AQI", low=C.AQI_MIN, high=C.AQI_MAX) -> DataFrame:
    """Rows with ``low <= column <= high``; NULL is out of range."""
    return r.filter(F.col(column).between(low, high))


def with_labels(r: DataFrame) -> DataFrame:
    return r.withColumns({"pollution_severity": pollution_severity("AQI"), "aqi_bracket": aqi_bracket("AQI")})


def clean_readings(r: DataFrame) -> DataFrame:
    """Complete, typed rows with an index in range, plus severity and bracket."""
    typed = cast_columns(drop_incomplete(r))
    return with_labels(valid_range(nan_as_null(typed)))


def clamp_to_ranges(r: DataFrame, ranges: dict[str, tuple[float, float]] = C.POLLUTANT_RANGES) -> DataFrame:
    return r.withColumns({name: clamp(name, low, high) for name, (low, high) in ranges.items()})


def cleaning_audit(r: DataFrame) -> DataFrame:
    """Rows before and after cleaning in one pass: the cleaning rules become one condition."""
    typed = cast_columns(r.withColumn("_complete", _all_present(r, C.CRITICAL_COLUMNS)))
    kept = F.col("_complete") & F.col("AQI").between(C.AQI_MIN, C.AQI_MAX)
    counts = typed.agg(F.count("*").alias("initial_count"), F.count_if(kept).alias("final_count"))
    return counts.withColumn("removed_count", F.col("initial_count") - F.col("final_count"))


def _all_present(r: DataFrame, cols) -> Column:
    fields = {f.name: f.dataType for f in r.schema}
    present = F.lit(True)
    for name in cols:
        present = present & F.col(name).isNotNull()
        if isinstance(fields[name], (DoubleType, FloatType)):
            present = present & ~F.isnan(name)
    return present
