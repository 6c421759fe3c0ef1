"""Feature table of the index model: columns, encoding, split."""

from pyspark.sql import DataFrame, functions as F

from skyledger import constants as C
from skyledger.functions.hashing import in_fraction, row_hash

LABEL = "AQI"
CATEGORY = "station_type"
ENCODED = "station_type_enc"
MISSING_LABEL = "nan"
IN_TEST = "in_test"


def encode_label(r: DataFrame, column: str, output: str, missing: str = MISSING_LABEL) -> DataFrame:
    """``r`` with the alphabetical number, from 0, of each distinct value of a text column; NULL is the value ``'nan'``.

    The distinct values are found map-side and reach the rows as a one-value
    subquery of the same plan, so the column must be a category, not an
    identifier.
    """
    value = F.coalesce(F.col(column).cast("string"), F.lit(missing))
    known = r.agg(F.sort_array(F.collect_set(value))).scalar()
    return r.withColumn(output, (F.array_position(known, value) - 1).cast("int"))


def ml_features(r: DataFrame, id_col: str = "record_id", columns=tuple(C.FEATURE_COLUMNS)) -> DataFrame:
    """Id, numeric features, encoded station type and label of the complete rows; absent columns are skipped.

    The numbers leave as the fields of one value, so that each is computed once:
    a condition on the columns themselves would move below what they are derived
    from, and compute all of them a second time.
    """
    features = [c for c in columns if c in r.columns]
    if CATEGORY in r.columns:
        r = encode_label(r, CATEGORY, ENCODED)
        features.append(ENCODED)
    numbers = F.struct(*[F.col(c).cast("double").alias(c) for c in [*features, LABEL]])
    # NaN counts as missing there
    return r.select(id_col, F.inline(F.array(numbers))).dropna(subset=[*features, LABEL])


def feature_names(features: DataFrame, id_col: str = "record_id") -> list[str]:
    return [c for c in features.columns if c not in (id_col, LABEL)]


def train_test_split(features: DataFrame, test: float = 0.2, seed: int = 42, id_col: str = "record_id",
                     ) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a hash of the id: the same rows in every run and partitioning."""
    return marked_split(mark_split(features, test, seed, id_col))


def mark_split(features: DataFrame, test: float = 0.2, seed: int = 42, id_col: str = "record_id") -> DataFrame:
    """``features`` with a column that tells test rows; of a stored table many passes read it instead of hashing every id anew."""
    return features.withColumn(IN_TEST, in_fraction(row_hash(id_col, seed), test))


def marked_split(features: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Train and test rows of ``mark_split``."""
    return features.filter(~F.col(IN_TEST)).drop(IN_TEST), features.filter(IN_TEST).drop(IN_TEST)
