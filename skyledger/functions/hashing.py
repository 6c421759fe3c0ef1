"""Deterministic pseudo-random keys: the same rows whatever the partitioning."""

from pyspark.sql import Column, functions as F

from skyledger.functions.numeric import col

HEX_SPACE = 16 ** 8


def row_hash(key: Column | str, seed: int = 42) -> Column:
    """32 hex digits that depend on the seed and the key only."""
    return F.md5(F.concat(F.lit(str(seed)), col(key).cast("string")))


def in_fraction(hash_col: Column, fraction: float) -> Column:
    """True for about ``fraction`` of the rows, read off the first eight hex digits."""
    cut = min(HEX_SPACE, max(0, round(fraction * HEX_SPACE)))
    return F.lit(True) if cut == HEX_SPACE else F.substring(hash_col, 1, 8) < F.lit(f"{cut:08x}")


def fold_number(hash_col: Column, folds: int) -> Column:
    """Fold 0..folds-1 from digits that ``in_fraction`` does not read."""
    return (F.conv(F.substring(hash_col, 9, 7), 16, 10).cast("long") % folds).cast("int")
