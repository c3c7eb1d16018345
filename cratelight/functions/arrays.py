"""Row-local functions on score arrays and segment matrices."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEGMENT_SECONDS = 2.05  # fixed value: audio covered by one segment score


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x.cast("double"))


def mean_of(values: Column) -> Column:
    """Mean of an array; NULL when empty."""
    return F.when(F.size(values) > 0, _total(values) / F.size(values))


def std_of(values: Column) -> Column:
    """Population standard deviation of an array; NULL when empty."""
    mean = mean_of(values)
    squares = F.aggregate(
        values, F.lit(0.0), lambda acc, x: acc + (x.cast("double") - mean) * (x.cast("double") - mean)
    )
    return F.when(F.size(values) > 0, F.sqrt(squares / F.size(values)))


def top_mean(values: Column, n: int) -> Column:
    """Mean of the ``n`` largest values."""
    return mean_of(F.slice(F.sort_array(values, asc=False), 1, n))


def pair_mean(left: Column, right: Column) -> Column:
    """Mean of the element-wise sum of two arrays: about 1 for complementary class scores."""
    return mean_of(F.zip_with(left, right, lambda a, b: a.cast("double") + b.cast("double")))


def column_means(matrix: Column) -> Column:
    """Element-wise mean over the rows of a segments x d matrix."""
    width = F.size(F.element_at(matrix, 1))
    zeros = F.transform(F.sequence(F.lit(1), width), lambda i: F.lit(0.0))
    sums = F.aggregate(
        matrix, zeros, lambda acc, row: F.zip_with(acc, row, lambda a, b: a + b.cast("double"))
    )
    return F.when(F.size(matrix) > 0, F.transform(sums, lambda s: s / F.size(matrix)))


def matrix_column(matrix: Column, index: int) -> Column:
    """Column ``index`` (0-based) of a segments x classes matrix as one array."""
    return F.transform(matrix, lambda row: row[index])


def log_compress(value: Column) -> Column:
    """Mel-band compression ``log10(10000 x + 1)``."""
    return F.log10(F.lit(10000.0) * value + F.lit(1.0))


def segment_start(pos: Column) -> Column:
    """Start second of segment ``pos`` (0-based)."""
    return pos * F.lit(SEGMENT_SECONDS)
