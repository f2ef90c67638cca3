"""Scalar column functions used by the visit and probability operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What stands in for a missing fineline and a missing UPC.
FINELINE_SENTINEL = 9999
UPC_SENTINEL = -1
# Exponents of the two second-level models in the final blend.
BLEND_WEIGHTS = (0.784, 0.216)


def units(scan_count: str | Column = "scan_count") -> Column:
    """Units bought on a line; a return counts as zero."""
    return F.greatest(F.col(scan_count) if isinstance(scan_count, str) else scan_count, F.lit(0))


def fineline_or_sentinel(column: str = "fineline") -> Column:
    return F.coalesce(F.col(column), F.lit(FINELINE_SENTINEL))


def upc_or_sentinel(column: str = "upc") -> Column:
    return F.coalesce(F.col(column), F.lit(UPC_SENTINEL).cast("long"))


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator``, and 0 where the denominator is 0 (also in ANSI mode)."""
    return F.when(denominator == 0, F.lit(0.0)).otherwise(numerator / denominator)


def geometric_blend(first: Column, second: Column, weights: tuple[float, float] = BLEND_WEIGHTS) -> Column:
    return F.pow(first, F.lit(weights[0])) * F.pow(second, F.lit(weights[1]))


def euclidean(a: Column, b: Column) -> Column:
    """Euclidean distance of two numeric arrays of equal length."""
    def square_diff(x: Column, y: Column) -> Column:
        delta = x.cast("double") - y.cast("double")
        return delta * delta

    return F.sqrt(F.aggregate(F.zip_with(a, b, square_diff), F.lit(0.0), lambda acc, x: acc + x))
