"""Vector arithmetic on array columns, in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    """Inner product of two arrays of equal length."""
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def unit_score(a: Column, unit: Column, digits: int = 6) -> Column:
    """(1 + cos) / 2 against a vector of length 1, NULL when ``a`` has no length.

    Not a number when ``a`` is not finite; callers leave such rows out.
    """
    return F.round((1 + F.try_divide(dot(a, unit), norm(a))) / 2, digits)
