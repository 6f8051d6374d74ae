"""Small column expressions: newest value, exact sums, finite values, F1, fallback shares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def newest(order: Sequence[str], values: Sequence[str]) -> Column:
    """Aggregate: the ``values`` of the row that is last by ``order``, as a struct.

    The values follow the order columns inside the compared struct, so rows that
    tie on every order column still give one well-defined winner, and a NULL in
    the newest row stays NULL.
    """
    rest = [c for c in values if c not in order]
    return F.max(F.struct(*order, *rest))


def total(column: str, digits: int | None = None) -> Column:
    """Aggregate: sum of a column.

    With ``digits`` the values are known to hold that many decimals; they are added
    as whole numbers, so the result does not depend on the order of rows and the
    sum stays in a primitive buffer.
    """
    if digits is None:
        return F.sum(column)
    scale = 10**digits
    return F.sum(F.round(F.col(column) * scale).cast("bigint")) / F.lit(float(scale))


def finite(column: str) -> Column:
    """The value as double, NULL where it is NaN or infinite."""
    value = F.col(column).cast("double")
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def f1(tp: Column, fp: Column, fn: Column) -> Column:
    """F1 of the positive class; 0 when there is no positive label and prediction."""
    errors = (fp + fn).cast("double")
    hits = 2 * tp.cast("double")
    return F.when(hits + errors > 0, hits / (hits + errors)).otherwise(F.lit(0.0))


def share_floor(smallest: Column) -> Column:
    """Share used for a category a window has no row of.

    Fixed values: 1e-4, or a millionth of the smallest share present if that one
    is not above 1e-4.
    """
    return F.when(smallest <= 1e-4, smallest / 1e6).otherwise(F.lit(1e-4))
