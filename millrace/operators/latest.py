"""Newest row per key, and first row per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.columns import newest

DELETED = "_deleted"


def with_deletes(df: DataFrame, delete_when: str) -> DataFrame:
    """Flag the rows that delete their key."""
    return df.withColumn(DELETED, F.coalesce(F.expr(delete_when), F.lit(False)))


def latest_by_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    delete_when: str | None = None,
    drop: Sequence[str] = (),
    keep_deleted: bool = False,
) -> DataFrame:
    """Keyed upsert as an aggregation: per key the row that is last by ``order``.

    Arrival order does not matter, so late rows never replace newer ones. A row that
    meets ``delete_when`` deletes its key; with ``keep_deleted`` the deleting row stays,
    flagged, so that a later merge still knows how new the delete was. ``drop`` names
    columns left out of the result.

    Each task reduces its rows to one per key before the shuffle, so a key that holds
    a large part of all rows costs no more than any other.
    """
    rows = df.drop(*[c for c in drop if c not in order and c not in keys])
    if delete_when is not None:
        rows = with_deletes(rows, delete_when)
    values = [c for c in rows.columns if c not in keys]
    if not values:
        return rows.distinct()
    picked = rows.groupBy(*keys).agg(
        newest([c for c in order if c not in keys], values).alias("_row")
    )
    result = picked.select(
        *[F.col(c) if c in keys else F.col(f"_row.{c}") for c in rows.columns]
    )
    if DELETED in result.columns and not keep_deleted:
        result = result.where(~F.col(DELETED)).drop(DELETED)
    return result.drop(*[c for c in drop if c not in keys])


def first_per_group(
    df: DataFrame, groups: Sequence[str], order: Sequence[Column], rank: str = "row_number"
) -> DataFrame:
    """First row of each group by ``order``; the order has to be total within a group.

    Spark limits each task to one row per group before the shuffle
    (``WindowGroupLimit``), so a large group is never gathered whole.
    """
    window = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) == 1).drop(rank)
