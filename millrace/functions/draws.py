"""Repeatable pseudo-random columns, a function of the row id alone."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = float(2**32)


def uniform(row_id: Column, k: int) -> Column:
    """The k-th uniform in (0, 1) of a row: 32 bits of the MD5 of ``<id>-<k div 4>``."""
    block, part = divmod(k, 4)
    digest = F.md5(F.concat(row_id.cast("string"), F.lit(f"-{block}")).cast("binary"))
    word = F.conv(F.substring(digest, 8 * part + 1, 8), 16, 10).cast("double")
    return (word + 0.5) / SPAN


def normal(row_id: Column, k: int, mean: float, sd: float) -> Column:
    """A normal value from the uniforms k and k + 1 (Box-Muller)."""
    radius = F.sqrt(-2 * F.log(uniform(row_id, k)))
    return mean + sd * radius * F.cos(2 * math.pi * uniform(row_id, k + 1))


def choice(u: Column, weighted: dict) -> Column:
    """Pick a value with the given probabilities from a uniform."""
    values = list(weighted.items())
    edge = 0.0
    picked = None
    for value, weight in values[:-1]:
        edge = round(edge + weight, 12)
        picked = F.when(u < edge, value) if picked is None else picked.when(u < edge, value)
    return F.lit(values[-1][0]) if picked is None else picked.otherwise(values[-1][0])
