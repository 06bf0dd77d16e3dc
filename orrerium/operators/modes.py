"""Aggregates whose ties are settled by a rule."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mode(c: str) -> Column:
    """The most frequent value, nulls aside; of several, the least."""
    return F.mode(F.col(c), True)


def distinct_union(c: str) -> Column:
    """Sorted distinct members of all arrays."""
    return F.array_sort(F.array_distinct(F.flatten(F.collect_set(c))))
