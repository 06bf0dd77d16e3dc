"""Weights of evidence and the index of a dataset."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Thresholds where a field has none of its own.
FAIR_THRESHOLD, CITATION_THRESHOLD, MENTION_THRESHOLD = 13.46, 1.0, 1.0
FAIR_EXTRAPOLATED = 42.31


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def evidence_weight(dataset_year, evidence_year) -> Column:
    """1 plus a third of the logarithm of the years between, to two places; 1 if a year is missing or evidence is older."""
    years = F.greatest(F.lit(0), F.coalesce(_col(evidence_year) - _col(dataset_year), F.lit(0)))
    return F.round(1 + 0.33 * F.log(1.0 + years), 2)


def _threshold(c, default: float) -> Column:
    c = F.lit(None).cast("double") if c is None else _col(c)
    return F.when(c > 0, c).otherwise(F.lit(default))


def dataset_index(fair, citations, mentions, fair_t=None, citation_t=None, mention_t=None) -> Column:
    """Mean of the three scores over their thresholds; fails for a score out of range, as bad input must not pass silently."""
    fair, citations, mentions = (_col(c) for c in (fair, citations, mentions))
    value = (fair / _threshold(fair_t, FAIR_THRESHOLD) + citations / _threshold(citation_t, CITATION_THRESHOLD) + mentions / _threshold(mention_t, MENTION_THRESHOLD)) / 3.0
    return F.when((fair < 0) | (fair > 100) | (citations < 0) | (mentions < 0), F.raise_error(F.lit("a score is out of range")).cast("double")).otherwise(value)


def raw_index(fair, citations, mentions) -> Column:
    """Unnormalised; what is missing counts as 0."""
    zero = lambda c: F.coalesce(_col(c), F.lit(0.0))
    return (zero(fair) / 100.0 + zero(citations) + zero(mentions)) / 3.0


def floored(c, floor) -> tuple[Column, Column]:
    """The value raised to a floor, and whether it was; null stays null and unmarked."""
    c, floor = _col(c), floor if isinstance(floor, Column) else F.lit(floor)
    return F.when(c < floor, floor).otherwise(c), F.coalesce(c < floor, F.lit(False))
