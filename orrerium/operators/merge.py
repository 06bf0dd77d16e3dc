"""Merging and deduplicating evidence. Sequence columns say what came first; ties in them must be whole copies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ids import clean_link


def merge_evidence(rows: DataFrame, kind: str, seq: list[str], clean: bool = True) -> DataFrame:
    """One row per dataset and link: fields of the first record, sources of all, and the bundle of the earliest year.

    kind: 'citation' or 'mention', in front of link, weight, date and year. clean: compare links without fragment and
    slashes at the end. Rows without id or link go. One shuffle on (dataset, link), with map-side combination.
    """
    link, year = f"{kind}_link", f"{kind}_year"
    bundle = [year, "placeholder_year", f"{kind}_date", "placeholder_date", f"{kind}_weight"]
    rows = rows.filter((F.col("dataset_id") != "") & (F.col(link) != ""))
    rows = rows.withColumn(link, clean_link(link)) if clean else rows
    first = F.struct(*seq)
    other = [c for c in rows.columns if c not in {"dataset_id", link, "source", *bundle, *seq}]
    out = rows.groupBy("dataset_id", link).agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.coalesce("source", F.array().cast("array<string>")))))).alias("source"),
        F.min_by(F.struct(*bundle), F.struct(F.coalesce(F.col(year), F.lit(2**31 - 1)).alias("y"), first.alias("s"))).alias("bundle"),
        *([F.min_by(F.struct(*other), first).alias("other")] if other else []),
    )
    return out.select("dataset_id", link, "source", "bundle.*", *(["other.*"] if other else []))


def dedupe_by_link(rows: DataFrame, kind: str, seq: list[str]) -> DataFrame:
    """Of each dataset and link, the record of earliest date; one without a date loses to one with; then what came first."""
    link = f"{kind}_link"
    order = F.struct(F.col(f"{kind}_date").isNull().alias("none"), F.coalesce(F.try_to_timestamp(F.col(f"{kind}_date")), F.lit("9999-12-31").cast("timestamp")).alias("at"), F.struct(*seq).alias("s"))
    rows = rows.filter(F.col(link).isNotNull())
    return rows.groupBy("dataset_id", link).agg(F.min_by(F.struct(*[c for c in rows.columns if c not in ("dataset_id", link)]), order).alias("r")).select("dataset_id", link, "r.*")


def last_wins(rows: DataFrame, key: str, seq: str) -> DataFrame:
    """Of each key the record that came last."""
    rest = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*rest), F.col(seq)).alias("r")).select(key, "r.*")


def first_wins(rows: DataFrame, key: str, seq: str) -> DataFrame:
    rest = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.min_by(F.struct(*rest), F.col(seq)).alias("r")).select(key, "r.*")
