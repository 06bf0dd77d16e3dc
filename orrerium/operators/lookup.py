"""Thresholds of a field and year with clamping and fallbacks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ALL, ANY_YEAR = "ALL", -1
VALUES = ("ft_median", "ctw_median", "mtw_median")


def with_factors(rows: DataFrame, factors: DataFrame, key: str, year: str) -> DataFrame:
    """Each row with the factors of the first level that has any: its key and clamped year, all keys in that year, and,
    for rows with a year, the key in any year and all in any year. `level` names it; null if none has.

    factors: key, year (-1: any) and VALUES, one row for each pair. Years are clamped to those of the key and of all.
    """
    real = factors.filter(F.col("year") >= 0)
    own = real.groupBy(F.col("key").alias("k")).agg(F.min("year").alias("own_min"), F.max("year").alias("own_max"))
    whole = own.filter(F.col("k") == ALL).select(F.col("own_min").alias("all_min"), F.col("own_max").alias("all_max"))
    # Run-time statistics decide which of these sides are sent out; only the one row of all keys is so by its nature.
    out = rows.join(own, rows[key] == F.col("k"), "left").join(F.broadcast(whole), F.lit(True), "left")
    low, high = F.least("own_min", "all_min"), F.greatest("own_max", "all_max")
    out = out.withColumn("used_year", F.when(F.col(year).isNull(), ANY_YEAR).otherwise(F.least(F.greatest(F.col(year), low), high)))
    levels = [("key_year", F.col(key), F.col("used_year")), ("all_year", F.lit(ALL), F.col("used_year")), ("key_any", F.col(key), F.when(F.col(year).isNotNull(), ANY_YEAR)), ("all_any", F.lit(ALL), F.when(F.col(year).isNotNull(), ANY_YEAR))]
    found = []
    for name, k, y in levels:
        side = factors.select(F.col("key").alias(f"{name}_k"), F.col("year").alias(f"{name}_y"), F.struct(F.lit(name).alias("level"), *VALUES).alias(name))
        out = out.join(side, (k == F.col(f"{name}_k")) & (y == F.col(f"{name}_y")), "left").drop(f"{name}_k", f"{name}_y")
        found.append(F.col(name))
    return out.withColumn("f", F.coalesce(*found)).select(*rows.columns, "used_year", "f.*")
