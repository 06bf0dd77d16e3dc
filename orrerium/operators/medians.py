"""Medians of groups over a lifetime and over rolling years."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Years back that a target year looks, for evidence and for scores.
EVIDENCE_BACK, SCORE_BACK = (2, 3), (1, 2, 3)
MEASURES = {"cit_weight": ("total_cit_weight", EVIDENCE_BACK), "men_weight": ("total_men_weight", EVIDENCE_BACK), "fair_score": ("fair_score", SCORE_BACK)}


#: Bins to a unit of the logarithm by which medians are narrowed down.
BINS = 4096


def exact_medians(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Keys, `median` and `n` of each group. cells: keys, `value` (a double, not null) and `n`, how often it occurs.

    The bins that hold the middle are found by running counts over a histogram, and only what lies in them is sorted, a bin
    at a time; so a group of all rows costs one task its bins and not its values. Bins grow with the value, by its
    logarithm, which keeps them few for any range.
    """
    cells = cells.withColumn("bin", F.floor(F.signum("value") * F.log1p(F.abs("value")) * BINS))
    group, upto = Window.partitionBy(*keys), Window.partitionBy(*keys).orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bins = cells.groupBy(*keys, "bin").agg(F.sum("n").alias("in_bin")).withColumns({"upto": F.sum("in_bin").over(upto), "in_group": F.sum("in_bin").over(group)})
    low, high = F.expr("(in_group - 1) div 2"), F.expr("in_group div 2")
    middle = bins.filter((F.col("upto") > low) & (F.col("upto") - F.col("in_bin") <= high)).withColumn("before", F.col("upto") - F.col("in_bin"))
    sides = middle.select(*[F.col(k).alias(f"m_{k}") for k in [*keys, "bin"]], "before", "in_group")
    same = F.col("bin") == F.col("m_bin")
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"m_{key}"))
    inside = cells.join(sides, same).select(*keys, "bin", "value", "n", "before", "in_group")
    here = Window.partitionBy(*keys, "bin").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = inside.withColumn("upto", F.col("before") + F.sum("n").over(here)).withColumn("from", F.col("upto") - F.col("n"))
    at = lambda rank: F.max(F.when((F.col("from") <= rank) & (F.col("upto") > rank), F.col("value")))
    return placed.groupBy(*keys).agg(((at(low) + at(high)) / 2.0).alias("median"), F.max("in_group").alias("n"))


def target_years(rows: DataFrame) -> DataFrame:
    """One row for each target year: from three after the first year to one after the last; three after the last if there are none.

    Nothing if both ends meet, since the last year is exclusive; a descending sequence must not be made of that.
    """
    ends = rows.agg(F.min("pubyear").alias("a"), F.max("pubyear").alias("b"))
    years = F.when(F.col("a") + 3 <= F.col("b") + 1, F.sequence(F.col("a") + 3, F.col("b") + 1)).when(F.col("a") + 3 > F.col("b") + 2, F.array(F.col("b") + 3)).otherwise(F.array().cast("array<int>"))
    return ends.select(F.explode(years).alias("pubyear"))


def normalization_factors(metrics: DataFrame, id_column: str, name_column: str, positive: bool = False) -> DataFrame:
    """id, name, pubyear, the three medians and their counts, of all rows, each group, each target year, and both.

    Rows without a year are left out (also years of 0 and less, if positive); rows without an id count in the totals only.
    A group without a name is Unknown. Every group has a row for every target year, if only with nulls and zeros.

    Equal values of a group and year fold to a count first. These counts, not rows, go to the totals, to the lifetime and
    to the years that look back at them; the grid of groups and years is as small as its factors.
    """
    rows = metrics.filter("pubyear is not null" + (" and pubyear > 0" if positive else "")).select(
        F.col(id_column).cast("string").alias("id"), F.when(F.col(id_column).isNotNull(), F.coalesce(F.col(name_column), F.lit("Unknown"))).alias("name"), F.col("pubyear").cast("int").alias("pubyear"),
        *{column for column, _ in MEASURES.values()},
    )
    keys, everything = ["total", "id", "name"], [F.lit(True).alias("total"), F.lit(None).cast("string").alias("id"), F.lit(None).cast("string").alias("name")]
    measured = F.explode(F.array(*[F.struct(F.lit(name).alias("measure"), F.col(column).cast("double").alias("value")) for name, (column, _) in MEASURES.items()]))
    counts = rows.select("id", "name", "pubyear", measured.alias("m")).select("id", "name", "pubyear", "m.*").filter("value is not null")
    counts = counts.groupBy("id", "name", "pubyear", "measure", "value").agg(F.count("*").alias("n"))
    # A null target is the lifetime; the look-backs of a measure decide for which other targets a value counts.
    targets = F.coalesce(*[F.when(F.col("measure") == name, F.array(F.lit(None).cast("int"), *[F.col("pubyear") + b for b in years])) for name, (_, years) in MEASURES.items()])
    levels = F.array(F.struct(*everything), F.struct(F.lit(False).alias("total"), "id", "name"))
    cells = counts.withColumn("g", F.explode(levels)).filter("g.total or g.id is not null").select("g.*", "pubyear", "measure", "value", "n")
    cells = cells.withColumn("target", F.explode(targets)).groupBy(*keys, "target", "measure", "value").agg(F.sum("n").alias("n"))
    found = exact_medians(cells, [*keys, "target", "measure"])
    pick = lambda c, name: F.max(F.when(F.col("measure") == name, F.col(c)))
    found = found.groupBy(*keys, "target").agg(*[pick(c, name).alias(f"{p}_{name}") for name in MEASURES for p, c in (("median", "median"), ("n", "n"))])
    some = rows.agg(F.count("*").alias("rows")).filter("rows > 0").select(*everything)
    groups = some.unionByName(rows.filter("id is not null").select(F.lit(False).alias("total"), "id", "name").distinct())
    years = target_years(rows).unionByName(rows.sparkSession.range(1).select(F.lit(None).cast("int").alias("pubyear")))
    grid = groups.crossJoin(F.broadcast(years))
    found = found.withColumnsRenamed({key: f"f_{key}" for key in keys})
    same = (F.col("total") == F.col("f_total")) & F.col("pubyear").eqNullSafe(F.col("target"))
    for key in ("id", "name"):
        same = same & F.col(key).eqNullSafe(F.col(f"f_{key}"))
    whole = grid.join(found, same, "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    return whole.select(
        "id", "name", "pubyear", F.col("median_fair_score").alias("median_fair_score_3yr"), F.col("median_cit_weight").alias("median_cit_weight_3yr"), F.col("median_men_weight").alias("median_men_weight_3yr"),
        zero("n_fair_score").alias("n_fair"), zero("n_cit_weight").alias("n_cit"), zero("n_men_weight").alias("n_men"),
    )
