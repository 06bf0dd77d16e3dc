"""Appending what is new: by id, by file, by folder, by day, and by passes over old and new inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def new_rows(incoming: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """Incoming rows of which no known row has the keys. Copies among the incoming stay."""
    return incoming.join(known.select(*keys), keys, "left_anti")


def winning_files(rows: DataFrame, key: str, folder_rank: str, file: str) -> DataFrame:
    """All rows of the first file that has a key: of the folder of least rank, then by file name."""
    first = Window.partitionBy(key).orderBy(folder_rank, file)
    return rows.withColumn("__r", F.rank().over(first)).filter("__r = 1").drop("__r")


def two_pass(edges: DataFrame, datasets: DataFrame, edge_key: str, file: str, new_files: Column, since: Column) -> DataFrame:
    """Edges of new files to all datasets, and edges of old files to datasets added since; each pair once."""
    hit = edges.join(datasets, edges[edge_key] == datasets["dataset_id"])
    return hit.filter(new_files | since).drop(file).distinct()


def pending_days(days: DataFrame, ledger: DataFrame, source: str, done: str = "loaded", force: bool = False, newest_first: bool = False, most: int | None = None) -> DataFrame:
    """Days of the list that the ledger doesn't have as done, in the order in which they are to run."""
    own = ledger.filter((F.col("source") == source) & F.col(done))
    out = days if force else days.join(own.select("day"), "day", "left_anti")
    out = out.orderBy(F.desc("day") if newest_first else F.asc("day"))
    return out.limit(most) if most is not None else out


def day_list(spark, first: str, last: str) -> DataFrame:
    return spark.sql(f"select explode(sequence(date'{first}', date'{last}')) as day")


def harvest_windows(spark, start: str, end: str, days: int = 7) -> DataFrame:
    """Windows (first, last) backwards from the end, each of at most so many days and within a calendar year."""
    span = spark.sql(f"select explode(sequence(year(date'{start}'), year(date'{end}'))) as y")
    span = span.select(F.greatest(F.make_date("y", F.lit(1), F.lit(1)), F.lit(start).cast("date")).alias("a"), F.least(F.make_date("y", F.lit(12), F.lit(31)), F.lit(end).cast("date")).alias("b"))
    last = span.select("a", F.explode(F.expr(f"sequence(b, a, interval -{days} days)")).alias("last"))
    return last.select(F.greatest(F.col("a"), F.date_sub("last", days - 1)).alias("first"), "last").orderBy(F.desc("last"))


def upsert(current: DataFrame, changes: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """Current rows with changes over them: of each key the last change, else what there is. Both have equal columns."""
    rest = [c for c in current.columns if c not in keys]
    marked = current.withColumn(seq, F.lit(-1).cast("long")).unionByName(changes.withColumn(seq, F.col(seq).cast("long")))
    return marked.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(seq)).alias("r")).select(*keys, "r.*")


def numbered_inserts(incoming: DataFrame, existing: DataFrame, key: str, id_column: str, order: list[str]) -> DataFrame:
    """New keys with ids that go on from the largest: counts by part of the keys, then row numbers within parts."""
    fresh = incoming.join(existing.select(key), key, "left_anti").dropDuplicates([key])
    top = existing.agg(F.coalesce(F.max(id_column), F.lit(0)).alias("top"))
    number = F.row_number().over(Window.partitionBy("__p").orderBy(*order))
    parts = fresh.withColumn("__p", F.pmod(F.xxhash64(key), F.lit(64)))
    sizes = parts.groupBy("__p").agg(F.count("*").alias("n"))
    before = sizes.select("__p", F.coalesce(F.sum("n").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    out = parts.withColumn("__n", number).join(F.broadcast(before), "__p").crossJoin(F.broadcast(top))
    return out.withColumn(id_column, F.col("top") + F.col("before") + F.col("__n")).drop("__p", "__n", "before", "top")
