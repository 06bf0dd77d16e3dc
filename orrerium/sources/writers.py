"""Writers: tables, NDJSON, Parquet and CSV exports, day partitions, insert-ignore, and a manifest as commit marker."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Lines in one exported file.
LINES = 500_000


def replace_table(df: DataFrame, name: str) -> None:
    df.write.mode("overwrite").saveAsTable(name)


def append_table(df: DataFrame, name: str) -> None:
    """Creates the table if there is none."""
    df.write.mode("append").saveAsTable(name)


def copy_table(spark: SparkSession, name: str, to: str) -> None:
    replace_table(spark.table(name), to)


def external_table(spark: SparkSession, name: str, path: str) -> None:
    """A name for Parquet files that stay where they are."""
    spark.catalog.createTable(name, path=path, source="parquet")


def view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def ndjson(df: DataFrame, path: str, lines: int = LINES, compression: str = "none") -> None:
    """Keys whose value is null are left out; a file has at most so many lines."""
    df.write.mode("overwrite").option("maxRecordsPerFile", lines).option("compression", compression).option("ignoreNullFields", "true").json(path)


def parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    out = df.write.mode("overwrite").option("compression", "zstd")
    (out.partitionBy(*partition_by) if partition_by else out).parquet(path)


def csv(df: DataFrame, path: str, sep: str = ",") -> None:
    df.write.mode("overwrite").option("header", "true").option("sep", sep).csv(path)


def day_partitions(df: DataFrame, path: str, day: str = "day") -> None:
    """Replaces the days that the rows have, and no others, so that a load may be repeated."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)


def joined_lines(spark: SparkSession, paths: list[str], out: str, blank: bool = False) -> None:
    """The lines of text files, blank ones only if asked for."""
    lines = spark.read.text(paths)
    (lines if blank else lines.filter(F.trim("value") != "")).write.mode("overwrite").text(out)


def audited(df: DataFrame, path: str, *measures: Column) -> dict:
    """Writes Parquet and returns the measures, named aggregates that are taken of the rows while they are written."""
    seen = Observation()
    parquet(df.observe(seen, *measures), path)
    return seen.get


def with_prefix_only(df: DataFrame, prefix: str) -> DataFrame:
    """Records of which some identifier starts with a prefix."""
    return df.filter(F.exists("identifiers", lambda x: F.coalesce(x["identifier"].startswith(prefix), F.lit(False))))


def sorted_out(rows: DataFrame, checks: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Rows that pass all conditions, and the others with the names of those that they fail."""
    failed = F.array_compact(F.array(*[F.when(~F.coalesce(F.expr(condition), F.lit(False)), F.lit(name)) for name, condition in checks.items()]))
    marked = rows.withColumn("failed", failed)
    return marked.filter(F.size("failed") == 0).drop("failed"), marked.filter(F.size("failed") > 0)


def publish(df: DataFrame, path: str, about: dict) -> None:
    """Data first, a manifest last: a reader that waits for the manifest never sees half a load. Any store that Spark writes will do."""
    spark = df.sparkSession
    df.write.mode("overwrite").json(f"{path}/data", compression="gzip")
    text = json.dumps({**about, "records": spark.read.text(f"{path}/data").count()}, sort_keys=True)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/manifest")


def published(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(f"{path}/manifest").first()[0])
