"""Incremental loads as streams that end with their input.

A stream's checkpoint is the ledger of files: a file is read once, whatever happens in between. Each batch appends only
keys that the table doesn't hold, so that a repeated batch changes nothing.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: How long after its day a record may still come.
LATE = "7 days"


def _shared(spark: SparkSession) -> str:
    """A new folder in the one that the session shares between driver and executors."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir() or f"{spark.conf.get('spark.sql.warehouse.dir')}/streams"
    return os.path.join(named, f"stream-{uuid.uuid4().hex}")


def _files(spark: SparkSession, path: str, schema: T.StructType, files: int = 64) -> DataFrame:
    """Parquet files of a folder, or one file, as a stream."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    is_file = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(hadoop).isFile()
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files)
    return reader.option("pathGlobFilter", os.path.basename(path)).parquet(os.path.dirname(path)) if is_file else reader.parquet(path)


def append_new(table: str, keys: list[str]):
    """A foreachBatch function that appends rows whose keys the Parquet table doesn't hold yet."""

    def append(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.select(*keys).distinct()
        if batch_id > 0:
            # what this batch wrote before a failure must not count as known
            known = spark.read.parquet(table).filter(F.col("batch_id") != batch_id).select(*keys)
            rows = rows.join(known, keys, "left_anti")
        rows.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(table)

    return append


def load_new(spark: SparkSession, path: str, schema: T.StructType, keys: list[str], table: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Loads what is new in a folder into a table of distinct keys, and returns the table."""
    base = _shared(spark)
    table, checkpoint = table or f"{base}/table", checkpoint or f"{base}/checkpoint"
    rows = _files(spark, path, schema)
    stream = rows.writeStream.foreachBatch(append_new(table, keys)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    stream.awaitTermination()
    return spark.read.parquet(table).select(*keys)


def daily_counts(spark: SparkSession, path: str, schema: T.StructType, files: int = 64) -> DataFrame:
    """day, event_type and n. Each batch writes the counts that it changed; of a day the last batch's count holds.

    A record that comes later than LATE after the latest of earlier batches is left out, and the state of days that the
    watermark has passed is dropped, so that it doesn't grow with the stream. files: of one batch.
    """
    base = _shared(spark)
    rows = _files(spark, path, schema, files).withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", LATE)
    counts = rows.groupBy(F.window("at", "1 day").alias("w"), "event_type").agg(F.count("*").alias("n"))
    out = counts.select(F.to_date("w.start").alias("day"), "event_type", "n")

    def keep(batch: DataFrame, batch_id: int) -> None:
        changed = batch.withColumn("batch_id", F.lit(batch_id))
        changed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(f"{base}/counts")

    out.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{base}/counts").groupBy("day", "event_type").agg(F.max_by("n", "batch_id").alias("n"))
