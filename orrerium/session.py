"""A session with the settings that the plans count on."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

#: UTC dates, run-time re-planning with skew handling, and partitions that fit in an executor's memory.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "128m",
    # aggregates that collect keep hashing for so many keys before they sort
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "65536",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # files of a checkpoint go when nothing refers to it any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def session(app: str = "orrerium", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder for checkpoints that the session names. Where none is named, a local one serves a local session only."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        if named is None and not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="orrerium-checkpoint-"))
    return named or context.getCheckpointDir()


def checkpoint(df: DataFrame) -> DataFrame:
    """Cuts the lineage with files in the shared folder, which outlive a lost executor and leave no memory taken."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
