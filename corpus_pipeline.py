"""The corpus pipeline: five stages over documents, each written as Parquet and read again as the next one's input.

A stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. Documents that the quality rules reject
go; of near-duplicates one stays; documents that hold a benchmark's window go; the mix takes each document as often as
its source's target asks; and every copy, with all its columns, gets its shard and its slot there.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from orrerium.llm import decontamination, mixing, ngram_join, quality_rules, sharding
from orrerium.llm.common import shared_folder

STAGES = [
    ("quality_rules", quality_rules.stage),
    ("ngram_join", ngram_join.stage),
    ("decontamination", decontamination.stage),
    ("mixing", mixing.stage),
    ("sharding", sharding.stage),
]

#: Random rounding and bin packing have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, with what each returns written to the shared folder that the session names; a stage's files go
    once the next has written its own, so that those of the last stay."""
    at = os.path.join(shared_folder(spark), f"corpus-{uuid.uuid4().hex}")
    docs, read = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{at}/{name}")
        if read is not None:
            _remove(spark, read)
        read = f"{at}/{name}"
        docs = spark.read.parquet(read)
    return docs
