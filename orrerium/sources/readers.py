"""Readers of NDJSON, JSON arrays, Parquet folders, mappings and patents. Schemas are declared, never inferred."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import dois_in, emdb_in

BAD = "_bad"


def ndjson(spark: SparkSession, paths: str | list[str], schema: str, keep_bad: bool = False, glob: str = "*.ndjson*") -> DataFrame:
    """Lines of files or folders (searched through); absent keys are null. A line that can't be parsed is dropped, or kept in BAD."""
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    if not keep_bad:
        return reader.option("mode", "DROPMALFORMED").schema(schema).json(paths)
    return reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD).schema(f"{schema}, {BAD} string").json(paths)


def bad_line_count(rows: DataFrame) -> DataFrame:
    # All columns are read, as a scan of the column for broken lines alone isn't allowed.
    return rows.agg(F.count("*").alias("n"), F.count(F.when(F.col(BAD).isNotNull(), F.struct(*rows.columns))).alias("n_bad"))


def json_arrays(spark: SparkSession, paths: str | list[str], schema: str) -> DataFrame:
    return spark.read.option("multiLine", "true").schema(schema).json(paths)


def ranked_folders(spark: SparkSession, folders: list[str]) -> DataFrame:
    """Parquet of several folders with `folder_rank` in the order given and `file`."""
    out = None
    for rank, folder in enumerate(folders):
        rows = spark.read.parquet(folder).withColumns({"folder_rank": F.lit(rank), "file": F.col("_metadata.file_path")})
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out


def separator(spark: SparkSession, path: str, known: str = ",;|\t") -> str:
    """The one of the known signs that is most frequent in a file's first line; a tab if it has none."""
    line = spark.read.text(path).first()
    counts = [(line[0] or "").count(sign) if line else 0 for sign in known]
    return known[counts.index(max(counts))] if max(counts) else "\t"


def mapping(spark: SparkSession, path: str, sep: str | None = ",") -> DataFrame:
    """A lookup table in CSV: header names without blanks, a byte order mark ignored, `seq` for the last of equal keys.

    Without a separator, the one that the header shows is taken.
    """
    sep = sep or separator(spark, path)
    rows = spark.read.option("header", "true").option("sep", sep).option("ignoreLeadingWhiteSpace", "true").option("ignoreTrailingWhiteSpace", "true").csv(path)
    rows = rows.toDF(*[c.strip().lstrip("﻿").strip() for c in rows.columns])
    return rows.withColumn("seq", F.monotonically_increasing_id())


def first_identifiers(slim: DataFrame, seq: str) -> DataFrame:
    """dataset_id and pubyear of the first record of each first identifier."""
    rows = slim.withColumn("dataset_id", F.get("identifiers", F.lit(0))["identifier"]).filter("dataset_id is not null")
    return rows.groupBy("dataset_id").agg(F.min_by("pubyear", seq).alias("pubyear"))


def highest_revisions(files: DataFrame, column: str = "file") -> DataFrame:
    """Of files named base_rN.zip the one of highest N; without _rN it is 0."""
    base, revision = F.regexp_extract(column, r"(ipg\d{6})", 1), F.regexp_extract(column, r"_r(\d+)\.zip$", 1)
    rows = files.select(F.col(column).alias("file"), base.alias("base"), F.coalesce(F.when(revision != "", revision).cast("int"), F.lit(0)).alias("revision")).filter("base <> ''")
    return rows.groupBy("base").agg(F.max_by("file", F.struct("revision", "file")).alias("file"), F.max("revision").alias("revision"))


def patents(spark: SparkSession, path: str, glob: str = "*.zip") -> DataFrame:
    """source_file and xml of each document in zip archives of concatenated XML; broken ones come through as text.

    An archive is one task's work, as a zip can't be split; documents leave it one by one.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path).select("path", "content")

    def documents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path_, content in zip(batch["path"], batch["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for name in archive.namelist():
                        if not name.lower().endswith(".xml"):
                            continue
                        held: list[str] = []
                        with archive.open(name) as lines:
                            for line in io.TextIOWrapper(lines, encoding="utf-8", errors="replace"):
                                if line.startswith("<?xml") and held:
                                    yield pd.DataFrame({"source_file": [path_.rsplit("/", 1)[-1]], "xml": ["".join(held)]})
                                    held = []
                                held.append(line)
                        if "".join(held).strip():
                            yield pd.DataFrame({"source_file": [path_.rsplit("/", 1)[-1]], "xml": ["".join(held)]})

    return files.mapInPandas(documents, "source_file string, xml string")


def patent_records(documents: DataFrame) -> DataFrame:
    """Number, link, date and the DOIs and EMDB accessions of each patent that has any; read by patterns, so that broken XML will do."""
    first = lambda pattern: F.regexp_extract("xml", pattern, 1)
    plain = F.regexp_replace("xml", r"(?s)<[^>]*>", " ")
    number = first(r"(?s)<publication-reference.*?<doc-number>\s*([^<\s]+)")
    rows = documents.select(number.alias("patent_id"), F.concat(F.lit("https://patents.google.com/patent/US"), F.regexp_replace(number, "^0+", "")).alias("mention_link"), first(r"(?s)<publication-reference.*?<date>\s*(\d{8})").alias("mention_date"), dois_in(plain).alias("doi"), emdb_in(plain).alias("emdb_id"), "source_file")
    return rows.filter((F.size("doi") > 0) | (F.size("emdb_id") > 0))


def line_counts(spark: SparkSession, path: str, marker: str = "<?xml") -> DataFrame:
    """One row: lines, blank ones among them, and lines that start with a marker, such as the documents of an archive's file."""
    value = F.col("value")
    count = lambda condition: F.count(F.when(condition, 1))
    return spark.read.text(path).agg(F.count("*").alias("n_lines"), count(F.trim(value) == "").alias("n_blank"), count(value.startswith(marker)).alias("n_marked"))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their file and place in it, for what came first."""
    rows = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("at"))
    return rows.withColumn("line", F.row_number().over(Window.partitionBy("file").orderBy("at"))).drop("at")


def content_checksums(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", F.sha2("content", 256).alias("sha256"), "length")
