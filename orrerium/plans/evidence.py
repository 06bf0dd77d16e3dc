"""Evidence tables: citations, mentions, scores, topics and metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import PLACEHOLDER_DATE, PLACEHOLDER_YEAR, try_date
from ..functions.ids import topic_id
from ..functions.weights import FAIR_EXTRAPOLATED, evidence_weight
from ..operators.merge import last_wins


def metadata_of(slim: DataFrame) -> DataFrame:
    """One row for each slim record with a first identifier."""
    first = F.get("identifiers", F.lit(0))["identifier"]
    return slim.filter(first.isNotNull()).select(
        first.alias("dataset_id"), try_date("publication_date").alias("pub_ts"), "pubyear", "creators", "title", "source", "publisher"
    )


def with_weight(rows: DataFrame, kind: str, dataset_year: str = "pubyear") -> DataFrame:
    return rows.withColumn(f"{kind}_weight", evidence_weight(dataset_year, f"{kind}_year"))


def with_placeholders(rows: DataFrame, kind: str) -> DataFrame:
    """Fills a missing date and a missing year, each for itself, and marks both. Weights must have been computed before."""
    date, year = f"{kind}_date", f"{kind}_year"
    return rows.withColumns(
        {
            "placeholder_date": F.col(date).isNull(), date: F.coalesce(date, F.lit(PLACEHOLDER_DATE)),
            "placeholder_year": F.col(year).isNull(), year: F.coalesce(year, F.lit(PLACEHOLDER_YEAR)),
        }
    )


TOPIC_FIELDS = ("topic_id", "topic_name", "score", "subfield_id", "subfield_name", "field_id", "field_name", "domain_id", "domain_name")


def selected_topics(oa: DataFrame, model: DataFrame) -> DataFrame:
    """Of two topic assignments the first if its score is over a half or over the other's, else the second, field by field."""
    oa, model = oa.alias("o"), model.alias("m")
    both = oa.join(model, F.col("o.dataset_id") == F.col("m.dataset_id"), "full_outer")
    score = lambda side: F.coalesce(F.col(f"{side}.score"), F.lit(0.0))
    wins = (score("o") > 0.5) | (score("o") > score("m"))
    fields = [F.when(wins, F.col(f"o.{f}")).otherwise(F.col(f"m.{f}")).alias(f) for f in TOPIC_FIELDS]
    return both.select(F.coalesce("o.dataset_id", "m.dataset_id").alias("dataset_id"), *fields, F.when(wins, F.lit("openalex")).otherwise(F.lit("custom_model")).alias("source"))


def enhanced_topics(topics: DataFrame, mapping: DataFrame) -> DataFrame:
    """Topics with the mapping's columns filled in by topic; of equal topics in the mapping the last row counts."""
    known = last_wins(mapping.withColumn("topic_id", topic_id("topic_id")), "topic_id", "seq")
    extra = [c for c in known.columns if c != "topic_id"]
    side = known.select(F.col("topic_id").alias("__t"), *[F.col(c).alias(f"__{c}") for c in extra])
    out = topics.withColumn("topic_id", topic_id("topic_id")).join(side, F.col("topic_id") == F.col("__t"), "left")
    return out.select(*[c for c in topics.columns if c not in extra], *[F.coalesce(f"__{c}", c).alias(c) if c in topics.columns else F.col(f"__{c}").alias(c) for c in extra])


def flat_model_topics(rows: DataFrame) -> DataFrame:
    return rows.select(
        "dataset_id", topic_id("topic.id").alias("topic_id"), F.col("topic.name").alias("topic_name"), F.col("topic.score").alias("score"), F.lit("custom_model").alias("source"),
        *[F.col(f"{level}.{f}").alias(f"{level}_{f}") for level in ("subfield", "field", "domain") for f in ("id", "name")],
    )


def with_subfield(topics: DataFrame, mapping: DataFrame) -> DataFrame:
    """Topics with the subfield that the mapping's first row of their topic has; ids are compared by their digits."""
    named = mapping.select(topic_id("topic_id").alias("__t"), F.trim("subfield_id").alias("subfield_id"), "seq").filter("__t is not null")
    first = named.groupBy("__t").agg(F.min_by("subfield_id", "seq").alias("subfield_id"))
    out = topics.drop("subfield_id").withColumn("topic_id", topic_id("topic_id"))
    return out.join(first, F.col("topic_id") == F.col("__t"), "left").drop("__t")


def merged_scores(parts: list[DataFrame]) -> DataFrame:
    """Score records of several files, their DOI as dataset_id."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out.withColumnRenamed("doi", "dataset_id") if "doi" in out.columns else out


def extrapolated_fair(datasets: DataFrame, scores: DataFrame, seq: str = "seq", default: float = FAIR_EXTRAPOLATED) -> DataFrame:
    """Each dataset with its last score, or the default, and whether that was extrapolated."""
    last = last_wins(scores.select("dataset_id", "score", seq), "dataset_id", seq)
    out = datasets.join(last.select("dataset_id", F.col("score").alias("own")), "dataset_id", "left")
    return out.select("dataset_id", F.coalesce("own", F.lit(default)).alias("score"), F.col("own").isNull().alias("extrapolated"))
