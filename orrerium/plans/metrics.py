"""From evidence to metrics, normalisation factors, indices and authors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.ids import creator_identifier, norm_dataset_id
from ..functions.text import affiliation_list
from ..functions.weights import CITATION_THRESHOLD, FAIR_THRESHOLD, MENTION_THRESHOLD, floored, raw_index
from ..operators.asof import asof_left_join
from ..operators.medians import normalization_factors

#: Years from a dataset's first that the short window holds beyond it.
SHORT_WINDOW = 2
TOPIC = ("topic_id", "topic_name", "subfield_id", "subfield_name", "field_id", "field_name", "domain_id", "domain_name")


def evidence_stats(evidence: DataFrame, metadata: DataFrame, kind: str, short: str) -> DataFrame:
    """Count and weight of each dataset's evidence, in all and up to two years from publication (earlier counts too)."""
    year, weight, plural = f"{kind}_year", f"{kind}_weight", {"citation": "citations", "mention": "mentions"}[kind]
    near = F.col(year) <= F.col("pubyear") + SHORT_WINDOW
    rows = evidence.join(metadata.select("dataset_id", "pubyear"), "dataset_id")
    return rows.groupBy("dataset_id", "pubyear").agg(
        F.count("*").alias(f"total_{plural}"), F.sum(weight).alias(f"total_{short}_weight"), F.count(F.when(near, 1)).alias(f"{short}_3yr"), F.sum(F.when(near, F.col(weight)).otherwise(0.0)).alias(f"{short}_weight_3yr")
    )


def dataset_metrics(metadata: DataFrame, citations: DataFrame, mentions: DataFrame, fair: DataFrame, topics: DataFrame) -> DataFrame:
    """One row for each dataset (more, if a side holds its id more than once): identity, topic, score, counts, raw indices."""
    cit = evidence_stats(citations, metadata, "citation", "cit").drop("pubyear")
    men = evidence_stats(mentions, metadata, "mention", "men").drop("pubyear")
    topics = topics.select("dataset_id", *TOPIC, F.col("score").alias("topic_score"))
    out = metadata.join(cit, "dataset_id", "left").join(men, "dataset_id", "left").join(fair.select("dataset_id", F.col("score").alias("fair_score")), "dataset_id", "left").join(topics, "dataset_id", "left")
    count = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    weight = lambda c: F.coalesce(F.col(c), F.lit(0.0)).alias(c)
    return out.select(
        "dataset_id", "pubyear", *(["creators"] if "creators" in metadata.columns else []), F.col("source").alias("dataset_source"), *TOPIC, "topic_score", "fair_score",
        count("total_citations"), weight("total_cit_weight"), count("cit_3yr"), weight("cit_weight_3yr"), count("total_mentions"), weight("total_men_weight"), count("men_3yr"), weight("men_weight_3yr"),
        raw_index("fair_score", "total_cit_weight", "total_men_weight").alias("raw_dataset_index"), raw_index("fair_score", "cit_weight_3yr", "men_weight_3yr").alias("raw_dataset_index_3yr"),
    )


def topic_factors(metrics: DataFrame) -> DataFrame:
    return normalization_factors(metrics, "topic_id", "topic_name")


def subfield_factors(metrics: DataFrame) -> DataFrame:
    return normalization_factors(metrics, "subfield_id", "subfield_name")


DEFAULT = "DEFAULT"


def floored_factors(factors: DataFrame) -> DataFrame:
    """Factors raised to floors, with flags, and one default row.

    The floor of scores is the least median of all rows if that is larger than the fixed one.
    """
    least = factors.agg(F.greatest(F.lit(FAIR_THRESHOLD), F.min("median_fair_score_3yr")).alias("fair_floor"))
    rows = factors.crossJoin(F.broadcast(least))
    (fair, fair_is), (cit, cit_is), (men, men_is) = floored("median_fair_score_3yr", F.col("fair_floor")), floored("median_cit_weight_3yr", CITATION_THRESHOLD), floored("median_men_weight_3yr", MENTION_THRESHOLD)
    out = rows.select("id", "name", "pubyear", cit.alias("median_cit_weight_3yr"), cit_is.alias("cit_is_floored"), men.alias("median_men_weight_3yr"), men_is.alias("men_is_floored"), fair.alias("median_fair_score_3yr"), fair_is.alias("fair_is_floored"), "n_fair", "n_cit", "n_men")
    yes, none = F.lit(True), F.lit(0).cast("long")
    default = least.select(
        F.lit(DEFAULT).alias("id"), F.lit("Default Fallback").alias("name"), F.lit(None).cast("int").alias("pubyear"), F.lit(CITATION_THRESHOLD).alias("median_cit_weight_3yr"), yes.alias("cit_is_floored"), F.lit(MENTION_THRESHOLD).alias("median_men_weight_3yr"),
        yes.alias("men_is_floored"), F.col("fair_floor").alias("median_fair_score_3yr"), yes.alias("fair_is_floored"), none.alias("n_fair"), none.alias("n_cit"), none.alias("n_men"),
    )
    return out.unionByName(default)


def _normalised(metrics: DataFrame, factors: DataFrame, key: str, p: str) -> DataFrame:
    """Adds the norms, gap and kind of match by one key: as of the year of publication, or else the default row."""
    names = {"median_fair_score_3yr": "fair", "median_cit_weight_3yr": "cit", "median_men_weight_3yr": "men"}
    side = factors.filter(F.col("id") != DEFAULT).select(F.col("id").alias(f"{p}_id"), F.col("pubyear").cast("int").alias(f"{p}_year"), F.col("name").alias(f"{p}_name"), *[F.col(c).alias(f"{p}_{n}") for c, n in names.items()])
    default = factors.filter(F.col("id") == DEFAULT).select(*[F.col(c).alias(f"{p}_def_{n}") for c, n in names.items()])
    out = asof_left_join(metrics, side, key, "pubyear", f"{p}_id", f"{p}_year", ties=[F.col(f"{p}_name")]).join(F.broadcast(default), F.lit(True), "left")
    gap = F.col("pubyear") - F.col(f"{p}_year")
    norms = {f"{p}_norm_{n}": F.coalesce(f"{p}_{n}", f"{p}_def_{n}") for n in names.values()}
    out = out.withColumns({**norms, f"{p}_norm_gap": gap, f"{p}_source": F.when(F.col(f"{p}_year").isNull(), "Default").when(gap == 0, "Exact Year").otherwise("Closest Past Year")})
    return out.drop(f"{p}_id", f"{p}_year", f"{p}_name", *[f"{p}_{n}" for n in names.values()], *[f"{p}_def_{n}" for n in names.values()])


def dataset_index(metrics: DataFrame, topics: DataFrame, subfields: DataFrame) -> DataFrame:
    """Metrics with norms by topic and subfield as of the year of publication, and the two indices (null without a score)."""
    out = _normalised(_normalised(metrics, topics, "topic_id", "t"), subfields, "subfield_id", "s")
    index = lambda p: (F.col("fair_score") / F.col(f"{p}_norm_fair") + F.col("total_cit_weight") / F.col(f"{p}_norm_cit") + F.col("total_men_weight") / F.col(f"{p}_norm_men")) / 3.0
    return out.withColumns({"dataset_index_topic": index("t"), "dataset_index_subfield": index("s")})


def year_factors(rows: DataFrame, factors: DataFrame, key: str) -> DataFrame:
    """Rows (key and pubyear) with ft, ctw and mtw as of the year or by default, n_year_gap and method."""
    out = _normalised(rows, factors, key, "n")
    return out.withColumnsRenamed({"n_norm_fair": "ft", "n_norm_cit": "ctw", "n_norm_men": "mtw", "n_norm_gap": "n_year_gap", "n_source": "method"})


def series_of_requests(requests: DataFrame, metadata: DataFrame, topics: DataFrame, fair: DataFrame, citations: DataFrame, mentions: DataFrame, factors: DataFrame, this_year: int) -> DataFrame:
    """The yearly series of datasets that are asked for by DOI or address (column `request`, in any writing).

    What is known of a dataset is joined by its normalised id; an unknown one has neither year nor subfield and gets the
    default factors. factors: floored ones of subfields.
    """
    asked = requests.select(norm_dataset_id("request").alias("dataset_id")).filter("dataset_id <> ''").distinct()
    known = asked.join(metadata.groupBy("dataset_id").agg(F.min("pubyear").alias("pubyear")), "dataset_id", "left")
    known = known.join(topics.groupBy("dataset_id").agg(F.min("subfield_id").alias("subfield_id")), "dataset_id", "left")
    known = known.join(fair.groupBy("dataset_id").agg(F.max("score").alias("fair_score")), "dataset_id", "left")
    event = lambda df, kind: df.select("dataset_id", F.lit(kind).alias("kind"), F.col(f"{kind}_year").alias("year"), F.col(f"{kind}_weight").alias("weight"))
    events = event(citations, "citation").unionByName(event(mentions, "mention")).join(asked, "dataset_id", "left_semi")
    return index_series(year_factors(known, factors, "subfield_id"), events, this_year, ("ft", "ctw", "mtw"))


def creators(metrics: DataFrame) -> DataFrame:
    """dataset_id, creator_name, name_type, affiliations and primary_identifier of each creator of each dataset."""
    c = F.col("c")
    each = metrics.select("dataset_id", F.explode("creators").alias("c"))
    return each.select("dataset_id", c["name"].alias("creator_name"), c["name_type"].alias("name_type"), c["affiliations"].alias("affiliations"), creator_identifier(F.get(c["identifiers"], F.lit(0))).alias("primary_identifier"))


def author_key(null_affiliation: str = "reference") -> Column:
    """The identifier, or else name and sorted affiliations.

    A creator without both identifier and affiliations has no key; all of them form one group ("reference"), or are told
    apart by name ("split").
    """
    parts = F.array_join(F.array_sort(F.transform("affils", lambda x: F.lower(x))), ", ")
    parts = F.coalesce(parts, F.lit("")) if null_affiliation == "split" else parts
    return F.coalesce(F.col("primary_identifier"), F.concat(F.lower("clean_name"), F.lit("_["), parts, F.lit("]")))


#: What an author's most frequent value is taken of, and under which name.
AUTHOR_MODES = {"clean_name": "display_name", "name_type": "name_type", "topic_id": "primary_topic_id", "topic_name": "primary_topic_name", "subfield_id": "primary_subfield_id", "subfield_name": "primary_subfield_name"}
AUTHOR_SUMS = {
    "dataset_index_topic": "S_index_topics", "dataset_index_subfield": "S_index_subfield", "total_cit_weight": "total_cit_weight", "total_men_weight": "total_men_weight",
    "total_citations": "sum_total_citations", "total_mentions": "sum_total_mentions",
}
AUTHOR_MEANS = {"dataset_index_topic": "avg_dataset_index_topics", "dataset_index_subfield": "avg_dataset_index_subfield", "fair_score": "avg_fair_score"}


def author_index(creator_rows: DataFrame, index: DataFrame, null_affiliation: str = "reference") -> DataFrame:
    """One row for each author: identity, field, years, sums of indices and of metrics.

    An author's rows fold twice: by author, column and value to counts, beside one row of sums and extremes, and those by
    author to the most frequent value (of several, the least) of each column. Both steps combine before they shuffle, so
    that an author of a third of all rows, such as all creators without identifier and affiliation, isn't gathered.
    """
    rows = creator_rows.join(index.drop("creators"), "dataset_id")
    rows = rows.withColumns({"clean_name": F.trim("creator_name"), "affils": affiliation_list(F.to_json("affiliations"))}).withColumn("gid", author_key(null_affiliation))
    rows = rows.filter("primary_identifier is not null or clean_name is not null")
    # Each row gives its values and, as value null of column '', what is summed.
    pair = lambda name, value: F.struct(F.lit(name).alias("of"), value.cast("string").alias("value"))
    own = [pair("", F.lit(None)), *[pair(c, F.col(c)) for c in AUTHOR_MODES]]
    affils = F.transform(F.coalesce(F.col("affils"), F.array().cast("array<string>")), lambda x: pair("affils", x))
    measures = [*dict.fromkeys([*AUTHOR_SUMS, *AUTHOR_MEANS])]
    each = rows.select("gid", F.explode(F.concat(F.array(*own), affils)).alias("p"), "primary_identifier", "pubyear", *measures).filter("p.of = '' or p.value is not null")
    only = lambda c: F.when(F.col("p.of") == "", F.col(c))
    folded = each.groupBy("gid", F.col("p.of").alias("of"), F.col("p.value").alias("value")).agg(
        F.count("*").alias("n"), F.max(only("primary_identifier")).alias("identifier"), F.min(only("pubyear")).alias("first_year"), F.max(only("pubyear")).alias("last_year"),
        *[F.sum(only(c)).alias(f"sum_{c}") for c in measures], *[F.count(only(c)).alias(f"n_{c}") for c in AUTHOR_MEANS],
    )
    of = lambda name: F.col("of") == name
    top = lambda c: F.min(F.when(of(c), F.struct(-F.col("n"), F.col("value").alias("value"))))["value"]
    distinct = lambda c: F.count(F.when(of(c), F.lit(1)))
    mean = lambda c: F.try_divide(F.sum(f"sum_{c}"), F.sum(f"n_{c}"))
    return folded.groupBy(F.col("gid").alias("distinct_group_id")).agg(
        F.when(F.max("identifier").isNotNull(), "identifier").otherwise("name_affiliation").alias("grouping_method"), top("clean_name").alias("display_name"), F.max("identifier").alias("primary_identifier"),
        F.array_sort(F.collect_list(F.when(of("affils"), F.col("value")))).alias("all_affiliations"),
        *[top(c).alias(name) for c, name in AUTHOR_MODES.items() if c != "clean_name"],
        distinct("topic_id").alias("n_unique_topics"), distinct("subfield_id").alias("n_unique_subfields"), F.min("first_year").alias("first_pub_year"), F.max("last_year").alias("last_pub_year"),
        F.sum(F.when(of(""), F.col("n"))).alias("n_datasets"),
        *[F.sum(f"sum_{c}").alias(name) for c, name in AUTHOR_SUMS.items()], *[mean(c).alias(name) for c, name in AUTHOR_MEANS.items()],
    )


#: Fixed value: the name of an account that stands for no person.
NOBODY = "GBIF.Org User"


def people_only(authors: DataFrame) -> DataFrame:
    """Without organisations and unknown names; by three-valued logic also without all that have no kind of name."""
    return authors.filter(f"not (name_type = 'Organizational' or display_name = '{NOBODY}')")


def ranked(authors: DataFrame) -> DataFrame:
    return authors.orderBy(F.desc_nulls_last("S_index_topics"))


def index_series(datasets: DataFrame, events: DataFrame, this_year: int, thresholds: tuple = (FAIR_THRESHOLD, CITATION_THRESHOLD, MENTION_THRESHOLD)) -> DataFrame:
    """dataset_id, position, year and dataset_index for the year of publication and every other year with evidence.

    thresholds: of the score, citations and mentions; numbers, or names of columns of the datasets.

    The first row is that of publication; what was cited before is in it already, so that earlier years, which follow,
    repeat its value. datasets: dataset_id, pubyear, fair_score. events: dataset_id, kind, year, weight.
    """
    sums = events.groupBy("dataset_id", F.coalesce("year", F.lit(this_year)).alias("year")).agg(*[F.sum(F.when(F.col("kind") == k, F.coalesce("weight", F.lit(0.0))).otherwise(0.0)).alias(k) for k in ("citation", "mention")])
    starts = datasets.select("dataset_id", F.col("pubyear").alias("year"), F.lit(0.0).alias("citation"), F.lit(0.0).alias("mention")).filter("year is not null")
    known = datasets.select("dataset_id").join(sums.select("dataset_id").unionAll(starts.select("dataset_id")), "dataset_id", "left_anti")
    bare = known.select("dataset_id", F.lit(this_year).alias("year"), F.lit(0.0).alias("citation"), F.lit(0.0).alias("mention"))
    years = sums.unionByName(starts).unionByName(bare).groupBy("dataset_id", "year").agg(F.sum("citation").alias("citation"), F.sum("mention").alias("mention"))
    rows = years.join(datasets.select("dataset_id", "pubyear", "fair_score", *[t for t in thresholds if isinstance(t, str)]), "dataset_id")
    own = Window.partitionBy("dataset_id")
    upto = own.orderBy("year").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = lambda c: F.sum(F.when(F.col("year") <= F.col("pubyear"), F.col(c)).otherwise(0.0)).over(own)
    total = lambda c: F.when(F.col("year") <= F.col("pubyear"), first(c)).otherwise(F.sum(c).over(upto))
    ft, ct, mt = (F.col(t) if isinstance(t, str) else F.lit(t) for t in thresholds)
    value = (F.coalesce("fair_score", F.lit(0.0)) / ft + total("citation") / ct + total("mention") / mt) / 3.0
    place = F.row_number().over(own.orderBy(F.coalesce(F.col("year") != F.col("pubyear"), F.lit(True)), "year"))
    return rows.select("dataset_id", place.alias("position"), "year", value.alias("dataset_index"))
