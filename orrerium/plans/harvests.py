"""From harvested records to slim records, datasets, citations and mentions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, ids, text
from ..operators.incremental import new_rows
from ..operators.merge import dedupe_by_link
from .evidence import with_placeholders, with_weight


def _filled(c: Column) -> Column:
    """Null for an empty text."""
    return F.when(c != "", c)


def _some(c: Column) -> Column:
    """Null for an empty array."""
    return F.when(F.size(c) > 0, c)


def _distinct_by(array: Column, key) -> Column:
    """Members whose key stands for the first time, in order."""
    keys = F.transform(array, key)
    return F.filter(array, lambda x, i: F.array_position(keys, key(x)) == i + 1)


def _rights(r: Column) -> Column:
    part = lambda name: _filled(ids.stripped(r[name]))
    return F.struct(part("rights").alias("rights"), part("rightsUri").alias("rights_uri"), part("rightsIdentifier").alias("rights_identifier"), part("schemeUri").alias("scheme_uri"))


def _affiliations(json: Column) -> Column:
    """Names from JSON text of a name, or an array of names or of structs with a name."""
    names = F.from_json(json, "array<string>")
    name = lambda x: F.coalesce(F.when(x.startswith("{"), F.get_json_object(x, "$.name")).otherwise(x), F.lit(""))
    many = F.filter(F.transform(names, name), lambda x: x != "")
    return F.when(json.startswith("["), _some(many)).when(json != "", F.array(F.regexp_replace(json, '^"|"$', "")))


def slim_datacite(raw: DataFrame, this_year: int) -> DataFrame:
    """The fields of a record that the metrics need, cleaned; what is empty is null."""
    a = F.col("attributes")
    doi = ids.norm_doi(a["doi"])
    subjects = F.array_distinct(F.filter(F.transform(a["subjects"], lambda s: ids.stripped(s["subject"])), lambda s: s != ""))
    abstract = F.get(F.filter(a["descriptions"], lambda d: F.lower(d["descriptionType"]) == "abstract"), F.lit(0))["description"]
    rights = F.filter(F.transform(a["rightsList"], _rights), lambda r: F.coalesce(r["rights"], r["rights_uri"], r["rights_identifier"], r["scheme_uri"]).isNotNull())
    right_key = lambda r: F.coalesce(F.concat(F.lit("i:"), r["rights_identifier"]), F.to_json(r))
    dated = lambda kind: F.try_element_at(F.filter(a["dates"], lambda d: (d["dateType"] == kind) & (d["date"] != "")), F.lit(-1))["date"]
    creators = F.transform(
        a["creators"],
        lambda c: F.struct(
            _filled(c["name"]).alias("name"), _filled(c["nameType"]).alias("name_type"),
            _some(F.filter(F.transform(c["nameIdentifiers"], lambda i: i["nameIdentifier"]), lambda i: F.coalesce(i, F.lit("")) != "")).alias("identifiers"), _affiliations(c["affiliation"]).alias("affiliations"),
        ),
    )
    creators = F.filter(creators, lambda c: F.coalesce(c["name"], c["name_type"], F.to_json(c["identifiers"]), F.to_json(c["affiliations"])).isNotNull())
    links = F.filter(F.transform(F.col("relationships.citations.data"), lambda x: F.struct(F.trim(x["id"]).alias("id"), F.trim(x["type"]).alias("type"))), lambda x: x["id"] != "")
    is_doi = lambda x: F.lower(F.coalesce(x["type"], F.lit(""))) == "dois"
    dois = _some(F.array_distinct(F.filter(F.transform(F.filter(links, is_doi), lambda x: ids.norm_doi(x["id"])), lambda x: x != "")))
    other = _some(F.array_distinct(F.filter(links, lambda x: ~is_doi(x))))
    out = raw.select(
        F.lit("datacite").alias("source"), F.when(doi != "", F.array(F.struct(doi.alias("identifier"), F.lit("doi").alias("identifier_type")))).otherwise(F.array().cast("array<struct<identifier:string,identifier_type:string>>")).alias("identifiers"),
        _filled(a["url"]).alias("url"), _filled(F.get(a["titles"], F.lit(0))["title"]).alias("title"), _some(subjects).alias("subjects"), _filled(ids.stripped(abstract)).alias("description"), _filled(a["version"]).alias("version"),
        _filled(a["publisher"]).alias("publisher"), _filled(F.col("relationships.client.data.id")).alias("publisher_id"), _some(_distinct_by(rights, right_key)).alias("rights"), _filled(a["created"]).alias("doi_created_date"),
        dated("Issued").alias("issued"), dated("Created").alias("created"), _filled(a["published"]).alias("published"), a["publicationYear"].alias("publication_year"), _some(creators).alias("creators"),
        F.when(dois.isNotNull() | other.isNotNull(), F.struct(dois.alias("dois"), other.alias("other"))).alias("citations"),
    )
    out = out.withColumn("pubyear", dates.first_year(this_year, "publication_year", "published", "doi_created_date", "created", "issued"))
    return out.withColumn("publication_date", F.concat(F.lpad(F.col("pubyear").cast("string"), 4, "0"), F.lit("-01-01T00:00:00")))


def slim_emdb(raw: DataFrame, this_year: int) -> DataFrame:
    """The same fields of an EMDB record; a person's ORCID is that of the first author of equal name in the primary citation."""
    orcid = lambda name: ids.norm_orcid(F.get(F.filter(F.col("primary_citation.authors"), lambda p: p["valueOf_"] == name), F.lit(0))["ORCID"])
    day = dates.norm_date_iso("deposition_date")
    creators = F.transform("authors", lambda a: F.struct(a["valueOf_"].alias("name"), F.lit("Personal").alias("name_type"), F.when(orcid(a["valueOf_"]).isNotNull(), F.array(orcid(a["valueOf_"]))).alias("identifiers"), F.lit(None).cast("array<string>").alias("affiliations")))
    return raw.select(
        F.lit("emdb").alias("source"), F.array(F.struct(F.col("emdb_id").alias("identifier"), F.lit("emdb_id").alias("identifier_type"))).alias("identifiers"), F.concat(F.lit("https://www.ebi.ac.uk/emdb/"), "emdb_id").alias("url"),
        _filled(F.col("title")).alias("title"), F.transform(F.split("keywords", ","), lambda x: F.trim(x)).alias("subjects"), day.alias("publication_date"), dates.leading_year(day, this_year).alias("pubyear"), _some(creators).alias("creators"),
        F.lit("The Electron Microscopy Data Bank (EMDB)").alias("publisher"), F.lit("emdb").alias("publisher_id"),
    )


def incoming_datasets(slim: DataFrame, kind: str, added: str) -> DataFrame:
    best = ids.preferred_identifier("identifiers", kind)
    out = slim.select(best["identifier"].alias("dataset_id"), best["identifier_type"].alias("id_type"), "pubyear", F.lit(added).cast("timestamp_ntz").alias("added_date"))
    return out.filter("dataset_id is not null")


def add_datasets(known: DataFrame, slim: DataFrame, kind: str, added: str) -> DataFrame:
    """Rows to append: datasets that aren't known yet. Copies within a load stay, as they do in the table."""
    return new_rows(incoming_datasets(slim, kind, added), known, ["dataset_id"])


def citation_blocks(slim: DataFrame) -> DataFrame:
    return slim.filter("citations is not null").select(ids.preferred_identifier("identifiers", "doi")["identifier"].alias("dataset_id"), "pubyear", "citations")


def cited_dois(blocks: DataFrame) -> DataFrame:
    """Distinct DOIs of all citation blocks."""
    return blocks.select(F.explode("citations.dois").alias("raw")).select(ids.norm_doi("raw").alias("doi")).filter("doi <> ''").distinct()


def latest_dates(dois: DataFrame, published: DataFrame) -> DataFrame:
    """The last date, as text, of each DOI that the table of dates has."""
    return dois.join(published.select("doi", "pub_date"), "doi").groupBy("doi").agg(F.max("pub_date").alias("pub_date"))


def block_citations(blocks: DataFrame, published: DataFrame, today: str) -> DataFrame:
    """Citation records of blocks: DOIs with date, year and weight; other links with placeholders and weight 1."""
    this_year = int(today[:4])
    base = blocks.select(ids.norm_doi("dataset_id").alias("dataset_id"), F.when(dates.realistic_year("pubyear", this_year), F.col("pubyear")).alias("pubyear"), "citations").filter("dataset_id <> ''")
    dois = base.select("dataset_id", "pubyear", F.posexplode("citations.dois").alias("seq", "raw")).withColumn("doi", ids.norm_doi("raw")).filter("doi <> ''")
    known = published.select("doi", F.col("pub_date").alias("raw_date"))
    dois = dois.join(known, "doi", "left").withColumn("citation_date", dates.realistic_date(dates.norm_date_iso("raw_date"), today)).withColumn("citation_year", dates.leading_year("citation_date", this_year))
    dois = with_weight(dois, "citation").select("dataset_id", F.concat(F.lit(ids.DOI_URL), "doi").alias("citation_link"), "citation_weight", "citation_date", "citation_year", F.lit(0).alias("part"), "seq")
    other = base.select("dataset_id", F.posexplode("citations.other").alias("seq", "o")).select("dataset_id", F.trim("o.id").alias("citation_link"), F.lit(1.0).alias("citation_weight"), F.lit(None).cast("string").alias("citation_date"), F.lit(None).cast("int").alias("citation_year"), F.lit(1).alias("part"), "seq").filter("citation_link <> ''")
    rows = with_placeholders(dois.unionByName(other), "citation").withColumn("source", F.array(F.lit("datacite")))
    return dedupe_by_link(rows, "citation", ["part", "seq"]).drop("part", "seq")


def new_links(blocks: DataFrame, known: DataFrame) -> DataFrame:
    """Of each dataset's DOIs those that no known block has, sorted."""
    each = lambda df: df.select("dataset_id", F.explode("citations.dois").alias("doi"))
    fresh = new_rows(each(blocks).distinct(), each(known), ["dataset_id", "doi"])
    return fresh.groupBy("dataset_id").agg(F.array_sort(F.collect_set("doi")).alias("dois"))


def new_others(blocks: DataFrame, known: DataFrame) -> DataFrame:
    """Of each dataset's other links the ids that no known block has, sorted."""
    each = lambda df: df.select("dataset_id", F.explode("citations.other").alias("o")).select("dataset_id", F.trim("o.id").alias("id"))
    fresh = new_rows(each(blocks).filter("id <> ''").distinct(), each(known), ["dataset_id", "id"])
    return fresh.groupBy("dataset_id").agg(F.array_sort(F.collect_set("id")).alias("others"))


def citing_works(works: DataFrame, today: str) -> DataFrame:
    """Citations from citing works: dataset_id, pubyear, id, doi, publication_date and publication_year of each.

    A date that isn't realistic gives way to the year; without both there are placeholders. Works without DOI and id go.
    """
    this_year = int(today[:4])
    link = F.coalesce(F.when(ids.norm_doi("doi") != "", ids.norm_doi_url("doi")), _filled(F.col("id")))
    dated = lambda c: dates.realistic_date(dates.norm_date_iso(c), today)
    rows = works.withColumns({"citation_link": link, "citation_date": F.coalesce(dated("publication_date"), dated(F.col("publication_year").cast("string")))})
    rows = rows.withColumn("citation_year", dates.leading_year("citation_date", this_year)).filter("citation_link is not null")
    rows = with_placeholders(with_weight(rows, "citation"), "citation").withColumn("source", F.array(F.lit("openalex")))
    keep = ["dataset_id", "citation_link", "citation_weight", "citation_date", "placeholder_date", "citation_year", "placeholder_year", "source", "id"]
    return dedupe_by_link(rows.select(*keep), "citation", ["id"]).drop("id")


def fair_report() -> list[Column]:
    """The columns of an assessment's report that are kept, from its response; an instant is normalised."""
    return [
        F.col("summary.score_percent.FAIR").alias("fair_score"), dates.norm_date_iso("end_timestamp").alias("evaluation_date"),
        F.col("metric_version").alias("fuji_metric_version"), F.col("software_version").alias("fuji_software_version"),
    ]


def corpus_index(records: DataFrame) -> DataFrame:
    """One row for each dataset and publication of a citation corpus; each column is the least of its values."""
    day = dates.norm_date_iso("publishedDate")
    rows = records.filter("dataset is not null and publication is not null").select(
        ids.norm_dataset_id("dataset").alias("dataset_norm"), ids.doi_url_or_raw("publication").alias("citation_link"), day.alias("citation_date"), F.year(dates.try_date(day)).alias("citation_year")
    )
    return rows.filter("citation_link <> ''").groupBy("dataset_norm", "citation_link").agg(F.min("citation_date").alias("citation_date"), F.min("citation_year").alias("citation_year"))


def corpus_citations(index: DataFrame, datasets: DataFrame, this_year: int) -> DataFrame:
    """Citations of datasets by the corpus. Ids keep their own writing; weight before placeholders."""
    hit = datasets.withColumn("dataset_norm", ids.norm_dataset_id("dataset_id")).join(index, "dataset_norm").drop("dataset_norm")
    hit = hit.withColumn("citation_year", F.when(dates.realistic_year("citation_year", this_year), F.col("citation_year")))
    return with_placeholders(with_weight(hit, "citation"), "citation").withColumn("source", F.array(F.lit("mdc"))).drop("pubyear")


def _mentions(rows: DataFrame, datasets: DataFrame, today: str) -> DataFrame:
    """rows: key, mention_link, raw_date, raw_year, source."""
    hit = rows.join(datasets.select(F.col("dataset_id"), "pubyear"), rows["key"] == F.col("dataset_id"))
    hit = hit.withColumns({"mention_date": dates.realistic_date(dates.norm_date_iso("raw_date"), today), "mention_year": F.when(dates.realistic_year("raw_year", int(today[:4])), F.col("raw_year"))})
    out = with_placeholders(with_weight(hit, "mention"), "mention")
    return out.select("dataset_id", "source", "mention_link", "mention_weight", "mention_date", "placeholder_date", "mention_year", "placeholder_year")


def model_card_mentions(scans: DataFrame, datasets: DataFrame, today: str) -> DataFrame:
    each = scans.select("url", "created_at", F.explode("references").alias("r")).filter("r.id is not null")
    return _mentions(each.select(ids.norm_dataset_id("r.id").alias("key"), F.col("url").alias("mention_link"), F.col("created_at").alias("raw_date"), F.year(dates.try_date("created_at")).alias("raw_year"), F.array(F.lit("hf")).alias("source")), datasets, today)


def archive_mentions(rows: DataFrame, datasets: DataFrame, today: str) -> DataFrame:
    return _mentions(rows.select(ids.norm_dataset_id("dataset_id").alias("key"), "mention_link", F.col("mention_date").alias("raw_date"), F.year(dates.try_date("mention_date")).alias("raw_year"), F.array("source").alias("source")), datasets, today)


def patent_mentions(patents: DataFrame, datasets: DataFrame, today: str) -> DataFrame:
    each = patents.select("mention_link", "mention_date", F.explode("doi").alias("key")).unionAll(patents.select("mention_link", "mention_date", F.explode("emdb_id").alias("key")))
    return _mentions(each.select("key", "mention_link", F.col("mention_date").alias("raw_date"), dates.leading_year("mention_date", int(today[:4])).alias("raw_year"), F.array(F.lit("uspto")).alias("source")), datasets, today)


def code_search_mentions(items: DataFrame, dataset_id: str) -> DataFrame:
    """One mention for each repository that isn't a fork and whose root README was found. items: repo, fork, path, created_at."""
    rows = items.filter(~F.col("fork") & text.is_root_readme("path"))
    return rows.groupBy("repo").agg(F.min("created_at").alias("mention_date")).select(F.lit(dataset_id).alias("dataset_id"), F.concat(F.lit("https://github.com/"), "repo").alias("mention_link"), "mention_date", F.array(F.lit("github")).alias("source"))


#: Names of a repository's README and main branches, as bytes.
README_NAMES, MAIN_BRANCHES = ("README.md", "readme.md", "README", "README.txt"), ("refs/heads/main", "refs/heads/master")


def readme_contents(origin: DataFrame, status: DataFrame, branch: DataFrame, revision: DataFrame, entry: DataFrame, content: DataFrame, prefix: str = "https://github.com/") -> DataFrame:
    """Of each repository under a prefix the README's content of the last visit.

    Of a directory, and of a snapshot, only the greatest README can be the answer: files fold to one for each directory
    and then for each snapshot before visits meet them, so that no visit is paired with all branches of its snapshot.
    """
    named = lambda names: F.col("name").isin(*[bytearray(n.encode()) for n in names])
    ours = lambda c: F.col(c).startswith(prefix)
    files = entry.filter((F.col("type") == "file") & named(README_NAMES)).select("directory_id", F.col("target").alias("sha1_git"))
    found = _greatest(files.join(content.select("sha1_git", "sha1"), "sha1_git"), "directory_id", "sha1_git", "sha1")
    heads = branch.filter((F.col("target_type") == "revision") & named(MAIN_BRANCHES)).select("snapshot_id", F.col("target").alias("revision_id"))
    roots = heads.join(revision.select(F.col("id").alias("revision_id"), F.col("directory").alias("directory_id")), "revision_id")
    best = _greatest(roots.join(_dealt(found), "directory_id"), "snapshot_id", "sha1_git", "sha1")
    visits = status.filter(F.col("snapshot").isNotNull() & ours("origin")).select(F.col("origin").alias("url"), F.col("date").alias("visit_date"), F.col("snapshot").alias("snapshot_id"))
    # the origins come last: their join finds the rows dealt by url already, and one that is listed twice adds none
    return latest_per_url(visits.join(_dealt(best), "snapshot_id")).join(origin.filter(ours("url")).select("url"), "url", "left_semi")


def _greatest(rows: DataFrame, key: str, *columns: str) -> DataFrame:
    """Of each key the row whose columns, compared in turn, are the greatest."""
    return rows.groupBy(key).agg(F.max(F.struct(*columns)).alias("r")).select(key, "r.*")


def _dealt(folded: DataFrame) -> DataFrame:
    """A grouped side that its join shuffles anew: only then can run-time planning split what is frequent on the other side."""
    return folded.hint("rebalance")


def latest_per_url(rows: DataFrame) -> DataFrame:
    return _greatest(rows, "url", "visit_date", "sha1_git", "sha1")


def readme_mentions(readmes: DataFrame) -> DataFrame:
    """repo_link, repo_creation_date, dois_mentioned and emd_ids of READMEs that mention any."""
    out = readmes.select(F.col("url").alias("repo_link"), F.substring_index(F.col("date").cast("string"), " ", 1).alias("repo_creation_date"), text.readme_dois("content").alias("dois_mentioned"), text.readme_emdb("content").alias("emd_ids"))
    return out.filter((F.size("dois_mentioned") > 0) | (F.size("emd_ids") > 0))


def works_metadata(works: DataFrame) -> DataFrame:
    return works.select(
        ids.last_segment("id").alias("oa_id"), ids.norm_doi("doi").alias("doi"), F.coalesce(F.when(F.col("publication_date") != "", F.col("publication_date")), F.col("publication_year").cast("string")).alias("pub_date"),
        ids.last_segment("primary_topic.id").alias("topic_id"), F.col("primary_topic.display_name").alias("topic_name"), F.col("primary_topic.score").alias("topic_score"),
    )


def works_citations(works: DataFrame) -> DataFrame:
    each = works.select("id", F.explode("referenced_works").alias("cited"))
    return each.select(ids.last_segment("id").alias("citing_oa_id"), ids.last_segment("cited").alias("cited_oa_id"))


def resolved_links(links: DataFrame, works: DataFrame, datasets: DataFrame) -> DataFrame:
    """Links (citing_oa_id, dataset_id) with the citing work's DOI and date and the dataset's year; weights and placeholders."""
    out = links.join(works.select(F.col("oa_id").alias("citing_oa_id"), "doi", "pub_date"), "citing_oa_id", "left").join(datasets.select("dataset_id", "pubyear"), "dataset_id", "left")
    link = F.when(F.coalesce("doi", F.lit("")) != "", F.concat(F.lit(ids.DOI_URL), "doi")).otherwise(F.concat(F.lit("https://openalex.org/"), "citing_oa_id"))
    out = out.withColumns({"citation_link": link, "citation_date": F.col("pub_date"), "citation_year": F.year(dates.try_date("pub_date"))})
    return with_placeholders(with_weight(out, "citation"), "citation").select("dataset_id", F.array(F.lit("openalex")).alias("source"), "citation_link", "citation_weight", "citation_date", "placeholder_date", "citation_year", "placeholder_year")


def search_documents(datasets: DataFrame, authors: DataFrame, identifiers: DataFrame) -> DataFrame:
    """One nested document for each dataset."""
    a = authors.groupBy("dataset_id").agg(F.array_sort(F.collect_set("name")).alias("authors"))
    i = identifiers.groupBy("dataset_id").agg(F.array_sort(F.collect_set(F.struct("identifier_type", "identifier"))).alias("identifiers"))
    return datasets.join(a, "dataset_id", "left").join(i, "dataset_id", "left")


def frequencies(rows: DataFrame, column: str, missing: str) -> DataFrame:
    """value and n, most frequent first; trimmed, in lower case."""
    value = F.lower(F.trim(F.col(column)))
    return rows.select(F.when(value != "", value).otherwise(missing).alias("value")).groupBy("value").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value")
