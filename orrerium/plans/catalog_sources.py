"""Registered queries on harvested records, links and incremental loads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, ids, text
from ..operators import incremental, lookup
from ..operators.asof import asof_left_join
from . import evidence, harvests, metrics
from .catalog import SHARED, THIS_YEAR, TODAY, W, _r, query, with_views
from .views import table, view

RAW_ID = """case p_partkey % 7 when 0 then '  doi:10.5555/DS.' || cast(p_partkey as string) || ').' when 1 then 'see (https://dx.doi.org/10.5555/Ds.' || cast(p_partkey as string) || '/X).' when 2 then ' emd-' || cast(10000 + p_partkey % 9000 as string) || ' '
    when 3 then ' SQ' || cast(p_partkey as string) || ' ' when 4 then '10.5555/a%2Fb' || cast(p_partkey as string) when 5 then '10.123/x' || cast(p_partkey as string) end"""
DOI_SQL = r"""coalesce(regexp_replace(regexp_extract(lower(url_decode(replace(trim({0}), '+', '%2B'))), '10\.[0-9]{{4,9}}/[^\s"''<>\]]+'), '[.,;:)\]]+$', ''), '')"""


def _sql(spark: SparkSession, d: str, text_: str, *tables: str) -> DataFrame:
    return spark.sql(text_, **{t: table(spark, d, t) for t in tables})


@query(f"""with r as (select p_partkey, {RAW_ID} as raw from part), n as (select *, {DOI_SQL.format('raw')} as doi, coalesce(upper(regexp_extract(raw, '(?i)EMD-[0-9]{{4,5}}')), '') as emdb from r)
    select p_partkey, doi, case when doi <> '' then 'https://doi.org/' || doi else '' end as doi_url, emdb, case when doi <> '' then doi when emdb <> '' then emdb else coalesce(lower(trim(raw)), '') end as dataset_id from n""")
def norm_ids(spark: SparkSession, d: str) -> DataFrame:
    rows = _sql(spark, d, f"select p_partkey, {RAW_ID} as raw from {{part}}", "part")
    return rows.select("p_partkey", ids.norm_doi("raw").alias("doi"), ids.norm_doi_url("raw").alias("doi_url"), ids.norm_emdb("raw").alias("emdb"), ids.norm_dataset_id("raw").alias("dataset_id"))


DAY = "cast(cast(o_orderdate as date) as string)"
RAW_DATE = f"""case o_orderkey % 8 when 0 then substr({DAY}, 1, 4) when 1 then substr({DAY}, 1, 7) when 2 then replace({DAY}, '-', '') when 3 then {DAY} when 4 then {DAY} || 'T13:22:55Z' when 5 then replace({DAY}, '-', '/') when 6 then substr({DAY}, 1, 4) || '-4-43' else {DAY} || 'T01:02:03+02:00' end"""


@query(f"""select o_orderkey, case o_orderkey % 8 when 0 then substr({DAY}, 1, 4) || '-01-01T00:00:00' when 1 then substr({DAY}, 1, 7) || '-01T00:00:00' when 4 then {DAY} || 'T13:22:55+00:00' when 6 then null when 7 then {DAY} || 'T01:02:03+02:00' else {DAY} || 'T00:00:00' end as iso,
    case when o_orderkey % 8 = 3 then cast(o_orderdate as date) end as strict, case when o_orderkey % 8 in (3, 4, 5, 7) then cast(o_orderdate as date) end as cast_date, case when o_orderkey % 8 <> 6 and year(o_orderdate) <= 1998 then cast(year(o_orderdate) as int) end as realistic from orders""")
def norm_dates(spark: SparkSession, d: str) -> DataFrame:
    rows = _sql(spark, d, f"select o_orderkey, {RAW_DATE} as raw from {{orders}}", "orders").withColumn("iso", dates.norm_date_iso("raw"))
    return rows.select("o_orderkey", "iso", dates.strict_date("raw").alias("strict"), dates.try_date("raw").alias("cast_date"), dates.leading_year(dates.realistic_date("iso", "1998-12-31"), 1998).alias("realistic"))


FREE = "'See 10.5555/DS.' || cast(p_partkey as string) || '. Also EMD-' || cast(1000 + p_partkey % 90000 as string) || ', emd-1234 and (doi:10.5555/x_' || cast(p_partkey % 10 as string) || ').' || case when p_partkey % 4 = 0 then ' again 10.5555/ds.' || cast(p_partkey as string) else '' end"


@query(rf"""with t as (select p_partkey, {FREE} as t from part) select p_partkey, array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(t, '(?i)10\.[0-9]{{4,9}}/[-._;()/:a-z0-9]+'), lambda x: regexp_replace(lower(x), '[.,]+$', '')))), ' ') as dois,
    array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(t, '(?i)\bEMD-[0-9]{{4,5}}\b'), lambda x: upper(x)))), ' ') as emdb from t""")
def extracted_mentions(spark: SparkSession, d: str) -> DataFrame:
    rows = _sql(spark, d, f"select p_partkey, {FREE} as t from {{part}}", "part")
    return rows.select("p_partkey", F.array_join(text.dois_in("t"), " ").alias("dois"), F.array_join(text.emdb_in("t"), " ").alias("emdb"))


README = "'[paper](https://doi.org/10.5555/(DS)' || cast(p_partkey as string) || ') DOI: 10.5555/b.' || cast(p_partkey as string) || '; http://dx.doi.org/10.5555/c' || cast(p_partkey as string) || ', EMD-' || cast(10000 + p_partkey % 90000 as string)"


@query("select p_partkey, '10.5555/(DS)' || cast(p_partkey as varchar) || ' 10.5555/b.' || cast(p_partkey as varchar) || ' 10.5555/c' || cast(p_partkey as varchar) as dois, 'EMD-' || cast(10000 + p_partkey % 90000 as varchar) as emdb from part")
def readme_mentions(spark: SparkSession, d: str) -> DataFrame:
    rows = _sql(spark, d, f"select p_partkey, {README} as t from {{part}}", "part")
    return rows.select("p_partkey", F.array_join(text.readme_dois("t"), " ").alias("dois"), F.array_join(text.readme_emdb("t"), " ").alias("emdb"))


@query("""select p_partkey, case p_partkey % 5 when 0 then '10.5555/ab.' || cast(p_partkey as varchar) when 1 then '10.1101/x' || cast(p_partkey as varchar) when 2 then '10.5555/a' || cast(p_partkey as varchar) || '/b' when 3 then '10.5555/(q)' || cast(p_partkey as varchar) end as doi from part""")
def readme_dois_cleaned(spark: SparkSession, d: str) -> DataFrame:
    raw = "case p_partkey % 5 when 0 then 'https://doi.org/10.5555/AB.' || cast(p_partkey as string) || '?x=1' when 1 then '10.1101/X' || cast(p_partkey as string) || '.full.pdf' when 2 then '10.5555/a' || cast(p_partkey as string) || '/b/references/figures' when 3 then '10.5555/(q)' || cast(p_partkey as string) || '))' else 'none here' end"
    return _sql(spark, d, f"select p_partkey, {raw} as raw from {{part}}", "part").select("p_partkey", text.readme_doi_cleaned("raw").alias("doi"))


@query(r"""select page_id, cast(len(regexp_extract_all(html, 'href="([^"]*)"', 1)) as int) as n_links, cast(len(list_filter(regexp_extract_all(html, 'href="([^"]*)"', 1), lambda x: regexp_matches(x, '(?i)^https?://[^/?#]+'))) as int) as n_urls, regexp_extract(url, '^https?://([^/?#:]+)', 1) as host from pages""")
def page_links(spark: SparkSession, d: str) -> DataFrame:
    links = F.regexp_extract_all("html", F.lit(r'href="([^"]*)"'), F.lit(1))
    return table(spark, d, "pages").select("page_id", F.size(links).alias("n_links"), F.size(F.filter(links, ids.is_url)).alias("n_urls"), F.try_parse_url("url", F.lit("HOST")).alias("host"))


@query(with_views(last="select dataset_id, case when source = 'emdb' then 'emdb_id' else 'doi' end as id_type, pubyear from v_metadata m where not exists (select 1 from v_known k where k.dataset_id = m.dataset_id)"))
def new_datasets(spark: SparkSession, d: str) -> DataFrame:
    kind = F.when(F.col("source") == "emdb", "emdb_id").otherwise("doi")
    slim = view(spark, d, "v_metadata").select(F.array(F.struct(F.lit(None).cast("string").alias("identifier"), F.lit("other").alias("identifier_type")), F.struct(F.col("dataset_id").alias("identifier"), kind.alias("identifier_type"))).alias("identifiers"), "pubyear")
    slim = slim.withColumn("identifiers", F.filter("identifiers", lambda x: x["identifier"].isNotNull()))
    return harvests.add_datasets(view(spark, d, "v_known"), slim, "doi", "2025-01-01 00:00:00").select("dataset_id", "id_type", "pubyear")


@query(with_views(last="select distinct citing_oa_id, k.dataset_id from v_edges e join v_known k on e.cited = k.dataset_id where file in ('part-0', 'part-1') or added_date >= date '2024-06-01'"))
def two_pass_links(spark: SparkSession, d: str) -> DataFrame:
    return incremental.two_pass(view(spark, d, "v_edges"), view(spark, d, "v_known"), "cited", "file", F.col("file").isin("part-0", "part-1"), F.col("added_date") >= F.lit("2024-06-01").cast("date")).select("citing_oa_id", "dataset_id").distinct()


@query(with_views(last="select oa_id, doi, topic_id, topic_score, file from (select *, rank() over (partition by doi order by folder_rank, file) as r from v_works where doi <> '') where r = 1"))
def winning_topics(spark: SparkSession, d: str) -> DataFrame:
    return incremental.winning_files(view(spark, d, "v_works").filter("doi <> ''"), "doi", "folder_rank", "file").select("oa_id", "doi", "topic_id", "topic_score", "file")


@query(with_views(last="select doi, max(topic_score) as topic_score, min(topic_id) as topic_id from (select *, rank() over (partition by doi order by topic_score desc) as r from v_works where doi <> '') where r = 1 group by doi"))
def best_topic_per_doi(spark: SparkSession, d: str) -> DataFrame:
    rows = view(spark, d, "v_works").filter("doi <> ''")
    return rows.groupBy("doi").agg(F.max_by(F.struct("topic_score", "topic_id"), F.struct(F.col("topic_score"), -F.substring("topic_id", 2, 10).cast("int"))).alias("b")).select("doi", "b.*")


@query(with_views(last=f"""select l.dataset_id, case when coalesce(doi, '') <> '' then 'https://doi.org/' || doi else 'https://openalex.org/' || citing_oa_id end as citation_link, {W.format('pubyear', 'y')} as citation_weight, coalesce(pub_date, '2026-01-01T00:00:00') as citation_date, pub_date is null as placeholder_date,
    cast(coalesce(y, 2026) as int) as citation_year, y is null as placeholder_year from (select citing_oa_id, dataset_id, pubyear from v_edges join v_known on cited = dataset_id) l left join (select *, case when length(pub_date) = 10 then cast(substr(pub_date, 1, 4) as int) end as y from v_works) w on w.oa_id = l.citing_oa_id"""))
def resolved_citations(spark: SparkSession, d: str) -> DataFrame:
    known = view(spark, d, "v_known")
    links = view(spark, d, "v_edges").join(known, F.col("cited") == F.col("dataset_id")).select("citing_oa_id", "dataset_id")
    return harvests.resolved_links(links, view(spark, d, "v_works"), known).drop("source")


@query(with_views(last="select doi, max(pub_date) as pub_date from v_works where doi <> '' group by doi having max(pub_date) is not null or count(*) > 0"))
def latest_publication_dates(spark: SparkSession, d: str) -> DataFrame:
    works = view(spark, d, "v_works").filter("doi <> ''")
    return harvests.latest_dates(works.select("doi").distinct(), works)


CORPUS = "select case l_linenumber % 3 when 0 then 'https://doi.org/10.5555/DS.' || cast(l_partkey as string) when 1 then ' emd-' || cast(10000 + l_partkey % 5000 as string) when 2 then case when l_orderkey % 10 = 0 then null else '10.5555/ds.' || cast(l_partkey as string) || '.' end end as dataset, case when l_orderkey % 6 = 0 then 'http://example.org/' || cast(l_orderkey as string) else 'https://doi.org/10.5555/PUB.' || cast(l_orderkey as string) end as publication, case when l_orderkey % 5 = 0 then null else cast(cast(l_shipdate as date) as string) || 'T00:00:00+00:00' end as \"publishedDate\" from lineitem"
CORPUS_SQL = f"""with r as ({CORPUS}), n as (select case when dataset like ' emd%' then upper(trim(dataset)) else {DOI_SQL.format('dataset')} end as dataset_norm, case when publication like '%doi.org%' then lower(publication) else publication end as citation_link, "publishedDate" as day from r where dataset is not null),
    c as (select dataset_norm, citation_link, min(day) as citation_date, cast(min(year(cast(substr(day, 1, 10) as date))) as int) as citation_year from n group by dataset_norm, citation_link) """


def _corpus(spark, d) -> DataFrame:
    return _sql(spark, d, CORPUS.replace('"publishedDate"', "publishedDate").replace("from lineitem", "from {lineitem}"), "lineitem")


@query(CORPUS_SQL + "select * from c")
def corpus_index(spark: SparkSession, d: str) -> DataFrame:
    return harvests.corpus_index(_corpus(spark, d))


@query("with " + with_views(last="select 1 from v_metadata").removeprefix("with ").rsplit("\n", 1)[0] + ", " + CORPUS_SQL.removeprefix("with ") + f"""select dataset_id, citation_link, {W.format('pubyear', 'citation_year')} as citation_weight, coalesce(citation_date, '2026-01-01T00:00:00') as citation_date, citation_date is null as placeholder_date, coalesce(citation_year, 2026) as citation_year, citation_year is null as placeholder_year
    from c join v_metadata on dataset_norm = dataset_id""")
def corpus_citations(spark: SparkSession, d: str) -> DataFrame:
    return harvests.corpus_citations(harvests.corpus_index(_corpus(spark, d)), view(spark, d, "v_metadata").select("dataset_id", "pubyear"), THIS_YEAR).drop("source")


LINES = "select '10.5555/ds.' || cast(l_partkey as string) as dataset_id, cast(case when l_partkey % 20 = 0 then 1066 else 1994 + l_partkey % 8 end as int) as pubyear, l_orderkey, l_linenumber from lineitem"
BLOCKS = LINES


def _blocks(spark, d) -> DataFrame:
    rows = _sql(spark, d, LINES.replace("from lineitem", "from {lineitem}"), "lineitem").distinct()
    doi = F.when(F.col("l_linenumber") <= 4, F.concat(F.lit("10.5555/PUB."), (F.col("l_orderkey") % 3000).cast("string")))
    other = F.when(F.col("l_linenumber") > 4, F.struct(F.concat(F.lit(" x:"), (F.col("l_orderkey") % 50).cast("string")).alias("id"), F.lit("url").alias("type")))
    return rows.groupBy("dataset_id", "pubyear").agg(F.struct(F.array_sort(F.collect_list(doi)).alias("dois"), F.array_sort(F.collect_list(other)).alias("other")).alias("citations"))


def _published(spark, d) -> DataFrame:
    return view(spark, d, "v_works").filter("doi <> '' and pub_date is not null").groupBy("doi").agg(F.max("pub_date").alias("pub_date"))


@query(with_views(last=f"""select distinct dataset_id, 'https://doi.org/' || b.doi as citation_link, {W.format('py', 'y')} as citation_weight, coalesce(p.iso, '2026-01-01T00:00:00') as citation_date, p.iso is null as placeholder_date, coalesce(y, 2026) as citation_year, y is null as placeholder_year
    from (select dataset_id, case when pubyear >= 1950 then pubyear end as py, '10.5555/pub.' || cast(l_orderkey % 3000 as varchar) as doi from ({BLOCKS}) where l_linenumber <= 4) b
    left join (select doi, case when length(d) = 4 then d || '-01-01T00:00:00' else d || 'T00:00:00' end as iso, cast(substr(d, 1, 4) as int) as y from (select doi, max(pub_date) as d from v_works where doi <> '' and pub_date is not null group by doi)) p on p.doi = b.doi
    union all select distinct dataset_id, 'x:' || cast(l_orderkey % 50 as varchar), 1.0, '2026-01-01T00:00:00', true, 2026, true from ({BLOCKS}) where l_linenumber > 4"""))
def block_citations(spark: SparkSession, d: str) -> DataFrame:
    return harvests.block_citations(_blocks(spark, d), _published(spark, d), TODAY).drop("source")


@query(f"select distinct '10.5555/pub.' || cast(l_orderkey % 3000 as varchar) as doi from ({BLOCKS}) where l_linenumber <= 4")
def cited_dois(spark: SparkSession, d: str) -> DataFrame:
    return harvests.cited_dois(_blocks(spark, d))


@query(f"""with b as (select distinct dataset_id, '10.5555/PUB.' || cast(l_orderkey % 3000 as varchar) as doi, l_orderkey % 3000 as k from ({BLOCKS}) where l_linenumber <= 4)
    select dataset_id, string_agg(doi, ' ' order by doi) as dois from b where k % 2 = 1 group by dataset_id""")
def new_block_links(spark: SparkSession, d: str) -> DataFrame:
    blocks = _blocks(spark, d)
    even = F.filter("citations.dois", lambda x: F.substring_index(x, ".", -1).cast("int") % 2 == 0)
    known = blocks.select("dataset_id", F.struct(even.alias("dois")).alias("citations"))
    return harvests.new_links(blocks, known).select("dataset_id", F.array_join("dois", " ").alias("dois"))


def _mention_sql(rows: str, source: str) -> str:
    return with_views(last=f"""select m.dataset_id, '{source}' as source, mention_link, {W.format('pubyear', 'y')} as mention_weight, coalesce(iso, '2026-01-01T00:00:00') as mention_date, iso is null as placeholder_date, coalesce(y, 2026) as mention_year, y is null as placeholder_year from ({rows}) r join v_metadata m on m.dataset_id = r.key""")


def _flat(df: DataFrame) -> DataFrame:
    return df.withColumn("source", F.array_join("source", ","))


@query(_mention_sql("select '10.5555/ds.' || cast((o_custkey * 3 + k) % 2000 as varchar) as key, 'https://patents.example/' || cast(o_orderkey as varchar) as mention_link, cast(cast(o_orderdate as date) as varchar) || 'T00:00:00' as iso, cast(year(o_orderdate) as int) as y from orders cross join (select 0 as k union all select 1)", "uspto"))
def patent_mentions(spark: SparkSession, d: str) -> DataFrame:
    rows = _sql(spark, d, "select o_orderkey as patent_id, 'https://patents.example/' || cast(o_orderkey as string) as mention_link, date_format(o_orderdate, 'yyyyMMdd') as mention_date, array('10.5555/ds.' || cast((o_custkey * 3) % 2000 as string)) as doi, array('10.5555/ds.' || cast((o_custkey * 3 + 1) % 2000 as string)) as emdb_id from {orders}", "orders")
    return _flat(harvests.patent_mentions(rows, view(spark, d, "v_metadata"), TODAY))


@query(_mention_sql("select '10.5555/ds.' || cast(o_custkey % 2000 as varchar) as key, 'https://models.example/' || cast(o_orderkey % 500 as varchar) as mention_link, case when o_orderkey % 4 = 0 then null else cast(cast(o_orderdate as date) as varchar) || 'T10:00:00+00:00' end as iso, case when o_orderkey % 4 = 0 then null else cast(year(o_orderdate) as int) end as y from orders", "hf"))
def model_card_mentions(spark: SparkSession, d: str) -> DataFrame:
    rows = _sql(spark, d, "select 'https://models.example/' || cast(o_orderkey % 500 as string) as url, case when o_orderkey % 4 = 0 then null else date_format(o_orderdate, 'yyyy-MM-dd') || 'T10:00:00Z' end as created_at, array(named_struct('id', 'https://doi.org/10.5555/DS.' || cast(o_custkey % 2000 as string)), named_struct('id', cast(null as string))) as references from {orders}", "orders")
    return _flat(harvests.model_card_mentions(rows, view(spark, d, "v_metadata"), TODAY))


@query(_mention_sql("select '10.5555/ds.' || cast(o_custkey % 2000 as varchar) as key, 'https://code.example/' || cast(o_orderkey as varchar) as mention_link, cast(cast(o_orderdate as date) as varchar) || 'T00:00:00' as iso, cast(year(o_orderdate) as int) as y from orders", "swh"))
def archive_mentions(spark: SparkSession, d: str) -> DataFrame:
    rows = _sql(spark, d, "select '10.5555/DS.' || cast(o_custkey % 2000 as string) as dataset_id, 'https://code.example/' || cast(o_orderkey as string) as mention_link, date_format(o_orderdate, 'yyyy-MM-dd') as mention_date, 'swh' as source from {orders}", "orders")
    return _flat(harvests.archive_mentions(rows, view(spark, d, "v_metadata"), TODAY))


@query("select 'D' as dataset_id, 'https://github.com/u/r' || cast(o_custkey as varchar) as mention_link, min(cast(cast(o_orderdate as date) as varchar)) as mention_date from orders where o_orderkey % 7 <> 0 and o_orderkey % 3 <> 2 group by o_custkey")
def code_search_mentions(spark: SparkSession, d: str) -> DataFrame:
    rows = _sql(spark, d, "select 'u/r' || cast(o_custkey as string) as repo, o_orderkey % 7 = 0 as fork, case o_orderkey % 3 when 0 then 'README.md' when 1 then 'readme' else 'docs/README.md' end as path, date_format(o_orderdate, 'yyyy-MM-dd') as created_at from {orders}", "orders")
    return harvests.code_search_mentions(rows, "D").drop("source")


GRAPH = {
    "origin": "select 'o' || cast(c_custkey as string) as id, case when c_custkey % 2 = 0 then 'https://github.com/u/' else 'https://gitlab.example/u/' end || cast(c_custkey as string) as url from customer",
    "status": "select case when o_custkey % 2 = 0 then 'https://github.com/u/' else 'https://gitlab.example/u/' end || cast(o_custkey as string) as origin, o_orderdate as date, case when o_orderkey % 9 = 0 then null else 's' || cast(o_orderkey % 1000 as string) end as snapshot from orders",
    "branch": "select 's' || cast(p_partkey % 1000 as string) as snapshot_id, {0} as name, 'r' || cast(p_partkey as string) as target, case when p_partkey % 10 = 0 then 'release' else 'revision' end as target_type from part",
    "revision": "select 'r' || cast(p_partkey as string) as id, 'd' || cast(p_partkey as string) as directory from part",
    "entry": "select 'd' || cast(p_partkey - p_partkey % 2 as string) as directory_id, {1} as name, 'c' || cast(p_partkey as string) as target, case when p_partkey % 8 = 0 then 'dir' else 'file' end as type from part",
    "content": "select 'c' || cast(p_partkey as string) as sha1_git, 'x' || cast(p_partkey as string) as sha1 from part",
}
BRANCH, FILE = "case p_partkey % 3 when 0 then 'refs/heads/main' when 1 then 'refs/heads/master' else 'refs/heads/dev' end", "case p_partkey % 4 when 0 then 'README.md' when 1 then 'README' when 2 then 'readme.md' else 'LICENSE' end"


@query("with " + ", ".join(f"g_{k} as ({v.format(BRANCH, FILE)})" for k, v in GRAPH.items()) + """, a as (select o.url, s.date as visit_date, e.target as sha1_git, c.sha1 from g_origin o join g_status s on s.origin = o.url join g_branch b on b.snapshot_id = s.snapshot and b.target_type = 'revision' and b.name in ('refs/heads/main', 'refs/heads/master')
    join g_revision r on r.id = b.target join g_entry e on e.directory_id = r.directory and e.type = 'file' and e.name <> 'LICENSE' join g_content c on c.sha1_git = e.target where o.url like 'https://github.com/%')
    select url, visit_date, sha1_git, sha1 from (select *, row_number() over (partition by url order by visit_date desc, sha1_git desc) as n from a) where n = 1""")
def readme_chain(spark: SparkSession, d: str) -> DataFrame:
    tables = ("customer", "orders", "part")
    frame = {}
    for k, v in GRAPH.items():
        body = v.format(f"cast({BRANCH} as binary)", f"cast({FILE} as binary)")
        used = next(t for t in tables if body.endswith(f"from {t}"))
        frame[k] = _sql(spark, d, body.removesuffix(used) + "{" + used + "}", used)
    return harvests.readme_contents(frame["origin"], frame["status"], frame["branch"], frame["revision"], frame["entry"], frame["content"])


@query("""select p_partkey, '10.5555/ds.' || cast(p_partkey as varchar) as doi, p_name as title, case when p_partkey % 2 = 0 then p_brand || '|x' else 'x' end as subjects, case when p_partkey % 3 = 0 then 'about' end as description, p_brand as publisher,
    case when p_partkey % 4 = 0 then cast(1994 + p_partkey % 8 as int) when p_partkey % 4 = 1 then 2001 when p_partkey % 4 = 2 then 1999 end as pubyear, 'A ' || p_brand || '/' || case when p_partkey % 2 = 0 then '0000-0001' else '' end || '/' || case when p_partkey % 5 = 0 then 'Uni, One' else 'Lab' end as creator,
    '10.5555/c' || cast(p_partkey as varchar) as cited, case when p_partkey % 2 = 1 then 'u1:url' else '' end as other, case when p_partkey % 2 = 0 then 2 else 1 end as n_rights from part""")
def slim_records(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    k, brand, even = F.col("p_partkey"), F.col("p_brand"), F.col("p_partkey") % 2 == 0
    s = lambda **cols: F.struct(*[c.alias(n) for n, c in cols.items()])
    text_ = lambda v: F.lit(v).cast("string")
    right = lambda i, t: s(rights=F.lit(t), rightsUri=text_(None), rightsIdentifier=F.lit(i).cast("string"), schemeUri=text_(""))
    attributes = s(
        doi=F.concat(F.lit(" 10.5555/DS."), k.cast("string")), url=text_(""), version=text_(None), publisher=brand, created=F.when(k % 4 == 2, "1999-05-05T00:00:00Z"), published=F.when(k % 4 == 1, "2001-02"),
        publicationYear=F.when(k % 4 == 0, (1994 + k % 8).cast("int")), titles=F.array(s(title=F.col("p_name")), s(title=text_("other"))), subjects=F.array(s(subject=F.when(even, brand)), s(subject=text_(" x ")), s(subject=text_("x")), s(subject=text_(""))),
        descriptions=F.array(s(descriptionType=text_("Methods"), description=text_("no")), s(descriptionType=text_("Abstract"), description=F.when(k % 3 == 0, " about ").otherwise(" "))), dates=F.array(s(dateType=text_("Issued"), date=text_("1066"))),
        rightsList=F.when(even, F.array(right("cc", "A"), right("cc", "B"), right(None, "C"), right(None, "C"))).otherwise(F.array(right("cc", "A"), right("cc", "A"))),
        creators=F.array(s(name=F.concat(F.lit("A "), brand), nameType=text_(""), affiliation=F.when(k % 5 == 0, F.lit('["Uni, One"]')).otherwise(F.lit('[{"name":"Lab"}]')), nameIdentifiers=F.array(s(nameIdentifier=F.when(even, "0000-0001")))), s(name=text_(""), nameType=text_(None), affiliation=text_("[]"), nameIdentifiers=F.array(s(nameIdentifier=text_(None))))),
    )
    links = F.array(s(id=F.concat(F.lit("10.5555/C"), k.cast("string")), type=text_("DOIs")), s(id=F.concat(F.lit("https://doi.org/10.5555/c"), k.cast("string")), type=text_("dois")), s(id=F.when(~even, "u1"), type=text_("url")), s(id=F.when(~even, " u1 "), type=text_("url")))
    raw = part.select(k, attributes.alias("attributes"), s(client=s(data=s(id=text_("c.x"))), citations=s(data=links)).alias("relationships"))
    out = harvests.slim_datacite(raw, THIS_YEAR).withColumn("doi", F.get("identifiers", F.lit(0))["identifier"])
    c = F.get("creators", F.lit(0))
    empty = lambda x: F.coalesce(x, F.lit(""))
    return out.select(
        F.substring_index("doi", ".", -1).cast("long").alias("p_partkey"), "doi", "title", F.array_join("subjects", "|").alias("subjects"), "description", "publisher", "pubyear",
        F.concat(c["name"], F.lit("/"), empty(F.array_join(c["identifiers"], "|")), F.lit("/"), empty(F.array_join(c["affiliations"], "|"))).alias("creator"), F.array_join("citations.dois", "|").alias("cited"),
        empty(F.array_join(F.transform("citations.other", lambda x: F.concat(x["id"], F.lit(":"), x["type"])), "|")).alias("other"), F.size("rights").alias("n_rights"),
    )


@query(with_views(last="""select d.dataset_id, coalesce(s.score, 42.31) as score, s.score is null as extrapolated from v_metadata d left join (select dataset_id, score from (select *, row_number() over (partition by dataset_id order by seq desc) as r from (select dataset_id, max(score) as score, seq from v_scores_all group by dataset_id, seq)) where r = 1) s on s.dataset_id = d.dataset_id"""))
def fair_extrapolated(spark: SparkSession, d: str) -> DataFrame:
    scores = view(spark, d, "v_scores_all").groupBy("dataset_id", "seq").agg(F.max("score").alias("score"))
    return evidence.extrapolated_fair(view(spark, d, "v_metadata"), scores)


@query(with_views(last="select t.dataset_id, t.topic_id, t.topic_name, case when m.k is not null then 'new ' || cast(m.k % 7 as varchar) else t.field_name end as field_name, 'kw' || cast(m.k as varchar) as keywords from v_oa_topics t left join (select distinct p_size as k from part where p_size % 2 = 0) m on 'T' || cast(10000 + m.k as varchar) = t.topic_id"))
def topics_enhanced(spark: SparkSession, d: str) -> DataFrame:
    mapping = _sql(spark, d, "select distinct ' T' || cast(10000 + p_size as string) as topic_id, case when c = 1 then 'new ' || cast(p_size % 7 as string) else 'old' end as field_name, case when c = 1 then 'kw' || cast(p_size as string) else 'none' end as keywords, c as seq from {part} cross join (select explode(array(0, 1)) as c) where p_size % 2 = 0", "part")
    return evidence.enhanced_topics(view(spark, d, "v_oa_topics"), mapping).select("dataset_id", "topic_id", "topic_name", "field_name", "keywords")


@query("select '10.5555/ds.' || cast(p_partkey as varchar) as dataset_id, 'T' || cast(10000 + p_size as varchar) as topic_id, p_name as topic_name, cast(p_partkey % 10 as double) as score, 'custom_model' as source, p_brand as subfield_id, cast(null as varchar) as field_name from part")
def topics_restructured(spark: SparkSession, d: str) -> DataFrame:
    nested = _sql(spark, d, "select '10.5555/ds.' || cast(p_partkey as string) as dataset_id, named_struct('id', cast(10000 + p_size as string), 'name', p_name, 'score', cast(p_partkey % 10 as double)) as topic, named_struct('id', p_brand, 'name', p_brand) as subfield, named_struct('id', 'f', 'name', cast(null as string)) as field, named_struct('id', 'd', 'name', 'd') as domain from {part}", "part")
    return evidence.flat_model_topics(nested).select("dataset_id", "topic_id", "topic_name", "score", "source", "subfield_id", "field_name")


@query(with_views(last="""select m.dataset_id, m.publisher, (select string_agg(n, '|' order by n) from (select distinct name as n from v_creators c where c.dataset_id = m.dataset_id)) as authors, 'doi=' || m.dataset_id || ',pk=' || replace(m.dataset_id, '10.5555/ds.', '') as identifiers from v_metadata m"""))
def search_documents(spark: SparkSession, d: str) -> DataFrame:
    m = view(spark, d, "v_metadata").select("dataset_id", "publisher")
    i = m.select("dataset_id", F.explode(F.array(F.struct(F.lit("doi").alias("identifier_type"), F.col("dataset_id").alias("identifier")), F.struct(F.lit("pk").alias("identifier_type"), F.substring_index("dataset_id", ".", -1).alias("identifier")))).alias("x")).select("dataset_id", "x.*")
    out = harvests.search_documents(m, view(spark, d, "v_creators").select("dataset_id", "name"), i)
    return out.select("dataset_id", "publisher", F.array_join("authors", "|").alias("authors"), F.array_join(F.transform("identifiers", lambda x: F.concat(x["identifier_type"], F.lit("="), x["identifier"])), ",").alias("identifiers"))


@query("select coalesce(lower(trim(p_brand)), 'unknown') as value, count(*) as n from part group by 1")
def publisher_counts(spark: SparkSession, d: str) -> DataFrame:
    return harvests.frequencies(table(spark, d, "part"), "p_brand", "unknown")


@query(r"select case when l = '' then 'no rights listed' else lower(l) end as value, count(*) as n from (select regexp_extract(text, '(MIT License|Apache License|CC BY[A-Z0-9. -]*)') as l from documents) group by 1")
def licence_counts(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select(F.regexp_extract("text", "(MIT License|Apache License|CC BY[A-Z0-9. -]*)", 1).alias("licence"))
    return rows.groupBy(F.when(F.col("licence") == "", "no rights listed").otherwise(F.lower("licence")).alias("value")).agg(F.count("*").alias("n"))


@query(with_views(last="select day from v_days where day not in (select day from v_days where extract(day from day) % 3 = 0)"))
def pending_days(spark: SparkSession, d: str) -> DataFrame:
    days = view(spark, d, "v_days")
    ledger = days.filter("day(day) % 3 <= 1").select(F.lit("datacite").alias("source"), "day", (F.dayofmonth("day") % 3 == 0).alias("loaded"))
    return incremental.pending_days(days, ledger, "datacite")


@query("""select cast(ts as date) as day, count(*) as records, count(*) filter (where event_id % 5 <> 0) as inserted, count(*) filter (where event_id % 5 = 0) as skipped, count(*) filter (where value < 0) as failed from events group by 1""")
def ingest_counters(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("records"), F.count_if(F.col("event_id") % 5 != 0).alias("inserted"), F.count_if(F.col("event_id") % 5 == 0).alias("skipped"), F.count_if(F.col("value") < 0).alias("failed"))


@query("select event_type as source, cast(ts as date) as day, arg_max(user_id, event_id) as records from events group by 1, 2")
def ledger_upsert(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").select(F.col("event_type").alias("source"), F.to_date("ts").alias("day"), F.col("user_id").alias("records"), F.col("event_id").alias("seq"))
    first = rows.groupBy("source", "day").agg(F.min_by("records", "seq").alias("records"))
    return incremental.upsert(first, rows, ["source", "day"], "seq")


@query("""select 'key' as kind, 'k' || cast(p_partkey as varchar) as value from part where p_partkey % 3 <> 0
    union all select 'id', cast(1000 + row_number() over (order by p_partkey) as varchar) from part where p_partkey % 3 <> 0""")
def numbered_inserts(spark: SparkSession, d: str) -> DataFrame:
    """Each new key and each id given out; which key gets which id is left to a hash."""
    part = table(spark, d, "part")
    existing = part.filter("p_partkey % 3 = 0").select(F.concat(F.lit("k"), F.col("p_partkey").cast("string")).alias("key"), F.least(F.col("p_partkey"), F.lit(1000)).alias("id"))
    existing = existing.unionAll(spark.sql("select 'x' as key, 1000L as id"))
    incoming = part.select(F.concat(F.lit("k"), F.col("p_partkey").cast("string")).alias("key"))
    out = incremental.numbered_inserts(incoming.unionAll(incoming), existing, "key", "id", ["key"])
    pair = lambda kind, value: F.struct(F.lit(kind).alias("kind"), value.cast("string").alias("value"))
    return out.select(F.inline(F.array(pair("key", F.col("key")), pair("id", F.col("id")))))


@query("""with y as (select greatest(make_date(y, 1, 1), date '2022-03-10') as a, least(make_date(y, 12, 31), date '2024-02-20') as b from (select cast(unnest(range(2022, 2025)) as int) as y)),
    w as (select a, cast(b - cast(i * 7 as int) as date) as last from y cross join (select unnest(range(0, 60)) as i) where b - cast(i * 7 as int) >= a) select greatest(a, cast(last - 6 as date)) as first, last from w""")
def harvest_windows(spark: SparkSession, d: str) -> DataFrame:
    return incremental.harvest_windows(spark, "2022-03-10", "2024-02-20")


SHARED["series_events"] = "select dataset_id, coalesce(citation_year, 2025) as year, 1.0 as weight from v_citations union all select dataset_id, coalesce(mention_year, 2025), 0.5 from v_mentions"


@query(with_views("series_events", last="""select x.dataset_id, cast(x.year as int) as year, round((coalesce(f.score, 0) / 13.46 + coalesce((select sum(weight) from series_events e where e.dataset_id = x.dataset_id and e.year <= greatest(x.year, coalesce(m.pubyear, x.year))), 0)) / 3.0, 6) as dataset_index, x.year = m.pubyear as is_first
    from (select distinct dataset_id, year from series_events where dataset_id in (select dataset_id from v_metadata) union select dataset_id, pubyear from v_metadata where pubyear is not null) x join v_metadata m on m.dataset_id = x.dataset_id left join v_fair f on f.dataset_id = x.dataset_id"""))
def index_series(spark: SparkSession, d: str) -> DataFrame:
    c = view(spark, d, "v_citations").select(F.lit("citation").alias("kind"), "dataset_id", F.col("citation_year").alias("year"), F.lit(1.0).alias("weight"))
    m = view(spark, d, "v_mentions").select(F.lit("mention").alias("kind"), "dataset_id", F.col("mention_year").alias("year"), F.lit(0.5).alias("weight"))
    data = view(spark, d, "v_metadata").select("dataset_id", "pubyear").join(view(spark, d, "v_fair").withColumnRenamed("score", "fair_score"), "dataset_id", "left")
    out = metrics.index_series(data, c.unionByName(m), THIS_YEAR).join(data.select("dataset_id", "pubyear"), "dataset_id")
    return out.select("dataset_id", "year", _r("dataset_index"), (F.col("year") == F.col("pubyear")).alias("is_first"))


FACTORS = "select 'T' || cast(s as string) as key, cast(y as int) as year, cast(s + y % 10 as double) as ft_median, 1.0 as ctw_median, 2.0 as mtw_median from (select distinct p_size as s from part where p_size % 3 = 0) cross join ({0}) where (s + y) % 4 <> 0 union all select 'ALL', cast(y as int), 50.0 + y % 10, 1.5, 2.5 from ({0}) union all select 'ALL', -1, 40.0, 1.0, 1.0"


@query("""with f as (""" + FACTORS.format("select unnest(range(1996, 2000)) as y") + """), rows as (select p_partkey, 'T' || cast(p_size as varchar) as topic, cast(case when p_partkey % 9 = 0 then null else 1990 + p_partkey % 15 end as int) as y from part),
    lim as (select key, min(year) as lo, max(year) as hi from f where year >= 0 group by key), u as (select r.*, case when y is null then -1 else least(greatest(y, least(l.lo, a.lo)), greatest(l.hi, a.hi)) end as used_year from rows r left join lim l on l.key = r.topic left join lim a on a.key = 'ALL')
    select p_partkey, cast(used_year as int) as used_year, case when f1.key is not null then 'key_year' when f2.key is not null then 'all_year' when y is not null and f3.key is not null then 'key_any' when y is not null and f4.key is not null then 'all_any' end as level, coalesce(f1.ft_median, f2.ft_median, case when y is not null then coalesce(f3.ft_median, f4.ft_median) end) as ft_median
    from u left join f f1 on f1.key = topic and f1.year = used_year left join f f2 on f2.key = 'ALL' and f2.year = used_year left join f f3 on f3.key = topic and f3.year = -1 left join f f4 on f4.key = 'ALL' and f4.year = -1""")
def norm_lookup(spark: SparkSession, d: str) -> DataFrame:
    f = _sql(spark, d, FACTORS.format("select explode(sequence(1996, 1999)) as y").replace("from part", "from {part}"), "part")
    rows = _sql(spark, d, "select p_partkey, 'T' || cast(p_size as string) as topic, cast(case when p_partkey % 9 = 0 then null else 1990 + p_partkey % 15 end as int) as y from {part}", "part")
    return lookup.with_factors(rows, f, "topic", "y").select("p_partkey", "used_year", "level", "ft_median")


@query("""with a as (select event_id, user_id, ts from events), b as (select user_id as bu, ts as bt, max(value) as bv from events where event_id % 5 = 1 group by user_id, ts) select event_id, user_id, bt, bv from a asof left join b on a.user_id = b.bu and a.ts >= b.bt""")
def asof_events(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    b = e.filter("event_id % 5 = 1").groupBy(F.col("user_id").alias("bu"), F.col("ts").alias("bt")).agg(F.max("value").alias("bv"))
    return asof_left_join(e.select("event_id", "user_id", "ts"), b, "user_id", "ts", "bu", "bt").select("event_id", "user_id", "bt", "bv")
