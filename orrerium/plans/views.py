"""The domain's inputs as projections of the driver's tables. The same text runs on Spark and on other engines."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "labels", "benchmark", "conversations", "embeddings")

DS = "'10.5555/ds.' || cast({0} as string)"
YEAR = "cast(case when {0} % 20 = 0 then null else 1994 + {0} % 8 end as int)"

VIEWS = {
    "v_metadata": f"select {DS.format('p_partkey')} as dataset_id, {YEAR.format('p_partkey')} as pubyear, p_name as title, case when p_partkey % 3 = 0 then 'emdb' else 'datacite' end as source, p_brand as publisher from part",
    # links differ by fragment and slash, and some have no year; the sequence columns put copies next to each other
    "v_citations": f"""select {DS.format('l_partkey')} as dataset_id, case l_returnflag when 'A' then 'mdc' when 'N' then 'openalex' else 'datacite' end as src,
        'https://doi.org/10.5555/pub.' || cast(l_orderkey as string) || case l_linenumber % 3 when 0 then '/' when 1 then '#s1' else '' end as citation_link,
        cast(case when l_orderkey % 17 = 0 then null else year(l_shipdate) end as int) as citation_year, {YEAR.format('l_partkey')} as pubyear,
        l_returnflag as s1, l_orderkey as s2, l_linenumber as s3, l_suppkey as s4, year(l_shipdate) as s5, l_extendedprice as s6 from lineitem""",
    "v_mentions": f"""select {DS.format('(event_id * 7) % 1999')} as dataset_id, event_type as src, 'https://example.org/r/' || cast(user_id as string) || case event_id % 4 when 0 then '/' else '' end as mention_link,
        cast(case when event_id % 13 = 0 then null else 1994 + event_id % 12 end as int) as mention_year, {YEAR.format('((event_id * 7) % 1999)')} as pubyear, event_id as s1 from events""",
    "v_fair": f"select {DS.format('p_partkey')} as dataset_id, cast((p_partkey * 7) % 101 as double) as score from part where p_partkey % 4 <> 0",
    "v_oa_topics": f"""select {DS.format('p_partkey')} as dataset_id, 'T' || cast(10000 + p_size as string) as topic_id, 'Topic ' || cast(p_size as string) as topic_name, cast((p_partkey * 13) % 100 as double) / 100 as score,
        'S' || p_brand as subfield_id, 'Subfield ' || p_brand as subfield_name, 'F' || cast(p_size % 7 as string) as field_id, 'Field ' || cast(p_size % 7 as string) as field_name, 'D' || p_type as domain_id, p_type as domain_name from part where p_partkey % 3 <> 0""",
    "v_model_topics": f"""select {DS.format('p_partkey')} as dataset_id, 'T' || cast(10000 + (p_size * 3) % 50 + 1 as string) as topic_id, 'Topic ' || cast((p_size * 3) % 50 + 1 as string) as topic_name, cast((p_partkey * 29) % 100 as double) / 100 as score,
        'S' || p_brand as subfield_id, 'Subfield ' || p_brand as subfield_name, 'F' || cast(p_size % 7 as string) as field_id, 'Field ' || cast(p_size % 7 as string) as field_name, 'D' || p_type as domain_id, p_type as domain_name from part where p_partkey % 5 <> 0""",
    "v_creators": f"""select distinct {DS.format('l_partkey')} as dataset_id, s_suppkey, s_name as name, case when s_suppkey % 11 = 0 then 'Organizational' when s_suppkey % 7 = 0 then null else 'Personal' end as name_type,
        case when s_suppkey % 4 = 0 then 'https://orcid.org/0000-' || cast(s_suppkey as string) when s_suppkey % 4 = 2 then 'orcid:0000-' || cast(s_suppkey - 2 as string) end as identifier,
        case when s_suppkey % 5 = 0 then null else 'Dept. of ' || n_name || ', ' || n_name end as affiliation
        from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey""",
    "v_scores_all": f"select {DS.format('l_partkey')} as dataset_id, cast(round(l_extendedprice, 0) % 101 as double) as score, l_orderkey * 1000000 + l_linenumber * 100000 + l_suppkey * 10 + cast(l_quantity as int) % 10 as seq from lineitem",
    "v_days": "select distinct cast(ts as date) as day from events",
    "v_works": """select 'W' || cast(o_orderkey as string) as oa_id, case when o_orderkey % 5 = 0 then '' else '10.5555/pub.' || cast(o_orderkey % 9000 as string) end as doi,
        case when o_orderkey % 7 = 0 then cast(year(o_orderdate) as string) when o_orderkey % 11 = 0 then null else cast(cast(o_orderdate as date) as string) end as pub_date,
        'T' || cast(10000 + o_custkey % 40 as string) as topic_id, cast(o_custkey % 100 as double) / 100 as topic_score, 1 + o_orderkey % 3 as folder_rank, 'part-' || cast(o_orderkey % 4 as string) as file from orders""",
    "v_edges": f"select 'W' || cast(l_orderkey as string) as citing_oa_id, {DS.format('l_partkey')} as cited, 'part-' || cast(l_suppkey % 5 as string) as file from lineitem",
    "v_known": f"select {DS.format('p_partkey')} as dataset_id, {YEAR.format('p_partkey')} as pubyear, case when p_partkey % 6 = 0 then date '2024-06-01' else date '2024-01-01' end as added_date from part where p_partkey % 2 = 0",
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of VIEWS over the Parquet tables in a folder."""
    text = VIEWS[name]
    used = [t for t in TABLES if re.search(rf"\b(?:from|join) {t}\b", text)]
    for t in used:
        text = re.sub(rf"\b(from|join) {t}\b", rf"\1 {{{t}}}", text)
    return spark.sql(text, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in used})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
