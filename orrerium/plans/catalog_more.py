"""Registered queries on records, reports, dates, thresholds and round trips through files and tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, ids, weights
from ..operators.merge import first_wins
from ..session import checkpoint
from ..sources import readers, writers
from ..streaming.incremental import _shared
from . import evidence, harvests, metrics
from .catalog import SHARED, THIS_YEAR, TODAY, W, _citations, _mentions, _metrics, _r, _topics, query, with_views
from .catalog_sources import LINES, _blocks, _sql
from .views import table, view

DS = "'10.5555/ds.' || cast({0} as string)"
#: A day of each part, in both dialects.
SPARK_DAY, SQL_DAY = "date_add(date '1994-01-01', cast(p_partkey % 3000 as int))", "(date '1994-01-01' + cast(p_partkey % 3000 as int))"
ORDER_DAY = "cast(cast(o_orderdate as date) as string)"


@query(f"""select 'EMD-' || cast(10000 + p_partkey as varchar) as emdb_id, p_name as title, p_brand || '|' || p_type as subjects,
    cast({SQL_DAY} as varchar) || 'T00:00:00' as publication_date, cast(year({SQL_DAY}) as int) as pubyear,
    'A ' || p_brand || ':|B:0000-0001-0002-' || lpad(cast(p_partkey % 10000 as varchar), 4, '0') as creators from part""")
def slim_emdb_records(spark: SparkSession, d: str) -> DataFrame:
    raw = _sql(spark, d, f"""select 'EMD-' || cast(10000 + p_partkey as string) as emdb_id, p_name as title, p_brand || ' , ' || p_type as keywords, cast({SPARK_DAY} as string) as deposition_date,
        array(named_struct('valueOf_', 'A ' || p_brand, 'ORCID', cast(null as string)), named_struct('valueOf_', 'B', 'ORCID', cast(null as string))) as authors,
        named_struct('authors', array(named_struct('valueOf_', 'B', 'ORCID', 'https://orcid.org/0000-0001-0002-' || lpad(cast(p_partkey % 10000 as string), 4, '0')),
        named_struct('valueOf_', 'B', 'ORCID', '0000-0000-0000-0001'))) as primary_citation from {{part}}""", "part")
    name = lambda c: F.concat(c["name"], F.lit(":"), F.coalesce(F.get(c["identifiers"], F.lit(0)), F.lit("")))
    return harvests.slim_emdb(raw, THIS_YEAR).select(
        F.get("identifiers", F.lit(0))["identifier"].alias("emdb_id"), "title", F.array_join("subjects", "|").alias("subjects"), "publication_date", "pubyear",
        F.array_join(F.transform("creators", name), "|").alias("creators"),
    )


@query(f"""select {DS.format('p_partkey')} as dataset_id, {SQL_DAY} as pub_ts, cast(year({SQL_DAY}) as int) as pubyear, p_name as title, 'datacite' as source, p_brand as publisher
    from part where p_partkey % 4 <> 0""")
def metadata_table(spark: SparkSession, d: str) -> DataFrame:
    slim = _sql(spark, d, f"""select if(p_partkey % 4 = 0, array(), array(named_struct('identifier', {DS.format('p_partkey')}, 'identifier_type', 'doi'))) as identifiers,
        cast({SPARK_DAY} as string) || 'T00:00:00' as publication_date, year({SPARK_DAY}) as pubyear, cast(null as array<string>) as creators, p_name as title, 'datacite' as source,
        p_brand as publisher from {{part}}""", "part")
    return evidence.metadata_of(slim).drop("creators")


@query(f"""select 'W' || cast(o_orderkey as varchar) as oa_id, '10.5555/pub.' || cast(o_orderkey as varchar) as doi, case when o_orderkey % 3 = 0 then cast(year(o_orderdate) as varchar) else {ORDER_DAY} end as pub_date,
    'T' || cast(o_custkey as varchar) as topic_id, 'Topic' as topic_name, 0.5 as topic_score from orders""")
def works_metadata(spark: SparkSession, d: str) -> DataFrame:
    works = _sql(spark, d, f"""select 'https://openalex.org/W' || cast(o_orderkey as string) as id, 'https://doi.org/10.5555/PUB.' || cast(o_orderkey as string) as doi,
        if(o_orderkey % 3 = 0, '', {ORDER_DAY}) as publication_date, year(o_orderdate) as publication_year,
        named_struct('id', 'https://openalex.org/T' || cast(o_custkey as string), 'display_name', 'Topic', 'score', 0.5D) as primary_topic from {{orders}}""", "orders")
    return harvests.works_metadata(works)


@query("select 'W' || cast(l_orderkey as varchar) as citing_oa_id, 'W' || cast(l_partkey as varchar) as cited_oa_id from lineitem")
def works_citations(spark: SparkSession, d: str) -> DataFrame:
    works = _sql(spark, d, """select 'https://openalex.org/W' || cast(l_orderkey as string) as id, collect_list('https://openalex.org/W' || cast(l_partkey as string)) as referenced_works
        from {lineitem} group by l_orderkey""", "lineitem")
    return harvests.works_citations(works)


@query(f"""with r as (select o_orderkey as k, {DS.format('o_custkey % 2000')} as dataset_id, cast(1993 + o_custkey % 4 as int) as py, {ORDER_DAY} as day, cast(year(o_orderdate) as int) as year from orders),
    n as (select *, k % 4 in (2, 3) as dated, k % 4 in (0, 1) and k % 8 <> 0 as by_year from r)
    select dataset_id, case when k % 5 = 0 then 'https://openalex.org/W' || cast(k as varchar) else 'https://doi.org/10.5555/pub.' || cast(k as varchar) end as citation_link,
    {W.format('py', 'case when dated or by_year then year end')} as citation_weight,
    case when dated then day || 'T00:00:00' when by_year then cast(year as varchar) || '-01-01T00:00:00' else '2026-01-01T00:00:00' end as citation_date,
    not (dated or by_year) as placeholder_date, case when dated or by_year then year else 2026 end as citation_year, not (dated or by_year) as placeholder_year from n""")
def citing_works(spark: SparkSession, d: str) -> DataFrame:
    works = _sql(spark, d, f"""select {DS.format('o_custkey % 2000')} as dataset_id, cast(1993 + o_custkey % 4 as int) as pubyear, 'https://openalex.org/W' || cast(o_orderkey as string) as id,
        if(o_orderkey % 5 = 0, cast(null as string), 'https://doi.org/10.5555/PUB.' || cast(o_orderkey as string)) as doi,
        case o_orderkey % 4 when 0 then null when 1 then 'unknown' else {ORDER_DAY} end as publication_date, if(o_orderkey % 8 = 0, cast(null as int), year(o_orderdate)) as publication_year
        from {{orders}}""", "orders")
    return harvests.citing_works(works, TODAY).drop("source")


@query(f"""select dataset_id, pubyear, cast(count(*) filter (where l_linenumber <= 4) as int) as n_dois, cast(count(*) filter (where l_linenumber > 4) as int) as n_other
    from (select distinct * from ({LINES})) group by dataset_id, pubyear""")
def citation_blocks(spark: SparkSession, d: str) -> DataFrame:
    blocks = _blocks(spark, d)
    named = F.array(F.struct(F.col("dataset_id").alias("identifier"), F.lit("doi").alias("identifier_type")))
    slim = blocks.withColumn("identifiers", named).drop("dataset_id")
    bare = slim.withColumn("citations", F.when(F.lit(False), F.col("citations")))
    out = harvests.citation_blocks(slim.unionByName(bare))
    return out.select("dataset_id", "pubyear", F.size("citations.dois").alias("n_dois"), F.size("citations.other").alias("n_other"))


@query(f"""select dataset_id, string_agg(id, ' ' order by id) as others from (select distinct dataset_id, 'x:' || cast(l_orderkey % 50 as varchar) as id from ({LINES}) where l_linenumber > 4 and l_orderkey % 2 = 1) group by dataset_id""")
def new_block_others(spark: SparkSession, d: str) -> DataFrame:
    blocks = _blocks(spark, d)
    even = F.filter("citations.other", lambda x: F.substring_index(x["id"], ":", -1).cast("int") % 2 == 0)
    known = blocks.select("dataset_id", F.struct(even.alias("other")).alias("citations"))
    return harvests.new_others(blocks, known).select("dataset_id", F.array_join("others", " ").alias("others"))


@query("""select '10.5555/ds.' || cast(l_partkey as varchar) as dataset_id, cast(1950 + min(l_orderkey * 8 + l_linenumber) % 70 as int) as pubyear from lineitem group by l_partkey""")
def first_identifiers(spark: SparkSession, d: str) -> DataFrame:
    slim = _sql(spark, d, f"""select array(named_struct('identifier', {DS.format('l_partkey')}, 'identifier_type', 'doi')) as identifiers, l_orderkey * 8 + l_linenumber as seq,
        cast(1950 + (l_orderkey * 8 + l_linenumber) % 70 as int) as pubyear from {{lineitem}}""", "lineitem")
    return readers.first_identifiers(slim, "seq")


@query("select p_partkey from part where p_partkey % 3 <> 0")
def records_by_prefix(spark: SparkSession, d: str) -> DataFrame:
    rows = _sql(spark, d, f"""select p_partkey, array(named_struct('identifier', cast(null as string)), named_struct('identifier', if(p_partkey % 3 = 0, 'EMD-1234', {DS.format('p_partkey')}))) as identifiers
        from {{part}}""", "part")
    return writers.with_prefix_only(rows, "10.5555/").select("p_partkey")


@query(f"""select o_orderkey, case when o_orderkey % 3 = 2 then {ORDER_DAY} || 'T00:00:00' when o_orderkey % 2 = 1 then '2001-02-03' end as best,
    epoch(cast(o_orderdate as date))::bigint + 30030 as instant, cast(year(o_orderdate) as varchar) || case when o_orderkey % 2 = 0 then '-01-01' else '-0' || cast(1 + o_orderkey % 9 as varchar) || '-01' end || 'T00:00:00' as parts,
    case o_orderkey % 4 when 0 then {ORDER_DAY} || 'T00:00:00' when 1 then '2002-01-01T00:00:00' when 2 then '2003-04-05T00:00:00' end as published,
    case when o_orderkey % 5 = 0 then cast(year(o_orderdate) as int) when o_orderkey % 2 = 0 then 1998 end as work_year from orders""")
def dates_of_records(spark: SparkSession, d: str) -> DataFrame:
    key, day = F.col("o_orderkey"), F.date_format("o_orderdate", "yyyy-MM-dd")
    published = F.when(key % 3 == 1, "1066-01-01T00:00:00").when(key % 3 == 2, F.concat(day, F.lit("T00:00:00")))
    created = F.when(key % 2 == 0, "2999-01-01").otherwise("2001-02-03")
    year, month = F.year("o_orderdate"), (1 + key % 9).cast("int")
    chain = dates.best_publication_date(F.when(key % 4 == 0, day), F.when(key % 4 <= 1, "2002"), F.when(key % 4 <= 2, "April 5, 2003"))
    return table(spark, d, "orders").select(
        "o_orderkey", dates.best_date(published, created, TODAY).alias("best"), dates.utc_instant(F.concat(day, F.lit("T10:20:30+02:00"))).cast("long").alias("instant"),
        dates.date_of_parts(F.when(key % 2 == 0, F.array(year)).otherwise(F.array(year, month))).alias("parts"), chain.alias("published"),
        dates.work_year(F.when(key % 5 == 0, year).otherwise(F.lit(17)), F.when(key % 2 == 0, "1998-02"), THIS_YEAR).alias("work_year"),
    )


@query("""select o_orderkey, case when o_orderkey % 9 = 8 then null else strftime(case o_orderkey % 9 when 2 then cast(date_trunc('month', o_orderdate) as date)
    when 5 then case when day(o_orderdate) <= 12 then make_date(cast(year(o_orderdate) as int), cast(day(o_orderdate) as int), cast(month(o_orderdate) as int)) else cast(o_orderdate as date) end
    else cast(o_orderdate as date) end, '%Y-%m-%dT00:00:00') end as iso from orders""")
def free_dates(spark: SparkSession, d: str) -> DataFrame:
    shapes = ("MMMM d, yyyy", "d MMM yyyy", "MMM yyyy", "MM/dd/yyyy", "yyyy.MM.dd", "dd.MM.yyyy", "yyyy MMMM d", "dd-MMM-yyyy")
    raw = F.lit("31 Foo 2019")
    for n, shape in enumerate(shapes):
        raw = F.when(F.col("o_orderkey") % 9 == n, F.date_format("o_orderdate", shape)).otherwise(raw)
    return table(spark, d, "orders").select("o_orderkey", dates.norm_date_iso(raw).alias("iso"))


@query("select p_partkey, case when p_partkey % 2 = 0 then 'A=doi;B=emdb' else 'A=doi' end as pairs from part")
def identifier_pairs(spark: SparkSession, d: str) -> DataFrame:
    pair = lambda i, t: F.struct(F.lit(i).cast("string").alias("identifier"), F.lit(t).alias("identifier_type"))
    many = F.array(pair("A", "DOI"), pair("", "x"), pair("A", "doi"), pair(None, "x"), pair("B", "EMDB"))
    few = F.array(pair("A", "doi"), pair("A", "Doi"))
    pairs = ids.unique_pairs(F.when(F.col("p_partkey") % 2 == 0, many).otherwise(few))
    text_ = F.array_join(F.transform(pairs, lambda x: F.concat(x["identifier"], F.lit("="), x["identifier_type"])), ";")
    return table(spark, d, "part").select("p_partkey", text_.alias("pairs"))


@query("""select p_partkey, round((p_size / case when p_partkey % 3 = 0 then 20.0 else 13.46 end + (p_partkey % 10) / case when p_partkey % 3 = 1 then 2.0 else 1.0 end + p_partkey % 7) / 3.0, 6) as dataset_index,
    case when lower(p_brand) = 'brand#11' then null else p_brand end as brand_id from part""")
def thresholded_index(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    fair_t, cit_t = F.when(k % 3 == 0, 20.0), F.when(k % 3 == 1, 2.0).otherwise(-5.0)
    value = weights.dataset_index(F.col("p_size").cast("double"), (k % 10).cast("double"), (k % 7).cast("double"), fair_t, cit_t)
    brand = F.when(F.lower("p_brand") != "brand#11", F.col("p_brand"))
    return table(spark, d, "part").select("p_partkey", F.round(value, 6).alias("dataset_index"), brand.alias("brand_id"))


@query("select p_partkey, cast(case when p_partkey % 5 <> 0 then p_partkey % 1000 end as double) as s_index_topics from part order by s_index_topics desc nulls last, p_partkey")
def ranked_authors(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").select("p_partkey", F.when(F.col("p_partkey") % 5 != 0, F.col("p_partkey") % 1000).cast("double").alias("S_index_topics"))
    return metrics.ranked(rows).withColumnRenamed("S_index_topics", "s_index_topics")


@query(f"""select p_partkey, case when p_partkey % 3 <> 0 then cast(p_size as double) end as fair_score, cast({SQL_DAY} as varchar) || 'T00:00:00+00:00' as evaluation_date,
    'm' as fuji_metric_version, '3' as fuji_software_version from part""")
def fair_reports(spark: SparkSession, d: str) -> DataFrame:
    raw = _sql(spark, d, f"""select p_partkey, if(p_partkey % 3 = 0, null, named_struct('score_percent', named_struct('FAIR', cast(p_size as double)))) as summary,
        cast({SPARK_DAY} as string) || 'T00:00:00Z' as end_timestamp, 'm' as metric_version, '3' as software_version from {{part}}""", "part")
    return raw.select("p_partkey", *harvests.fair_report())


@query(f"""select {DS.format('p_partkey')} as dataset_id, cast(p_size as double) as score from part union all select {DS.format('s_suppkey')}, 50.0 from supplier""")
def merged_scores(spark: SparkSession, d: str) -> DataFrame:
    one = _sql(spark, d, f"select {DS.format('p_partkey')} as doi, cast(p_size as double) as score from {{part}}", "part")
    two = _sql(spark, d, f"select {DS.format('s_suppkey')} as doi, 50.0D as score from {{supplier}}", "supplier")
    return evidence.merged_scores([one, two])


@query("select t.dataset_id, t.topic_id, case when m.k is not null then 'new ' || cast(m.k % 7 as varchar) end as subfield from (" + "select '10.5555/ds.' || cast(p_partkey as varchar) as dataset_id, 'T' || cast(10000 + p_size as varchar) as topic_id from part" + """) t
    left join (select distinct p_size as k from part where p_size % 2 = 0) m on 'T' || cast(10000 + m.k as varchar) = t.topic_id""")
def subfield_of_topic(spark: SparkSession, d: str) -> DataFrame:
    rows = _sql(spark, d, f"select {DS.format('p_partkey')} as dataset_id, 'https://openalex.org/T' || cast(10000 + p_size as string) as topic_id from {{part}}", "part")
    mapping = _sql(spark, d, """select distinct cast(10000 + p_size as string) as topic_id, if(c = 0, ' new ' || cast(p_size % 7 as string), 'late') as subfield_id, c as seq
        from {part} cross join (select explode(array(0, 1)) as c) where p_size % 2 = 0""", "part")
    return evidence.with_subfield(rows, mapping).select("dataset_id", "topic_id", F.col("subfield_id").alias("subfield"))


FACTOR_SIDE = "asof left join (select * from s_floored where id <> 'DEFAULT') s on {0} = s.id and {1} >= s.pubyear cross join s_def sd"


@query(with_views("s_floored", "s_def", last="""select k.subfield_id, k.pubyear, round(coalesce(s.mf, sd.mf), 6) as ft, round(coalesce(s.mc, sd.mc), 6) as ctw, round(coalesce(s.mm, sd.mm), 6) as mtw, k.pubyear - s.pubyear as n_year_gap,
    case when s.pubyear is null then 'Default' when s.pubyear = k.pubyear then 'Exact Year' else 'Closest Past Year' end as method
    from (select distinct 'S' || p_brand as subfield_id, cast(1990 + p_partkey % 15 as int) as pubyear from part) k """ + FACTOR_SIDE.format("k.subfield_id", "k.pubyear")))
def subfield_year_factors(spark: SparkSession, d: str) -> DataFrame:
    asked = _sql(spark, d, "select distinct 'S' || p_brand as subfield_id, cast(1990 + p_partkey % 15 as int) as pubyear from {part}", "part")
    factors = metrics.floored_factors(metrics.subfield_factors(checkpoint(_metrics(spark, d))))
    out = metrics.year_factors(asked, factors, "subfield_id")
    return out.select("subfield_id", "pubyear", *[_r(c) for c in ("ft", "ctw", "mtw")], "n_year_gap", "method")


SHARED["asked"] = "select m.*, t.subfield_id from v_metadata m left join topics t on t.dataset_id = m.dataset_id"
SHARED["asked_factors"] = "select k.dataset_id, k.pubyear, coalesce(s.mf, sd.mf) as ft, coalesce(s.mc, sd.mc) as ctw, coalesce(s.mm, sd.mm) as mtw from asked k " + FACTOR_SIDE.format("k.subfield_id", "k.pubyear")
SHARED["cited_years"] = "select dataset_id, coalesce(citation_year, 2025) as year, citation_weight as c, 0.0 as m from citations union all select dataset_id, coalesce(mention_year, 2025), 0.0, mention_weight from mentions"


@query(with_views("s_floored", "s_def", "asked_factors", "cited_years", last="""select x.dataset_id, cast(x.year as int) as year,
    round((coalesce(f.score, 0) / a.ft + coalesce(sum(e.c) filter (where e.year <= greatest(x.year, coalesce(a.pubyear, x.year))), 0) / a.ctw
    + coalesce(sum(e.m) filter (where e.year <= greatest(x.year, coalesce(a.pubyear, x.year))), 0) / a.mtw) / 3.0, 6) as dataset_index
    from (select distinct dataset_id, year from cited_years union select dataset_id, pubyear from v_metadata where pubyear is not null) x
    join asked_factors a on a.dataset_id = x.dataset_id left join v_fair f on f.dataset_id = x.dataset_id left join cited_years e on e.dataset_id = x.dataset_id
    group by x.dataset_id, x.year, f.score, a.ft, a.ctw, a.mtw"""))
def series_of_requests(spark: SparkSession, d: str) -> DataFrame:
    """Every dataset asked for by an address of its DOI, in other letters."""
    asked = view(spark, d, "v_metadata").select(F.concat(F.lit("https://doi.org/"), F.upper("dataset_id")).alias("request"))
    factors = metrics.floored_factors(metrics.subfield_factors(checkpoint(_metrics(spark, d))))
    out = metrics.series_of_requests(asked, view(spark, d, "v_metadata"), _topics(spark, d), view(spark, d, "v_fair"), _citations(spark, d), _mentions(spark, d), factors, THIS_YEAR)
    return out.select("dataset_id", "year", _r("dataset_index"))


def _records(spark, d) -> DataFrame:
    return _sql(spark, d, "select p_partkey as k, p_name as name, if(p_partkey % 4 = 0, null, p_size) as size, array(p_brand, p_type) as tags from {part}", "part")


RECORDS = "select p_partkey as k, p_name as name, case when p_partkey % 4 = 0 then null else p_size end as size, p_brand || '|' || p_type as tags from part"


def _plain(df: DataFrame) -> DataFrame:
    return df.select("k", "name", "size", F.array_join("tags", "|").alias("tags"))


@query(RECORDS)
def ndjson_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Written as lines in files of at most 1,000, and read with a schema and a column for broken lines."""
    at, rows = _shared(spark), _records(spark, d)
    writers.ndjson(rows, f"{at}/lines", lines=1000)
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    read = readers.ndjson(spark, f"{at}/lines", types, keep_bad=True, glob="*.json")
    return _plain(read.filter(F.col(readers.BAD).isNull()))


@query(RECORDS)
def parquet_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Two folders in an order of rank; each record is in both and the first counts."""
    at, rows = _shared(spark), _records(spark, d)
    writers.parquet(rows, f"{at}/one")
    writers.parquet(rows.withColumn("name", F.lit("late")), f"{at}/two")
    both = readers.ranked_folders(spark, [f"{at}/one", f"{at}/two"])
    return _plain(first_wins(both.select("k", "name", "size", "tags", "folder_rank"), "k", "folder_rank"))


@query("select p_partkey as k, p_name as name, cast(p_size as varchar) as size from part")
def csv_round_trip(spark: SparkSession, d: str) -> DataFrame:
    at = _shared(spark)
    part = table(spark, d, "part")
    writers.csv(part.select(F.col("p_partkey").alias("k "), F.col("p_name").alias("name"), F.col("p_size").alias(" size")), f"{at}/csv")
    return readers.mapping(spark, f"{at}/csv").select(F.col("k").cast("long").alias("k"), "name", "size")


@query("select p_partkey as k, 2 as n from part union all select s_suppkey + 1000000000, 1 from supplier")
def table_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """A table replaced, appended to twice, copied, and read as an external one."""
    name, at = f"t_{uuid.uuid4().hex}", _shared(spark)
    keys = table(spark, d, "part").select(F.col("p_partkey").alias("k"))
    writers.replace_table(keys.limit(1), name)
    writers.replace_table(keys, name)
    writers.append_table(keys, name)
    writers.append_table(table(spark, d, "supplier").select((F.col("s_suppkey") + 1_000_000_000).alias("k")), name)
    writers.copy_table(spark, name, f"{name}_copy")
    writers.parquet(spark.table(f"{name}_copy"), f"{at}/external")
    writers.external_table(spark, f"{name}_out", f"{at}/external")
    out = spark.table(f"{name}_out").groupBy("k").agg(F.count("*").cast("int").alias("n"))
    for made in (name, f"{name}_copy"):
        spark.sql(f"drop table {made}")
    return out


@query("select cast(ts as date) as day, count(*) as n from events group by 1")
def day_partition_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Days loaded twice: the second load replaces its own days and leaves the others."""
    at = _shared(spark)
    rows = table(spark, d, "events").select("event_id", F.to_date("ts").alias("day"))
    writers.day_partitions(rows, f"{at}/days")
    writers.day_partitions(rows.filter(F.dayofmonth("day") % 2 == 0), f"{at}/days")
    return spark.read.parquet(f"{at}/days").groupBy("day").agg(F.count("*").alias("n"))


@query("select count(*) as records, 'parts' as name, count(*) as n_lines, 0 as n_bad from part")
def published_load(spark: SparkSession, d: str) -> DataFrame:
    """Data with a manifest, then its lines joined and counted."""
    at, rows = _shared(spark), _records(spark, d)
    writers.publish(rows, f"{at}/load", {"name": "parts"})
    about = writers.published(spark, f"{at}/load")
    writers.joined_lines(spark, [f"{at}/load/data"], f"{at}/joined")
    lines = readers.numbered_lines(spark, f"{at}/joined")
    counted = readers.ndjson(spark, f"{at}/load/data", "k bigint", keep_bad=True, glob="*.json.gz")
    bad = readers.bad_line_count(counted).select(F.col("n_bad").cast("int").alias("n_bad"))
    about = F.lit(about["records"]).cast("long").alias("records"), F.lit(about["name"]).alias("name")
    return lines.agg(F.count("value").alias("n_lines")).crossJoin(F.broadcast(bad)).select(*about, "n_lines", "n_bad")  # one row each


@query("select p_partkey as k, case when p_size > 25 then 'size' else '' end || case when p_partkey % 3 = 0 then case when p_size > 25 then ',key' else 'key' end else '' end as failed from part")
def sorted_out_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").select(F.col("p_partkey").alias("k"), F.col("p_size").alias("size"))
    good, bad = writers.sorted_out(rows, {"size": "size <= 25", "key": "if(k % 3 = 0, null, true)"})
    return good.select("k", F.lit("").alias("failed")).unionByName(bad.select("k", F.array_join("failed", ",").alias("failed")))


STATUS = "select o_orderkey as k, cast(case o_orderkey % 7 when 0 then 200 when 1 then 302 when 2 then 403 when 3 then 404 when 4 then 405 when 5 then 503 end as int) as head, cast(case o_orderkey % 3 when 0 then 200 when 1 then 401 else 404 end as int) as get"


@query("""select o_orderkey as k, o_orderkey % 7 in (0, 1) or (o_orderkey % 7 in (4, 5) and o_orderkey % 3 = 0) as works,
    o_orderkey % 7 in (0, 1, 2) or (o_orderkey % 7 in (4, 5) and o_orderkey % 3 < 2) as works_or_blocked from orders""")
def reachable_links(spark: SparkSession, d: str) -> DataFrame:
    rows = _sql(spark, d, STATUS + " from {orders}", "orders")
    return rows.select("k", ids.reachable("head", "get").alias("works"), ids.reachable("head", "get", allow_blocked=True).alias("works_or_blocked"))


@query("select p_partkey as k, p_name || ', ' || p_brand as name from part")
def sniffed_mapping(spark: SparkSession, d: str) -> DataFrame:
    """A lookup table whose separator the header shows; its values hold other signs that could be one."""
    at = _shared(spark)
    rows = table(spark, d, "part").select(F.col("p_partkey").alias("k"), F.concat_ws(", ", "p_name", "p_brand").alias("name"))
    writers.csv(rows, f"{at}/sniffed", sep="\t")
    return readers.mapping(spark, f"{at}/sniffed", sep=None).select(F.col("k").cast("long").alias("k"), "name")


@query("""select 3 * count(*) as n_lines, count(*) as n_blank, count(*) as n_marked, 2 * count(*) as n_kept from part""")
def counted_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines of joined files, with blank ones and without."""
    at = _shared(spark)
    lines = F.explode(F.array(F.lit('<?xml version="1.0"?>'), F.lit(" "), F.col("p_name"))).alias("value")
    table(spark, d, "part").select(lines).write.text(f"{at}/raw")
    writers.joined_lines(spark, [f"{at}/raw"], f"{at}/all", blank=True)
    writers.joined_lines(spark, [f"{at}/raw"], f"{at}/kept")
    kept = readers.line_counts(spark, f"{at}/kept").select(F.col("n_lines").alias("n_kept"))
    return readers.line_counts(spark, f"{at}/all").crossJoin(F.broadcast(kept))  # one row each


@query("select count(*) as n, count(*) filter (where p_size is null or p_size > 25) as n_large, cast(max(p_partkey) as bigint) as last from part")
def audited_load(spark: SparkSession, d: str) -> DataFrame:
    """Counts of a load, taken while it is written."""
    at, part = _shared(spark), table(spark, d, "part")
    seen = writers.audited(part, f"{at}/audited", F.count("*").alias("n"), F.count(F.when(F.coalesce(F.col("p_size") > 25, F.lit(True)), 1)).alias("n_large"), F.max("p_partkey").cast("long").alias("last"))
    return spark.createDataFrame([(seen["n"], seen["n_large"], seen["last"])], "n bigint, n_large bigint, last bigint")
