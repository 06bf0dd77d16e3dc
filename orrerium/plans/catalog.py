"""The registered queries of the domain over the driver's tables, each with the SQL that an independent engine runs."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, ids, text
from ..functions.weights import evidence_weight
from ..operators import incremental, lookup
from ..operators.asof import asof_left_join
from ..operators.merge import dedupe_by_link, merge_evidence
from ..operators.modes import mode
from ..session import checkpoint
from . import evidence, harvests, metrics
from .views import VIEWS, table, view

TODAY, THIS_YEAR = "2025-06-30", 2025
QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name, with its SQL if there is one."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return register


def with_views(*parts: str, last: str) -> str:
    """A WITH query over the views that it names and parts of SHARED, in order of need."""
    done: dict[str, str] = {}

    def need(body: str) -> None:
        for name, other in {**VIEWS, **SHARED}.items():
            if name not in done and re.search(rf"\b(?:from|join) (?:\(select \* from )?{name}\b", body):
                need(other)
                done.setdefault(name, other)

    for p in parts:
        need(SHARED[p])
        done.setdefault(p, SHARED[p])
    need(last)
    return "with " + ",\n".join(f"{name} as ({body})" for name, body in done.items()) + "\n" + last


W = "round(1 + 0.33 * ln(1 + greatest(0, coalesce({1} - {0}, 0))), 2)"
SHARED = {
    "c_raw": f"select *, regexp_replace(string_split(citation_link, '#')[1], '/+$', '') as link, {W.format('pubyear', 'citation_year')} as w, row_number() over (order by s1, s2, s3, s4, s5, s6) as seq from v_citations",
    "citations": """select a.dataset_id, a.link as citation_link, string_agg(distinct a.src, ',' order by a.src) as source, min(a.citation_year) as citation_year,
        (select b.w from c_raw b where b.dataset_id = a.dataset_id and b.link = a.link order by b.citation_year nulls last, b.seq limit 1) as citation_weight from c_raw a group by a.dataset_id, a.link""",
    "m_raw": f"select *, regexp_replace(mention_link, '/+$', '') as link, {W.format('pubyear', 'mention_year')} as w from v_mentions",
    "mentions": """select dataset_id, link as mention_link, string_agg(distinct src, ',' order by src) as source, min(mention_year) as mention_year, cast(null as double) as none,
        (select b.w from m_raw b where b.dataset_id = a.dataset_id and b.link = a.link order by b.mention_year nulls last, b.s1 limit 1) as mention_weight from m_raw a group by dataset_id, link""",
    "topics": """select coalesce(o.dataset_id, m.dataset_id) as dataset_id, w, case when w then o.topic_id else m.topic_id end as topic_id, case when w then o.topic_name else m.topic_name end as topic_name, case when w then o.score else m.score end as topic_score,
        case when w then o.subfield_id else m.subfield_id end as subfield_id, case when w then o.subfield_name else m.subfield_name end as subfield_name, case when w then 'openalex' else 'custom_model' end as source
        from (select o.dataset_id as od, m.dataset_id as md, coalesce(o.score, 0) > 0.5 or coalesce(o.score, 0) > coalesce(m.score, 0) as w from v_oa_topics o full outer join v_model_topics m on o.dataset_id = m.dataset_id) k
        left join v_oa_topics o on o.dataset_id = od left join v_model_topics m on m.dataset_id = md""",
    "c_stats": """select c.dataset_id, count(*) as total_citations, sum(citation_weight) as total_cit_weight, count(case when citation_year <= pubyear + 2 then 1 end) as cit_3yr, sum(case when citation_year <= pubyear + 2 then citation_weight else 0 end) as cit_weight_3yr
        from citations c join v_metadata m on c.dataset_id = m.dataset_id group by c.dataset_id""",
    "m_stats": """select c.dataset_id, count(*) as total_mentions, sum(mention_weight) as total_men_weight, count(case when mention_year <= pubyear + 2 then 1 end) as men_3yr, sum(case when mention_year <= pubyear + 2 then mention_weight else 0 end) as men_weight_3yr
        from mentions c join v_metadata m on c.dataset_id = m.dataset_id group by c.dataset_id""",
    "metrics": """select m.dataset_id, m.pubyear, m.source as dataset_source, t.topic_id, t.topic_name, t.topic_score, t.subfield_id, t.subfield_name, f.score as fair_score, coalesce(total_citations, 0) as total_citations, coalesce(total_cit_weight, 0) as total_cit_weight,
        coalesce(cit_3yr, 0) as cit_3yr, coalesce(cit_weight_3yr, 0) as cit_weight_3yr, coalesce(total_mentions, 0) as total_mentions, coalesce(total_men_weight, 0) as total_men_weight, coalesce(men_3yr, 0) as men_3yr, coalesce(men_weight_3yr, 0) as men_weight_3yr
        from v_metadata m left join c_stats c on c.dataset_id = m.dataset_id left join m_stats n on n.dataset_id = m.dataset_id left join v_fair f on f.dataset_id = m.dataset_id left join topics t on t.dataset_id = m.dataset_id""",
}
for _p, _id, _name in (("t", "topic_id", "topic_name"), ("s", "subfield_id", "subfield_name")):
    SHARED[f"{_p}_base"] = f"select {_id} as id, case when {_id} is null then null else coalesce({_name}, 'Unknown') end as name, pubyear, total_cit_weight as c, total_men_weight as m, fair_score as f from metrics where pubyear is not null"
    SHARED[f"{_p}_years"] = f"select unnest(case when lo + 3 < hi + 2 then range(lo + 3, hi + 2) when lo + 3 > hi + 2 then [hi + 3] else [] end) as y from (select min(pubyear) as lo, max(pubyear) as hi from {_p}_base)"
    SHARED[f"{_p}_groups"] = f"select distinct id, name, false as whole from {_p}_base where id is not null union all select null, null, true"
    _on = "(g.whole or (b.id = g.id and b.name = g.name))"
    SHARED[f"{_p}_factors"] = f"""select g.id, g.name, cast(null as int) as pubyear, median(f) as mf, median(c) as mc, median(m) as mm, count(f) as nf, count(c) as nc, count(m) as nm from {_p}_groups g join {_p}_base b on {_on} group by g.id, g.name
        union all select g.id, g.name, cast(y as int), median(case when b.pubyear between y - 3 and y - 1 then f end), median(case when b.pubyear between y - 3 and y - 2 then c end), median(case when b.pubyear between y - 3 and y - 2 then m end),
        count(case when b.pubyear between y - 3 and y - 1 then f end), count(case when b.pubyear between y - 3 and y - 2 then c end), count(case when b.pubyear between y - 3 and y - 2 then m end)
        from {_p}_groups g cross join {_p}_years left join {_p}_base b on {_on} group by g.id, g.name, y"""
    SHARED[f"{_p}_floor"] = f"select greatest(13.46, min(mf)) as ff from {_p}_factors"
    SHARED[f"{_p}_floored"] = f"""select id, name, pubyear, case when mc < 1 then 1.0 else mc end as mc, coalesce(mc < 1, false) as cit_is_floored, case when mm < 1 then 1.0 else mm end as mm, coalesce(mm < 1, false) as men_is_floored, case when mf < ff then ff else mf end as mf,
        coalesce(mf < ff, false) as fair_is_floored, nf, nc, nm from {_p}_factors cross join {_p}_floor union all select 'DEFAULT', 'Default Fallback', null, 1.0, true, 1.0, true, ff, true, 0, 0, 0 from {_p}_floor"""
    SHARED[f"{_p}_def"] = f"select mf, mc, mm from {_p}_floored where id = 'DEFAULT'"
SHARED["indexed"] = """select m.*, t.pubyear as ty, s.pubyear as sy, coalesce(t.mf, td.mf) as tf, coalesce(t.mc, td.mc) as tc, coalesce(t.mm, td.mm) as tm, coalesce(s.mf, sd.mf) as sf, coalesce(s.mc, sd.mc) as sc, coalesce(s.mm, sd.mm) as sm,
    (fair_score / coalesce(t.mf, td.mf) + total_cit_weight / coalesce(t.mc, td.mc) + total_men_weight / coalesce(t.mm, td.mm)) / 3.0 as it, (fair_score / coalesce(s.mf, sd.mf) + total_cit_weight / coalesce(s.mc, sd.mc) + total_men_weight / coalesce(s.mm, sd.mm)) / 3.0 as ix
    from metrics m asof left join (select * from t_floored where id <> 'DEFAULT') t on m.topic_id = t.id and m.pubyear >= t.pubyear asof left join (select * from s_floored where id <> 'DEFAULT') s on m.subfield_id = s.id and m.pubyear >= s.pubyear cross join t_def td cross join s_def sd"""
SHARED["parsed"] = """select dataset_id, name as creator_name, name_type, affiliation, lower(trim(case when identifier like '%orcid.org/%' then string_split(identifier, 'orcid.org/')[2] when identifier like 'orcid:%' then string_split(identifier, 'orcid:')[2] else identifier end)) as primary_identifier from v_creators"""
SHARED["signed"] = """select p.*, i.*, trim(creator_name) as clean_name, list_transform(string_split(affiliation, ','), lambda x: trim(x)) as affils from parsed p join indexed i on p.dataset_id = i.dataset_id"""
SHARED["authors"] = "select *, coalesce(primary_identifier, lower(clean_name) || '_[' || array_to_string(list_sort(list_transform(affils, lambda x: lower(x))), ', ') || ']') as gid from signed"


def _mode_sql(column: str) -> str:
    return f"mode_{column} as (select gid, {column} as v from (select gid, {column}, row_number() over (partition by gid order by count(*) desc, {column}) as r from authors where {column} is not null group by gid, {column}) where r = 1)"


def _year_weight(rows: DataFrame, kind: str) -> DataFrame:
    return rows.withColumn(f"{kind}_weight", evidence_weight("pubyear", f"{kind}_year"))


def _raw(spark, d, kind: str) -> DataFrame:
    rows = _year_weight(view(spark, d, f"v_{kind}s"), kind)
    return rows.withColumns({"source": F.array("src"), "placeholder_year": F.lit(False), "placeholder_date": F.lit(False), f"{kind}_date": F.lit(None).cast("string")}).drop("src", "pubyear")


CITATION_SEQ, MENTION_SEQ = ["s1", "s2", "s3", "s4", "s5", "s6"], ["s1"]


def _citations(spark, d) -> DataFrame:
    return merge_evidence(_raw(spark, d, "citation"), "citation", CITATION_SEQ)


def _mentions(spark, d) -> DataFrame:
    return merge_evidence(_raw(spark, d, "mention"), "mention", MENTION_SEQ)


def _topics(spark, d) -> DataFrame:
    return evidence.selected_topics(view(spark, d, "v_oa_topics"), view(spark, d, "v_model_topics"))


def _metrics(spark, d) -> DataFrame:
    return metrics.dataset_metrics(view(spark, d, "v_metadata"), _citations(spark, d), _mentions(spark, d), view(spark, d, "v_fair"), _topics(spark, d))


def _r(c, name=None):
    return F.round(F.col(c), 6).alias(name or c)


@query(with_views("citations", last="select dataset_id, citation_link, source, citation_year, citation_weight from citations"))
def merged_citations(spark: SparkSession, d: str) -> DataFrame:
    return _citations(spark, d).select("dataset_id", "citation_link", F.array_join("source", ",").alias("source"), "citation_year", "citation_weight")


@query(with_views("mentions", last="select dataset_id, mention_link, source, mention_year, mention_weight from mentions"))
def merged_mentions(spark: SparkSession, d: str) -> DataFrame:
    return _mentions(spark, d).select("dataset_id", "mention_link", F.array_join("source", ",").alias("source"), "mention_year", "mention_weight")


@query(with_views(last=f"select pubyear, citation_year, {W.format('pubyear', 'citation_year')} as weight, count(*) as n from v_citations group by pubyear, citation_year"))
def evidence_weights(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "v_citations").groupBy("pubyear", "citation_year").agg(F.count("*").alias("n")).withColumn("weight", evidence_weight("pubyear", "citation_year"))


@query(with_views(last="""select dataset_id, citation_link, citation_year, src from (select *, row_number() over (partition by dataset_id, citation_link order by citation_year nulls last, s1, s2, s3, s4, s5, s6) as r from v_citations) where r = 1"""))
def deduped_links(spark: SparkSession, d: str) -> DataFrame:
    rows = view(spark, d, "v_citations").withColumn("citation_date", F.concat(F.col("citation_year").cast("string"), F.lit("-01-01T00:00:00")))
    return dedupe_by_link(rows, "citation", CITATION_SEQ).select("dataset_id", "citation_link", "citation_year", "src")


@query(with_views("c_stats", last="select dataset_id, total_citations, round(total_cit_weight, 6) as total_cit_weight, cit_3yr, round(cit_weight_3yr, 6) as cit_weight_3yr from c_stats"))
def citation_stats(spark: SparkSession, d: str) -> DataFrame:
    return metrics.evidence_stats(_citations(spark, d), view(spark, d, "v_metadata"), "citation", "cit").select("dataset_id", "total_citations", _r("total_cit_weight"), "cit_3yr", _r("cit_weight_3yr"))


@query(with_views("topics", last="select dataset_id, topic_id, topic_name, topic_score, subfield_id, source from topics"))
def topics_selected(spark: SparkSession, d: str) -> DataFrame:
    return _topics(spark, d).select("dataset_id", "topic_id", "topic_name", F.col("score").alias("topic_score"), "subfield_id", "source")


@query(with_views("metrics", last="""select dataset_id, pubyear, dataset_source, topic_id, subfield_id, fair_score, total_citations, round(total_cit_weight, 6) as total_cit_weight, cit_3yr, round(cit_weight_3yr, 6) as cit_weight_3yr, total_mentions, round(total_men_weight, 6) as total_men_weight,
    men_3yr, round(men_weight_3yr, 6) as men_weight_3yr, round((coalesce(fair_score, 0) / 100.0 + total_cit_weight + total_men_weight) / 3.0, 6) as raw_dataset_index, round((coalesce(fair_score, 0) / 100.0 + cit_weight_3yr + men_weight_3yr) / 3.0, 6) as raw_dataset_index_3yr from metrics"""))
def dataset_metrics(spark: SparkSession, d: str) -> DataFrame:
    return _metrics(spark, d).select("dataset_id", "pubyear", "dataset_source", "topic_id", "subfield_id", "fair_score", "total_citations", _r("total_cit_weight"), "cit_3yr", _r("cit_weight_3yr"), "total_mentions", _r("total_men_weight"), "men_3yr", _r("men_weight_3yr"), _r("raw_dataset_index"), _r("raw_dataset_index_3yr"))


FACTOR_SQL = "select id, name, pubyear, round(mf, 6) as median_fair_score_3yr, round(mc, 6) as median_cit_weight_3yr, round(mm, 6) as median_men_weight_3yr, nf as n_fair, nc as n_cit, nm as n_men"


def _factors(df: DataFrame) -> DataFrame:
    return df.select("id", "name", "pubyear", _r("median_fair_score_3yr"), _r("median_cit_weight_3yr"), _r("median_men_weight_3yr"), "n_fair", "n_cit", "n_men")


@query(with_views("t_factors", last=FACTOR_SQL + " from t_factors"))
def norm_factors_topics(spark: SparkSession, d: str) -> DataFrame:
    return _factors(metrics.topic_factors(checkpoint(_metrics(spark, d))))


@query(with_views("s_factors", last=FACTOR_SQL + " from s_factors"))
def norm_factors_subfields(spark: SparkSession, d: str) -> DataFrame:
    return _factors(metrics.subfield_factors(checkpoint(_metrics(spark, d))))


@query(with_views("t_floored", last=FACTOR_SQL + ", cit_is_floored, men_is_floored, fair_is_floored from t_floored"))
def floored_factors(spark: SparkSession, d: str) -> DataFrame:
    out = metrics.floored_factors(metrics.topic_factors(checkpoint(_metrics(spark, d))))
    return out.select("id", "name", "pubyear", _r("median_fair_score_3yr"), _r("median_cit_weight_3yr"), _r("median_men_weight_3yr"), "n_fair", "n_cit", "n_men", "cit_is_floored", "men_is_floored", "fair_is_floored")


def _indexed(spark, d, extra: DataFrame | None = None) -> DataFrame:
    rows = checkpoint(_metrics(spark, d))
    return metrics.dataset_index(rows, checkpoint(metrics.floored_factors(metrics.topic_factors(rows))), checkpoint(metrics.floored_factors(metrics.subfield_factors(rows))))


def _label(year: str) -> str:
    return f"case when {year} is null then 'Default' when {year} = pubyear then 'Exact Year' else 'Closest Past Year' end"


INDEX_SQL = with_views("indexed", last=f"""select dataset_id, pubyear, topic_id, subfield_id, round(tf, 6) as t_norm_fair, round(tc, 6) as t_norm_cit, round(tm, 6) as t_norm_men, pubyear - ty as t_norm_gap, {_label('ty')} as t_source, round(sf, 6) as s_norm_fair, round(sc, 6) as s_norm_cit, round(sm, 6) as s_norm_men,
    pubyear - sy as s_norm_gap, {_label('sy')} as s_source, round(it, 6) as dataset_index_topic, round(ix, 6) as dataset_index_subfield from indexed""")


@query(INDEX_SQL)
def dataset_index(spark: SparkSession, d: str) -> DataFrame:
    out = _indexed(spark, d)
    return out.select("dataset_id", "pubyear", "topic_id", "subfield_id", *[c for p in ("t", "s") for c in (_r(f"{p}_norm_fair"), _r(f"{p}_norm_cit"), _r(f"{p}_norm_men"), F.col(f"{p}_norm_gap"), F.col(f"{p}_source"))], _r("dataset_index_topic"), _r("dataset_index_subfield"))


def _creators(spark, d) -> DataFrame:
    rows = view(spark, d, "v_creators")
    struct = F.struct("s_suppkey", F.col("name"), F.col("name_type"), F.when(F.col("identifier").isNotNull(), F.array("identifier")).alias("identifiers"), F.when(F.col("affiliation").isNotNull(), F.array("affiliation")).alias("affiliations"))
    return metrics.creators(rows.groupBy("dataset_id").agg(F.array_sort(F.collect_list(struct)).alias("creators")))


@query(with_views("parsed", last="select dataset_id, creator_name, name_type, affiliation, primary_identifier from parsed"))
def creators_parsed(spark: SparkSession, d: str) -> DataFrame:
    return _creators(spark, d).select("dataset_id", "creator_name", "name_type", F.array_join("affiliations", ",").alias("affiliation"), "primary_identifier")


AUTHOR_MODES = {"clean_name": "display_name", "name_type": "name_type", "topic_id": "primary_topic_id", "topic_name": "primary_topic_name", "subfield_id": "primary_subfield_id", "subfield_name": "primary_subfield_name"}
_AUTHORS = with_views("authors", last="") .rstrip() + ",\n" + ",\n".join(map(_mode_sql, AUTHOR_MODES)) + """,
flat as (select gid, list_sort(list_distinct(flatten(list(affils)))) as aff from authors where affils is not null group by gid),
grouped as (select gid, max(primary_identifier) as primary_identifier, count(distinct topic_id) as n_unique_topics, count(distinct subfield_id) as n_unique_subfields, min(pubyear) as first_pub_year, max(pubyear) as last_pub_year, count(*) as n_datasets,
  round(sum(it), 6) as S_index_topics, round(sum(ix), 6) as S_index_subfield, round(avg(it), 6) as avg_dataset_index_topics, round(avg(ix), 6) as avg_dataset_index_subfield, round(sum(total_cit_weight), 6) as total_cit_weight, round(sum(total_men_weight), 6) as total_men_weight,
  cast(sum(total_citations) as bigint) as sum_total_citations, cast(sum(total_mentions) as bigint) as sum_total_mentions, round(avg(fair_score), 6) as avg_fair_score from authors where primary_identifier is not null or clean_name is not null group by gid),
answer as (select g.gid as distinct_group_id, case when g.primary_identifier is not null then 'identifier' else 'name_affiliation' end as grouping_method, coalesce(array_to_string(aff, '|'), '') as all_affiliations, """ + ", ".join(f"m_{c}.v as {n}" for c, n in AUTHOR_MODES.items()) + ", g.* exclude (gid) from grouped g left join flat on flat.gid is not distinct from g.gid " + " ".join(f"left join mode_{c} m_{c} on m_{c}.gid is not distinct from g.gid" for c in AUTHOR_MODES) + ")\n"  # fmt: skip


def _authors(spark, d) -> DataFrame:
    out = metrics.author_index(_creators(spark, d), _indexed(spark, d))
    rounded = ["S_index_topics", "S_index_subfield", "avg_dataset_index_topics", "avg_dataset_index_subfield", "total_cit_weight", "total_men_weight", "avg_fair_score"]
    return out.withColumns({**{c: F.round(c, 6) for c in rounded}, "all_affiliations": F.array_join("all_affiliations", "|")})


@query(_AUTHORS + "select * from answer")
def author_index(spark: SparkSession, d: str) -> DataFrame:
    return _authors(spark, d)


@query(_AUTHORS + "select * from answer where not (name_type = 'Organizational' or display_name = 'GBIF.Org User')")
def author_index_people(spark: SparkSession, d: str) -> DataFrame:
    return metrics.people_only(_authors(spark, d))
