"""Merges, medians, floors, indices and authors on small tables with results worked out by hand."""

import itertools
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from orrerium.operators import incremental
from orrerium.operators.asof import asof_left_join
from orrerium.operators.merge import merge_evidence
from orrerium.plans import evidence, harvests, metrics
from orrerium.schemas import CITATION_BLOCK

EVIDENCE = "dataset_id string, citation_link string, source array<string>, citation_year int, citation_weight double, citation_date string, placeholder_year boolean, placeholder_date boolean, seq int"


def test_merge(spark):
    rows = [("d1", "http://a/#s", ["mdc"], 2021, 1.36, None, False, False, 1), ("d1", "http://a", ["openalex"], 2020, 1.23, None, False, False, 2), ("d1", "http://a/", ["datacite"], 2020, 9.9, None, False, False, 3), ("d1", "http://b", ["mdc"], None, 1.0, None, True, True, 4), (None, "http://c", ["mdc"], 2020, 1.0, None, False, False, 5), ("d2", "", ["mdc"], 2020, 1.0, None, False, False, 6)]
    got = {(r.dataset_id, r.citation_link): (r.source, r.citation_year, r.citation_weight) for r in merge_evidence(spark.createDataFrame(rows, EVIDENCE), "citation", ["seq"]).collect()}
    assert got == {("d1", "http://a"): (["datacite", "mdc", "openalex"], 2020, 1.23), ("d1", "http://b"): (["mdc"], None, 1.0)}


METRICS = "dataset_id string, topic_id string, topic_name string, subfield_id string, subfield_name string, pubyear int, fair_score double, total_cit_weight double, total_men_weight double"
ROWS = [("A", "T1", "one", "S", "s", 2018, 50.0, 2.0, 1.0), ("B", "T1", "one", "S", "s", 2019, None, 4.0, 0.0), ("C", "T2", None, "S", "s", 2021, 10.0, 0.0, 3.0), ("D", None, None, None, None, 2018, 30.0, 6.0, 0.0)]


def test_factors_floors_and_index(spark):
    rows = spark.createDataFrame(ROWS, METRICS)
    factors = metrics.topic_factors(rows)
    got = {(r.id, r.pubyear): (r.median_fair_score_3yr, r.n_fair, r.median_cit_weight_3yr, r.n_cit, r.median_men_weight_3yr, r.n_men) for r in factors.collect()}
    assert got == {
        (None, None): (30, 3, 3, 4, 0.5, 4), ("T1", None): (50, 1, 3, 2, 0.5, 2), ("T2", None): (10, 1, 0, 1, 3, 1), (None, 2021): (40, 2, 4, 3, 0, 3), ("T1", 2021): (50, 1, 3, 2, 0.5, 2),
        ("T2", 2021): (None, 0, None, 0, None, 0), (None, 2022): (10, 1, 4, 1, 0, 1), ("T1", 2022): (None, 0, 4, 1, 0, 1), ("T2", 2022): (10, 1, None, 0, None, 0),
    }
    assert {r.name for r in factors.collect()} == {None, "one", "Unknown"}
    floors = metrics.floored_factors(factors)
    default = floors.filter("id = 'DEFAULT'").first()
    assert (default.median_cit_weight_3yr, default.median_fair_score_3yr, default.fair_is_floored) == (1.0, 13.46, True)
    out = {r.dataset_id: r for r in metrics.dataset_index(rows, floors, metrics.floored_factors(metrics.subfield_factors(rows))).collect()}
    assert {k: (r.t_source, r.t_norm_gap) for k, r in out.items()} == {"A": ("Default", None), "B": ("Default", None), "C": ("Exact Year", 0), "D": ("Default", None)}
    for k, want in {"A": 2.238237, "B": None, "C": 1.247647, "D": 2.742942}.items():
        assert out[k].dataset_index_topic is None if want is None else math.isclose(out[k].dataset_index_topic, want, abs_tol=1e-6)


@pytest.mark.parametrize("years", [(2018, 2019), (2018,), (2000, 2004, 2009), (1990, 1991, 1993)])
def test_factors_equal_a_loop(spark, years):
    rng = random.Random(len(years))
    rows = [(str(i), rng.choice(["T1", "T2", None]), "n", "S", "s", rng.choice([*years, None]) if i > 3 else years[i % len(years)], rng.choice([None, rng.uniform(0, 100)]), rng.uniform(0, 9), rng.uniform(0, 9)) for i in range(40)]
    got = {(r.id, r.pubyear): (r.median_fair_score_3yr, r.median_cit_weight_3yr, r.n_fair, r.n_cit) for r in metrics.topic_factors(spark.createDataFrame(rows, METRICS)).collect()}
    rows = [r for r in rows if r[5] is not None]
    low, high = min(r[5] for r in rows), max(r[5] for r in rows)
    targets = list(range(low + 3, high + 2)) if low + 3 <= high + 2 else [high + 3]
    median = lambda xs: statistics.median(xs) if xs else None
    want = {}
    for group, year in itertools.product({None} | {r[1] for r in rows}, [None, *targets]):
        own = [r for r in rows if group is None or r[1] == group]
        fair = [r[6] for r in own if r[6] is not None and (year is None or year - 3 <= r[5] <= year - 1)]
        cit = [r[7] for r in own if year is None or year - 3 <= r[5] <= year - 2]
        want[group, year] = (median(fair), median(cit), len(fair), len(cit))
    assert got.keys() == want.keys()
    for k, w in want.items():
        assert all(a == b or math.isclose(a, b) for a, b in zip(got[k], w))


def test_asof_equals_a_loop(spark):
    rng = random.Random(1)
    left = [(i, rng.choice(["a", "b", None]), rng.choice([*range(20), None])) for i in range(200)]
    right = [(k, y, f"{k}{y}{n}") for k in ("a", "c", None) for y in (3, 7, 7, 12, None) for n in range(2)]
    l, r = spark.createDataFrame(left, "i int, k string, y int"), spark.createDataFrame(right, "rk string, ry int, v string")  # noqa: E741
    for small in (True, False, None):
        got = {x.i: x.v for x in asof_left_join(l, r, "k", "y", "rk", "ry", ties=[F.col("v")], small=small).collect()}
        assert len(got) == 200
        for i, k, y in left:
            fits = [(ry, v) for rk, ry, v in right if None not in (k, y, rk, ry) and rk == k and ry <= y]
            best = max((ry for ry, _ in fits), default=None)
            assert got[i] == min((v for ry, v in fits if ry == best), default=None)


def test_series(spark):
    data = spark.createDataFrame([("a", 2020, 0.0), ("b", None, 0.0), ("c", None, None)], "dataset_id string, pubyear int, fair_score double")
    events = spark.createDataFrame([("a", "citation", 2018, 3.0), ("a", "citation", 2022, 3.0), ("b", "mention", None, 6.0)], "dataset_id string, kind string, year int, weight double")
    out = [(r.dataset_id, r.year, r.dataset_index) for r in metrics.index_series(data, events, 2025).orderBy("dataset_id", "position").collect()]
    assert out == [("a", 2020, 1.0), ("a", 2018, 1.0), ("a", 2022, 2.0), ("b", 2025, 2.0), ("c", 2025, 0.0)]


def test_authors(spark):
    creator = lambda name, identifiers, affiliations: (name, "Personal", identifiers, affiliations)
    rows = [("d1", [creator("Ann", None, None), creator("X", ["https://orcid.org/0000-0001"], None)]), ("d2", [creator("Bob", None, None), creator("Y", ["orcid:0000-0001"], ["Z"])]), ("d3", [creator("Cy", None, ["B, C", "A"])]), ("d4", [creator("cy ", None, ["C", "A", "B"])]), ("d5", None)]
    df = spark.createDataFrame(rows, "dataset_id string, creators array<struct<name:string,name_type:string,identifiers:array<string>,affiliations:array<string>>>")
    index = df.withColumns({**{c: F.lit("t") for c in ("topic_id", "topic_name", "subfield_id", "subfield_name")}, "pubyear": F.lit(2000), **{c: F.lit(1.0) for c in ("dataset_index_topic", "dataset_index_subfield", "total_cit_weight", "total_men_weight", "fair_score")}, "total_citations": F.lit(1), "total_mentions": F.lit(1)})
    out = {r.distinct_group_id: r for r in metrics.author_index(metrics.creators(df), index).collect()}
    assert set(out) == {None, "0000-0001", "cy_[a, b, c]"} and out[None].n_datasets == 2 and out["cy_[a, b, c]"].S_index_topics == 2.0 and out["0000-0001"].grouping_method == "identifier"
    assert len(metrics.author_index(metrics.creators(df), index, "split").collect()) == 4


def test_topic_choice(spark):
    fields = "topic_id string, topic_name string, score double, subfield_id string, subfield_name string, field_id string, field_name string, domain_id string, domain_name string"
    side = lambda rows, t: spark.createDataFrame([(i, t, t, s, *[t] * 6) for i, s in rows], f"dataset_id string, {fields}")
    oa, model = side([("1", 0.6), ("2", 0.4), ("3", 0.4), ("4", 0.4), ("6", None)], "o"), side([("1", 0.9), ("2", 0.5), ("3", 0.4), ("5", 0.2)], "m")
    got = {r.dataset_id: (r.source, r.topic_id) for r in evidence.selected_topics(oa, model).collect()}
    assert got == {"1": ("openalex", "o"), "2": ("custom_model", "m"), "3": ("custom_model", "m"), "4": ("openalex", "o"), "5": ("custom_model", "m"), "6": ("custom_model", None)}


def test_block_citations_and_placeholders(spark):
    blocks = spark.createDataFrame([("10.5555/D", 2000, (["10.5555/A", "10.5555/a", "10.5555/b"], [(" u ", "url"), ("u", "url")])), ("10.5555/e", 2000, None)], f"dataset_id string, pubyear int, citations {CITATION_BLOCK}")
    known = spark.createDataFrame([("10.5555/a", "2003-05"), ("10.5555/b", "1800")], "doi string, pub_date string")
    got = {r.citation_link: (r.dataset_id, r.citation_weight, r.citation_date, r.placeholder_date, r.citation_year, r.placeholder_year) for r in harvests.block_citations(blocks, known, "2025-01-01").collect()}
    assert got == {"https://doi.org/10.5555/a": ("10.5555/d", 1.46, "2003-05-01T00:00:00", False, 2003, False), "https://doi.org/10.5555/b": ("10.5555/d", 1.0, "2026-01-01T00:00:00", True, 2026, True), "u": ("10.5555/d", 1.0, "2026-01-01T00:00:00", True, 2026, True)}


def test_windows_and_days(spark):
    got = [(str(r.first), str(r.last)) for r in incremental.harvest_windows(spark, "2023-12-28", "2024-01-10").collect()]
    assert got == [("2024-01-04", "2024-01-10"), ("2024-01-01", "2024-01-03"), ("2023-12-28", "2023-12-31")]
    days = incremental.day_list(spark, "2024-01-01", "2024-01-04")
    ledger = spark.sql("select 's' as source, date'2024-01-02' as day, true as loaded union all select 's', date'2024-01-03', false union all select 't', date'2024-01-01', true")
    pending = lambda **k: [str(r.day)[-2:] for r in incremental.pending_days(days, ledger, "s", **k).collect()]
    assert pending() == ["01", "03", "04"] and pending(newest_first=True, most=2) == ["04", "03"] and len(pending(force=True)) == 4
