"""Registered queries read all rows of their tables, held against rows worked out by hand."""

import pytest

from orrerium.plans import catalog, catalog_sources  # noqa: F401  (registers the queries)


@pytest.fixture
def tables(spark, tmp_path):
    """Writes tables given as SQL and returns the folder."""

    def write(**texts):
        for name, text in texts.items():
            spark.sql(text).write.parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)

    return write


def test_readmes_of_large_keys_are_read(spark, tables):
    d = tables(part="select explode(array(5, 89999, 90000, 250007)) as p_partkey")
    got = {r.p_partkey: (r.dois, r.emdb) for r in catalog.QUERIES["readme_mentions"](spark, d).collect()}
    dois = lambda k: f"10.5555/(DS){k} 10.5555/b.{k} 10.5555/c{k}"
    assert got == {5: (dois(5), "EMD-10005"), 89999: (dois(89999), "EMD-99999"), 90000: (dois(90000), "EMD-10000"), 250007: (dois(250007), "EMD-80007")}


PARTS = "select explode(sequence(0, 9)) as p_partkey, 'name' as p_name, 'brand' as p_brand"


@pytest.mark.parametrize("name,links,per_order", [("patent_mentions", "https://patents.example/", 2), ("model_card_mentions", "https://models.example/", 1), ("archive_mentions", "https://code.example/", 1)])
def test_mentions_come_from_every_order(spark, tables, name, links, per_order):
    d = tables(part=PARTS, orders="select explode(sequence(1, 40)) as o_orderkey, 1 as o_custkey, timestamp'1996-03-05 00:00:00' as o_orderdate")
    got = sorted((r.mention_link, r.dataset_id) for r in catalog.QUERIES[name](spark, d).collect())
    datasets = ["10.5555/ds.3", "10.5555/ds.4"] if per_order == 2 else ["10.5555/ds.1"]
    assert got == sorted((f"{links}{k}", i) for k in range(1, 41) for i in datasets)


def test_blocks_hold_every_line(spark, tables):
    d = tables(
        lineitem="select 1 as l_partkey, k as l_suppkey, k as l_orderkey, 1 + k % 5 as l_linenumber from (select explode(sequence(1, 8)) as k)",
        orders="select 1 as o_orderkey, 1 as o_custkey, timestamp'1996-03-05 00:00:00' as o_orderdate",
    )
    run = lambda name: catalog.QUERIES[name](spark, d).collect()
    assert {r.doi for r in run("cited_dois")} == {f"10.5555/pub.{k}" for k in (1, 2, 3, 5, 6, 7, 8)}
    assert {(r.dataset_id, r.citation_link) for r in run("block_citations")} == {("10.5555/ds.1", f"https://doi.org/10.5555/pub.{k}") for k in (1, 2, 3, 5, 6, 7, 8)} | {("10.5555/ds.1", "x:4")}
    assert [(r.dataset_id, r.dois) for r in run("new_block_links")] == [("10.5555/ds.1", "10.5555/PUB.1 10.5555/PUB.3 10.5555/PUB.5 10.5555/PUB.7")]


def test_every_dataset_gets_its_last_score(spark, tables):
    d = tables(
        part="select explode(sequence(1, 120)) as p_partkey, 'name' as p_name, 'brand' as p_brand",
        lineitem="select k as l_partkey, 1 as l_suppkey, o as l_orderkey, 1 as l_linenumber, cast(k % 90 + o as double) as l_extendedprice, 1.0 as l_quantity from (select explode(sequence(1, 110)) as k) cross join (select explode(array(1, 2)) as o)",
    )
    got = {r.dataset_id: (r.score, r.extrapolated) for r in catalog.QUERIES["fair_extrapolated"](spark, d).collect()}
    assert got == {f"10.5555/ds.{k}": (float(k % 90 + 2), False) if k <= 110 else (42.31, True) for k in range(1, 121)}


def test_asof_matches_every_event(spark, tables):
    d = tables(events="select id as event_id, 1 as user_id, timestamp_seconds(id) as ts, cast(id as double) as value from range(1, 11)")
    got = {r.event_id: r.bv for r in catalog.QUERIES["asof_events"](spark, d).collect()}
    assert got == {k: 1.0 if k < 6 else 6.0 for k in range(1, 11)}
