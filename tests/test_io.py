"""Readers, writers, the paged data source and streams."""

import json
import zipfile

import pyarrow as pa
import pyarrow.parquet as pq

from orrerium.schemas import FAIR, SLIM
from orrerium.sources import pages, readers, writers
from orrerium.streaming import incremental


def test_ndjson(spark, tmp_path):
    (tmp_path / "in" / "deep").mkdir(parents=True)
    (tmp_path / "in" / "a.ndjson").write_text('{"dataset_id": "a", "score": 1.5}\n\nnot json\n')
    (tmp_path / "in" / "deep" / "b.ndjson").write_text('{"dataset_id": "b"}\n')
    assert {(r.dataset_id, r.score) for r in readers.ndjson(spark, str(tmp_path / "in"), FAIR).collect()} == {("a", 1.5), ("b", None)}
    rows = readers.ndjson(spark, str(tmp_path / "in"), FAIR, keep_bad=True).cache()
    assert tuple(readers.bad_line_count(rows).first()) == (3, 1)
    writers.ndjson(readers.ndjson(spark, str(tmp_path / "in"), FAIR).coalesce(1), str(tmp_path / "out"), lines=1)
    files = sorted((tmp_path / "out").glob("part-*"))
    assert len(files) == 2 and sorted(json.loads(f.read_text()).get("score", 0) for f in files) == [0, 1.5]
    assert spark.createDataFrame([], SLIM).columns[0] == "source"


def test_mapping_folders_and_arrays(spark, tmp_path):
    (tmp_path / "m.csv").write_text("﻿ topic_id , topic_name\nT1, one\nT1, two\n", encoding="utf-8")
    assert [tuple(r) for r in readers.mapping(spark, str(tmp_path / "m.csv")).select("topic_id", "topic_name").collect()] == [("T1", "one"), ("T1", "two")]
    for n in (0, 1):
        spark.range(n, n + 2).write.parquet(str(tmp_path / f"f{n}"))
    assert sorted((r.id, r.folder_rank) for r in readers.ranked_folders(spark, [str(tmp_path / "f1"), str(tmp_path / "f0")]).collect()) == [(0, 1), (1, 0), (1, 1), (2, 0)]
    (tmp_path / "x.json").write_text('[{"dataset_id": "a"}, {"dataset_id": "b"}]')
    assert readers.json_arrays(spark, str(tmp_path / "x.json"), FAIR).count() == 2


def test_patents(spark, tmp_path):
    doc = '<?xml version="1.0"?>\n<p><publication-reference><document-id><doc-number>0{0}</doc-number><date>20240102</date></document-id></publication-reference><d>see 10.1234/AB{0}. and EMD-1234</d>{1}\n'
    with zipfile.ZipFile(tmp_path / "ipg240102.zip", "w") as z:
        z.writestr("ipg.xml", doc.format(1, "</p>") + doc.format(2, "<broken") + '<?xml version="1.0"?>\n<p>none</p>\n')
    documents = readers.patents(spark, str(tmp_path))
    assert documents.count() == 3
    got = {r.patent_id: (r.mention_link, r.mention_date, r.doi, r.emdb_id, r.source_file) for r in readers.patent_records(documents).collect()}
    assert got["01"] == ("https://patents.google.com/patent/US1", "20240102", ["10.1234/ab1"], ["EMD-1234"], "ipg240102.zip") and set(got) == {"01", "02"}


def test_writers(spark, tmp_path):
    days = spark.sql("select date'2024-01-01' as day, 1 as n union all select date'2024-01-02', 2")
    writers.day_partitions(days, str(tmp_path / "days"))
    writers.day_partitions(days.filter("n = 2").selectExpr("day", "n * 10 as n"), str(tmp_path / "days"))
    assert sorted(r.n for r in spark.read.parquet(str(tmp_path / "days")).collect()) == [1, 20]
    good, bad = writers.sorted_out(days, {"small": "n < 2", "known": "n is not null"})
    assert good.count() == 1 and bad.first().failed == ["small"]
    writers.publish(days, str(tmp_path / "load"), {"source": "s"})
    assert writers.published(spark, str(tmp_path / "load")) == {"records": 2, "source": "s"}
    writers.csv(days, str(tmp_path / "csv"))
    assert spark.read.option("header", "true").csv(str(tmp_path / "csv")).count() == 2
    writers.replace_table(days, "t_days")
    writers.append_table(days, "t_days")
    assert spark.table("t_days").count() == 4
    (tmp_path / "l.txt").write_text("a\n\n b\n")
    writers.joined_lines(spark, [str(tmp_path / "l.txt")], str(tmp_path / "lines"))
    assert spark.read.text(str(tmp_path / "lines")).count() == 2


def recorded(window, cursor, size):
    """Three pages for each window; a page of more than 300 records times out."""
    if size > 300:
        raise TimeoutError
    n = int(cursor or 0)
    return [{"id": f"{window}-{n}-{i}"} for i in range(2)], str(n + 1) if n < 2 else None


def test_pages(spark):
    assert len(list(pages.records(recorded, "w"))) == 6
    spark.dataSource.register(pages.Pages)
    rows = spark.read.format("pages").option("provider", "tests.test_io:recorded").option("windows", json.dumps(["a", "b"])).load()
    assert rows.count() == 12 and rows.select("window").distinct().count() == 2


def test_streams_load_once(spark, tmp_path):
    folder, schema = tmp_path / "in", spark.createDataFrame([], "k string, v int").schema
    folder.mkdir()
    put = lambda name, keys: pq.write_table(pa.table({"k": keys, "v": pa.array(range(len(keys)), pa.int32())}), folder / name)
    put("1.parquet", ["a", "b", "a"])
    load = lambda: sorted(r.k for r in incremental.load_new(spark, str(folder), schema, ["k"], str(tmp_path / "t"), str(tmp_path / "c")).collect())
    assert load() == ["a", "b"] and load() == ["a", "b"]
    put("2.parquet", ["b", "c"])
    assert load() == ["a", "b", "c"]
