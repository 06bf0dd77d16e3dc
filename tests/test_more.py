"""Free-form dates, late records of a stream, series of requests, and reports on edge cases."""

import datetime
import os

import pytest

from orrerium.functions import dates
from orrerium.operators.asof import asof_left_join
from orrerium.plans import evidence, harvests, metrics
from orrerium.sources import readers
from orrerium.streaming import incremental


@pytest.mark.parametrize(
    "raw,iso",
    [
        ("March 5, 2019", "2019-03-05"), ("Mar. 5 2019", "2019-03-05"), ("5 Mar 2019", "2019-03-05"), ("5th of 2019", None), ("3rd Sept, 2019", "2019-09-03"), ("Jan 2020", "2020-01-01"),
        ("03/05/2019", "2019-03-05"), ("25/12/2019", "2019-12-25"), ("25.12.2019", "2019-12-25"), ("13/13/2019", None), ("2020.05.06", "2020-05-06"), ("2020 May 6", "2020-05-06"),
        ("6-May-2020", "2020-05-06"), ("30 Feb 2020", None), ("Feb 2020 x", None), ("2019", "2019-01-01"), ("2019/4/4", "2019-04-04"), ("", None), (None, None), ("tomorrow", None),
    ],
)
def test_dates_in_many_writings(spark, raw, iso):
    found = spark.createDataFrame([(raw,)], "raw string").select(dates.norm_date_iso("raw")).first()[0]
    assert found == (iso and f"{iso}T00:00:00")


def test_a_late_record_is_left_out_of_daily_counts(spark, tmp_path):
    schema = "ts timestamp, event_type string"
    day = lambda n: datetime.datetime(2024, 3, 1) + datetime.timedelta(days=n)
    batches = [[(day(0), "a"), (day(30), "a")], [(day(30), "a"), (day(24), "b")], [(day(1), "a"), (day(31), "a"), (day(30), "a")]]
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        for file in (tmp_path / "in").glob("part-*.parquet"):
            if not file.name.startswith("part-x"):
                file.rename(file.with_name(f"part-x{n}.parquet"))
                os.utime(tmp_path / "in" / f"part-x{n}.parquet", (1_700_000_000 + n * 60,) * 2)
    got = {(r.day.day + 31 * (r.day.month - 3), r.event_type): r.n for r in incremental.daily_counts(spark, str(tmp_path / "in"), spark.read.parquet(str(tmp_path / "in")).schema, files=1).collect()}
    assert got == {(1, "a"): 1, (31, "a"): 3, (25, "b"): 1, (32, "a"): 1}


def test_series_of_an_unknown_request(spark):
    asked = spark.createDataFrame([("https://doi.org/10.5555/A",), ("10.5555/a",), ("http://x.example/y",), ("",)], "request string")
    known = spark.createDataFrame([("10.5555/a", 2000, "S1", 50.0)], "dataset_id string, pubyear int, subfield_id string, score double")
    event = lambda kind: spark.createDataFrame([("10.5555/a", 2001, 2.0), ("10.5555/other", 2001, 9.0)], f"dataset_id string, {kind}_year int, {kind}_weight double")
    factors = spark.createDataFrame(
        [("S1", "s", 1999, 25.0, 2.0, 4.0), (metrics.DEFAULT, "d", None, 10.0, 1.0, 1.0)], "id string, name string, pubyear int, median_fair_score_3yr double, median_cit_weight_3yr double, median_men_weight_3yr double"
    )
    out = metrics.series_of_requests(asked, known, known, known, event("citation"), event("mention"), factors, 2025)
    got = {(r.dataset_id, r.year): r.dataset_index for r in out.collect()}
    assert got == pytest.approx({("10.5555/a", 2000): 2 / 3, ("10.5555/a", 2001): (2 + 1 + 0.5) / 3, ("http://x.example/y", 2025): 0.0})


def test_as_of_join_needs_no_look_at_its_input(spark):
    left = spark.createDataFrame([("a", 5), ("a", 1), ("b", 5), (None, 5)], "k string, t int")
    right = spark.createDataFrame([("a", 2, "x"), ("a", 5, "y"), (None, 1, "z")], "rk string, rt int, v string")
    for small in (False, True):
        got = {(r.k, r.t): r.v for r in asof_left_join(left, right, "k", "t", "rk", "rt", small=small).collect()}
        assert got == {("a", 5): "y", ("a", 1): None, ("b", 5): None, (None, 5): None}


def test_reports_and_subfields_without_values(spark):
    raw = spark.createDataFrame([(None, None, "m", None)], "summary struct<score_percent:struct<FAIR:double>>, end_timestamp string, metric_version string, software_version string")
    assert raw.select(*harvests.fair_report()).first().asDict() == {"fair_score": None, "evaluation_date": None, "fuji_metric_version": "m", "fuji_software_version": None}
    topics = spark.createDataFrame([("d", "T1"), ("e", None), ("f", "T9")], "dataset_id string, topic_id string")
    mapping = spark.createDataFrame([("1", " 17 ", 2), ("T1", "18", 3), ("x", "19", 1)], "topic_id string, subfield_id string, seq int")
    assert {r.dataset_id: r.subfield_id for r in evidence.with_subfield(topics, mapping).collect()} == {"d": "17", "e": None, "f": None}


def test_broken_lines_are_counted(spark, tmp_path):
    (tmp_path / "a.ndjson").write_text('{"a": 1}\n{"a": \n{"b": 2}\n')
    rows = readers.ndjson(spark, str(tmp_path), "a int", keep_bad=True)
    assert tuple(readers.bad_line_count(rows).first()) == (3, 1)
    assert [r.a for r in rows.orderBy("a").collect() if r[readers.BAD] is None] == [None, 1]
