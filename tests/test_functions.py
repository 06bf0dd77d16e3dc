"""Identifiers, dates, weights and text against the values that the rules give by hand."""

import math

import pytest
from pyspark.sql import functions as F

from orrerium.functions import dates, ids, text, weights


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f("x").alias("y")).first().y


@pytest.mark.parametrize(
    "raw,doi,dataset",
    [
        ("10.1000/ABC.DEF", "10.1000/abc.def", None), ("doi:10.1000/Foo-Bar", "10.1000/foo-bar", None), ("see (https://dx.doi.org/10.1000/XYZ).", "10.1000/xyz", None),
        ("https://doi.org/10.1000/XYZ?param=1", "10.1000/xyz?param=1", None), ("10.1000/foo%2Fbar", "10.1000/foo/bar", None), ("10.1000/a+b", "10.1000/a+b", None), ("10.123/x", "", "10.123/x"),
        (" emd-24511 ", "", "EMD-24511"), ("EMD-1234567", "", "EMD-12345"), (" SQ22536 ", "", "sq22536"), (None, "", ""), (" \t", "", ""), ("10.1000/a%zz", "10.1000/a%zz", None),
    ],
)
def test_identifiers(spark, raw, doi, dataset):
    assert one(spark, raw, ids.norm_doi) == doi
    assert one(spark, raw, ids.norm_dataset_id) == (doi if dataset is None else dataset)


def test_people_and_links(spark):
    for raw, want in [("https://orcid.org/0000-0001-2345-6789", "0000-0001-2345-6789"), ("0000‐0001‐2345‐6789", "0000-0001-2345-6789"), ("0000-0001-2345-678X", None), ("x", None), (None, None)]:
        assert one(spark, raw, ids.norm_orcid) == want
    for raw, want in [("https://orcid.org/0000-A", "0000-a"), ("orcid:0000-1 ", "0000-1"), ("ORCID:1", "orcid:1"), ("", ""), (None, None)]:
        assert one(spark, raw, ids.creator_identifier) == want
    for raw, want in [("http://a/#s", "http://a"), ("http://a//", "http://a"), (" http://a/b ", "http://a/b"), ("#x", "")]:
        assert one(spark, raw, ids.clean_link) == want
    for raw, want in [("https://e.org/x", True), ("HTTP://e.org", True), ("ftp://e.org", False), ("e.org", False), (None, False)]:
        assert one(spark, raw, ids.is_url) is want
    pairs = spark.sql("select array(named_struct('identifier','a','identifier_type','DOI'), named_struct('identifier','a','identifier_type','doi'), named_struct('identifier','','identifier_type','x')) as x")
    assert [tuple(r) for r in pairs.select(ids.unique_pairs("x").alias("y")).first().y] == [("a", "doi")]


@pytest.mark.parametrize("raw,want", [("2024", "2024-01-01T00:00:00"), ("2024-05", "2024-05-01T00:00:00"), ("20240101", "2024-01-01T00:00:00"), ("2025/04/04", "2025-04-04T00:00:00"), ("2025-04-04T13:22:55Z", "2025-04-04T13:22:55+00:00"), ("2024-4-43", None), ("2024-02-30", None), ("", None), ("12", None), (None, None)])
def test_dates(spark, raw, want):
    assert one(spark, raw, dates.norm_date_iso) == want


def test_more_dates(spark):
    assert str(one(spark, "2024/5/1", dates.try_date)) == "2024-05-01" and one(spark, "2024-05", dates.try_date) is None and str(one(spark, "2024-05-01T23:00:00-05:00", dates.try_date)) == "2024-05-01"
    assert one(spark, "1949-12-31T00:00:00", lambda c: dates.realistic_date(c, "2025-01-01")) is None and one(spark, "2025-01-01T05:00:00", lambda c: dates.realistic_date(c, "2025-01-01")) == "2025-01-01T05:00:00"
    assert one(spark, [2024, 2], dates.date_of_parts, "array<int>") == "2024-02-01T00:00:00" and one(spark, [2024, 13], dates.date_of_parts, "array<int>") is None
    assert one(spark, "no", lambda c: dates.search_format(dates.published_at(c))) == "1970-01-01T00:00:00.000+00:00"
    assert one(spark, "2024-05-01T10:00:00+02:00", lambda c: dates.search_format(dates.published_at(c))) == "2024-05-01T08:00:00.000+00:00"


def test_weights(spark):
    for years, want in [(0, 1.0), (1, 1.23), (2, 1.36), (3, 1.46), (4, 1.53), (5, 1.59), (10, 1.79), (20, 2.0), (-3, 1.0), (None, 1.0)]:
        assert one(spark, years, lambda c: weights.evidence_weight(F.lit(0), c), "int") == want
    index = lambda fair, t: spark.range(1).select(weights.dataset_index(F.lit(fair), F.lit(2.0), F.lit(3.0), t).alias("y")).first().y
    assert math.isclose(index(50.0, None), (50 / 13.46 + 5) / 3) and math.isclose(index(50.0, F.lit(0.0)), (50 / 13.46 + 5) / 3) and math.isclose(index(50.0, F.lit(25.0)), (2 + 5) / 3)
    with pytest.raises(Exception, match="out of range"):
        index(101.0, None)


def test_text(spark):
    assert one(spark, "EMD-1234 emd-12345 EMD-123456", text.emdb_in) == ["EMD-1234", "EMD-12345"]
    for raw, want in [("https://doi.org/10.1/(a)b))", "10.1/(a)b"), ("doi: 10.1/a.,;", "10.1/a"), ("10.1/a((", "10.1/a"), ("10.1/{x}", "10.1/{x}")]:
        assert one(spark, raw, text.clean_doi) == want
    assert one(spark, "[p](https://doi.org/10.1234/x) DOI: 10.1234/y; 10.1234/z.", text.readme_dois) == ["10.1234/x", "10.1234/y", "10.1234/z"]
    for raw, want in [("https://doi.org/10.1234/AB.pdf", "10.1234/ab"), ("10.1234/ab?x=1#y", "10.1234/ab"), ("10.1234/ab/figures/pdf", "10.1234/ab"), ("10.1101/2020.01.01v1.full", "10.1101/2020.01.01v1"), ("nothing", None), (None, None)]:
        assert one(spark, raw, text.readme_doi_cleaned) == want
    assert one(spark, "docs/README.md", text.is_root_readme) is False and one(spark, "ReadMe.md", text.is_root_readme) is True
    assert one(spark, '["B, C","A"]', text.affiliation_list) == ["B", "C", "A"]
