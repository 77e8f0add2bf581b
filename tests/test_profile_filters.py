"""Profiles and filters on inline edge rows."""

from narrata.operators import filters as FL
from narrata.operators import profile as P
from tests.conftest import rows


def test_length_bins_edges(spark):
    df = spark.createDataFrame([(n,) for n in (0, 99, 100, 299, 300, 599, 600, 999, 1000)], "wc long")
    got = dict(rows(P.bin_counts(df, "wc"), "bin", "frequency"))
    assert got == {"<100": 2, "100-300": 2, "301-600": 2, "601-1000": 2, ">1000": 1}


def test_length_bins_zero_filled(spark):
    df = spark.createDataFrame([(5,)], "wc long")
    got = dict(rows(P.bin_counts(df, "wc"), "bin", "frequency"))
    assert got[">1000"] == 0 and got["<100"] == 1


def test_threshold_counts_strict(spark):
    df = spark.createDataFrame([(511,), (512,), (513,)], "wc long")
    assert rows(P.threshold_counts(df, "wc", 512)) == [(1, 1)]


def test_exclude_label_keeps_null(spark):
    df = spark.createDataFrame([("In progress",), (None,), ("Closed",)], "r string")
    assert sorted(rows(FL.exclude_label(df, "r", "In progress")), key=str) == [("Closed",), (None,)]


def test_not_in_keeps_null(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",)], "r string")
    assert sorted(rows(FL.not_in_values(df, "r", ["a"])), key=str) == [("b",), (None,)]


def test_keep_frequent_drops_null_and_rare(spark):
    df = spark.createDataFrame([("a",)] * 6 + [("b",)] * 2 + [(None,)] * 7, "r string")
    assert rows(FL.keep_frequent(df, "r", 5).distinct()) == [("a",)]


def test_outside_oversized_keeps_null(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)] + [(None,)], "r string")
    got = sorted(rows(FL.outside_oversized(df, "r", 2)), key=str)
    assert got == [("b",), (None,)]


def test_dropna_columns(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "y", "z")], "a long, b string, c string")
    assert FL.dropna_columns(df).columns == ["a", "c"]


def test_validate_raises(spark):
    import pytest
    df = spark.createDataFrame([(1, None)], "a long, t string")
    with pytest.raises(ValueError):
        P.validate(df, ["a", "missing"])
    with pytest.raises(ValueError):
        P.validate(df, ["a", "t"], target="t")


def test_histogram_of_one_value_and_of_none(spark):
    df = spark.createDataFrame([(7.0,), (7.0,), (None,)], "x double")
    got = rows(P.histogram(df, "x", 4), "bin", "lower", "upper", "count")
    assert sorted(got) == [(0, 7.0, 7.0, 2), (1, 7.0, 7.0, 0), (2, 7.0, 7.0, 0), (3, 7.0, 7.0, 0)]
    assert rows(P.histogram(df.filter("x IS NULL"), "x", 4)) == []
    even = spark.createDataFrame([(float(i),) for i in range(9)], "x double")
    assert [r[3] for r in sorted(rows(P.histogram(even, "x", 4)))] == [2, 2, 2, 3]


def test_distinct_values_by_appearance(spark):
    df = spark.createDataFrame([(3, "a"), (1, "c"), (2, "b"), (5, "c"), (0, None)], "k int, v string")
    assert rows(P.distinct_in_order(df, "v", "k")) == [("c", 1), ("b", 2), ("a", 3)]
    assert rows(P.distinct_values(df, "v")) == [("a",), ("b",), ("c",)]
