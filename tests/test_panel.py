import pytest
from pyspark.sql import functions as F

from blockrisk.operators import aggregates as A
from blockrisk.operators import panel as P
from tests.conftest import rows

COUNTS = [("a", 2010, 2), ("a", 2011, 5), ("a", 2013, 1), ("b", 2012, 4)]


@pytest.fixture()
def counts(spark):
    return spark.createDataFrame(COUNTS, "GISJOIN string, Year int, n long")


@pytest.fixture()
def blocks(spark):
    return spark.createDataFrame([("a",), ("b",), ("c",)], "GISJOIN string")


def test_target_is_the_count_of_the_year_after(spark, counts, blocks):
    spine = P.year_spine(blocks, 2010, 2013)
    panel = P.join_counts_and_targets(spine, counts, {"n": "next"}, last_complete_year=2013)
    got = {(b, y): (n, t) for b, y, n, t in rows(panel, "GISJOIN", "Year", "n", "next")}
    actual = {(b, y): n for b, y, n in COUNTS}
    for (b, y), (n, t) in got.items():
        assert n == actual.get((b, y), 0)
        assert t == (actual.get((b, y + 1), 0) if y < 2013 else None)
    assert len(got) == 12


def test_target_without_known_years_stays_null_where_no_count(spark, counts, blocks):
    spine = P.year_spine(blocks, 2010, 2011)
    one = P.join_counts_and_targets(spine, counts, {"n": "next"})
    keys = ["GISJOIN", "Year"]
    shifted = P.shift_to_target(counts, {"n": "next"})
    two = P.left_fill(spine, counts, keys).join(shifted, keys, "left")
    columns = [*keys, "n", "next"]
    assert rows(one, *columns) == rows(two, *columns)
    assert ("c", 2010, 0, None) in rows(one, *columns)


def test_observed_years_only(spark, counts, blocks):
    years = {r["Year"] for r in P.observed_year_spine(blocks, counts).collect()}
    assert years == {2010, 2011, 2012, 2013}


def test_merges(spark, counts, blocks):
    other = spark.createDataFrame([("b", 1), ("z", 2)], "GISJOIN string, m int")
    assert rows(P.outer_merge(blocks, other, ["GISJOIN"]))[-1] == ("z", 2)
    assert rows(P.inner_merge(blocks, other, ["GISJOIN"])) == [("b", 1)]
    assert rows(P.natural_join(blocks, other)) == [("b", 1)]
    assert rows(P.semi_join(blocks, other, "GISJOIN")) == [("b",)]
    renamed = other.withColumnRenamed("GISJOIN", "GISJOI")
    assert ("b", 1) in rows(P.join_renamed(blocks, renamed, "GISJOIN", "GISJOI"))
    with pytest.raises(ValueError):
        P.natural_join(blocks, spark.range(1))


def test_null_keys_belong_to_no_group(spark):
    df = spark.createDataFrame([("a", 1), (None, 1), ("a", 1)], "k string, v int")
    assert rows(A.count_per(df, ["k"], "n")) == [("a", 2)]


def test_shares_sum_to_one_and_merge(spark):
    df = spark.createDataFrame([("a", c) for c in "ABBX"] + [("b", None), ("b", "A")], "k string, c string")
    got = rows(A.pivot_shares(df, ["k"], "c", ["A", "B", "X"], {"S": ["X"]}), "k", "A", "B", "S")
    assert got == [("a", 0.25, 0.5, 0.25), ("b", 1.0, 0.0, 0.0)]


def test_single_row_has_no_deviation(spark):
    df = spark.createDataFrame([("a", 1900), ("b", 1900), ("b", 1910)], "k string, v int")
    got = {r["k"]: r["sd"] for r in A.spread_stats(df, ["k"], "v").collect()}
    assert got["a"] is None and got["b"] == pytest.approx(50 ** 0.5)


def test_yearly_description_cuts_the_last_year(spark, counts):
    got = A.describe_yearly(counts, "Year", ["n"]).first()
    assert (got["count"], got["mean"], got["q50"], got["max"]) == (3, pytest.approx(11 / 3), 4.0, 5.0)
    assert A.mean_of_yearly_sums(counts, "Year", ["n"]).first()[0] == pytest.approx(11 / 3)


def test_null_policy(spark):
    df = spark.createDataFrame(
        [(1, None, 2.0, None), (2, None, None, 1.0), (3, 0.5, 4.0, None)],
        "k int, S double, v double, SF_pred double",
    )
    whole = A.fill_nulls(df, {"S": 1.0, "absent": 0.0}, keep=["k", "SF_pred"])
    assert rows(whole) == [(1, 1.0, 2.0, None), (2, 1.0, 3.0, 1.0), (3, 0.5, 4.0, None)]
    fitted = A.fill_nulls(df, {}, keep=["k", "S", "SF_pred"], fit_on=F.col("k") < 3)
    assert rows(fitted, "v") == [(2.0,), (2.0,), (4.0,)]


def test_profiles(spark):
    df = spark.createDataFrame([("a", None), ("a", 1), ("b", 2)], "k string, v int")
    assert A.null_profile(df).first().asDict() == {"k": 0, "v": 1}
    assert rows(A.count_profile(df, ["k"])) == [("a", 1), ("b", 1)]
