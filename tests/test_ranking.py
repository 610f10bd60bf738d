import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from blockrisk.ml.split import stratified_folds
from blockrisk.operators import ranking as R
from blockrisk.plans import risk
from tests.conftest import rows


def column(spark, values, name="v"):
    return spark.createDataFrame([(v,) for v in values], f"{name} double")


@pytest.mark.parametrize("values", [
    [1.0, 2.0, 4.0], [5.0], [3.0] * 50, [1.0, 1.0, 1.0, 9.0], [float(v) for v in range(997)],
])
def test_quantiles_equal_numpy(spark, values):
    qs = {"a": 0.0, "b": 0.05, "c": 0.5, "d": 0.95, "e": 1.0}
    got = R.quantiles(column(spark, [*values, None]), "v", qs).first()
    assert list(got) == pytest.approx([np.quantile(values, q) for q in qs.values()], abs=1e-12)


def test_below_quantile_is_strict(spark):
    assert rows(R.below_quantile(column(spark, [1.0, 2.0, 2.0, 2.0]), "v", 0.5)) == [(1.0,)]


def test_running_totals_over_two_keys(spark):
    rng = random.Random(3)
    data = sorted({(rng.choice("ab"), rng.randint(0, 4000)) for _ in range(3000)})
    df = spark.createDataFrame([(a, b, i % 7) for i, (a, b) in enumerate(data)], "a string, b int, w long").repartition(5)
    got = rows(R.running_totals(df, ["a", "b"], {"s": F.col("w")}, ranges=9), "a", "b", "s_before", "s_total")
    total, before, expected = sum(i % 7 for i in range(len(data))), 0, []
    for i, (a, b) in enumerate(data):
        expected.append((a, b, before, total))
        before += i % 7
    assert got == expected


def test_row_numbers(spark):
    df = spark.createDataFrame([(f"k{v:05d}",) for v in range(500)], "k string").repartition(3)
    assert rows(R.row_numbers(df, ["k"]), "row_number") == [(i + 1,) for i in range(500)]


def test_threshold_leaves_ties_out(spark):
    df = column(spark, [9.0, 8.0, 7.0, 7.0, 7.0, 1.0])
    assert R.nth_largest_threshold(df, "v", 3).first()[0] == 7.0
    assert R.flag_above_threshold(df, "v", 3).agg(F.sum("highrisk")).first()[0] == 2


def test_few_rows_are_all_flagged_but_nulls(spark):
    df = column(spark, [2.0, 1.0, None])
    assert rows(R.flag_above_threshold(df, "v", 5)) == [(None, 0), (1.0, 1), (2.0, 1)]


def test_top_k_breaks_ties_by_key(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", 2.0)], "k string, v double")
    assert rows(R.top_k(df, "v", 2, "k"), "k") == [("a",), ("c",)]
    assert R.marginal_row(df, "v", 2, "k").first()["k"] == "a"


def test_histogram_equals_numpy_and_keeps_empty_bins(spark):
    values = [0.0, 0.1, 0.2, 5.0, 9.99, 10.0, 10.0]
    counts, edges = np.histogram(values, bins=10)
    got = R.histogram(column(spark, values), "v", 10).orderBy("bin").collect()
    assert [r["n"] for r in got] == list(counts)
    assert [r["low"] for r in got] == pytest.approx(list(edges[:-1]))


def test_histogram_of_one_value(spark):
    assert R.histogram(column(spark, [3.0, 3.0]), "v", 2).orderBy("bin").select("n").collect()[0][0] == 2


@pytest.mark.parametrize("sizes", [(7, 23), (100, 900), (5, 5), (3, 40)])
def test_folds_are_consecutive_and_even(spark, sizes):
    data = [(f"{label}{i:04d}", label) for label, n in enumerate(sizes) for i in range(n)]
    df = spark.createDataFrame(data, "key string, label int").repartition(4)
    got = {}
    for key, label, fold in rows(stratified_folds(df, "key"), "key", "label", "fold"):
        got.setdefault(label, []).append(fold)
    for label, n in enumerate(sizes):
        expected = [i for i, part in enumerate(np.array_split(range(n), 5)) for _ in part]
        assert got[label] == expected


def test_legend_breaks_round_to_the_leading_digit(spark):
    values = [float(v) for v in range(101)]
    got = [r["value"] for r in risk.legend_breaks(column(spark, values, "score")).orderBy("break").collect()]
    assert got == pytest.approx([0.0, 50.0, 80.0, 80.0, 90.0])


@pytest.mark.parametrize("sketch,most", [(10_000, 50_000), (20, 5), (4, 1)])
def test_quantiles_bracketed_by_a_sketch_are_exact(spark, sketch, most):
    import random
    rng = random.Random(sketch)
    columns = {
        "spread": [rng.uniform(-1e6, 1e6) for _ in range(1000)], "ties": [float(rng.choice([0, 0, 0, 1, 7])) for _ in range(1000)],
        "few": [3.0, 1.0], "one": [5.0], "two_values": [1e-300] * 500 + [1e300] * 500, "steps": [float(k // 3) for k in range(1000)],
    }
    asked = {"zero": 0.0, "low": 0.05, "middle": 0.5, "high": 0.95, "top": 1.0}
    for values in columns.values():
        df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "v double").repartition(3)
        got = R.quantiles(df, "v", asked, sketch, most).first().asDict()
        ordered = sorted(values)
        for name, q in asked.items():
            position = (len(ordered) - 1) * q
            a, b = ordered[int(position)], ordered[min(int(position) + 1, len(ordered) - 1)]
            assert got[name] == (a if position == int(position) else a + (b - a) * (position - int(position)))
    empty = spark.createDataFrame([], "v double")
    assert R.quantiles(empty, "v", asked).first().asDict() == dict.fromkeys(asked)
