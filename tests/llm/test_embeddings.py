"""Hard negatives and whitening against brute force, on given and on odd tables."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from blockrisk.llm import hard_negatives as N
from blockrisk.llm import queries
from blockrisk.llm import whitening as W

FOLDER = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, label int, file string, row long, weights int, x int, high int, rank int, band int, _metadata string, is_anchor int"
EXTRA = ("f", 1, 2, 3, 4, 5, 6, "m", 7)


def usable(rows):
    good = []
    for place, (vec_id, vector, label) in enumerate(rows):
        if label is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            good.append((place, vec_id, [math.floor(256 * float(np.float32(x))) for x in vector], label))
    return good


def brute_negatives(rows, is_anchor):
    good, out = usable(rows), []
    score = lambda a, b: sum(x * y for x, y in zip(a, b))
    order = lambda r: (-r[0], r[1] is None, r[1] or 0)
    for place, vec_id, vector, label in good:
        if vec_id is None or not is_anchor(vec_id):
            continue
        same = sorted(((score(vector, v), i) for p, i, v, m in good if m == label and p != place), key=order)[:5]
        other = sorted(((score(vector, v), i) for p, i, v, m in good if m != label), key=order)
        for high, positive in same:
            inside = [(s, i) for s, i in other if 80 * high <= 100 * s <= 100 * high][:5]
            out += [(vec_id, positive, k + 1, i, high, s) for k, (s, i) in enumerate(inside)]
    return sorted(out, key=str)


def mined(df, **settings):
    rows = N.mine(df, F.col("vec_id") % 3 == 0, F.col("label"), **settings).collect()
    return sorted(map(tuple, rows), key=str)


def random_rows(seed, n, dims=6, labels=3):
    rng = np.random.default_rng(seed)
    lengths = np.exp(rng.normal(0, 1, n))
    vectors = rng.normal(0, 0.3, (n, dims)) * lengths[:, None]
    return [(int(i), [float(x) for x in v], int(rng.integers(labels))) for i, v in enumerate(vectors)]


ODD = [
    (0, None, 1), (3, [1.0, None], 1), (6, [1.0, float("nan")], 1), (9, [float("inf"), 0.0], 1), (12, [0.5, 0.5], None), (15, [], 1), (18, [0.5], 1), (18, [0.5], 1),
    (21, [0.5, 0.25, 0.125], 0), (None, [0.5, 0.25], 1), (None, [0.5, 0.25], 0), (24, [-0.5, -0.5], 1), (27, [0.0, 0.0], 0), (28, [0.45, 0.0], 0), (29, [0.45, 0.0], 0), (29, [0.45, 0.0], 0),
    (30, [0.5, 0.5], 2), (33, [-0.0, 1e-9], 3), (33, [0.5, 0.1], 3),
]


@pytest.mark.parametrize("shard_rows,bucket_rows", [(10_000, 10_000), (40, 7)])
def test_negatives_equal_brute_force(spark, shard_rows, bucket_rows):
    rows = random_rows(1, 150)
    df = spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA).repartition(3)
    rows = [(i, [float(np.float32(x)) for x in v], m) for i, v, m in rows]
    assert mined(df, shard_rows=shard_rows, bucket_rows=bucket_rows) == brute_negatives(rows, lambda i: i % 3 == 0)


@pytest.mark.parametrize("shard_rows,bucket_rows", [(10_000, 10_000), (3, 2)])
def test_negatives_of_odd_rows(spark, shard_rows, bucket_rows):
    df = spark.createDataFrame([(*r, *EXTRA) for r in ODD], SCHEMA)
    got = mined(df, shard_rows=shard_rows, bucket_rows=bucket_rows)
    assert got == brute_negatives(ODD, lambda i: i % 3 == 0) and len(got) > 10
    assert mined(df.limit(0)) == [] and mined(df.where("vec_id = 28")) == []


def test_coordinate_lists_prune_and_lose_nothing():
    rng = np.random.default_rng(2)
    centres = rng.normal(0, 1, (40, 16))
    rows = centres[rng.integers(40, size=4000)] + rng.normal(0, 0.05, (4000, 16))
    whole = np.floor(256 * rows)
    index = N.Buckets(whole, 500)
    anything, query = np.ones(len(whole), bool), np.floor(256 * centres[3])
    scores = index.weights @ query
    high = np.sort(scores)[-20]
    (found, values), = index.search(query, anything, index.order, np.array([math.ceil(0.8 * high)]), np.array([high]), 30)
    expected = np.sort(scores[(scores <= high) & (scores >= 0.8 * high)])[::-1][:30]
    assert values.tolist() == expected.tolist() and index.tested < len(whole) / 3


def test_query_equals_brute_force(spark):
    table = spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding", "label").collect()
    rows = [(i, v, (m + 1) % 10 if m is not None and i % 7 == 0 else m) for i, v, m in map(tuple, table)]
    got = sorted(map(tuple, queries.QUERIES["op11_hard_negatives"](spark, FOLDER).collect()), key=str)
    assert got == brute_negatives(rows, lambda i: i % 100 == 0) and len(got) > 100


def brute_whitening(rows):
    good = [(i, v) for _, i, v, _ in usable([(i, v, 0) for i, v in rows])]
    size = max(len(v) for _, v in good)
    good = [(i, tuple(v) + (0,) * (size - len(v))) for i, v in good]
    fit = sorted({v for _, v in good})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = [[n * x - s for x, s in zip(v, sums)] for v in fit]
    v = np.array([[sum(r[a] * r[b] for r in centred) / n**3 for b in range(size)] for a in range(size)])
    return good, n, sums, v


def check_whitening(got, rows, components=4):
    good, n, sums, v = brute_whitening(rows)
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1]
    by_row = sorted((r.vec_id is None, r.vec_id or 0, r.component, r.deviation) for r in got)
    expected = [(i is None, i or 0, k + 1, sum((n * x - s) ** 2 for x, s in zip(x, sums))) for i, x in good for k in range(components)]
    assert by_row == sorted(expected) and {r.n for r in got} == {n}
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-4
    for k in range(components):
        assert all(r.explained == pytest.approx(values[k] / np.trace(v), rel=1e-9) for r in got if r.component == k + 1)
        far = lambda x: sum((n * e - s) ** 2 for e, s in zip(x, sums))
        white = sorted((i is None, i or 0, far(x), (np.array(x) - np.array(sums) / n) @ vectors[:, k] / math.sqrt(values[k])) for i, x in good)
        mine = sorted((r.vec_id is None, r.vec_id or 0, r.deviation, r.whitened) for r in got if r.component == k + 1)
        a, b = (np.array([w[-1] for w in side]) for side in (white, mine))
        assert np.abs(math.copysign(1, a @ b) * a - b).max() < 1e-6


def test_whitening_of_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding").collect()]
    check_whitening(queries.QUERIES["op12_whitening"](spark, FOLDER).collect(), rows)


def test_whitening_of_odd_rows(spark):
    df = spark.createDataFrame([(*r, *EXTRA) for r in ODD + [(40, [0.1, 0.9, -3.0], 1), (41, [0.0, 0.3, 7.0], 1), (42, [2.0, 0.3, 1.0], None)]], SCHEMA)
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    check_whitening(W.whitened_rows(df, 3).collect(), rows, 3)
    assert W.whitened_rows(df.limit(0)).collect() == []
    assert W.whitened_rows(df.where("vec_id = 15")).collect() == []
    assert W.whitened_rows(df.where("vec_id = 18")).collect() == []
    # two distinct rows span one dimension
    assert {r.component for r in W.whitened_rows(df.where("vec_id in (21, 28)")).collect()} == {1}


@pytest.mark.parametrize("bits", [3, 20, 30, 33, 47, 50, 61])
def test_square_sums_are_exact(bits):
    values = np.random.default_rng(bits).integers(-(1 << bits), 1 << bits, (5000, 3))
    assert W.exact_square_sums(values) == [sum(int(x) ** 2 for x in c) for c in values.T]
    for value in (0, 5, -7, 1 << 150, -(1 << 90)):
        place, *parts = W._parts(4, value)
        assert place == 4 and sum(p << (W.LIMB * k) for k, p in enumerate(parts)) == value and all(0 <= p < 1 << 40 for p in parts[:-1])


def test_whitening_of_huge_entries(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(rng.normal(0, 1e13, (40, 3)))]
    df = spark.createDataFrame([(*r, 1, *EXTRA) for r in rows], SCHEMA)
    good, n, sums, _ = brute_whitening(rows)
    exact = {i: sum((n * x - s) ** 2 for x, s in zip(v, sums)) for i, v in good}
    got = W.whitened_rows(df, 3).collect()
    assert {r.vec_id: r.deviation for r in got} == {i: d if d < 1 << 63 else None for i, d in exact.items()}
    assert got[0].identity_error < 1e-4
