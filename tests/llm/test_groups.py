"""Exact and near duplicates, components, and top-k against brute force."""

import hashlib
import math
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from blockrisk.llm import jaccard_join as J
from blockrisk.llm import maxscore as M
from blockrisk.llm import stream_dedup as D
from blockrisk.llm.components import connected_components
from blockrisk.session import scratch_path

from .conftest import TEXTS

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def lower(text):
    return (text or "").translate(UPPER)


def expected_groups(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[lower(t)].append(i)
    rank = lambda i: -1 if i is None else i
    return sorted((rank(i), rank(max(ids, key=rank)), len(ids), hashlib.sha256(t.encode()).hexdigest()) for t, ids in groups.items() for i in ids)


def got_groups(rows):
    rank = lambda i: -1 if i is None else i
    return sorted((rank(r.doc_id), rank(r.keep_id), r.group_size, r.text_sha256) for r in rows)


def weak(text):
    return F.unhex(F.lpad(F.hex(F.length(text) % 3), 2, "0"))


@pytest.mark.parametrize("digest", [D.sha256, weak])
def test_exact_groups(odd_docs, digest):
    """Also with a digest that collides, where only the comparison of bytes can tell texts apart."""
    rows = D.deduplicate(odd_docs, digest, files_per_trigger=2).collect()
    assert got_groups(rows) == expected_groups(TEXTS)
    kept = [r for r in rows if r.kept]
    assert len(kept) == len({lower(t) for _, t in TEXTS}) and all(r.doc_id == r.keep_id for r in kept)


def test_hot_group_is_salted_and_kept_once(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 < 2, "Same").otherwise(F.col("id").cast("string")).alias("text"))
    rows = D.deduplicate(docs).collect()
    assert sum(r.kept for r in rows) == 1001 and {r.group_size for r in rows} == {1, 2000}


def test_state_goes_on_over_batches(spark):
    arrivals, state = scratch_path(spark, "arrivals"), scratch_path(spark, "state")
    schema = "digest binary, doc_id long, file string, row long"
    for batch in ([(b"a", 1, "f", 0), (b"b", 2, "f", 1)], [(b"a", 5, "g", 0)]):
        spark.createDataFrame(batch, schema).write.mode("append").parquet(arrivals)
        D.update_state(spark, arrivals, state)
    got = {bytes(r.digest): (r.keep_id, r.keep_file, r.rows) for r in D.read_state(spark, state).collect()}
    assert got == {b"a": (5, "g", 2), b"b": (2, "f", 1)}


def test_no_documents(no_docs):
    assert D.deduplicate(no_docs).collect() == []
    assert J.near_duplicate_groups(no_docs).collect() == []
    assert D.keep_last_copies(no_docs).collect() == []


def test_kept_copies_keep_their_columns(odd_docs):
    kept = D.keep_last_copies(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == len({lower(t) for _, t in TEXTS})


def brute_groups(rows, percent=80):
    sets = []
    for i, t in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
        sets.append((i, frozenset(zip(*[words[k:] for k in range(5)])) if len(words) >= 5 else frozenset([tuple(words)] if words else [])))
    name = list(range(len(sets)))

    def root(k):
        while name[k] != k:
            k = name[k]
        return k

    for a in range(len(sets)):
        for b in range(a):
            common = len(sets[a][1] & sets[b][1])
            if common and 100 * common >= percent * len(sets[a][1] | sets[b][1]):
                name[max(root(a), root(b))] = min(root(a), root(b))
    least = defaultdict(list)
    for k, (i, _) in enumerate(sets):
        least[root(k)].append(i)
    floor = lambda ids: min((i for i in ids if i is not None), default=-1)
    return sorted((-1 if i is None else i, len(s), floor(least[root(k)])) for k, (i, s) in enumerate(sets))


def got_near(docs):
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_shingles, -1 if r.component_id is None else r.component_id) for r in J.near_duplicate_groups(docs).collect())


def test_near_groups_of_odd_rows(odd_docs):
    assert got_near(odd_docs) == brute_groups(TEXTS)


def test_near_groups_with_edits_chains_and_shared_passages(spark):
    rng = np.random.default_rng(5)
    words = [f"w{k}" for k in range(400)]
    passage = list(rng.choice(words, 60))
    rows, number = [], 0
    for _ in range(12):
        base = list(rng.choice(words, 90))
        for _ in range(6):
            copy = list(base)
            for at in rng.integers(0, len(copy), int(rng.integers(0, 4))):
                copy[at] = f"edit{rng.integers(1000)}"
            rows.append((number, " ".join(copy)))
            number += 1
    for _ in range(20):
        rows.append((number, " ".join(passage + list(rng.choice(words, 40)))))
        number += 1
    chain = list(rng.choice(words, 120))
    for _ in range(8):  # each near the one before, the ends far apart
        rows.append((number, " ".join(chain)))
        number += 1
        chain[int(rng.integers(120))] = f"step{number}"
    docs = spark.createDataFrame([(i, t) for i, t in rows], "doc_id long, text string")
    assert got_near(docs) == brute_groups(rows)


def test_components(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, 101), (101, 102), (100, 102), (7, 7)] + [(200, k) for k in range(201, 260)]
    got = {r.node: r.label for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(41)} | {100: 100, 101: 100, 102: 100} | {k: 200 for k in range(200, 260)}


def test_top_k(spark):
    rng = np.random.default_rng(2)
    vectors = [(int(i), (rng.standard_normal(12) * (5 if i % 7 else 0)).round(1).tolist()) for i in range(300)]
    odd = [(300, None), (301, [1.0, None]), (302, [math.nan, 1.0]), (303, [math.inf]), (304, []), (305, [2.0]), (50, [1.0, 1.0]), (None, [1.0])]
    table = spark.createDataFrame([(i, v, "x", 1) for i, v in vectors + odd], "vec_id long, embedding array<double>, weights string, score int")
    usable = [(i, v) for i, v in vectors + odd if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    expected = set()
    for q, v in usable:
        if q % 50 or len(v) != 12:
            continue
        a = [math.floor(256 * x) for x in v]
        scores = sorted(((-sum(x * math.floor(256 * y) for x, y in zip(a, w)), i) for i, w in usable if i != q))[:5]
        expected.add((q, tuple((i, -s) for s, i in scores)))
    old, M.SHARD_VECTORS = M.SHARD_VECTORS, 64
    try:
        got = M.top_k(table, table.where((F.col("vec_id") % 50 == 0) & (F.size("embedding") == 12)), 5).collect()
    finally:
        M.SHARD_VECTORS = old
    by_query = defaultdict(list)
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        by_query[r.query_id].append((r.vec_id, r.score))
    assert {(q, tuple(v)) for q, v in by_query.items()} == expected
    assert M.top_k(table.limit(0), table.limit(0), 5).collect() == []


def test_top_k_of_doubled_queries_empty_vectors_and_missing_ids(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.5, 0.0]), (3, []), (4, [-1.0]), (None, [0.5]), (None, [0.25, 9.0]), (5, [0.5, 3.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in M.top_k(table, table.where("vec_id = 1"), 3).collect() if r.vec_id is not None)
    # two equal query rows have two equal answers; of equal scores the row without an id comes last
    assert got == sorted(2 * [(1, 1, 2, 32768), (1, 2, 5, 32768)])
    whole = M.top_k(table, table.where("vec_id = 3"), 9).collect()
    assert sorted((r.rank, r.vec_id, r.score) for r in whole if r.vec_id is not None) == [(1, 1, 0), (2, 1, 0), (3, 2, 0), (4, 4, 0), (5, 5, 0)]
    assert [(r.rank, r.score) for r in whole if r.vec_id is None] == [(6, 0), (7, 0)]
    assert {r.vec_id for r in M.top_k(table, table.where("vec_id = 1 and embedding[0] = 1"), 9).collect()} == {2, 3, 4, 5, None}


def test_shard_search_equals_full_scores():
    rng = np.random.default_rng(4)
    ids, weights = np.arange(900), rng.integers(-300, 300, (900, 24)).astype(np.float64)
    weights[::9] = weights[0]  # ties
    shard = M.Shard(ids, weights)
    for q in range(0, 900, 37):
        best, scores = shard.search(q, weights[q], 5)
        full = sorted((-float(weights[q] @ weights[i]), i) for i in range(900) if i != q)[:5]
        assert list(zip((-scores).tolist(), best.tolist())) == full
