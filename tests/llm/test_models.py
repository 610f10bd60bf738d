"""Classifiers on held-out rows, the string kernel and Viterbi against brute force, and the pipeline."""

import itertools
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from blockrisk.llm import byte_cnn as Q
from blockrisk.llm import frames
from blockrisk.llm import labelled_sample as L
from blockrisk.llm import queries
from blockrisk.llm import string_kernel as K
from blockrisk.llm import transcript_hmm as H

from .conftest import TEXTS

FOLDER = "/root/testdata/sf0.01"


def test_kernel_equals_the_sum_over_subsequences():
    words, marks = ["idiot", "idxiot", "banana", "ab", "stupid", "ça"], ["idiot", "bananas", "upidé", "vequ"]

    def brute(s, t):
        total = 0
        for a in itertools.combinations(range(len(s)), K.LENGTH):
            for b in itertools.combinations(range(len(t)), K.LENGTH):
                if a[-1] - a[0] < K.SPAN > b[-1] - b[0] and all(s[x] == t[y] for x, y in zip(a, b)):
                    total += K.DECAY ** (a[-1] - a[0] + b[-1] - b[0] + 2)
        return total

    norm = lambda xs: K._norms(np.array([len(x) for x in xs]))
    expected = np.array([[brute(w, m) for m in marks] for w in words]) / norm(words)[:, None] / norm(marks)
    assert np.allclose(K.KernelTable(marks).features(words), expected, atol=1e-5)


def test_spelt_out_words_are_joined():
    words = K.word_lists(pa.array(["you i d i o t", "i.d.i.o.t", "Plain words, here."])).to_pylist()
    assert [[w for w in ws if w] for ws in words] == [["you", "idiot"], ["idiot"], ["plain", "words", "here"]]


def toy_texts(seed, n):
    rng = np.random.default_rng(seed)
    words = ["lane", "river", "stone", "meadow", "bright", "quiet", "walk", "garden", "idea", "moral"]
    texts, labels = [], []
    for k in range(n):
        body = list(rng.choice(words, 30))
        if k % 2:
            body[int(rng.integers(30))] = str(rng.choice(["idiot", "stupid", "moron"]))
        texts.append(" ".join(body) + ".")
        labels.append(k % 2)
    return texts, labels


def test_string_kernel_machine_learns_and_tolerates_gaps():
    model = K.fit(*toy_texts(1, 200))
    texts, labels = toy_texts(2, 100)
    assert ((model.score(pa.array(texts)) >= 0.5) == np.array(labels)).mean() > 0.97
    spoilt, plain = model.margins(["iidiot", "sttupid", "stupiid"]), model.margins(["river", "garden", "moral"])
    assert spoilt.min() > plain.max()
    odd = model.score(pa.array(["", "   ", "a i.d.i.o.t here", "x" * 5000]))
    assert odd[2] > 0.5 > max(odd[0], odd[1], odd[3])


def test_scored_words_belong_to_one_model(monkeypatch):
    """Another model with the same landmarks gets its own scores, and the worker keeps one model's words within the bound."""
    texts = pa.array(["you idiot there", "a quiet garden"])
    model, other = K.fit(*toy_texts(1, 200)), K.fit(*toy_texts(1, 200))
    other.weights, other.bias = -other.weights, -other.bias
    other.seal()
    first, second = model.score(texts), other.score(texts)
    assert first[0] > 0.5 and abs(second[0] - other.probability(max(other.margins(["you", "idiot", "there"]).max(), other.bias))) < 1e-9
    assert list(K._WORDS) == [other.number] and model.score(texts).tolist() == first.tolist() and list(K._WORDS) == [model.number]
    monkeypatch.setattr(K, "CACHE_BYTES", 4 * K.BYTES_PER_WORD)
    for start in range(0, 60, 6):
        model.score(pa.array([" ".join(f"word{'abcdefghij'[n % 10]}{'klmnopqrst'[n // 10]}" for n in range(start, start + 6))]))
        assert len(K._WORDS[model.number]) <= 4 + 6


def test_scoring_holds_features_of_few_words(monkeypatch):
    """The features of all new words of a slice are never held at once, and their margins do not depend on that."""
    model, asked = K.fit(*toy_texts(1, 200)), []
    words = [f"stup{'abcdefghij'[n % 10]}{'klmnopqrst'[n // 10 % 10]}{'uvwxyz'[n // 100 % 6]}{chr(97 + n // 600)}" for n in range(12_000)] + ["long" * 20]
    features = K.KernelTable.features
    monkeypatch.setattr(K.KernelTable, "features", lambda self, pieces, *block: asked.append(len(pieces)) or features(self, pieces, *block))
    margins = model.margins(words)
    assert max(asked) <= 4096 and sum(asked) > 12_000
    assert np.allclose(margins[[0, 5000, 12_000]], [model.margins([words[n]])[0] for n in (0, 5000, 12_000)], rtol=0, atol=1e-12)


def test_stages_drop_what_others_keep(spark):
    """A worker that scored words drops them for the next stage, and keeps them for its own next task."""
    K._words_of("one")["word"] = 0.5
    frames.keep_only("words")
    assert K._WORDS == {"one": {"word": 0.5}}
    frames.keep_only()
    assert K._WORDS == {}
    docs = spark.createDataFrame([(n, f"a quiet garden {n}") for n in range(8)], "doc_id long, text string").coalesce(1)
    mild, good = K.fit(*toy_texts(1, 100)), Q.fit(*toy_texts(1, 40), epochs=1)

    def words_held(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(K._WORDS)] * batch.num_rows)], names=["held"])

    for stage, model, held in ((K.keep_mild, mild, 1), (Q.keep_good, good, 0)):
        assert stage(docs, model, 2.0 if stage is K.keep_mild else -1.0).count() == 8
        assert docs.mapInArrow(words_held, "held long").distinct().collect() == [(held,)]


def test_models_without_labels():
    assert K.fit(["a b"], [0]).score(pa.array(["idiot", ""])).tolist() == [0, 0]
    assert (Q.fit(["a b"], [1]).score(pa.array(["x", ""])) > 0.99).all()


def test_network_gradients():
    rng = np.random.default_rng(0)
    texts = ["hello world, this is a text", "x", "", "another text that is rather longer than the others are"]
    rows = [Q.padded_bytes(pa.array([t])) for t in texts]
    values, sizes = np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows])
    p = {"embed": rng.standard_normal((257, Q.WIDTH)), "filters": rng.standard_normal((Q.CHUNK, Q.WIDTH, Q.FILTERS)) * 0.1, "filter_bias": np.zeros(Q.FILTERS), "hidden": rng.standard_normal((2 * Q.FILTERS, Q.HIDDEN)) * 0.1, "hidden_bias": np.zeros(Q.HIDDEN), "out": rng.standard_normal(Q.HIDDEN), "out_bias": np.zeros(1)}
    y, balance = np.array([1.0, 0, 1, 0]), np.ones(4)

    def loss():
        tables = np.einsum("bw,cwf->cbf", p["embed"], p["filters"])
        net = Q.ByteCnn(tables, p["filter_bias"], p["hidden"], p["hidden_bias"], p["out"], float(p["out_bias"][0]))
        s = net.score(pa.array(texts))
        return -(y * np.log(s) + (1 - y) * np.log(1 - s)).mean()

    grads = Q._gradients(p, values, sizes, y, balance)
    for name, at in (("filters", (3, 2, 5)), ("hidden", (4, 7)), ("out", (2,)), ("embed", (ord("e"), 1)), ("hidden", (30, 3))):
        p[name][at] += 1e-5
        high = loss()
        p[name][at] -= 2e-5
        low = loss()
        p[name][at] += 1e-5
        assert abs((high - low) / 2e-5 - grads[name][at]) < 1e-3


def test_chunks_cover_every_byte():
    for n in (0, 1, 15, 16, 17, 24, 25, 1000):
        starts, counts = Q.chunk_starts(np.array([n]))
        covered = {b for s in starts.tolist() for b in range(s, s + Q.CHUNK)}
        assert covered >= set(range(n)) and counts[0] == len(starts)


@pytest.fixture(scope="module")
def labelled(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}


@pytest.mark.parametrize("query,label,least", [("op7_byte_cnn", "quality", 0.85), ("op8_string_kernel", "toxic", 0.9)])
def test_held_out_accuracy(spark, labelled, query, label, least):
    rows = queries.QUERIES[query](spark, FOLDER).collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    known = [r for r in rows if r.held_out and r.doc_id in labelled]
    assert sum(r.predicted == labelled[r.doc_id][label] for r in known) / len(known) >= least


def test_sample_never_holds_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    held = {r.text for r in docs.where(L.held_out()).collect()} - {r.text for r in docs.where(~L.held_out()).collect()}
    texts, values = L.labelled_sample(docs, labels, "toxic", 20, 1000)
    assert not held & set(texts) and set(values) <= {0, 1} and max(map(len, texts)) <= 1000 and len(texts) <= 40
    odd = spark.createDataFrame([(None, 1, 1), (3, None, None), (4, 7, 7)], labels.schema)
    assert L.labelled_sample(docs, odd, "toxic", 20, 1000) == ([], [])


def test_scores_of_odd_rows(odd_docs, no_docs):
    mild, good = K.fit(*toy_texts(1, 100)), Q.fit(*toy_texts(1, 40), epochs=1)
    for score, model, keep, bound in ((K.score_toxicity, mild, K.keep_mild, 2.0), (Q.score_quality, good, Q.keep_good, -1.0)):
        rows = score(odd_docs, model).collect()
        assert len(rows) == len(TEXTS) and all(0 <= r.score <= 1 for r in rows)
        assert keep(odd_docs, model, bound).collect() == odd_docs.collect()
        assert score(no_docs, model).collect() == [] and keep(no_docs, model, bound).collect() == []


def test_viterbi_equals_the_best_of_all_paths():
    start, moves, out = H.model()
    rng = np.random.default_rng(3)
    for n in (1, 2, 4):
        seen = rng.integers(0, 40, n)
        score = lambda p: start[p[0]] + out[seen[0], p[0]] + sum(moves[a, b] + out[s, b] for a, b, s in zip(p, p[1:], seen[1:]))
        best = max(score(p) for p in itertools.product(range(6), repeat=n))
        assert np.isclose(score(H.viterbi(seen, start, moves, out).tolist()), best)


def test_spread_conversation_equals_one_task(spark):
    rng = np.random.default_rng(8)
    lines = ["User: what now?", "Assistant: - a list", "plain line that goes on for quite a while, longer than sixty characters", "Bob: hm", "### System: rules", "", "short?"]
    rows = [(c, t, str(rng.choice(lines))) for c in (1, 2) for t in range(150)] + [(None, 1, None), (3, 1, "Human: hi\nall\nAI: yes"), (3, 1, "Human: hi\nall\nAI: yes")]
    turns = spark.createDataFrame([(*r, "user", 1, "s", True) for r in rows], "conv_id long, turn long, text string, role string, line int, side string, opens boolean")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    for parts in ("1", "23"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        got = H.format_transcripts(turns).collect()
        results.append(sorted(map(str, got)))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1] and len(results[0]) == 300 + 1 + 6
    third = sorted((r for r in got if r.conv_id == 3), key=lambda r: (r.turn, r.line))
    assert {r.role for r in third if r.line < 2} == {"user"} and {r.role for r in third if r.line == 2} == {"assistant"}
    whole = "".join(r.rendered for r in got if r.conv_id is None)
    assert whole.startswith("<|") and whole.endswith("<|end|>\n")
    assert H.format_transcripts(turns.limit(0)).collect() == []


def test_roles_of_conversations(spark):
    truth = {(r.conv_id, r.turn): r.role for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").collect()}
    got = queries.QUERIES["op10_transcript_hmm"](spark, FOLDER).collect()
    assert {(r.conv_id, r.turn) for r in got} == set(truth)
    assert sum(truth[r.conv_id, r.turn] == r.role for r in got) / len(got) > 0.99


def test_pipeline(spark, labelled):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, kept = docs.columns, docs
    clean = {i for i, r in labelled.items() if r.quality == 1 and r.toxic == 0}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, kept, FOLDER)
        before, after = ({r.doc_id for r in d.select("doc_id").collect()} for d in (kept, out))
        assert out.columns == columns and after < before
        if name in ("toxicity", "quality"):
            assert len(clean & after) >= 0.95 * len(clean & before)
        path = corpus_pipeline.scratch_path(spark, "test-stage")
        out.write.parquet(path)
        kept = spark.read.parquet(path)
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, FOLDER)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == after
    empty = kept.where(F.lit(False))
    assert all(stage(spark, empty, FOLDER).count() == 0 for _, stage in corpus_pipeline.STAGES)
