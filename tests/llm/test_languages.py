"""The language field against brute force, on switched texts, on held-out documents and on odd rows."""

import itertools
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from blockrisk.llm import language_crf as C
from blockrisk.llm import queries

from .conftest import TEXTS

FOLDER = "/root/testdata/sf0.01"


def test_forward_backward_equals_the_sum_over_paths():
    rng = np.random.default_rng(4)
    for sizes, states in (([1], 2), ([5, 1, 3], 3), ([2, 2, 2, 2], 2)):
        words = sum(sizes)
        evidence, start, moves = rng.random((words, states)) + 0.01, rng.random(states) + 0.1, rng.random((states, states)) + 0.1
        first = np.zeros(words, bool)
        first[np.cumsum([0, *sizes[:-1]])] = True
        forward, backward = C.forward_backward(evidence, first, start, moves)
        got = forward * backward / (forward * backward).sum(1, keepdims=True)
        at = 0
        for size in sizes:
            want = np.zeros((size, states))
            for path in itertools.product(range(states), repeat=size):
                weight = start[path[0]] * np.prod([moves[a, b] for a, b in zip(path, path[1:])]) * np.prod([evidence[at + k, s] for k, s in enumerate(path)])
                want[np.arange(size), path] += weight
            assert np.allclose(got[at : at + size], want / want.sum(1, keepdims=True))
            at += size


def test_features_are_affixes_grams_and_the_word():
    words = ["a", "über", "abab", "漢字", "x" * 300]
    got = [[] for _ in words]
    for keys, word in C.features(words):
        assert (np.diff(word) >= 0).all()
        for k, w in zip(keys.tolist(), word.tolist()):
            got[w].append(k)
    codes = lambda s: [ord(c) + 1 for c in s]

    def key(letters, kind, whole=False):
        value = 0
        for n, c in enumerate(letters):
            value = (value + c * int(C._BASE) ** n if whole else value * int(C._BASE) + c) % 2**64
        return int(C._key(np.array([value], np.uint64), kind)[0])

    for word, keys in zip(words, got):
        expected = [key(codes(word), 300, whole=True)]
        for n in range(1, min(4, len(word)) + 1):
            expected += [key(codes(word[k : k + n]), n) for k in range(len(word) - n + 1)]
            expected += [key(codes(word[:n]), 100 + n), key(codes(word[-n:]), 200 + n)]
        assert sorted(keys) == sorted(expected)


@pytest.fixture(scope="module")
def table(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="module")
def model(table):
    return C.fit_language(table, per_language=100)


def test_words_of_switched_texts(table, model):
    held = [r for r in table.where(C.held_out()).collect() if len(r.text) < 5000]
    rng, texts, truth = np.random.default_rng(1), [], []
    for _ in range(100):
        words = []
        for row in rng.choice(len(held), 3):
            part = re.findall(r"[^\W\d_]+", held[row].text)[: int(rng.integers(4, 30))]
            words += part
            truth += [held[row].lang] * len(part)
        texts.append(" ".join(words))
    probability, bounds = model.label(pa.array(texts))
    assert bounds[-1] == len(truth) and np.allclose(probability.sum(1), 1)
    assert (np.array(model.languages)[probability.argmax(1)] == np.array(truth)).mean() > 0.97
    # learned moves stay more often than they switch
    assert all(model.moves[s].argmax() == s for s in range(len(model.languages)))
    # a text is labelled alike whatever stands beside it
    alone = np.concatenate([model.label(pa.array([t]))[0] for t in texts[:20]])
    assert np.allclose(alone, probability[: len(alone)])


def test_held_out_documents(spark, table):
    truth = {r.doc_id: r.lang for r in table.collect()}
    rows = queries.QUERIES["op13_language_crf"](spark, FOLDER).collect()
    assert sorted(r.doc_id for r in rows) == sorted(truth) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) >= 0.98


def test_odd_rows(odd_docs, no_docs, model):
    rows = C.tag_languages(odd_docs, model).collect()
    assert len(rows) == len(TEXTS) and C.tag_languages(no_docs, model).collect() == []
    for row, (doc_id, text) in zip(rows, TEXTS):
        letters = any(c.isalpha() for c in text or "")
        assert row.doc_id == doc_id and (row.lang == "und") == (not letters) and 0 <= row.score <= 1
        assert sum(s.words for s in row.spans) == row.n_words and abs(sum(s.words for s in row.shares) - row.n_words) < 1e-6
        at = 0
        for span in row.spans:
            assert span.first_word == at and span.words > 0 and 0 < span.probability <= 1
            at += span.words
    marks = C._tagged(model, pa.array([1, 2, 3]), pa.array(["1234 -- ?!", "́́ 7", "́é 7"])).column("n_words").to_pylist()
    assert marks == [0, 0, 1]


def test_sample(spark, table):
    texts, spoken = C.language_sample(table, 10, 2000)
    teaching = {(r.text, r.lang) for r in table.where(~C.held_out()).collect()}
    assert set(zip(texts, spoken)) <= teaching and all(spoken.count(x) == 10 for x in ("de", "en", "es", "fr")) and max(len(t.encode()) for t in texts) <= 2000
    assert (texts, spoken) == C.language_sample(table.repartition(5), 10, 2000)
    odd = spark.createDataFrame([(None, "a b", "x", 1, "r"), (1, "a b", None, 1, "r"), (4, None, "x", 1, "r"), (4, "123", "x", 1, "r")], "doc_id long, text string, lang string, place int, rank string")
    nothing = C.fit_language(odd)
    assert nothing.languages == [] and [(r.lang, r.score) for r in C.tag_languages(odd, nothing).collect()] == [("und", 0.0)] * 4
    one = C.fit(["ein wort", "noch ein wort"], ["de", "de"])
    row = C._tagged(one, pa.array([1]), pa.array(["irgendein text"]))
    assert row.column("lang").to_pylist() == ["de"] and row.column("score").to_pylist() == [1.0]
