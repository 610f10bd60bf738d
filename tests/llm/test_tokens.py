"""Token files, packing, cached counts and numpy BPE against the tokenizers library."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from blockrisk.llm import best_fit_packing as B
from blockrisk.llm import bit_packing as P
from blockrisk.llm import numpy_bpe as N
from blockrisk.llm import token_counts as C
from blockrisk.llm.frames import tokenizer_path
from blockrisk.llm.library_tokens import encoder
from blockrisk.session import scratch_path

from .conftest import TEXTS

WORD, BYTE = "word_bpe_49k.json", "byte_bpe_50k.json"
PARTS = [*"aZé'sSßİΣ  \t\n\r\x0b\x1c\x85　.,;!%<|>12漢🙂́", "<|endoftext|>", "<|ENDOFTEXT|>", "'re", " Word", "    ", "hahaha"]


def library(name):
    return Tokenizer.from_file(tokenizer_path(name))


def random_texts(seed, n=3000):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 30))) for _ in range(n)]


def word_ids(text):
    return [*library(WORD).encode(text or "", add_special_tokens=False).ids, 1]


@pytest.mark.parametrize("name", [WORD, BYTE])
def test_encoders_equal_the_library(name):
    texts = [t or "" for _, t in TEXTS] + random_texts(3)
    ids, at = (encoder(name) if name == WORD else N.coder(name)).encode(pa.array(texts, pa.string()))
    expected = [e.ids for e in library(name).encode_batch(texts, add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == expected


def test_sentencepiece_counts_equal_the_library():
    import sentencepiece

    texts = [t or "" for _, t in TEXTS]
    _, at = encoder("piece_bpe_32k.model").encode(pa.array(texts, pa.string()))
    tool = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    assert np.diff(at).tolist() == [len(tool.encode(t)) for t in texts]


@given(st.lists(st.integers(0, 2**17 - 1), max_size=200), st.integers(17, 24), st.integers(1, 50))
@settings(max_examples=60, deadline=None)
def test_packed_segments_round_trip(ids, bits, block):
    ids = np.array(ids, np.uint32)
    cut = sorted({0, len(ids) // 3, len(ids)})
    image = P.build_segment(np.arange(len(cut) - 1), np.diff(cut), ids, bits, block)
    one = P.Segment(image)
    assert one.read(0, len(ids)).tolist() == ids.tolist()
    assert one.read(len(ids) // 4, len(ids) // 2).tolist() == ids[len(ids) // 4 : len(ids) // 2].tolist()
    assert [one.document(k).tolist() for k in range(len(cut) - 1)] == [ids[a:b].tolist() for a, b in zip(cut, cut[1:])]


def test_fewest_bits():
    assert [P.bits_for(v) for v in (1, 2, 3, 49_408, 65_536, 65_537)] == [1, 1, 2, 16, 16, 17]
    assert len(P.pack_ids(np.arange(16, dtype=np.uint32), 4)) == 8


@pytest.mark.parametrize("segment_ids", [50, 1 << 20])
def test_token_files(spark, odd_docs, segment_ids):
    path = scratch_path(spark, "files")
    P.write_token_files(odd_docs, path, WORD, 49_408, 1, shards=3, segment_ids=segment_ids)
    index = P.read_index(spark, path).join(P.segment_starts(spark, path), ["shard", "segment"])
    got = sorted((r.segment_start + r.local_start, r.doc_id, r.n_tokens, r.ids_crc32) for r in index.collect())
    expected, start = [], 0
    for doc_id, text in sorted(TEXTS, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or "")):
        ids = word_ids(text)
        expected.append((start, doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == expected


def test_token_files_of_no_documents(no_docs):
    assert P.token_file_index(no_docs, WORD, 49_408, 1).collect() == []


def checked_sequences(rows, capacity):
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by_sequence)


@pytest.mark.parametrize("capacity,group", [(64, 4), (4096, 4096)])
def test_packing(odd_docs, capacity, group):
    rows = B.pack_documents(odd_docs, WORD, 1, capacity, group).collect()
    pieces = sorted(((r.doc_id is None, r.doc_id or 0, r.piece, r.start, r.length, r.ids_crc32) for r in rows))
    expected = []
    for doc_id, text in TEXTS:
        ids = word_ids(text)
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            expected.append((doc_id is None, doc_id or 0, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert pieces == sorted(expected)
    total = sum(r.length for r in rows)
    assert checked_sequences(rows, capacity) <= -(-total // capacity) * 1.1 + 1


def test_packing_of_no_documents(no_docs):
    assert B.pack_documents(no_docs, WORD, 1).collect() == []


def test_local_search_empties_bins():
    # best fit in falling order needs three bins; one exchange makes it two
    lengths = np.array([6, 5, 5, 4, 4, 3, 3], np.int64)
    start = np.array([0, 1, 1, 2, 2, 0, 2], np.int64)
    fills = np.bincount(start, lengths).astype(int).tolist()
    bin_of, _ = B.local_search(lengths, start, fills, 15)
    assert len(set(bin_of.tolist())) == 2 and np.bincount(bin_of, lengths).max() <= 15


@given(st.lists(st.integers(1, 40), min_size=1, max_size=60))
@settings(max_examples=80, deadline=None)
def test_packs_hold_everything_and_never_worsen(lengths):
    lengths = np.array(lengths, np.int64)
    bins = len(B.best_fit(lengths, 40)[1])
    bin_of, offsets, fill = B.pack(lengths, 40)
    assert fill.max() <= 40 and len(set(bin_of.tolist())) <= bins
    assert np.bincount(bin_of, lengths).sum() == lengths.sum()
    for b in set(bin_of.tolist()):
        own = np.argsort(offsets[bin_of == b])
        assert offsets[bin_of == b][own].tolist() == [0, *np.cumsum(lengths[bin_of == b][own])[:-1].tolist()]


def test_token_counts_and_cache(spark, odd_docs, no_docs):
    cache = scratch_path(spark, "cache")
    rows = C.count_tokens(odd_docs, WORD, 2048, cache).collect()
    expected = sorted((i or -1, len((t or "").encode()), len(word_ids(t)) - 1, len(word_ids(t)) - 1 > 2048) for i, t in TEXTS)
    assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens, r.over_limit) for r in rows) == expected
    stored = spark.read.schema(C.CACHE_SCHEMA).parquet(cache)
    before = stored.count()
    assert before == stored.select("content").distinct().count() < len(TEXTS)  # case and white space do not count
    assert len(C.count_tokens(odd_docs, WORD, 2048, cache).collect()) == len(TEXTS)
    assert spark.read.schema(C.CACHE_SCHEMA).parquet(cache).count() == before  # nothing was encoded again
    assert C.count_tokens(no_docs, WORD, 2048, cache).collect() == []
    assert len(C.count_tokens(odd_docs, "piece_bpe_32k.model", 10, cache).collect()) == len(TEXTS)


def test_numpy_bpe(odd_docs, no_docs):
    tool = library(BYTE)
    expected = []
    for i, t in TEXTS:
        ids = tool.encode(t or "", add_special_tokens=False).ids
        decoded = tool.decode(ids, skip_special_tokens=False)
        expected.append((i or -1, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    got = N.encoding_digests(odd_docs, BYTE).collect()
    assert sorted((r.doc_id or -1, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == sorted(expected)
    full = {r.doc_id: r for r in N.encode_documents(odd_docs, BYTE).collect()}
    assert full[8].decoded == TEXTS[9][1] and full[1].ids == []
    assert N.encoding_digests(no_docs, BYTE).collect() == []


def test_decode_of_broken_bytes():
    tool, own = library(BYTE), N.coder(BYTE)
    for ids in ([own.of_byte[0xE6], own.of_byte[0xBC]], [own.of_byte[0xFF], 50256], [own.of_byte[0xF0], own.of_byte[0x41]]):
        assert own.decode(np.array(ids, np.uint32)) == tool.decode([int(i) for i in ids], skip_special_tokens=False)


def test_texts_go_to_packing_in_small_batches(spark, monkeypatch):
    """Batches of texts stay small while they are cut, and the session's own size comes back."""
    key, seen, write = "spark.sql.execution.arrow.maxRecordsPerBatch", [], B.written

    def written(df, name):
        seen.append((name, int(spark.conf.get(key))))
        return write(df, name)

    monkeypatch.setattr(B, "written", written)
    before = spark.conf.get(key)
    docs = spark.range(3).selectExpr("id AS doc_id", "repeat('word ', 9) AS text")
    assert B.pack_documents(docs, "word_bpe_49k.json", 1).count() == 3
    assert seen[0] == ("pieces", 512) and seen[1] == ("packed", int(before)) and spark.conf.get(key) == before
