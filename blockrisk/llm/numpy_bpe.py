"""Byte-level BPE encoding and decoding by batched numpy merge rounds.

The symbols of many words lie in one flat array. A round looks up the rank of every neighbouring
pair by binary search in the sorted pair keys, finds each word's lowest rank, and merges all
places of that pair in the word, from the left; words without a mergeable pair leave the array.
A batch of words thus takes as many rounds as its hardest word needs merges of distinct pairs.

Texts are first cut where the vocabulary's pattern always cuts: before a single space between
two characters that are no white space. These chunks repeat, so each task encodes a chunk once and
keeps its ids in a bounded cache; texts with other spacing, or with a special token, are cut by
the pattern as a whole. Decoding joins the bytes of the ids' tokens and reads them as UTF-8, with
the replacement character for bytes that are none.

Cases: a null text is empty, gives no ids and decodes to an empty text; special tokens inside a
text become their ids; repeated rows each get their row; an empty table gives no rows; a null
doc_id is kept; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from blockrisk.llm.frames import gather_runs, id_and_text, slices, split_points, strings_of, tokenizer_path

CACHE_CHUNKS = 1_000_000
#: Fixed value: the published pattern of byte-level vocabularies. \\s is spelt out as Unicode white space.
_SPACE = r"\p{White_Space}"
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+|{_SPACE}+(?!\P{{White_Space}})|{_SPACE}+"
_NO_RANK = np.int64(1) << 40
_CODERS: dict[str, "NumpyBpe"] = {}


def byte_symbols() -> dict[int, str]:
    """The visible character that stands for each byte in byte-level vocabularies."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + k) for k, b in enumerate(hidden)}


def coder(name: str) -> "NumpyBpe":
    if name not in _CODERS:
        _CODERS[name] = NumpyBpe(tokenizer_path(name))
    return _CODERS[name]


class NumpyBpe:
    """Encoder and decoder of one byte-level vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as handle:
            spec = json.load(handle)
        vocabulary, merges = spec["model"]["vocab"], spec["model"]["merges"]
        symbols = byte_symbols()
        byte_of = {c: b for b, c in symbols.items()}
        self.size = max([*vocabulary.values(), *(t["id"] for t in spec["added_tokens"])]) + 1
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        left, right = (np.array([vocabulary[p[k]] for p in pairs], np.int64) for k in (0, 1))
        keys = left * self.size + right
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([vocabulary[a + b] for a, b in pairs], np.int64)
        self.of_byte = np.array([vocabulary[symbols[b]] for b in range(256)], np.int64)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        tokens = [b""] * self.size
        for token, number in vocabulary.items():
            tokens[number] = bytes(byte_of[c] for c in token)
        for token, number in self.special.items():
            tokens[number] = token.encode()
        self.token_lengths = np.array([len(t) for t in tokens], np.int64)
        self.token_starts = split_points(self.token_lengths)[:-1]
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.pattern = regex.compile(PATTERN)
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self._forget()

    def _forget(self) -> None:
        self.slots: dict[str, int] = {}
        self.flat, self.starts, self.lengths = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def merge_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of words that the pattern has cut; all words in shared merge rounds."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        symbols = self.of_byte[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), lengths)
        done_symbols, done_words = [], []
        while len(symbols):
            key = symbols[:-1] * self.size + symbols[1:]
            place = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            known = (self.pair_keys[place] == key) & (word[:-1] == word[1:])
            rank = np.append(np.where(known, self.pair_ranks[place], _NO_RANK), _NO_RANK)
            begins = np.where(np.append(True, word[1:] != word[:-1]))[0]
            sizes = np.diff(np.append(begins, len(word)))
            least = np.minimum.reduceat(rank, begins)
            going = np.repeat(least < _NO_RANK, sizes)
            done_symbols.append(symbols[~going])
            done_words.append(word[~going])
            chosen = (rank == np.repeat(least, sizes)) & going
            at = np.where(chosen)[0]
            if len(at):
                # places that overlap form runs; every second one of a run stays
                breaks = np.append(True, np.diff(at) != 1)
                run_start = np.maximum.accumulate(np.where(breaks, np.arange(len(at)), 0))
                at = at[(np.arange(len(at)) - run_start) % 2 == 0]
            symbols = symbols.copy()
            symbols[at] = self.merged[rank[at]]
            stays = going
            stays[at + 1] = False
            symbols, word = symbols[stays], word[stays]
        all_words = np.concatenate(done_words) if done_words else np.zeros(0, np.int64)
        order = np.argsort(all_words, kind="stable")
        ids = np.concatenate(done_symbols)[order] if done_symbols else np.zeros(0, np.int64)
        return ids.astype(np.uint32), split_points(np.bincount(all_words, minlength=len(words)))

    def _chunk_slots(self, chunks: list[str]) -> np.ndarray:
        """Cache places of the chunks' ids; new chunks are cut, and their distinct words merged together."""
        if len(self.slots) > CACHE_CHUNKS:
            self._forget()
        get = self.slots.get
        if new := [c for c in dict.fromkeys(chunks) if get(c) is None]:
            pieces = list(map(self.pattern.findall, new))
            place: dict[str, int] = {}
            index = np.fromiter((place.setdefault(p, len(place)) for ps in pieces for p in ps), np.int64)
            ids, offsets = self.merge_words([p.encode() for p in place])
            lengths = np.diff(offsets)[index]
            flat = gather_runs(ids, offsets[:-1][index], lengths)
            bounds = split_points(lengths)[split_points(np.fromiter(map(len, pieces), np.int64, len(pieces)))]
            self.starts = np.concatenate([self.starts, bounds[:-1] + len(self.flat)])
            self.lengths = np.concatenate([self.lengths, np.diff(bounds)])
            self.flat = np.concatenate([self.flat, flat])
            first = len(self.slots)
            self.slots.update(zip(new, range(first, first + len(new))))
        return np.fromiter(map(self.slots.__getitem__, chunks), np.int64, len(chunks))

    def _encode_odd(self, text: str) -> np.ndarray:
        """Ids of a text with special tokens or unusual spacing."""
        parts = self.split_special.split(text) if self.split_special else [text]
        out = []
        for k, part in enumerate(parts):
            if k % 2:
                out.append(np.array([self.special[part]], np.uint32))
            elif part:
                place: dict[str, int] = {}
                index = np.array([place.setdefault(p, len(place)) for p in self.pattern.findall(part)], np.int64)
                ids, offsets = self.merge_words([p.encode() for p in place])
                out.append(gather_runs(ids, offsets[:-1][index], np.diff(offsets)[index]))
        return np.concatenate(out) if out else np.zeros(0, np.uint32)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets): text i has ids[offsets[i] : offsets[i + 1]]."""
        odd = pc.match_substring_regex(texts, r"[ \t\n\v\f\r\x1c-\x1f] |^ | [\t\n\v\f\r\x1c-\x1f]| $|[\x{0085}\x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")
        odd = odd.to_numpy(zero_copy_only=False)
        for mark in self.special:
            odd = odd | pc.match_substring(texts, mark).to_numpy(zero_copy_only=False)
        plain = texts.filter(pa.array(~odd))
        lists = pc.split_pattern(pc.replace_substring(plain, " ", "\u0001 "), "\u0001") if not pc.any(pc.match_substring(plain, "\u0001")).as_py() else None
        if lists is None:
            odd = np.ones(len(texts), bool)
            lists = pc.split_pattern(texts.slice(0, 0), "\u0001")
        coded = lists.flatten().dictionary_encode()
        slots = self._chunk_slots(coded.dictionary.to_pylist())[coded.indices.to_numpy(zero_copy_only=False)]
        per_text = split_points(pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        lengths = self.lengths[slots]
        flat, bounds = gather_runs(self.flat, self.starts[slots], lengths), split_points(lengths)[per_text]
        if not odd.any():
            return flat, bounds
        others = [self._encode_odd(t) for t in texts.filter(pa.array(odd)).to_pylist()]
        odd_bounds = split_points(np.array([len(x) for x in others], np.int64))
        starts, sizes = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        starts[~odd], sizes[~odd] = bounds[:-1], np.diff(bounds)
        starts[odd], sizes[odd] = odd_bounds[:-1] + len(flat), np.diff(odd_bounds)
        return gather_runs(np.concatenate([flat, *others]), starts, sizes), split_points(sizes)

    def decode_bytes(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of the ids' tokens, one after the other; ids outside the vocabulary give none."""
        ids = ids[ids < self.size]
        return gather_runs(self.token_bytes, self.token_starts[ids], self.token_lengths[ids])

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_bytes(ids).tobytes().decode("utf-8", "replace")


def encode_documents(docs: DataFrame, name: str) -> DataFrame:
    """doc_id, ids array<int>, decoded: the ids of every text and the text they decode to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                ids, at = coder(name).encode(strings_of(part.column("text")))
                decoded = [coder(name).decode(ids[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
                lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists, pa.array(decoded, pa.string())], names=["doc_id", "ids", "decoded"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def encoding_digests(docs: DataFrame, name: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: digests made beside the ids, which stay in the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                ids, at = coder(name).encode(strings_of(part.column("text")))
                rows = [[], []]
                for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
                    rows[0].append(hashlib.sha256(ids[a:b].astype("<u4").tobytes()).hexdigest())
                    rows[1].append(hashlib.sha256(coder(name).decode(ids[a:b]).encode("utf-8")).hexdigest())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.diff(at)), *(pa.array(r, pa.string()) for r in rows)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
