"""Exact encoding by the tokenizers library, each distinct chunk of a task encoded once.

A tokenizer that drops white space, such as the word-level one, gives a text the ids of its
white-space separated chunks one after the other; a letter followed by a mark of ``.,;:!?%*$#&``
is a boundary too. Chunks repeat far more than texts, so a bounded cache over chunks saves most
of the encoding. Texts that may hold a special token, and all texts of other tokenizers, go to
the library whole.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from blockrisk.llm.frames import KEPT, gather_runs, split_points, tokenizer_path

#: Most chunks kept by a worker; the cache starts anew beyond it. Never changes a result.
CACHE_CHUNKS = 400_000
_BOUNDARY = r"([A-Za-z])([.,;:!?%*$#&])"
#: Words of these letters alone are one piece that no normalisation changes.
_PLAIN_WORD = "^[a-zß-öø-ÿ]+$"
_ENCODERS: dict[str, "LibraryEncoder"] = {}


def encoder(name: str) -> "LibraryEncoder":
    """The worker's encoder for a tokenizer file; loaded once per Python worker."""
    if name not in _ENCODERS:
        _ENCODERS[name] = LibraryEncoder(tokenizer_path(name))
    return _ENCODERS[name]


def forget_all() -> None:
    """Drops the chunks of all encoders: another stage needs the memory of this worker now."""
    for one in _ENCODERS.values():
        one._forget()


KEPT["chunks"] = forget_all


def _drops_white_space(spec: dict) -> bool:
    """Whether texts fall apart at white space: \\s+ is replaced and a split keeps matches only."""
    parts = lambda key, of: (spec.get(key) or {}).get(of) or []
    replaced = any(p.get("type") == "Replace" and p.get("pattern") == {"Regex": "\\s+"} for p in parts("normalizer", "normalizers"))
    lower = any(p.get("type") == "Lowercase" for p in parts("normalizer", "normalizers"))
    split = any(p.get("type") == "Split" and p.get("behavior") == "Removed" and p.get("invert") for p in parts("pre_tokenizer", "pretokenizers"))
    return replaced and lower and split


class LibraryEncoder:
    """Encodes arrays of texts to flat ids, as ``encode(text, add_special_tokens=False)`` would."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.is_model = path.endswith(".model")
        self.by_chunk, self.marks = False, []
        if self.is_model:
            import sentencepiece

            self.tool = sentencepiece.SentencePieceProcessor(model_file=path)
        else:
            from tokenizers import Tokenizer

            self.tool = Tokenizer.from_file(path)
            self.tool.no_truncation()
            self.tool.no_padding()
            with open(path, encoding="utf-8") as handle:
                spec = json.load(handle)
            self.by_chunk = _drops_white_space(spec)
            if self.by_chunk:  # for plain words: the same model without the steps that leave them as they are
                bytes_only = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": False, "use_regex": False}
                self.words = Tokenizer.from_str(json.dumps(spec | {"normalizer": None, "pre_tokenizer": bytes_only, "truncation": None, "padding": None}))
            self.marks = [t["content"] for t in spec.get("added_tokens", [])]
        self._forget()

    def _forget(self) -> None:
        self.slots: dict[str, int] = {}
        self.flat = np.zeros(0, np.uint32)
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)

    def whole(self, texts: list[str]) -> list[list[int]]:
        if self.is_model:
            return self.tool.encode(texts, num_threads=1)
        return [e.ids for e in self.tool.encode_batch(texts, add_special_tokens=False)]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets): text i has ids[offsets[i] : offsets[i + 1]]."""
        if not self.by_chunk:
            return _joined(self.whole(texts.to_pylist()))
        special = np.zeros(len(texts), bool)
        for mark in self.marks:
            special |= pc.match_substring(texts, mark, ignore_case=True).to_numpy(zero_copy_only=False)
        if special.any():
            return self._mixed(texts, special)
        return self._chunked(texts)

    def _mixed(self, texts: pa.Array, special: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        plain, plain_at = self._chunked(texts.filter(pa.array(~special)))
        odd, odd_at = _joined(self.whole(texts.filter(pa.array(special)).to_pylist()))
        starts, lengths = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        starts[~special], lengths[~special] = plain_at[:-1], np.diff(plain_at)
        starts[special], lengths[special] = odd_at[:-1] + len(plain), np.diff(odd_at)
        return gather_runs(np.concatenate([plain, odd]), starts, lengths), split_points(lengths)

    def _chunked(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        marked = pc.replace_substring_regex(pc.ascii_lower(texts), _BOUNDARY, r"\1 \2")
        lists = pc.ascii_split_whitespace(marked)
        chunks = lists.flatten().dictionary_encode()
        slots = self._slots(chunks.dictionary.to_pylist())[chunks.indices.to_numpy(zero_copy_only=False)]
        per_text = split_points(pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        lengths = self.lengths[slots]
        ids = gather_runs(self.flat, self.starts[slots], lengths)
        return ids, split_points(lengths)[per_text]

    def _slots(self, chunks: list[str]) -> np.ndarray:
        """Cache places of the chunks; new ones are encoded, all at once."""
        if len(self.slots) > CACHE_CHUNKS:
            self._forget()
        get = self.slots.get
        found = [get(c, -1) for c in chunks]
        if new := [c for c, slot in zip(chunks, found) if slot < 0]:
            plain = pc.match_substring_regex(pa.array(new, pa.string()), _PLAIN_WORD).to_pylist()
            words, others = [c for c, p in zip(new, plain) if p], [c for c, p in zip(new, plain) if not p]
            ids, offsets = _after(self._plain(words), _joined(self.whole(others)))
            new = words + others
            self.starts = np.concatenate([self.starts, offsets[:-1] + len(self.flat)])
            self.lengths = np.concatenate([self.lengths, np.diff(offsets)])
            self.flat = np.concatenate([self.flat, ids])
            first = len(self.slots)
            self.slots.update(zip(new, range(first, first + len(new))))
            found = map(self.slots.__getitem__, chunks)
        return np.fromiter(found, np.int64, len(chunks))


    def _plain(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if not words:
            return _joined([])
        done = self.words.encode(words, is_pretokenized=True, add_special_tokens=False)
        counts = np.bincount(np.array(done.word_ids, np.int64), minlength=len(words))
        return np.array(done.ids, np.uint32), split_points(counts)


def _after(one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate([one[0], two[0]]), np.concatenate([one[1], two[1][1:] + len(one[0])])


def _joined(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    offsets = split_points(np.fromiter(map(len, lists), np.int64, len(lists)))
    flat = np.empty(int(offsets[-1]), np.uint32)
    for at, ids in zip(offsets.tolist(), lists):
        flat[at : at + len(ids)] = ids
    return flat, offsets
