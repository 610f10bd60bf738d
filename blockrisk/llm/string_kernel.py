"""Toxicity by a support vector machine over a gap-weighted subsequence string kernel.

The kernel of two strings sums over all common subsequences of ``LENGTH`` characters whose
occurrences span at most ``SPAN`` characters, each weighed down by ``DECAY`` for every character
that it spans, and is normalised by length: strings that differ by inserted, doubled or dropped
characters stay close. Strings are the words of a sentence,
lower-cased, without marks inside a word, single letters in a row joined ("i.d-i o t"), between a
begin and an end mark. Nyström landmarks, chosen from the labelled sentences, give every word a
short feature vector; a linear support vector machine on it scores the word, a sentence scores as
its worst word and a document as its worst sentence, mapped to a probability on the training rows.

Training takes a bounded sample (``PER_CLASS`` documents of either label, of at most
``TRAINING_BYTES`` bytes), cut into sentences. Sentences of clean documents are negative; those of
toxic documents are positive where they hold a word or a beginning of words that few clean ones
hold, and the machine then picks the word in each that is most so. Scoring reads every text whole; each task
scores a distinct word once.

Cases: a null or empty text, or one without letters, scores as the mildest word would; repeated
rows score alike; an empty table gives no rows; without labels of both kinds every score is 0.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from heapq import heapify, heappop, heappush
from itertools import combinations, groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from blockrisk.llm.frames import KEPT, SCORE_BYTES, id_and_text, keep_only, scored_rows, slices, split_points, strings_of
from blockrisk.llm.labelled_sample import labelled_sample

LENGTH, SPAN, DECAY = 4, 6, 0.6
LANDMARKS = 96
PER_CLASS, TRAINING_BYTES = 2000, 16_384
SENTENCE_WORDS = 64
#: Distinct clean words of the sample that the machine may learn from, at most.
MOST_NEGATIVES = 80_000
#: A worker keeps the words of the model in use only, and about so many bytes of them.
CACHE_BYTES, BYTES_PER_WORD = 24 << 20, 160
#: Words whose features are held at once; each has some ten rows of ``LANDMARKS`` numbers on the way.
MARGIN_WORDS = 2048
BEGIN, END = "\x02", "\x03"
RESULT = "doc_id long, score double"
_INSIDE = r"([\p{L}])[^\p{L}\s]+([\p{L}])"
_WORDS: dict[str, dict[str, float]] = {}


def _words_of(number: str) -> dict[str, float]:
    """The worker's scored words of one model; those of any other are dropped, and all once they are too many."""
    if number not in _WORDS or len(_WORDS[number]) * BYTES_PER_WORD > CACHE_BYTES:
        _WORDS.clear()
    return _WORDS.setdefault(number, {})


def forget_words() -> None:
    """Drops the scored words of all models: another stage needs the memory of this worker now."""
    _WORDS.clear()


KEPT["words"] = forget_words


def word_lists(texts: pa.Array) -> pa.Array:
    """For each text its words of letters: marks inside words dropped, single letters in a row joined."""
    low = pc.utf8_lower(texts)
    # twice, since matches that share a letter do not overlap
    for _ in range(2):
        low = pc.replace_substring_regex(low, _INSIDE, r"\1\2")
    low = pc.replace_substring_regex(low, r"[^\p{L}]+", " ")
    spelt = pc.match_substring_regex(low, r"(^| )\p{L} \p{L} \p{L}( |$)")
    if pc.any(spelt).as_py():
        low = pc.if_else(spelt, _joined_letters(low), low)
    return pc.ascii_split_whitespace(low)


def _joined_letters(low: pa.Array) -> pa.Array:
    import regex

    run = regex.compile(r"(?<!\S)(?:\p{L} ){2,}\p{L}(?!\S)")
    return pa.array([run.sub(lambda m: m.group().replace(" ", ""), t) for t in low.to_pylist()], pa.string())


def _gaps(length: int, span: int) -> list[tuple[int, ...]]:
    """Places of a subsequence's characters after its first, for all spans allowed."""
    return [c for c in combinations(range(1, span), length - 1)]


def _norms(sizes: np.ndarray) -> np.ndarray:
    """Root of a string's kernel with itself, as if all its subsequences differed."""
    total = np.zeros(len(sizes))
    for places in _gaps(LENGTH, SPAN):
        total += np.maximum(sizes - places[-1], 0) * DECAY ** (2 * (places[-1] + 1))
    return np.sqrt(np.maximum(total, DECAY ** (2 * LENGTH)))


class KernelTable:
    """Kernel with fixed landmarks: from each subsequence they hold to its weight in each of them."""

    def __init__(self, landmarks: list[str]):
        self.landmarks = landmarks
        characters = sorted(set("".join(landmarks)))
        self.points = np.array([ord(c) for c in characters], np.uint32)
        self.base = len(characters) + 1
        weights: dict[int, np.ndarray] = {}
        for k, mark in enumerate(landmarks):
            codes, word = self._codes([mark])
            for places in _gaps(LENGTH, SPAN):
                keys, _ = self._keys(codes, word, places)
                for key in keys.tolist():
                    weights.setdefault(key, np.zeros(len(landmarks), np.float32))[k] += DECAY ** (places[-1] + 1)
        self.keys = np.array(sorted(weights), np.int64)
        self.weights = np.array([weights[k] for k in self.keys.tolist()], np.float32).reshape(-1, len(landmarks))
        self.norms = _norms(np.array([len(m) for m in landmarks]))

    def _codes(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(number of each character, 0 where no landmark has it; word of each character)."""
        flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        place = np.minimum(np.searchsorted(self.points, flat), len(self.points) - 1)
        codes = np.where(self.points[place] == flat, place + 1, 0).astype(np.int64)
        return codes, np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)))

    def _keys(self, codes: np.ndarray, word: np.ndarray, places: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
        """(key, word) of every subsequence with the given places that lies in one word and in the alphabet."""
        n = max(len(codes) - places[-1], 0)
        key, inside = codes[:n].copy(), (word[:n] == word[places[-1] : places[-1] + n]) & (codes[:n] > 0)
        for place in places:
            other = codes[place : place + n]
            key = key * self.base + other
            inside &= other > 0
        return key[inside], word[:n][inside]

    def features(self, words: list[str], block: int = 8192) -> np.ndarray:
        """Normalised kernel of every word with every landmark, a block of words at a time."""
        out = np.zeros((len(words), len(self.landmarks)), np.float32)
        for first in range(0, len(words), block):
            self._fill(words[first : first + block], out[first : first + block])
        return out

    def _fill(self, words: list[str], out: np.ndarray) -> None:
        codes, word = self._codes(words)
        for places in _gaps(LENGTH, SPAN):
            key, of = self._keys(codes, word, places)
            row = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[row] == key
            row, of = row[hit], of[hit]
            if len(row):
                starts = np.where(np.append(True, of[1:] != of[:-1]))[0]
                out[of[starts]] += np.add.reduceat(self.weights[row], starts) * np.float32(DECAY ** (places[-1] + 1))
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        out /= (_norms(sizes)[:, None] * self.norms).astype(np.float32)


@dataclass
class ToxicityModel:
    table: KernelTable | None = None
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = 0.0
    slope: float = 0.0
    shift: float = -40.0
    number: str = ""

    def seal(self) -> None:
        """Names the model by all that a word's margin depends on."""
        parts = [repr(self.table.landmarks).encode(), np.asarray(self.weights, np.float64).tobytes(), np.float64(self.bias).tobytes()]
        self.number = hashlib.sha256(b"|".join(parts)).hexdigest()

    def margins(self, words: list[str]) -> np.ndarray:
        """Signed distance of each word; very long words count as their worst overlapping window."""
        if self.table is None or not words:
            return np.zeros(len(words))
        return np.concatenate([self._margins(words[first : first + MARGIN_WORDS]) for first in range(0, len(words), MARGIN_WORDS)])

    def _margins(self, words: list[str]) -> np.ndarray:
        pieces = [_windows(w) for w in words]
        values = self.table.features([p for ps in pieces for p in ps], MARGIN_WORDS) @ self.weights + self.bias
        return np.maximum.reduceat(values, split_points(np.array([len(p) for p in pieces], np.int64))[:-1])

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * margin + self.shift, -40, 40)))

    def score(self, texts: pa.Array) -> np.ndarray:
        lists = word_lists(texts)
        coded = lists.flatten().dictionary_encode()
        known = _words_of(self.number)
        words = coded.dictionary.to_pylist()
        new = [w for w in words if w not in known]
        known.update(zip(new, self.margins(new).tolist()))
        margins = np.fromiter(map(known.__getitem__, words), np.float64, len(words))[coded.indices.to_numpy(zero_copy_only=False)]
        at = split_points(lists.value_lengths().to_numpy(zero_copy_only=False))
        worst = np.full(len(texts), self.bias)
        some = np.diff(at) > 0
        if some.any():
            worst[some] = np.maximum.reduceat(margins, at[:-1][some])
        return self.probability(np.maximum(worst, self.bias)) if self.table else np.zeros(len(texts))


def _windows(word: str, width: int = 32) -> list[str]:
    if len(word) <= width:
        return [BEGIN + word + END]
    starts = range(0, len(word) - width // 2, width // 2)
    return [(BEGIN if s == 0 else "") + word[s : s + width] + (END if s + width >= len(word) else "") for s in starts]


def _sentences(texts: list[str]) -> tuple[list[list[str]], list[int]]:
    """(sentences as word lists, number of the text of each)."""
    cut = [(s, number) for number, text in enumerate(texts) for s in re.split(r"[.!?\n]+", text) if s.strip()]
    out, owner, one = [], [], {}  # each distinct word is held once
    for start in range(0, len(cut), 2000):
        part = cut[start : start + 2000]
        for words, (_, number) in zip(word_lists(pa.array([s for s, _ in part], pa.string())).to_pylist(), part):
            words = [one.setdefault(w, w) for w in words if w]
            for first in range(0, len(words), SENTENCE_WORDS):
                out.append(words[first : first + SENTENCE_WORDS])
                owner.append(number)
    return out, owner


def _strings(word: str) -> Iterator[str]:
    """The word between its marks, and its beginnings of four to seven letters."""
    whole = BEGIN + word + END
    yield whole
    for size in range(5, min(len(whole) - 1, 9)):
        yield whole[:size]


def _contrast(by_text: list[tuple[str, ...]], labels: np.ndarray, most: int) -> list[str]:
    """Strings that mark toxic texts, chosen greedily so that each such text is explained a few times."""
    toxic: Counter = Counter()
    for number in np.where(labels == 1)[0].tolist():
        toxic.update({s for w in by_text[number] for s in _strings(w)})
    least = max(3, int(labels.sum()) // 100)
    pool = {s for s, n in toxic.items() if n >= least}
    del toxic
    holders: dict[str, set[int]] = defaultdict(set)
    clean: Counter = Counter()
    for number, words in enumerate(by_text):
        for s in {s for w in words for s in _strings(w) if s in pool}:
            if labels[number]:
                holders[s].add(number)
            else:
                clean[s] += 1
    left = np.where(labels == 1, 3, 0)
    gain = lambda s: int((left[list(holders[s])] > 0).sum()) - 4 * clean[s]
    heap = [(-(len(h) - 4 * clean[s]), -len(s), s) for s, h in holders.items() if len(h) >= 4 * clean[s]]
    heapify(heap)
    chosen: list[str] = []
    while heap and len(chosen) < most:
        _, size, s = heappop(heap)
        now = gain(s)
        if heap and -now > heap[0][0]:
            heappush(heap, (-now, size, s))
        elif now < least:
            break
        else:
            chosen.append(s)
            left[list(holders[s])] -= 1
    return chosen


def _linear_svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, rounds: int = 40, seed: int = 7) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the hinge loss; ``cost`` bounds each row's multiplier."""
    x = np.hstack([x, np.ones((len(x), 1))])
    norms, alpha, w = (x * x).sum(1) + 1e-12, np.zeros(len(x)), np.zeros(x.shape[1])
    rng, active = np.random.default_rng(seed), np.arange(len(x))
    for turn in range(rounds):
        moved = 0.0
        for i in rng.permutation(active):
            gradient = y[i] * (x[i] @ w) - 1
            new = min(max(alpha[i] - gradient / norms[i], 0.0), cost[i])
            if new != alpha[i]:
                moved += abs(new - alpha[i])
                w += (new - alpha[i]) * y[i] * x[i]
                alpha[i] = new
        if turn % 5 == 4:  # rows that are far on the right side rest, all are looked at again now and then
            margin = y * (x @ w)
            active = np.arange(len(x)) if turn % 20 == 19 else np.where((margin < 1.5) | (alpha > 0))[0]
        if moved < 1e-3:
            break
    return w[:-1], float(w[-1])


def fit(texts: list[str], labels: list[int], landmarks: int = LANDMARKS, seed: int = 7) -> ToxicityModel:
    y = np.array(labels, np.int64)
    if len(set(labels)) < 2:
        return ToxicityModel()
    sentences, owner = _sentences(texts)
    by_text: list[tuple[str, ...]] = [()] * len(texts)
    for number, group in groupby(zip(owner, sentences), key=lambda x: x[0]):
        by_text[number] = tuple(sorted({w for _, words in group for w in words}))
    marks = _contrast(by_text, y, landmarks * 2 // 3)
    if not marks:
        return ToxicityModel()
    rng = np.random.default_rng(seed)
    clean_words = Counter(w for number, words in enumerate(by_text) if not y[number] for w in words)
    usual = [BEGIN + w + END for w, _ in clean_words.most_common(400) if len(w) >= 3]
    usual = [usual[k] for k in rng.permutation(len(usual))[: landmarks - len(marks)]]
    model = ToxicityModel(KernelTable(list(dict.fromkeys(marks + usual))))
    # Nyström: features k(x, landmarks) W^(-1/2), W the kernel among the landmarks
    values, vectors = np.linalg.eigh(model.table.features(model.table.landmarks).astype(np.float64))
    whiten = (vectors / np.sqrt(np.maximum(values, 1e-3))).astype(np.float32)
    windows = lambda words: [_windows(w)[0] for w in words]
    negatives = list(clean_words)
    if len(negatives) > MOST_NEGATIVES:
        negatives = [negatives[k] for k in rng.permutation(len(negatives))[:MOST_NEGATIVES]]
    negative = model.table.features(windows(negatives))
    marked = set(marks)
    telling = {w for number, words in enumerate(by_text) if y[number] for w in words if not marked.isdisjoint(_strings(w))}
    positives = [[w for w in words if w in telling] for words, number in zip(sentences, owner) if y[number]]
    positives = [p for p in positives if p]
    place = {w: k for k, w in enumerate(sorted(telling))}
    positive = model.table.features(windows(list(place)))
    guess, hard = positive[:, : len(marks)].max(1), np.argsort(-negative[:, : len(marks)].max(1))[:4000]
    for _ in range(3):
        counts = Counter(max(p, key=lambda w: guess[place[w]]) for p in positives)
        chosen = list(counts)
        x = np.vstack([positive[[place[w] for w in chosen]], negative[hard]]) @ whiten
        target = np.array([1] * len(chosen) + [-1] * len(hard))
        cost = np.array([float(min(counts[w], 20)) for w in chosen] + [2.0 * min(clean_words[negatives[k]], 20) for k in hard])
        w, model.bias = _linear_svm(x, target, cost)
        model.weights = whiten @ w
        guess = positive @ model.weights + model.bias
        hard = np.argsort(-(negative @ model.weights))[:4000]
    worst = np.array([model.margins(list(words)).max() if words else model.bias for words in by_text])
    model.slope, model.shift = _logistic(np.maximum(worst, model.bias), y)
    model.seal()
    return model


def _logistic(margin: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and shift of a probability over margins, by Newton steps with a light penalty."""
    x, theta = np.stack([margin, np.ones(len(margin))], 1), np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -40, 40)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (y - p) - 1e-3 * theta)
        theta += step
        if np.abs(step).max() < 1e-8:
            break
    return float(theta[0]), float(theta[1])


def fit_toxicity(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, most_bytes: int = TRAINING_BYTES) -> ToxicityModel:
    return fit(*labelled_sample(docs, labels, "toxic", per_class, most_bytes))


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, score for every row of ``docs``; ``keep_mild`` filters the rows themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only("words")
        for batch in batches:
            for part in slices(batch, "text", SCORE_BYTES):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(model.score(strings_of(part.column("text"))))], names=["doc_id", "score"])

    return id_and_text(docs).mapInArrow(run, RESULT)


def keep_mild(docs: DataFrame, model: ToxicityModel, most: float) -> DataFrame:
    """The rows of ``docs``, with all their columns, that score below ``most``."""
    return scored_rows(docs, model.score, lambda score: score < most, kept="words")
