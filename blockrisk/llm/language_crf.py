"""Language of words and texts by a linear-chain conditional random field.

The words of a text (runs of letters, lower-cased) are a chain with one state per language. A word
speaks for a state by the sum of learned weights of its features: its first one to four letters, its
last one to four, every run of one to four letters, and the word itself where the lexicon of the
sample has it. Learned weights of moves between states say how often a writer switches. Weights are
fitted together, by the gradient of the likelihood of whole chains, on a bounded sample: pieces of
labelled documents, spliced in random order to chains that switch in the middle, so that moves are
learned as well as features.

Words are labelled by forward-backward: each gets its probability of every language, given all words
of its text. All texts of a slice form one chain in which the first word of a text forgets what was
before. The chain is cut into as many blocks as a block has words; products of the blocks' matrices
carry the state from block to block, and all blocks are then run through at once, so a text of any
length costs the same per word and is exact to its ends.

A text's language has the largest sum of probabilities over its words, the first in alphabetical
order among equals; its score is that sum's share. ``spans`` are the runs of words whose most
probable language is the same.

Cases: a null or empty text, or one without a letter, is ``und`` with score 0 and no spans; repeated
rows are answered alike; rows without an id are labelled, but never teach; rows whose language is
null never teach; an empty table gives no rows; where no row may teach, every text is ``und``.
Memory grows with the longest text, by some 100 bytes a word and state. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blockrisk.llm.frames import slices, split_points, strings_of

UNKNOWN = "und"
#: The sample: so many documents of each language, of at most so many bytes each.
PER_LANGUAGE, TRAINING_BYTES = 300, 8192
#: Words of a piece on average, and of a chain, when documents are spliced for training.
PIECE_WORDS, CHAIN_WORDS = 24, 96
LONGEST_GRAM = 4
#: Features are kept that the sample shows so often, the most frequent so many.
LEAST_SEEN, MOST_FEATURES = 3, 400_000
ROUNDS, RATE, PENALTY = 25, 0.2, 1e-4
_MIX, _BASE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0x100000001B3)
TAGGED = (
    "doc_id long, n_words long, lang string, score double, shares array<struct<lang: string, words: double>>, "
    "spans array<struct<lang: string, first_word: long, words: long, probability: double>>"
)


def word_runs(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(distinct words, number of each word of the texts in order, offsets of the texts in them)."""
    low = pc.replace_substring_regex(pc.utf8_lower(texts), r"[^\p{L}\p{M}]+", " ")
    low = pc.replace_substring_regex(low, r"(^| )\p{M}+", r"\1")
    lists = pc.ascii_split_whitespace(low)
    flat = lists.flatten()
    real = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    bounds = split_points(lists.value_lengths().to_numpy(zero_copy_only=False))
    coded = flat.filter(pa.array(real)).dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), split_points(real.astype(np.int64))[bounds]


def _key(value: np.ndarray, kind: int) -> np.ndarray:
    mixed = (value + np.uint64(kind) * _BASE) * _MIX
    mixed ^= mixed >> np.uint64(29)
    return mixed * _MIX


def features(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(keys, numbers of the words that have them, rising) of each kind of feature. No word is empty."""
    if not words:
        return
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    bounds = split_points(sizes)
    starts, ends = bounds[:-1], bounds[1:]
    word = np.repeat(np.arange(len(words)), sizes)
    gram = np.zeros(len(flat), np.uint64)
    for n in range(1, LONGEST_GRAM + 1):
        gram = gram[: len(flat) - n + 1] * _BASE + flat[n - 1 :]
        inside = word[: len(gram)] == word[n - 1 :]
        yield _key(gram[inside], n), word[: len(gram)][inside]
        long = sizes >= n
        yield _key(gram[starts[long]], 100 + n), np.where(long)[0]
        yield _key(gram[ends[long] - n], 200 + n), np.where(long)[0]
    powers = np.ones(int(sizes.max()), np.uint64)
    powers[1:] = np.cumprod(np.full(len(powers) - 1, _BASE, np.uint64), dtype=np.uint64)
    whole = np.add.reduceat(flat * powers[np.arange(len(flat)) - np.repeat(starts, sizes)], starts)
    yield _key(whole, 300), np.arange(len(words))


def forward_backward(evidence: np.ndarray, first: np.ndarray, start: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scaled forward and backward values of a chain of words; their product, scaled, is each word's distribution.

    ``evidence`` has a positive row per word, ``first`` marks words at which a new text begins,
    ``start`` and ``moves`` hold the positive weights of a text's first state and of state to state.
    """
    words, states = evidence.shape
    length = max(1, int(np.ceil(np.sqrt(words))))
    blocks = -(-words // length)
    e = np.ones((blocks * length, states))
    e[:words] = evidence
    new = np.ones(blocks * length, bool)  # what pads the last block begins texts of its own
    new[:words] = first
    e, new = e.reshape(blocks, length, states), new.reshape(blocks, length)
    # the product of each block's matrices
    product = np.broadcast_to(np.eye(states), (blocks, states, states)).copy()
    for at in range(length):
        begun = product.sum(2)[:, :, None] * start
        product = np.where(new[:, at, None, None], begun, product @ moves) * e[:, None, at]
        product /= product.max((1, 2), keepdims=True)
    into, out = np.ones((blocks, states)), np.ones((blocks, states))
    for k in range(1, blocks):
        into[k] = into[k - 1] @ product[k - 1]
        into[k] /= into[k].sum()
        out[-k - 1] = product[-k] @ out[-k]
        out[-k - 1] /= out[-k - 1].sum()
    forward, backward = np.empty_like(e), np.empty_like(e)
    for at in range(length):
        into = np.where(new[:, at, None], into.sum(1)[:, None] * start, into @ moves) * e[:, at]
        into /= into.sum(1)[:, None]
        forward[:, at] = into
    for at in range(length - 1, -1, -1):
        backward[:, at] = out
        seen = e[:, at] * out
        out = np.where(new[:, at, None], (seen @ start)[:, None], seen @ moves.T)
        out /= out.sum(1)[:, None]
    return forward.reshape(-1, states)[:words], backward.reshape(-1, states)[:words]


@dataclass
class LanguageModel:
    """Languages in alphabetical order, sorted feature keys with a weight per language, and weights of starts and moves."""

    languages: list[str]
    keys: np.ndarray
    weights: np.ndarray
    start: np.ndarray
    moves: np.ndarray

    def evidence(self, words: list[str]) -> np.ndarray:
        """What each word's features say for every language, the largest being 1."""
        total = np.zeros((len(words), len(self.languages)))
        for keys, word in features(words) if len(self.keys) else ():
            place = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            hit = self.keys[place] == keys
            place, word = place[hit], word[hit]
            if len(place):
                runs = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
                total[word[runs]] += np.add.reduceat(self.weights[place], runs)
        return np.exp(np.maximum(total - total.max(1, keepdims=True), -60.0))

    def label(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(probability of every language for each word, offsets of the texts)."""
        words, number, bounds = word_runs(texts)
        if not len(number) or not self.languages:
            return np.zeros((0, max(1, len(self.languages)))), np.zeros(len(texts) + 1, np.int64)
        first = np.zeros(len(number), bool)
        first[bounds[:-1][np.diff(bounds) > 0]] = True
        forward, backward = forward_backward(self.evidence(words)[number], first, np.exp(self.start), np.exp(self.moves))
        both = forward * backward
        return both / both.sum(1, keepdims=True), bounds


def _chains(number: np.ndarray, bounds: np.ndarray, language: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word numbers, languages, marks of first words) of pieces of the texts in random order."""
    cuts = [np.append(np.arange(a, b, max(1, int(rng.integers(1, 2 * PIECE_WORDS)))), b) for a, b in zip(bounds[:-1], bounds[1:]) if b > a]
    starts, stops = np.concatenate([c[:-1] for c in cuts]), np.concatenate([c[1:] for c in cuts])
    owner = np.searchsorted(bounds, starts, "right") - 1
    order = rng.permutation(len(starts))
    take = np.concatenate([np.arange(starts[k], stops[k]) for k in order])
    spoken = np.repeat(language[owner[order]], (stops - starts)[order])
    return number[take], spoken, np.arange(len(take)) % CHAIN_WORDS == 0


def fit(texts: list[str], spoken: list[str], rounds: int = ROUNDS, seed: int = 3) -> LanguageModel:
    languages = sorted(set(spoken))
    states = len(languages)
    words, number, bounds = word_runs(pa.array(texts, pa.string()))
    nothing = LanguageModel([], np.zeros(0, np.uint64), np.zeros((0, 0)), np.zeros(0), np.zeros((0, 0)))
    if not states or not len(number):
        return nothing
    language = np.searchsorted(np.array(languages, object), np.array(spoken, object))
    number, truth, first = _chains(number, bounds, language, np.random.default_rng(seed))
    seen = np.bincount(number, minlength=len(words))
    pairs = list(features(words))
    keys, of = np.concatenate([k for k, _ in pairs]), np.concatenate([w for _, w in pairs])
    known, place = np.unique(keys, return_inverse=True)
    counts = np.bincount(place, seen[of])
    least = max(LEAST_SEEN, np.partition(counts, -MOST_FEATURES)[-MOST_FEATURES] if len(counts) > MOST_FEATURES else 0)
    kept = counts >= least
    renumber = np.cumsum(kept) - 1
    use = kept[place]
    place, of = renumber[place[use]], of[use]
    model = LanguageModel(languages, known[kept], np.zeros((int(kept.sum()), states)), np.zeros(states), np.zeros((states, states)))
    onehot = np.zeros((len(number), states))
    onehot[np.arange(len(number)), truth] = 1
    after = np.flatnonzero(~first)
    observed = np.zeros((states, states))
    np.add.at(observed, (truth[after - 1], truth[after]), 1)
    params = [model.weights, model.start, model.moves]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    for turn in range(1, rounds + 1):
        score = np.stack([np.bincount(of, model.weights[place, s], len(words)) for s in range(states)], 1)
        evidence = np.exp(np.maximum(score - score.max(1, keepdims=True), -60.0))[number]
        start, moves = np.exp(model.start), np.exp(model.moves)
        forward, backward = forward_backward(evidence, first, start, moves)
        both = forward * backward
        wrong = both / both.sum(1, keepdims=True) - onehot
        left, right = forward[after - 1], evidence[after] * backward[after]
        scale = 1.0 / ((left @ moves) * right).sum(1)
        expected = ((left * scale[:, None]).T @ right) * moves
        by_word = np.stack([np.bincount(number, wrong[:, s], len(words)) for s in range(states)], 1)
        by_feature = np.stack([np.bincount(place, by_word[of, s], len(model.keys)) for s in range(states)], 1)
        rows = len(number)
        gradients = [by_feature / rows + PENALTY * model.weights / max(1, len(model.keys)), wrong[first].sum(0) / rows, (expected - observed) / rows]
        rate = RATE * (1 - (turn - 1) / rounds) ** 0.5
        for p, g, (m, v) in zip(params, gradients, moments):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= rate * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.99**turn)) + 1e-9)
    return model


def held_out(id_col: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves 2 by division by four; such rows never teach the model."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def language_sample(docs: DataFrame, per_language: int = PER_LANGUAGE, most_bytes: int = TRAINING_BYTES, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], list[str]]:
    """(texts, languages): of each language the documents of the lowest hash of id and text, of at most ``most_bytes`` bytes.

    A share of the hashes that holds about twice the rows wanted goes on to the ranking, so that a
    language of a third of all rows sends no more to it than any other.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang"))
    fine = F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out() & (F.octet_length("text") <= most_bytes) & F.col("text").rlike(r"\p{L}")
    teaching = rows.where(fine)
    sizes = {r.lang: r["count"] for r in teaching.groupBy("lang").count().collect()}
    if not sizes:
        return [], []
    million = 1_000_000
    limits = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(million, 1 + 2 * per_language * million // n))])
    near = teaching.withColumn("rank", F.xxhash64("doc_id", "text")).where(F.pmod(F.col("rank"), F.lit(million)) < limits[F.col("lang")])
    order = F.row_number().over(Window.partitionBy("lang").orderBy("rank", "doc_id", "text"))
    chosen = near.withColumn("place", order).where(F.col("place") <= per_language).select("lang", "place", "text").collect()
    chosen.sort(key=lambda r: (r.lang, r.place))
    return [r.text for r in chosen], [r.lang for r in chosen]


def fit_language(docs: DataFrame, per_language: int = PER_LANGUAGE, most_bytes: int = TRAINING_BYTES, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    return fit(*language_sample(docs, per_language, most_bytes, id_col, text_col, lang_col))


def _tagged(model: LanguageModel, ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
    """One row per text, as ``TAGGED`` says."""
    probability, bounds = model.label(texts)
    counts, languages = np.diff(bounds), np.array([*model.languages, UNKNOWN], object)
    some, states = counts > 0, max(1, len(model.languages))
    sums = np.zeros((len(texts), states))
    if some.any():
        sums[some] = np.add.reduceat(probability, bounds[:-1][some])
    best = np.where(some, sums.argmax(1), len(model.languages))
    score = np.where(some, np.minimum(1.0, sums.max(1) / np.maximum(counts, 1)), 0.0)
    # runs of words with one most probable language, broken where a text begins
    winner, text = probability.argmax(1), np.repeat(np.arange(len(texts)), counts)
    begin = np.flatnonzero(np.append(True, (winner[1:] != winner[:-1]) | (text[1:] != text[:-1]))) if len(winner) else np.zeros(0, np.int64)
    words = np.diff(np.append(begin, len(winner)))
    sure = np.add.reduceat(probability.max(1), begin) / words if len(begin) else np.zeros(0)
    strings = lambda numbers: pa.DictionaryArray.from_arrays(pa.array(numbers, pa.int32()), pa.array(languages.tolist(), pa.string())).cast(pa.string())
    spans = pa.StructArray.from_arrays([strings(winner[begin]), pa.array(begin - bounds[text[begin]]), pa.array(words), pa.array(sure)], names=["lang", "first_word", "words", "probability"])
    said = int(some.sum())
    shares = pa.StructArray.from_arrays([strings(np.tile(np.arange(states), said)), pa.array(sums[some].ravel())], names=["lang", "words"])
    offsets = lambda sizes: pa.array(split_points(sizes), pa.int32())
    return pa.RecordBatch.from_arrays([
        ids, pa.array(counts), strings(best), pa.array(score), pa.ListArray.from_arrays(offsets(some * states), shares),
        pa.ListArray.from_arrays(offsets(np.bincount(text[begin], minlength=len(texts))), spans),
    ], names=["doc_id", "n_words", "lang", "score", "shares", "spans"])


def tag_languages(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, lang, score, shares (expected words of each language) and spans, for every row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield _tagged(model, part.column("doc_id"), strings_of(part.column("text")))

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(run, TAGGED)
