"""Quality of a text by a byte-level convolutional network in numpy.

A text's bytes are cut into overlapping chunks of ``CHUNK`` bytes, one every ``STRIDE``, so that the
chunks cover the whole text. Each byte value has a learned vector; learned filters turn a chunk's
vectors into ``FILTERS`` values (with a threshold at zero), which are combined over all chunks by
their maximum and their mean; a hidden layer joins them into one probability. As every filter is a
sum over the chunk's bytes, a filter bank is one table per place in the chunk, so scoring adds
``CHUNK`` table rows per chunk and no product is left in the task.

Training takes a bounded sample (``PER_CLASS`` documents of either label, of at most
``TRAINING_BYTES`` bytes) on the driver, by Adam with a fixed seed; scoring reads every text whole.

Cases: a null or empty text counts as one chunk of padding, as does a text shorter than a chunk
with padding behind it; repeated rows score alike; an empty table gives no rows; without labels of
both kinds every score is 1, so nothing is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockrisk.llm.frames import SCORE_BYTES, id_and_text, keep_only, scored_rows, slices, split_points, strings_of
from blockrisk.llm.labelled_sample import held_out, labelled_sample

CHUNK, STRIDE, WIDTH, FILTERS, HIDDEN = 16, 8, 6, 24, 16
PAD = 256
PER_CLASS, TRAINING_BYTES = 1200, 16_384
EPOCHS, BATCH, RATE = 14, 32, 0.01
#: Scores are raised until, of the calibrating documents of label 1, no more than this share lies below the cut.
CLEAN_LOST, CUT = 0.02, 0.3
RESULT = "doc_id long, score double"


def chunk_starts(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start of every chunk in the padded bytes, chunks per text); texts lie behind each other."""
    counts = 1 + np.maximum(0, -(-(sizes - CHUNK) // STRIDE))
    padded = (counts - 1) * STRIDE + CHUNK
    begins = split_points(padded)[:-1]
    number = np.arange(counts.sum()) - np.repeat(split_points(counts)[:-1], counts)
    return np.repeat(begins, counts) + number * STRIDE, counts


def padded_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(byte values with PAD behind each text up to its last chunk, sizes of the texts)."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32 if pa.types.is_string(texts.type) else np.int64)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    sizes = np.diff(offsets)
    _, counts = chunk_starts(sizes)
    begins = split_points((counts - 1) * STRIDE + CHUNK)
    out = np.full(begins[-1], PAD, np.int16)
    out[np.repeat(begins[:-1] - offsets[:-1], sizes) + np.arange(offsets[0], offsets[-1])] = data[offsets[0] : offsets[-1]]
    return out, sizes


@dataclass
class ByteCnn:
    """Weights of the network; ``tables`` holds for each place and byte what it adds to every filter."""

    tables: np.ndarray  # CHUNK x 257 x FILTERS
    filter_bias: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: float
    shift: float = 0.0

    def pooled(self, values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Largest and mean value of every filter over all chunks of each text."""
        starts, counts = chunk_starts(sizes)
        total = np.tile(self.filter_bias, (len(starts), 1))
        for place in range(CHUNK):
            total += self.tables[place][values[starts + place]]
        np.maximum(total, 0, out=total)
        firsts = split_points(counts)[:-1]
        return np.hstack([np.maximum.reduceat(total, firsts), np.add.reduceat(total, firsts) / counts[:, None]])

    def score(self, texts: pa.Array) -> np.ndarray:
        if len(texts) == 0:
            return np.zeros(0)
        hidden = np.maximum(self.pooled(*padded_bytes(texts)) @ self.hidden + self.hidden_bias, 0)
        return 1 / (1 + np.exp(-np.clip(hidden @ self.out + self.out_bias + self.shift, -40, 40).astype(np.float64)))


def constant(probability_logit: float) -> ByteCnn:
    zeros = lambda *shape: np.zeros(shape, np.float32)
    return ByteCnn(zeros(CHUNK, PAD + 1, FILTERS), zeros(FILTERS), zeros(2 * FILTERS, HIDDEN), zeros(HIDDEN), zeros(HIDDEN), 0.0, probability_logit)


def fit(texts: list[str], labels: list[int], prior: float = 0.5, seed: int = 11, epochs: int = EPOCHS) -> ByteCnn:
    """Trains on the sample; ``prior`` is the share of label 1 among all labelled rows, which a balanced sample hides."""
    if len(set(labels)) < 2:
        return constant(40.0)
    rng, y = np.random.default_rng(seed), np.array(labels, np.float32)
    rows = [padded_bytes(pa.array([t], pa.string())) for t in texts]
    start = lambda *shape: (rng.standard_normal(shape) / np.sqrt(np.prod(shape[:-1]))).astype(np.float32)
    p = {
        "embed": rng.standard_normal((PAD + 1, WIDTH)).astype(np.float32) * 0.5, "filters": start(CHUNK, WIDTH, FILTERS), "filter_bias": np.zeros(FILTERS, np.float32),
        "hidden": start(2 * FILTERS, HIDDEN), "hidden_bias": np.zeros(HIDDEN, np.float32), "out": start(HIDDEN, 1)[:, 0], "out_bias": np.zeros(1, np.float32),
    }
    moments, turn = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in p.items()}, 0
    # every fourth document of the sample only calibrates the result
    teaching, calibrating = (np.where((np.arange(len(rows)) % 4 == 3) == c)[0] for c in (False, True))
    balance = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    for epoch in range(epochs):
        order = rng.permutation(teaching)
        for first in range(0, len(order), BATCH):
            batch = order[first : first + BATCH]
            values = np.concatenate([rows[k][0] for k in batch])
            sizes = np.concatenate([rows[k][1] for k in batch])
            grads = _gradients(p, values, sizes, y[batch], balance[batch])
            turn += 1
            rate = RATE * (1 - epoch / epochs) ** 0.5
            for k, g in grads.items():
                m, v = moments[k]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p[k] -= rate * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.999**turn)) + 1e-8)
    tables = np.einsum("bw,cwf->cbf", p["embed"], p["filters"]).astype(np.float32)
    net = ByteCnn(tables, p["filter_bias"], p["hidden"], p["hidden_bias"], p["out"], float(p["out_bias"][0]))
    clean = [texts[k] for k in calibrating if labels[k] == 1]
    net.shift = float(np.log(prior / (1 - prior)))
    if clean:
        scores = np.clip(np.concatenate([net.score(pa.array([t], pa.string())) for t in clean]), 1e-9, 1 - 1e-9)
        low = np.quantile(np.log(scores / (1 - scores)), CLEAN_LOST)
        net.shift += max(0.0, float(np.log(CUT / (1 - CUT)) - low))
    return net


def _gradients(p: dict, values: np.ndarray, sizes: np.ndarray, y: np.ndarray, balance: np.ndarray) -> dict:
    starts, counts = chunk_starts(sizes)
    chunks = values[starts[:, None] + np.arange(CHUNK)]
    seen = p["embed"][chunks].reshape(len(starts), CHUNK * WIDTH)
    bank = p["filters"].reshape(CHUNK * WIDTH, FILTERS)
    active = np.maximum(seen @ bank + p["filter_bias"], 0)
    firsts = split_points(counts)[:-1]
    peak = np.maximum.reduceat(active, firsts)
    pooled = np.hstack([peak, np.add.reduceat(active, firsts) / counts[:, None]]).astype(np.float32)
    before = pooled @ p["hidden"] + p["hidden_bias"]
    hidden = np.maximum(before, 0)
    probability = 1 / (1 + np.exp(-np.clip(hidden @ p["out"] + p["out_bias"], -30, 30)))
    error = ((probability - y) * balance / len(y)).astype(np.float32)
    back = np.outer(error, p["out"]) * (before > 0)
    to_pool = back @ p["hidden"].T
    owner = np.repeat(np.arange(len(counts)), counts)
    # the maximum sends its gradient to the chunks that reach it, the mean to all
    slope = (to_pool[:, FILTERS:] / counts[:, None])[owner] + np.where(active == peak[owner], to_pool[:, :FILTERS][owner], 0)
    slope *= active > 0
    to_seen = (slope @ bank.T).reshape(len(starts) * CHUNK, WIDTH)
    flat = chunks.reshape(-1)
    embed = np.stack([np.bincount(flat, to_seen[:, w], PAD + 1) for w in range(WIDTH)], 1)
    return {
        "embed": embed.astype(np.float32), "filters": (seen.T @ slope).reshape(CHUNK, WIDTH, FILTERS), "filter_bias": slope.sum(0),
        "hidden": pooled.T @ back, "hidden_bias": back.sum(0), "out": hidden.T @ error, "out_bias": np.array([error.sum()], np.float32),
    }


def fit_quality(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, most_bytes: int = TRAINING_BYTES) -> ByteCnn:
    """Fits on a balanced sample and shifts the result to the share of label 1 in all rows that may teach."""
    teaching = labels.where(~held_out() & F.col("quality").isin(0, 1)).agg(F.avg("quality")).first()[0]
    prior = min(max(teaching if teaching is not None else 0.5, 0.01), 0.99)
    return fit(*labelled_sample(docs, labels, "quality", per_class, most_bytes), prior)


def score_quality(docs: DataFrame, model: ByteCnn) -> DataFrame:
    """doc_id, score for every row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only()
        for batch in batches:
            for part in slices(batch, "text", SCORE_BYTES):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(model.score(strings_of(part.column("text"))))], names=["doc_id", "score"])

    return id_and_text(docs).mapInArrow(run, RESULT)


def keep_good(docs: DataFrame, model: ByteCnn, least: float) -> DataFrame:
    """The rows of ``docs``, with all their columns, that score ``least`` or more."""
    return scored_rows(docs, model.score, lambda score: score >= least)
