"""Packing of documents into token sequences of bounded length by swap-based local search.

Each document's ids (with an end id) are cut into pieces only where they exceed the length of a
sequence. Pieces are dealt into groups of about ``GROUP_PIECES``; a group starts from best fit in
falling order and is then improved: a piece of the emptiest bin moves into another bin, or is
exchanged for a shorter one there, two for one or one for two, always so that the squared fill
grows, until the emptiest bin is empty or nothing improves. Bins left well underfull are pooled
over all groups and packed again, round by round, until one group holds them or a round saves no
bin, so that groups together waste hardly more than one search over all pieces would.

Cases: a null text is empty and gives one piece that holds the end id; repeated rows are packed as
often as they occur (``deal`` tells them apart); equal lengths fall in the order of the rows;
an empty table gives no rows; a null doc_id is kept; further columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockrisk.llm.bit_packing import encoded
from blockrisk.llm.frames import TEXT_BATCH, id_and_text, keep_only, slices, split_points, written
from blockrisk.session import settings

GROUP_PIECES = 4096
#: Bins whose gap is at least this share of a sequence are packed again with those of other groups.
OPEN_GAP = 1 / 16
MOST_ROUNDS = 8
#: Bytes of text encoded at once: arrays of ids and places take some twenty times as much.
CUT_BYTES = 1 << 20

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, deal long"
PACKED_SCHEMA = PIECE_SCHEMA + ", sequence_id long, offset long, is_open boolean"


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, list[int]]:
    """Best fit in falling order: (bin of each piece, fill of each bin)."""
    bin_of, fills = np.zeros(len(lengths), np.int64), []
    by_gap: dict[int, list[int]] = {}
    gaps = 0  # bit g is set while a bin with gap g is there
    for item in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[item])
        fitting = gaps >> length
        if fitting:
            gap = length + (fitting & -fitting).bit_length() - 1
            chosen = by_gap[gap].pop()
            if not by_gap[gap]:
                gaps &= ~(1 << gap)
            fills[chosen] += length
        else:
            chosen = len(fills)
            fills.append(length)
            gap = capacity
        bin_of[item] = chosen
        left = capacity - fills[chosen]
        by_gap.setdefault(left, []).append(chosen)
        gaps |= 1 << left
    return bin_of, fills


def local_search(lengths: np.ndarray, bin_of: np.ndarray, fills: list[int], capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Empties bins by moves and exchanges that increase squared fill, down to the lower bound at most."""
    fills, bin_of = np.array(fills, np.int64), bin_of.copy()
    least = -(-int(lengths.sum()) // capacity) if len(lengths) else 0
    stuck = np.zeros(len(fills), bool)
    while int((fills > 0).sum()) > least:
        candidates = np.where((fills > 0) & ~stuck)[0]
        if len(candidates) < 2:
            break
        victim = int(candidates[np.argmin(fills[candidates])])
        while fills[victim] and _improve(lengths, bin_of, fills, victim, capacity):
            pass
        if fills[victim]:
            stuck[victim] = True
            if fills[victim] * 4 > capacity * 3:
                break
    return bin_of, fills


def _improve(lengths: np.ndarray, bin_of: np.ndarray, fills: np.ndarray, victim: int, capacity: int) -> bool:
    """One move or exchange between ``victim`` and a bin at least as full; False if none increases squared fill."""
    own = np.where(bin_of == victim)[0]
    own = own[np.unique(lengths[own], return_index=True)[1]]
    gaps = capacity - fills
    hosts = (fills >= fills[victim]) & (gaps > 0)
    hosts[victim] = False
    open_bins = np.where(hosts)[0]
    if not len(own) or not len(open_bins):
        return False
    for item in own[::-1]:  # move: the bin it fills best
        room = gaps[open_bins] - lengths[item]
        if (room >= 0).any():
            host = int(open_bins[np.argmin(np.where(room >= 0, room, capacity + 1))])
            return _apply(lengths, bin_of, fills, [item], [], victim, host)
    others = np.where(hosts[bin_of])[0]
    room = gaps[bin_of[others]]
    for item in own[::-1]:  # one for one
        gain = lengths[item] - lengths[others]
        gain = np.where((gain > 0) & (gain <= room), gain, 0)
        if gain.any():
            other = int(others[np.argmax(gain)])
            return _apply(lengths, bin_of, fills, [item], [other], victim, int(bin_of[other]))
    all_own = np.where(bin_of == victim)[0]
    for one in range(min(len(all_own), 64)):  # two for one
        for two in range(one):
            pair = [int(all_own[one]), int(all_own[two])]
            gain = int(lengths[pair].sum()) - lengths[others]
            gain = np.where((gain > 0) & (gain <= room), gain, 0)
            if gain.any():
                other = int(others[np.argmax(gain)])
                return _apply(lengths, bin_of, fills, pair, [other], victim, int(bin_of[other]))
    order = others[np.argsort(bin_of[others], kind="stable")]
    same = bin_of[order[:-1]] == bin_of[order[1:]]
    pairs = np.stack([order[:-1][same], order[1:][same]]) if same.any() else np.zeros((2, 0), np.int64)
    for item in own[::-1]:  # one for two that lie in the same bin
        gain = lengths[item] - lengths[pairs].sum(0)
        gain = np.where((gain > 0) & (gain <= gaps[bin_of[pairs[0]]]), gain, 0)
        if gain.any():
            two = pairs[:, int(np.argmax(gain))].tolist()
            return _apply(lengths, bin_of, fills, [item], two, victim, int(bin_of[two[0]]))
    return False


def _apply(lengths: np.ndarray, bin_of: np.ndarray, fills: np.ndarray, out: list, back: list, victim: int, host: int) -> bool:
    gain = int(lengths[out].sum()) - int(lengths[back].sum() if back else 0)
    bin_of[out], fills[host], fills[victim] = host, fills[host] + gain, fills[victim] - gain
    if back:
        bin_of[back] = victim
    return True


def pack(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset in it, fill of it) of each piece; bins are numbered from 0."""
    bin_of, fills = local_search(lengths, *best_fit(lengths, capacity), capacity)
    bin_of = np.unique(bin_of, return_inverse=True)[1].reshape(-1)
    order = np.argsort(bin_of, kind="stable")
    ends = np.cumsum(lengths[order])
    firsts = np.searchsorted(bin_of[order], np.arange(bin_of.max() + 1 if len(bin_of) else 0))
    base = (ends - lengths[order])[firsts]
    offsets = np.empty(len(lengths), np.int64)
    offsets[order] = ends - lengths[order] - base[bin_of[order]]
    return bin_of, offsets, np.bincount(bin_of, lengths).astype(np.int64)[bin_of]


def cut_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """Rows of PIECE_SCHEMA: the ids of each document in runs of at most ``capacity``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        keep_only("chunks")
        task, seen = TaskContext.get().partitionId(), 0
        for batch in batches:
            for part in slices(batch, "text", CUT_BYTES):
                ids, starts = encoded(part, tokenizer, end_id)
                n_pieces = -(-np.diff(starts) // capacity)
                row = np.repeat(np.arange(len(n_pieces)), n_pieces)
                piece = np.arange(len(row)) - split_points(n_pieces)[row]
                start = piece * capacity
                length = np.minimum(capacity, np.diff(starts)[row] - start)
                view = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
                at = starts[row] + start
                sums = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(at.tolist(), (at + length).tolist())]
                deal = (np.uint64(task << 32) + np.arange(seen, seen + len(row), dtype=np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
                seen += len(row)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(np.array(sums, np.int64)), pa.array((deal >> np.uint64(16)).astype(np.int64))],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "deal"],
                )

    return id_and_text(docs).mapInArrow(cut, PIECE_SCHEMA)


def _pack_round(pieces: DataFrame, groups: int, number: int, capacity: int, open_gap: int) -> DataFrame:
    def search(table: pa.Table) -> pa.Table:
        table = table.sort_by("deal")
        group = table.column("_group")[0].as_py()
        bin_of, offsets, fill = pack(table.column("length").to_numpy(), capacity)
        sequence = (np.int64(number) << np.int64(58)) + (np.int64(group) << np.int64(16)) + bin_of.astype(np.int64)
        out = table.select(["doc_id", "piece", "start", "length", "ids_crc32", "deal"])
        for name, values in (("sequence_id", sequence), ("offset", offsets), ("is_open", fill <= capacity - open_gap)):
            out = out.append_column(name, pa.array(values))
        return out

    mixed = F.pmod(F.xxhash64("deal", F.lit(number)), F.lit(groups))
    return pieces.withColumn("_group", mixed).groupBy("_group").applyInArrow(search, PACKED_SCHEMA)


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 4096, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row per piece."""
    with settings(docs.sparkSession, TEXT_BATCH):
        rest, done, number = written(cut_pieces(docs, tokenizer, end_id, capacity), "pieces"), None, 0
    open_gap = max(1, math.ceil(capacity * OPEN_GAP))
    n_pieces, bins_before = rest.count(), None
    while True:
        groups = max(1, math.ceil(n_pieces / group_pieces))
        packed = written(_pack_round(rest, groups, number, capacity, open_gap), "packed")
        closed, left = packed.where(~F.col("is_open")), packed.where("is_open")
        n_pieces, bins = left.agg(F.count("*"), F.approx_count_distinct("sequence_id", 0.01)).first()
        last = groups == 1 or n_pieces == 0 or number + 1 == MOST_ROUNDS or (bins_before is not None and bins > 0.98 * bins_before)
        part = packed if last else closed
        done = part if done is None else done.unionByName(part)
        if last:
            return done.drop("deal", "is_open")
        rest, bins_before, number = left.select("doc_id", "piece", "start", "length", "ids_crc32", "deal"), bins, number + 1
