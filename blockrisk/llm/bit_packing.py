"""Token ids in binary files: fixed-width bit packing with block offsets.

Documents are dealt over shards by ranges of their id, so shards follow each other in ascending
id order. A shard holds segments; a segment is one self-contained binary image:

    magic "BRTK" | version u2 | bits u2 | block_ids u4 | docs u4 | ids u8
    doc_id i8[docs] | doc_start u8[docs + 1] | block_at u8[blocks + 1] | payload

all little-endian. Every id takes ``bits`` bits, the fewest that hold the vocabulary, lowest bit
first; blocks of ``block_ids`` ids begin on a byte, whose place is ``block_at``, so that any run of
ids is read from its blocks alone. Segments are the rows of Parquet files in the shared folder:
Spark's committer makes each shard appear once, whatever tasks are lost or repeated, and any store
that Spark writes to will do. A segment has about ``SEGMENT_IDS`` ids, or one longer document.

Cases: a null text is empty and holds the end id alone; a null doc_id sorts first and is read back
as null; documents that share a doc_id follow each other in the order of their texts; an empty
table gives an empty file set and an empty index; further columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from blockrisk.llm.frames import id_and_text, shuffle_partitions, slices, split_points, strings_of
from blockrisk.llm.library_tokens import encoder
from blockrisk.session import scratch_path

MAGIC, VERSION = b"BRTK", 1
HEADER = struct.Struct("<4sHHIIQ")
BLOCK_IDS = 4096
SEGMENT_IDS = 1 << 20
NULL_ID = -(1 << 63)

FILE_SCHEMA = "shard int, segment int, docs long, ids long, image binary"
INDEX_SCHEMA = "shard int, segment int, doc_id long, local_start long, n_tokens long, ids_crc32 long"


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack_ids(ids: np.ndarray, bits: int) -> bytes:
    """Ids one after the other in ``bits`` bits each, lowest bit first; the last byte is filled with zeros."""
    words = np.ascontiguousarray(ids, "<u4")
    if len(words) and int(words.max()) >> bits:
        raise ValueError(f"an id needs more than {bits} bits")
    if bits % 8 == 0:
        return words.view(np.uint8).reshape(-1, 4)[:, : bits // 8].tobytes()
    flags = np.unpackbits(words.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :bits]
    return np.packbits(flags.reshape(-1), bitorder="little").tobytes()


def unpack_ids(payload: np.ndarray, count: int, bits: int) -> np.ndarray:
    """The first ``count`` ids of a packed run of bytes."""
    if bits % 8 == 0:
        out = np.zeros((count, 4), np.uint8)
        out[:, : bits // 8] = payload[: count * (bits // 8)].reshape(count, bits // 8)
        return out.view("<u4").reshape(-1)
    at = np.arange(count, dtype=np.int64) * bits
    padded = np.concatenate([payload, np.zeros(8, np.uint8)]).astype(np.uint64)
    first, word = at >> 3, np.zeros(count, np.uint64)
    for k in range((bits + 14) // 8):
        word |= padded[first + k] << np.uint64(8 * k)
    return ((word >> (at & 7).astype(np.uint64)) & np.uint64((1 << bits) - 1)).astype(np.uint32)


def build_segment(doc_ids: np.ndarray, lengths: np.ndarray, ids: np.ndarray, bits: int, block_ids: int = BLOCK_IDS) -> bytes:
    blocks = [pack_ids(ids[at : at + block_ids], bits) for at in range(0, len(ids), block_ids)]
    places = split_points(np.array([len(b) for b in blocks], np.int64))
    head = HEADER.pack(MAGIC, VERSION, bits, block_ids, len(doc_ids), len(ids))
    return b"".join([head, doc_ids.astype("<i8").tobytes(), split_points(lengths).astype("<u8").tobytes(), places.astype("<u8").tobytes(), *blocks])


class Segment:
    """Reader of one segment image; nothing is unpacked before it is asked for."""

    def __init__(self, image: bytes):
        magic, version, self.bits, self.block_ids, docs, self.ids = HEADER.unpack_from(image)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a token segment")
        blocks, at = -(-self.ids // self.block_ids), HEADER.size
        self.doc_ids = np.frombuffer(image, "<i8", docs, at)
        self.starts = np.frombuffer(image, "<u8", docs + 1, at := at + 8 * docs).astype(np.int64)
        self.places = np.frombuffer(image, "<u8", blocks + 1, at := at + 8 * (docs + 1)).astype(np.int64)
        self.payload = np.frombuffer(image, np.uint8, -1, at + 8 * (blocks + 1))

    def read(self, start: int, stop: int) -> np.ndarray:
        """ids[start:stop], from the blocks that hold them."""
        if stop <= start:
            return np.zeros(0, np.uint32)
        first, last = start // self.block_ids, (stop - 1) // self.block_ids
        runs = [unpack_ids(self.payload[self.places[b] : self.places[b + 1]], min(self.block_ids, self.ids - b * self.block_ids), self.bits) for b in range(first, last + 1)]
        return np.concatenate(runs)[start - first * self.block_ids : stop - first * self.block_ids]

    def document(self, number: int) -> np.ndarray:
        return self.read(int(self.starts[number]), int(self.starts[number + 1]))


def encoded(batch: pa.RecordBatch, tokenizer: str, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets) of the batch's texts, each with ``end_id`` after its own ids."""
    ids, offsets = encoder(tokenizer).encode(strings_of(batch.column("text")))
    lengths = np.diff(offsets)
    out = np.full(len(ids) + len(lengths), end_id, np.uint32)
    starts = split_points(lengths + 1)
    out[np.repeat(starts[:-1] - offsets[:-1], lengths) + np.arange(len(ids))] = ids
    return out, starts


def write_token_files(docs: DataFrame, path: str, tokenizer: str, vocabulary: int, end_id: int, shards: int | None = None, segment_ids: int = SEGMENT_IDS) -> None:
    """Encodes (doc_id, text) and writes the packed segments in ascending doc_id order."""
    bits = bits_for(vocabulary)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, segment, held, n_held = TaskContext.get().partitionId(), 0, [], 0

        def image() -> pa.RecordBatch:
            doc_ids, lengths, ids = (np.concatenate(x) for x in zip(*held))
            row = [[shard], [segment], [len(doc_ids)], [len(ids)], [build_segment(doc_ids, lengths, ids, bits)]]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()))], names=["shard", "segment", "docs", "ids", "image"])

        for batch in batches:
            for part in slices(batch, "text"):
                ids, starts = encoded(part, tokenizer, end_id)
                names = part.column("doc_id").fill_null(NULL_ID).to_numpy(zero_copy_only=False)
                at = 0
                while at < len(names):
                    room = segment_ids - n_held
                    stop = max(int(np.searchsorted(starts, starts[at] + room, "right")) - 1, at + (n_held == 0))
                    if stop > at:
                        held.append((names[at:stop], np.diff(starts[at : stop + 1]), ids[starts[at] : starts[stop]]))
                        n_held += int(starts[stop] - starts[at])
                        at = stop
                    if at < len(names) or n_held >= segment_ids:
                        yield image()
                        segment, held, n_held = segment + 1, [], 0
        if held:
            yield image()

    # FILE_SCHEMA rows leave each task one segment at a time, so a task holds about one segment
    shards = shards or shuffle_partitions(docs.sparkSession)
    dealt = id_and_text(docs).repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id", "text")
    dealt.mapInArrow(pack, FILE_SCHEMA).write.parquet(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """One row per document, from the files: its place, length and checksum."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, segment, image in zip(*(batch.column(c) for c in ("shard", "segment", "image"))):
                one = Segment(image.as_buffer())
                ids, n = one.read(0, one.ids), len(one.doc_ids)
                view = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
                sums = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(one.starts[:-1].tolist(), one.starts[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, shard.as_py(), np.int32)), pa.array(np.full(n, segment.as_py(), np.int32)), pa.array(one.doc_ids, pa.int64(), mask=one.doc_ids == NULL_ID), pa.array(one.starts[:-1]), pa.array(np.diff(one.starts)), pa.array(np.array(sums, np.int64))],
                    names=["shard", "segment", "doc_id", "local_start", "n_tokens", "ids_crc32"],
                )

    return spark.read.schema(FILE_SCHEMA).parquet(path).select("shard", "segment", "image").mapInArrow(unpack, INDEX_SCHEMA)


def segment_starts(spark: SparkSession, path: str) -> DataFrame:
    """(shard, segment, segment_start): ids in all segments before, from the narrow columns alone.

    The only window without a key runs over one row per shard.
    """
    sizes = spark.read.schema(FILE_SCHEMA).parquet(path).select("shard", "segment", "ids")
    before = lambda spec: F.coalesce(F.sum("ids").over(spec.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shards = sizes.groupBy("shard").agg(F.sum("ids").alias("ids")).select("shard", before(Window.orderBy("shard")).alias("shard_start"))
    inside = before(Window.partitionBy("shard").orderBy("segment"))
    return sizes.withColumn("inside", inside).join(shards, "shard").select("shard", "segment", (F.col("shard_start") + F.col("inside")).alias("segment_start"))


def token_file_index(docs: DataFrame, tokenizer: str, vocabulary: int, end_id: int, path: str | None = None) -> DataFrame:
    """Writes the files, then reads them back: doc_id, start, n_tokens, ids_crc32, shard, segment."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "token-files")
    write_token_files(docs, path, tokenizer, vocabulary, end_id)
    places = segment_starts(spark, path)
    return read_index(spark, path).join(places, ["shard", "segment"]).select(
        "doc_id", (F.col("segment_start") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32", "shard", "segment"
    )


__all__ = ["Segment", "build_segment", "pack_ids", "read_index", "token_file_index", "unpack_ids", "write_token_files"]
