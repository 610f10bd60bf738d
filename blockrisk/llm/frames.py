"""Small helpers shared by the operators: input columns, written tables, batches."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blockrisk.session import scratch_path

#: Texts are worked on in slices of at most this many bytes (or one text), to bound memory in a task.
SLICE_BYTES = 4 << 20
#: A model scores texts of this many bytes at once: its arrays take up to forty times as much.
SCORE_BYTES = 1 << 20
#: Whole texts are read and go to a worker so many rows at a time: both batches are held in memory.
TEXT_BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "512", "spark.sql.parquet.columnarReaderBatchSize": "512"}
#: What a worker keeps between tasks, by name: a function that drops it.
KEPT: dict[str, Callable[[], None]] = {}


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file, resolved where it is called: on each executor."""
    import public_tokenizers

    return name if os.path.isabs(name) else public_tokenizers.path(name)


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", further: dict[str, str] | None = None) -> DataFrame:
    """(doc_id, text) alone, whatever else the table holds, and ``further`` columns under new names; a null text is empty."""
    return docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
        *(F.col(old).alias(new) for old, new in (further or {}).items()),
    )


def with_place(docs: DataFrame) -> tuple[DataFrame, str, str]:
    """``docs`` and two columns, under names that are free there: hash of a row's file path, and the row's number in it.

    Tables not of Parquet files are written first.
    """
    file, row = (free_name(docs, name) for name in ("_file", "_row"))
    try:
        lies = docs.metadataColumn("_metadata")
        return docs.select("*", F.xxhash64(lies["file_path"]).alias(file), lies["row_index"].alias(row)), file, row
    except AnalysisException:
        return with_place(written(docs, "documents"))


def free_name(table: DataFrame, name: str) -> str:
    """``name``, with underscores behind it until no column of the table is called so."""
    taken = {c.lower() for c in table.columns}
    while name.lower() in taken:
        name += "_"
    return name


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes to the shared folder and reads back: lineage ends, later readers prune columns."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def strings_of(column: pa.Array) -> pa.Array:
    """Column with nulls as empty strings, in one piece."""
    import pyarrow.compute as pc

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column, "")


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose text stays within ``limit`` bytes, one row at least."""
    import pyarrow.compute as pc

    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    start, held = 0, 0
    for row, size in enumerate(sizes.tolist()):
        if row > start and held + size > limit:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += size
    yield batch.slice(start)


def split_points(lengths: np.ndarray) -> np.ndarray:
    """Offsets [0, l0, l0+l1, ...] of consecutive runs."""
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def gather_runs(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenation of flat[s : s + l] over all runs, without a loop."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    shift = np.repeat(starts - (ends - lengths), lengths)
    return flat[shift + np.arange(total)]


def keep_only(name: str = "") -> None:
    """Drops what this worker keeps for other stages than ``name`` and gives freed memory back to the system."""
    for other, drop in KEPT.items():
        if other != name:
            drop()
    # Arrow's other pools hold on to freed buffers, the system's gives them back, and what Python and numpy freed with them
    pa.set_memory_pool(pa.system_memory_pool())
    pa.default_memory_pool().release_unused()


def scored_rows(docs: DataFrame, score: Callable[[pa.Array], np.ndarray], keep: Callable[[np.ndarray], np.ndarray], text_col: str = "text", kept: str = "") -> DataFrame:
    """The rows of ``docs``, columns as they are, whose text's score ``keep`` accepts. ``kept``: what ``score`` keeps in a worker."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only(kept)
        for batch in batches:
            for part in slices(batch, text_col, SCORE_BYTES):
                yield part.filter(pa.array(keep(score(strings_of(part.column(text_col))))))
        batch = part = None
        keep_only(kept)

    return docs.mapInArrow(run, docs.schema)


def placed(table: DataFrame, columns: dict[str, Column], file: str = "file", row: str = "row") -> DataFrame:
    """``columns`` of ``table``, and where each row lies: hash of its file's path and number in it.

    Only these columns, under the names given, so what else the table holds cannot clash. Tables that
    do not come from Parquet files are written first.
    """
    own = [value.alias(name) for name, value in columns.items()]
    try:
        lies = table.metadataColumn("_metadata")
        return table.select(*own, F.xxhash64(lies["file_path"]).alias(file), lies["row_index"].alias(row))
    except AnalysisException:
        stored = written(table.select(*own), "placed")
        return placed(stored, {name: F.col(f"`{name}`") for name in columns}, file, row)
