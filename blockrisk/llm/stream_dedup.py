"""Exact deduplication with keyed state that never expires.

The digests of the documents arrive as a stream. RocksDB state, keyed by digest, retains per
digest the largest doc_id seen (the stable identifier), where that row's text lies (the content
locator: file and row in it) and how many rows came. Partial aggregates leave each task first, so
the state gets one row per digest and task however large a group of copies is. State and progress
lie in the shared folder: a later call with the same ``state_path`` goes on from there.

A digest alone proves nothing: for every digest with a hit, the full bytes of each row are
compared with the bytes at the locator. Large groups are salted by their count for that, so no
task gets more than about ``ROWS_PER_SALT`` copies. Rows whose bytes differ from what the digest
retains (a collision) are grouped by their whole text instead.

Texts are equal when identical after lower-casing A-Z only. Cases: a null text is empty, and empty
texts are equal; a null doc_id ranks lowest; of rows that share both text and doc_id one stays,
the last by file and row; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blockrisk.llm.frames import ascii_lower, free_name, id_and_text, written
from blockrisk.session import scratch_path, settings

ROWS_PER_SALT = 1024
FILES_PER_TRIGGER = 256
#: Every state store takes some MB of its own, so their number follows the rows, not the shuffles.
ROWS_PER_STORE = 1 << 16
_ROCKSDB = "spark.sql.streaming.stateStore."
STATE_CONF = {
    _ROCKSDB + "providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    _ROCKSDB + "rocksdb.changelogCheckpointing.enabled": "true",
    _ROCKSDB + "rocksdb.boundedMemoryUsage": "true",
    _ROCKSDB + "rocksdb.maxMemoryUsageMB": "256",
}


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def located(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text (lower-cased), file, row. Tables that do not come from Parquet files are written first."""
    try:
        lies = docs.metadataColumn("_metadata")
        place = docs.select(lies["file_path"].alias("file"), lies["row_index"].alias("row"), F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    except AnalysisException:
        return located(written(id_and_text(docs, id_col, text_col), "documents"))
    return place.select("file", "row", F.col(f"`{id_col}`").cast("long").alias("doc_id"), ascii_lower(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("text"))


def update_state(spark: SparkSession, arrivals_path: str, state_path: str, files_per_trigger: int = FILES_PER_TRIGGER) -> None:
    """Folds all files of ``arrivals_path`` that the state has not seen into it.

    The number of state stores is fixed by the first call for a ``state_path``.
    """
    rows = spark.read.parquet(arrivals_path).count()
    stores = max(spark.sparkContext.defaultParallelism, -(-rows // ROWS_PER_STORE))
    arrivals = spark.readStream.schema("digest binary, doc_id long, file string, row long").option("maxFilesPerTrigger", files_per_trigger).parquet(arrivals_path)
    state = arrivals.groupBy("digest").agg(F.max(F.struct("doc_id", "file", "row")).alias("retained"), F.count("*").alias("rows"))
    with settings(spark, STATE_CONF | {"spark.sql.streaming.internal.stateStore.partitions": str(stores)}):
        run = state.writeStream.format("noop").outputMode("update").option("checkpointLocation", state_path).trigger(availableNow=True).start()
        run.awaitTermination()


def read_state(spark: SparkSession, state_path: str) -> DataFrame:
    """digest, keep_id, keep_file, keep_row, rows: what the state retains."""
    with settings(spark, STATE_CONF):
        state = spark.read.format("statestore").option("path", state_path).load()
        values = [f.name for f in state.schema["value"].dataType.fields]
    retained, rows = (F.col("value").getField(name) for name in values[-2:])
    return state.select(
        F.col("key.digest").alias("digest"), retained.getField("doc_id").alias("keep_id"), retained.getField("file").alias("keep_file"),
        retained.getField("row").alias("keep_row"), rows.alias("rows"),
    )


def collisions(rows: DataFrame, state: DataFrame) -> DataFrame:
    """digest, doc_id, text, file, row of the rows whose bytes differ from what their digest retains."""
    hits = state.where("rows > 1").withColumn("salts", F.ceil(F.col("rows") / ROWS_PER_SALT).cast("int"))
    suspects = written(rows.join(hits, "digest"), "suspects")
    kept = suspects.where((F.col("file") == F.col("keep_file")) & (F.col("row") == F.col("keep_row")))
    kept = kept.select("digest", F.col("text").alias("kept_text"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    salted = suspects.withColumn("salt", F.pmod(F.xxhash64("file", "row"), F.col("salts")).cast("int"))
    compared = salted.join(kept, ["digest", "salt"]).where(F.col("text") != F.col("kept_text"))
    return written(compared.select("digest", "doc_id", "text", "file", "row"), "collisions")


def _resolved(placed: DataFrame, odd: DataFrame) -> DataFrame:
    """Groups where digests collide: rows with other bytes form groups by their whole text."""
    classes = odd.groupBy("digest", "text").agg(F.max(F.struct("doc_id", "file", "row")).alias("last"), F.count("*").alias("odd_size"))
    own = odd.select("digest", "text", "file", "row").join(classes, ["digest", "text"]).select("file", "row", "last", "odd_size")
    lost = odd.groupBy("digest").agg(F.count("*").alias("lost"))
    whole = placed.join(own, ["file", "row"], "left").join(lost, "digest", "left")
    is_odd = F.col("odd_size").isNotNull()
    return whole.select(
        "doc_id", "file", "row", "sha256",
        F.when(is_odd, F.col("last.doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.when(is_odd, F.col("last.file")).otherwise(F.col("keep_file")).alias("keep_file"),
        F.when(is_odd, F.col("last.row")).otherwise(F.col("keep_row")).alias("keep_row"),
        F.when(is_odd, F.col("odd_size")).otherwise(F.col("rows") - F.coalesce("lost", F.lit(0))).alias("rows"),
    )


def deduplicate(docs: DataFrame, digest: Callable[[Column], Column] = sha256, files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, file, row: one row per row of ``docs``."""
    spark = docs.sparkSession
    arrivals_path, state_path = scratch_path(spark, "dedup-arrivals"), scratch_path(spark, "dedup-state")
    rows = located(docs).withColumn("digest", digest(F.col("text")))
    arrivals = rows.select("digest", "doc_id", "file", "row", sha256(F.col("text")).alias("sha256"))
    arrivals.write.parquet(arrivals_path)
    update_state(spark, arrivals_path, state_path, files_per_trigger)
    state = written(read_state(spark, state_path), "dedup-index")
    odd = collisions(rows, state)
    placed = spark.read.schema(arrivals.schema).parquet(arrivals_path).join(state, "digest")
    grouped = placed if odd.isEmpty() else _resolved(placed, odd)
    kept = (F.col("file") == F.col("keep_file")) & (F.col("row") == F.col("keep_row"))
    return grouped.select("doc_id", "keep_id", F.col("rows").alias("group_size"), kept.alias("kept"), F.lower(F.hex("sha256")).alias("text_sha256"), "file", "row")


def keep_last_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, that ``deduplicate`` keeps."""
    file, row = (free_name(docs, name) for name in ("_file", "_row"))
    try:
        lies = docs.metadataColumn("_metadata")
        placed = docs.select("*", lies["file_path"].alias(file), lies["row_index"].alias(row))
    except AnalysisException:
        return keep_last_copies(written(docs, "documents"))
    kept = deduplicate(docs).where("kept").select(F.col("file").alias(file), F.col("row").alias(row))
    return placed.join(kept, [file, row], "left_semi").select(*(f"`{n}`" for n in docs.columns))
