"""Token counts through a digest cache: only distinct texts that were never counted are encoded.

The cache is a Parquet table (content, tokenizer, n_tokens): ``content`` is the SHA-256 of the
normalised text, ``tokenizer`` the SHA-256 of the tokenizer file together with the library's
version and this module's normal form. Normalisation never changes a count: where a tokenizer
drops white space and case, runs of ASCII white space become one space and A-Z become lower
case, unless the text may hold a special token; for other tokenizers the text stays as it is.

One narrow pass gives each row its digest; the distinct digests that the cache lacks are encoded
once each, from the text of the least doc_id that holds them, and appended; all rows then take
their counts from the cache by a join on the digest. Digests are dealt by their own hash and
hot ones are split by adaptive execution, as the join is a plain equi-join.

Cases: a null text is empty (0 bytes, 0 tokens); repeated rows each get their row; an empty table
gives no rows and leaves the cache as it was; a null doc_id is kept; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blockrisk.llm.frames import ascii_lower, id_and_text, slices, strings_of, tokenizer_path, written
from blockrisk.llm.library_tokens import LibraryEncoder, encoder
from blockrisk.session import scratch_path

CACHE_SCHEMA = "content binary, tokenizer binary, n_tokens long"
NORMAL_FORM = "1"


def tokenizer_digest(name: str) -> bytes:
    """Identity of what gives the counts: file, library version and normal form."""
    import sentencepiece
    import tokenizers

    version = sentencepiece.__version__ if name.endswith(".model") else tokenizers.__version__
    return hashlib.sha256(Path(tokenizer_path(name)).read_bytes() + f"|{version}|{NORMAL_FORM}".encode()).digest()


def normal_form(text: Column, tool: LibraryEncoder) -> Column:
    """A text with the same count; equal for texts that differ in white space and A-Z case only."""
    if not tool.by_chunk:
        return text
    plain = ascii_lower(F.regexp_replace(text, r"[ \t\n\x0B\f\r]+", " "))
    special = F.lit(False)
    for mark in tool.marks:
        special = special | F.contains(F.lower(text), F.lit(mark.lower()))
    return F.when(special, text).otherwise(plain)


def _count(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            _, offsets = encoder(name).encode(strings_of(part.column("text")))
            yield pa.RecordBatch.from_arrays([part.column("content"), pa.array(np.diff(offsets))], names=["content", "n_tokens"])


def read_cache(spark: SparkSession, cache_path: str, tokenizer: bytes) -> DataFrame:
    """(content, n_tokens) of one tokenizer, once each whatever was appended twice."""
    cache = spark.read.schema(CACHE_SCHEMA).parquet(cache_path).where(F.col("tokenizer") == F.lit(tokenizer))
    return cache.groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))


def append_misses(docs: DataFrame, digests: DataFrame, name: str, cache_path: str) -> None:
    """Encodes the distinct texts of (doc_id, text, content) that the cache lacks, and appends their counts.

    ``digests`` holds the (doc_id, content) of the same rows, without the texts.
    """
    spark, version = docs.sparkSession, tokenizer_digest(name)
    known = read_cache(spark, cache_path, version)
    firsts = digests.groupBy("content").agg(F.coalesce(F.min("doc_id"), F.lit(-(1 << 63))).alias("first_id"))
    misses = firsts.join(known, "content", "left_anti")
    texts = docs.withColumn("first_id", F.coalesce("doc_id", F.lit(-(1 << 63)))).join(misses, ["first_id", "content"], "left_semi")
    counts = texts.select("content", "text").mapInArrow(lambda batches: _count(batches, name), "content binary, n_tokens long")
    counts.select("content", F.lit(version).alias("tokenizer"), "n_tokens").write.mode("append").parquet(cache_path)


def count_tokens(docs: DataFrame, name: str, limit: int, cache_path: str | None = None) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit) for every row of ``docs``."""
    spark = docs.sparkSession
    cache_path = cache_path or scratch_path(spark, "token-counts")
    spark.createDataFrame([], CACHE_SCHEMA).write.mode("append").parquet(cache_path)
    rows = id_and_text(docs)
    rows = rows.withColumn("content", F.unhex(F.sha2(normal_form(F.col("text"), encoder(name)), 256)))
    sized = written(rows.select("doc_id", "content", F.octet_length("text").cast("long").alias("n_bytes")), "digests")
    append_misses(rows, sized, name, cache_path)
    # stored, so that both sides of the join are plain shuffles, of which hot digests can be split
    cache = written(read_cache(spark, cache_path, tokenizer_digest(name)), "counts")
    return sized.join(cache, "content").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
