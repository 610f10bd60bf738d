"""A bounded sample of labelled documents, for models that are fitted on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockrisk.llm.frames import id_and_text


def held_out(id_col: str = "doc_id") -> Column:
    """Whether crc32 of the id as text is divisible by five; such rows never teach a model."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, most_bytes: int) -> tuple[list[str], list[int]]:
    """(texts, labels): up to ``per_class`` documents of either label, of at most ``most_bytes`` bytes each.

    The rows with the lowest hash of their id are taken, so the sample depends on nothing else.
    Held-out rows, and rows whose label or id is null, are left out.
    """
    clean = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out()).select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    # a quarter more ids than wanted, as some documents are too long; both bounds are parameters
    chosen = None
    for value in (0, 1):
        part = clean.where(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class * 5 // 4)
        chosen = part if chosen is None else chosen.unionByName(part)
    fitting = id_and_text(docs).where(F.octet_length("text") <= most_bytes)
    rows = fitting.join(F.broadcast(chosen), "doc_id").select("label", "text", F.xxhash64("doc_id").alias("rank")).collect()
    texts, values = [], []
    for value in (0, 1):
        for row in sorted((r for r in rows if r.label == value), key=lambda r: (r.rank, r.text))[:per_class]:
            texts.append(row.text)
            values.append(value)
    return texts, values
