"""Session defaults and the one place that cuts lineage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app: str = "blockrisk", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the package defaults; keyword names use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which every executor can read.

    Where it is unset, a folder in the warehouse. On a cluster that must not be a folder of one
    machine's disk, which the other executors would not see.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    if not spark.sparkContext.master.startswith("local") and urlparse(warehouse).scheme in ("", "file"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{warehouse.rstrip('/')}/_scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """Rows dealt by the named columns over two tasks a core.

    For rows that take far more work than their bytes in the file tell: a few MB of Parquet, read by one task,
    can hold a million shapes. The number is given, for adaptive execution would go by the bytes again.
    """
    tasks = 2 * df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(tasks, F.xxhash64(*[F.col(f"`{c}`") for c in columns or df.columns]))


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Session settings for the jobs started within; those from before come back."""
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: lineage ends, and later readers prune columns."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: cuts lineage where several results read one costly input."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()
