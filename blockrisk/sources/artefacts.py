"""Stored tables that know what they were built from.

A manifest beside a table records the stamp of every input file, which years it holds, and the
folder in which each year of the table lies. A refresh compares stamps, rebuilds only the years of
files that came, changed or went, writes them to a new folder, and publishes a manifest of one
file last: readers see the table before or after, never in between. Folders are never written
twice, and of two builders that refresh at once the second finds its version taken and takes what
the first published, before it looks again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_MANIFEST = "kind string, name string, stamp string, parts array<long>, folder string"


def file_stamps(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """name, stamp (time and length) of every file; contents are not read."""
    listed = spark.read.format("binaryFile").load(list(files)).select("_metadata.*")
    return listed.select(F.col("file_path").alias("name"), F.concat_ws("|", F.col("file_modification_time").cast("string"), F.col("file_size").cast("string")).alias("stamp"))


def _latest(spark: SparkSession, path: str) -> tuple[int, list]:
    """(version, manifest rows) last published; version -1 where there is none."""
    try:
        manifests = spark.read.schema(f"{_MANIFEST}, version int").parquet(f"{path}/manifests")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return -1, []
    version = manifests.agg(F.max("version")).first()[0]
    return version, manifests.filter(F.col("version") == version).collect()


def read(spark: SparkSession, path: str) -> DataFrame:
    """The table as last published."""
    folders = sorted(r["folder"] for r in _latest(spark, path)[1] if r["kind"] == "part")
    if not folders:
        raise ValueError(f"no table is published at {path}")
    # each refresh has its own base folder, so a base is read at a time for its years
    bases = sorted({f.rsplit("/", 1)[0] for f in folders})
    tables = [spark.read.option("basePath", b).parquet(*[f for f in folders if f.startswith(f"{b}/")]) for b in bases]
    return reduce(DataFrame.unionByName, tables)


def refresh(
    spark: SparkSession, path: str, files: Sequence[str], load: Callable[[Sequence[str]], DataFrame],
    build: Callable[[DataFrame], DataFrame], year: str,
) -> DataFrame:
    """The table that ``build`` makes of the rows of ``files``, brought up to date.

    ``load`` reads files, by any of Spark's file sources, to rows with a column ``year``; ``build``
    gives rows that keep it and depend on input rows of their own year alone. Rows without a year
    belong to none.
    """
    paths = lambda names: [unquote(name) for name in names]
    version, old = _latest(spark, path)
    known = {r["name"]: r for r in old if r["kind"] == "file"}
    stamps = {r["name"]: r["stamp"] for r in file_stamps(spark, files).collect()}
    changed = [name for name, stamp in stamps.items() if name not in known or known[name]["stamp"] != stamp]
    gone = [name for name in known if name not in stamps]
    if version >= 0 and not changed and not gone:
        return read(spark, path)
    held = {name: list(known[name]["parts"]) for name in stamps if name not in changed}
    if changed:
        # a row per file and year
        seen = load(paths(changed)).select(F.col("_metadata.file_path").alias("name"), F.col(year).cast("long").alias("part")).filter("part is not null").distinct()
        found = {r["name"]: sorted(r["parts"]) for r in seen.groupBy("name").agg(F.collect_set("part").alias("parts")).collect()}
        held |= {name: found.get(name, []) for name in changed}
    touched = {p for name in [*changed, *gone] for p in [*held.get(name, []), *(known[name]["parts"] if name in known else [])]}
    sources = [name for name, parts in held.items() if touched.intersection(parts)]
    folders = {int(r["name"]): r["folder"] for r in old if r["kind"] == "part" and int(r["name"]) not in touched}
    folder = f"{path}/data/{uuid.uuid4().hex}"
    if sources:
        build(load(paths(sources)).filter(F.col(year).isin(sorted(touched)))).write.partitionBy(year).parquet(folder)
        rebuilt = {p for name in sources for p in held[name] if p in touched}
        folders |= {p: f"{folder}/{year}={p}" for p in rebuilt}
    rows = [("file", name, stamps[name], held[name], None) for name in stamps]
    rows += [("part", str(p), None, None, f) for p, f in folders.items()]
    try:
        spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.parquet(f"{path}/manifests/version={version + 1}")
    except AnalysisException as taken:
        if taken.getCondition() != "PATH_ALREADY_EXISTS":
            raise
        return refresh(spark, path, files, load, build, year)
    return read(spark, path)
