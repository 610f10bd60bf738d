"""Where queries register: a builder, its SQL twin and the result's columns.

A result is declared as ``name kind`` pairs: ``s`` text, ``i`` integer, ``f``
number to six places, ``a`` to eight, ``m`` to two. Averages of amounts need the eight:
their halves and quarters fall on a rounding tie at fewer. Both sides are cast alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}

_PLACES = {"f": 6, "a": 8, "m": 2}


def _parse(columns: str) -> list[tuple[str, str]]:
    return [tuple(part.strip().rsplit(" ", 1)) for part in columns.split(",")]


def _spark_result(df: DataFrame, columns: list[tuple[str, str]]) -> DataFrame:
    out = []
    for name, kind in columns:
        if kind == "i":
            out.append(f"CAST(`{name}` AS BIGINT) AS `{name}`")
        elif kind in _PLACES:
            out.append(f"round(CAST(`{name}` AS DOUBLE), {_PLACES[kind]}) + 0D AS `{name}`")
        else:
            out.append(f"CAST(`{name}` AS STRING) AS `{name}`")
    return df.selectExpr(*out)


def _duckdb_result(sql: str, columns: list[tuple[str, str]]) -> str:
    out = []
    for name, kind in columns:
        if kind == "i":
            out.append(f'CAST("{name}" AS BIGINT) AS "{name}"')
        elif kind in _PLACES:
            out.append(f'round(CAST("{name}" AS DOUBLE), {_PLACES[kind]}) + 0.0 AS "{name}"')
        else:
            out.append(f'CAST("{name}" AS VARCHAR) AS "{name}"')
    return f"SELECT {', '.join(out)} FROM ({sql}) q"


def query(name: str, columns: str, sql: str | None = None) -> Callable[[Builder], Builder]:
    declared = _parse(columns)

    def add(build: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, folder: _spark_result(build(spark, folder), declared)
        if sql is not None:
            ORACLES[name] = _duckdb_result(sql, declared)
        return build

    return add
