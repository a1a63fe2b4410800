"""Registry of driver-table queries and their SQL oracles.

A query is a function ``(spark, sf_dir) -> DataFrame`` over the Parquet tables
of one scale-factor folder.  Its oracle is ANSI SQL over views with the same
table names (checked with DuckDB); ``None`` marks queries that SQL cannot
state (model fits), which only get a row-count check.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.functions.exprs import STRIP_PATTERN
from cadenza.session import read_table

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str | None] = {}


def register(name: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        ORACLES[name] = sql
        return fn
    return deco


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


def r6(c: str | Column) -> Column:
    """Round a float to 6 places (both engines round every float output)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), 6)


# ---- SQL helpers (DuckDB dialect, kept ANSI where possible) ----------------

def sql_strip(expr: str) -> str:
    return f"regexp_replace({expr}, '{STRIP_PATTERN}', '', 'g')"


def sql_case_map(expr: str, mapping: dict[str, str]) -> str:
    """``coalesce(map[expr], expr)`` spelled as a CASE."""
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"(CASE {expr} {whens} ELSE {expr} END)"


def sql_consolidate(expr: str, mapping: dict[str, str]) -> str:
    """Split on ',', strip, map, order-keeping dedupe, join ', '."""
    mapped = (f"list_transform(string_split({expr}, ','), "
              f"lambda t: {sql_case_map(sql_strip('t'), mapping)})")
    dedup = f"list_filter({mapped}, lambda x, i: list_position({mapped}, x) = i)"
    return (f"(CASE WHEN {expr} IS NULL OR {expr} = 'N/A' THEN {expr} "
            f"ELSE array_to_string({dedup}, ', ') END)")


def sql_missing(expr: str) -> str:
    return f"({expr} IS NULL OR {sql_strip(expr)} = '' OR {expr} = 'N/A')"


def sql_hash(seed, *exprs: str) -> str:
    parts = ", ".join([f"'{seed}'"] + [f"coalesce(CAST({e} AS VARCHAR), '')" for e in exprs])
    return f"md5(concat_ws('|', {parts}))"
