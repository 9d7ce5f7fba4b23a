"""Registry of named queries and their DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name`` with optional oracle SQL."""

    def deco(fn):
        assert name not in QUERIES, name
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every floating column (sum order differs between engines in the last bits)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            # "+ 0.0" turns -0.0 into 0.0 so signed zeros never split equal results
            cols.append((F.round(F.col(f.name).cast("double"), digits) + F.lit(0.0)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def with_ctes(body: str, **ctes: str) -> str:
    parts = [f"{name} AS (\n{sql}\n)" for name, sql in ctes.items()]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body
