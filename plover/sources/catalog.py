"""Catalog tables and temp views."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def register_external(spark: SparkSession, name: str, location: str, fmt: str = "parquet",
                      database: str = "default", options: dict[str, str] | None = None) -> DataFrame:
    """``USE db; DROP TABLE IF EXISTS; CREATE TABLE .. USING fmt [OPTIONS] LOCATION``; returns the table.

    The session's own database is set back afterwards.
    """
    def text(value):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"

    before = spark.catalog.currentDatabase()
    spark.catalog.setCurrentDatabase(database)
    try:
        spark.sql(f"DROP TABLE IF EXISTS {_quote(name)}")
        opts = " OPTIONS (" + ", ".join(f"{text(k)} {text(v)}" for k, v in options.items()) + ")" if options else ""
        spark.sql(f"CREATE TABLE {_quote(name)} USING {fmt}{opts} LOCATION {text(location)}")
        return spark.table(name)
    finally:
        spark.catalog.setCurrentDatabase(before)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {_quote(name)}")


@contextmanager
def views(spark: SparkSession, **frames: DataFrame) -> Iterator[dict[str, str]]:
    """Temp views for the time of a block, under names that no other caller of the session has.

    Yields the view name of each frame; frames made by SQL on them inside the block stay valid after it.
    """
    names = {k: f"plover_{k}_{uuid.uuid4().hex[:12]}" for k in frames}
    try:
        for k, df in frames.items():
            df.createOrReplaceTempView(names[k])
        yield names
    finally:
        for name in names.values():
            spark.catalog.dropTempView(name)
