"""Parquet scans of the input tables (A1, A2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def spread(df: DataFrame) -> DataFrame:
    """Round-robin a plain scan that is one single split, and so at most one split's bytes large.

    One split is read by one task, and every per-row expression up to the first
    shuffle runs there too.  Tables of more than one split are left as they are.
    Only for plain scans: asking a plan with shuffles for its partitions would run it.
    """
    want = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(want) if df.rdd.getNumPartitions() == 1 else df


def scan(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None,
         heavy_rows: bool = False) -> DataFrame:
    """A1: directory/file scan; ``columns`` prunes at the reader (ReadSchema).

    ``heavy_rows``: the caller runs costly per-row work (regex, date parsing,
    model fitting) before any shuffle, so an under-split input is spread first.
    Cheap aggregations skip it: partial aggregation shrinks rows before the
    shuffle, which beats shuffling raw rows.
    """
    df = spark.read.parquet(table_path(sf_dir, name))
    df = df.select(*columns) if columns else df
    return spread(df) if heavy_rows else df


def scan_glob(spark: SparkSession, pattern: str, base: str | None = None) -> DataFrame:
    """A2: every file that the glob matches, as one table; ``base`` keeps partition columns below it."""
    reader = spark.read.option("basePath", base) if base else spark.read
    return reader.parquet(pattern)


def colocate(df: DataFrame, name: str, keys: list[str], buckets: int, path: str | None = None) -> DataFrame:
    """Store ``df`` bucketed and sorted by ``keys`` as a catalog table in the shared folder.

    Two tables bucketed on their join keys with the same bucket count join
    without any shuffle (and without a sort, per bucket) -- the layout to use
    when many jobs join the same big tables, e.g. lineitem and orders on the
    order key.  A one-time write instead of a shuffle of both sides per query.
    """
    from plover.session import fresh_path

    spark = df.sparkSession
    location = path or fresh_path(spark, name)
    spark.sql(f"DROP TABLE IF EXISTS `{name}`")
    (df.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
     .option("path", location).saveAsTable(name))
    return spark.table(name)
