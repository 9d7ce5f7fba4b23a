"""Category indexes for columns with very many levels (H1, H3): a table of ranks, joined back.

``StringIndexer`` collects every level on the driver and ``OneHotEncoder`` makes vectors as
wide as the levels.  Here the levels are ranked on Spark and stay a table; encoded
rows are (row key, column, slot) triples.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plover.session import stored, written

HOT = 1000  # commonest levels of a column that are joined by broadcast; all others meet the rows in a shuffle


def level_table(df: DataFrame, cols: list[str]) -> DataFrame:
    """H1: (column, level, idx, n) of every non-null level; idx 0 is the most frequent, ties by level ascending.

    Counted levels are dealt out by range in the order of the index and written; the
    index is a level's place in its range plus the sizes of the ranges before (a row per
    column and range), so neither a task nor the driver holds a column's levels.
    """
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("level")) for c in cols]))
    counts = df.select(each.alias("e")).select("e.*").filter("level IS NOT NULL").groupBy("column", "level").agg(
        F.count(F.lit(1)).alias("n"))
    order = [F.col("column").asc(), F.col("n").desc(), F.col("level").asc()]
    ranged = counts.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    with written(ranged, "levels") as parts:
        before = Window.partitionBy("column").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        sizes = parts.groupBy("column", "part").agg(F.count(F.lit(1)).alias("size"))
        offsets = sizes.select("column", "part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
        inside = F.row_number().over(Window.partitionBy("column", "part").orderBy(*order[1:]))
        ranked = parts.withColumn("place", inside).join(offsets, ["column", "part"])
        return stored(ranked.select("column", "level", (F.col("offset") + F.col("place") - 1).alias("idx"), "n"), "level-index")


def index_levels(df: DataFrame, cols: list[str], levels: DataFrame, suffix: str = "_idx") -> DataFrame:
    """H1: ``df`` with the index of each column's level; null where the level is null or not in ``levels``.

    Rows of the ``HOT`` commonest levels find theirs in a broadcast table of at most that
    many rows.  They and null rows pass the shuffle of the others under keys of their
    own, so no partition gets the rows of a frequent level.
    """
    for c in cols:
        own = levels.filter(F.col("column") == c).select(F.col("level").alias("_level"), F.col("idx").alias("_idx"))
        value = F.col(c).cast("string")
        hot = F.broadcast(own.filter(F.col("_idx") < HOT).select(F.col("_level").alias("_hot"), F.col("_idx").alias("_hot_idx")))
        rows = df.join(hot, value == F.col("_hot"), "left").drop("_hot")
        known = value.isNull() | F.col("_hot_idx").isNotNull()
        rows = rows.withColumn("_known", known).withColumn(
            "_key", F.when(known, F.monotonically_increasing_id().cast("string")).otherwise(value))
        rows = rows.join(own.filter(F.col("_idx") >= HOT), (F.col("_key") == F.col("_level")) & ~F.col("_known"), "left")
        df = rows.select(*df.columns, F.coalesce("_hot_idx", "_idx").alias(c + suffix))
    return df


def one_hot_sparse(df: DataFrame, key_cols: list[str], cols: list[str], levels: DataFrame) -> DataFrame:
    """H3: (keys, column, slot) of every known level; null and unseen levels have no row (all slots zero)."""
    indexed = index_levels(df.select(*key_cols, *cols), cols, levels)
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"{c}_idx").alias("slot")) for c in cols]))
    return indexed.select(*key_cols, each.alias("e")).select(*key_cols, "e.*").filter("slot IS NOT NULL")
