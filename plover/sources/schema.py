"""Schema as data (A11-A13, A16): shapes, column lists, diffs, name-prefix families."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def schema_table(df: DataFrame) -> DataFrame:
    """(position, column, type) of a DataFrame's schema."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string")


def schema_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Full outer join of two schemas on the column name -> status added/removed/changed/same."""
    a = schema_table(before).select("column", F.col("type").alias("type_before"))
    b = schema_table(after).select("column", F.col("type").alias("type_after"))
    j = a.join(b, "column", "full_outer")
    status = (F.when(F.col("type_before").isNull(), "added")
              .when(F.col("type_after").isNull(), "removed")
              .when(F.col("type_before") != F.col("type_after"), "changed").otherwise("same"))
    return j.withColumn("status", status)


def table_shape(df: DataFrame, name: str) -> DataFrame:
    """Row count (parquet footers when nothing else is asked) and column count."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(name).alias("table"), "n_rows", F.lit(len(df.columns)).cast("bigint").alias("n_columns"))


def prefix_families(names: DataFrame, name_col: str = "column") -> DataFrame:
    """Every proper prefix of any column name, with the number of names starting with it.

    Each name is expanded to all its prefixes (including itself) and counted
    per prefix -- an equi-grouping, no pairwise name comparison -- then kept
    only where the prefix is a proper prefix of some name.
    """
    n = F.col(name_col)
    all_pref = names.select(n.alias("name"), F.explode(F.sequence(F.lit(1), F.length(n))).alias("k")).select(
        "name", "k", F.expr("substring(name, 1, k)").alias("family"))
    counts = all_pref.groupBy("family").agg(F.countDistinct("name").alias("count"))
    proper = all_pref.filter(F.col("k") < F.length("name")).select("family").distinct()
    return counts.join(proper, "family")


def filled_columns(df: DataFrame) -> DataFrame:
    """(column, n_filled): non-null values of every column, one pass over the rows."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column", "n_filled")


def filled_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """A12 over the rows: columns that two states of a table have, and how many values each holds there."""
    a = filled_columns(before).withColumnRenamed("n_filled", "n_before")
    b = filled_columns(after).withColumnRenamed("n_filled", "n_after")
    status = F.when(F.col("n_before").isNull(), "added").when(F.col("n_after").isNull(), "removed").otherwise("same")
    return a.join(b, "column", "full_outer").withColumn("status", status)


def filled_families(df: DataFrame) -> DataFrame:
    """A13 over the rows: per common name prefix, its columns and the values they hold."""
    filled = filled_columns(df)
    families = prefix_families(filled.select("column")).withColumnRenamed("count", "n_columns")
    own = filled.select("n_filled", F.explode(F.transform(
        F.sequence(F.lit(1), F.length("column")), lambda k: F.substring(F.col("column"), F.lit(1), k))).alias("family"))
    return families.join(own.groupBy("family").agg(F.sum("n_filled").alias("n_filled")), "family")
