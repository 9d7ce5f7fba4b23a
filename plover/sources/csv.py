"""Compressed CSV with header and inferred schema (A3)."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from plover.session import stored

FORMAT = {"header": "true", "escape": '"', "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
          "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def write_csv(df: DataFrame, path: str, compression: str = "gzip") -> None:
    """Quotes are doubled inside values and timestamps keep their microseconds."""
    df.write.mode("errorifexists").options(**FORMAT).option("compression", compression).csv(path)


def read_csv(spark: SparkSession, path: str, infer: bool = True, schema: str | None = None) -> DataFrame:
    """Read CSV with a header.  ``schema`` skips the inference pass (recommended at scale).

    A gzip file is read by one task; write as many files as tasks should read them.
    """
    reader = spark.read.options(**FORMAT)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", "true" if infer else "false")
    return reader.csv(path)


def kept_schema(spark: SparkSession, path: str, at: str) -> StructType:
    """The schema inferred from ``path`` on the first call and kept in the folder ``at`` (its JSON) for all later ones.

    Later files then cannot change a column's type: what does not fit goes to quarantine.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(at)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        schema = read_csv(spark, path, infer=True).schema
        spark.createDataFrame([(schema.json(),)], "json string").coalesce(1).write.text(at)
    return StructType.fromJson(json.loads(spark.read.text(at, wholetext=True).first()[0]))


def read_csv_checked(spark: SparkSession, path: str, schema: StructType, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """A3 with bad rows: (rows that fit the schema, quarantine).

    Lines with a field that does not parse, or with too few or too many fields, go whole to the
    quarantine (line, file) and leave the others alone.  The files are parsed once, with all
    columns (Spark would not notice a bad field in a column that it need not read), and
    both frames read the written result.  A line of empty fields is a row of nulls.
    """
    taken = {c.lower() for c in schema.names}
    bad = "_line"
    while bad in taken:
        bad = "_" + bad
    full = StructType([*schema.fields]).add(bad, StringType())
    parsed = (spark.read.options(**(FORMAT | {"header": str(header).lower()})).schema(full)
              .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", bad).csv(path))
    rows = stored(parsed.select("*", F.col("_metadata.file_path").alias(bad + "_file")), "csv-parsed")
    good = rows.filter(F.col(bad).isNull()).select(*[F.col(c) for c in schema.names])
    return good, rows.filter(F.col(bad).isNotNull()).select(F.col(bad).alias("line"), F.col(bad + "_file").alias("file"))
