"""J10 as a stream: tumbling means over files as they arrive.

The reference has no stream source, sink, watermark or stateful operator (SURVEY 2.I);
its one time-bucketed aggregate (J10, a batch tumbling mean) is a plain DataFrame
function, so it also runs on a streaming DataFrame.  ``TumblingMeanStream`` keeps such
a query's checkpoint, state and result in one folder of the shared storage:
it can be stopped, or lose executors and driver, and goes on from there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampNTZType

from plover.operators.rolling import tumbling_mean
from plover.session import fresh_path

#: Event time of the row that ends a stream; the watermark follows it past every window.
END_OF_STREAM = "9000-01-01 00:00:00"


def tumbling_mean_stream(stream: DataFrame, time_col: str, value_col: str, duration: str = "4 hours",
                         watermark: str = "1 hour") -> DataFrame:
    """J10 on ``spark.readStream`` input: rows later than the watermark are dropped by Spark.

    Watermarks need TIMESTAMP; a TIMESTAMP_NTZ event time is cast first (wall
    clock read in the session time zone).
    """
    if isinstance(stream.schema[time_col].dataType, TimestampNTZType):
        stream = stream.withColumn(time_col, F.col(time_col).cast("timestamp"))
    return tumbling_mean(stream.withWatermark(time_col, watermark), time_col, value_col, duration)


class TumblingMeanStream:
    """Tumbling means of the files of one table, file by file as they come.

    ``home`` (in the shared folder; a new one by default) holds the checkpoint with the
    state of the open windows, the windows that the watermark has closed, and the mark
    that ends the stream.  ``prepare`` turns the files' rows into ``time_col`` and
    ``value_col``; it must be a plain projection or filter.
    """

    def __init__(self, spark: SparkSession, source: str, schema: StructType, time_col: str, value_col: str,
                 duration: str = "4 hours", watermark: str = "1 hour", home: str | None = None, prepare=lambda df: df):
        self.spark, self.source, self.schema, self.prepare = spark, source, schema, prepare
        self.time_col, self.value_col, self.duration, self.watermark = time_col, value_col, duration, watermark
        self.home = home or fresh_path(spark, "tumbling-stream")
        if home is None:
            self._end_rows(0)

    def _end_rows(self, n: int) -> None:
        """The files of the ending source: none but an empty one while the stream runs."""
        rows = self.spark.range(n).select(F.lit(END_OF_STREAM).cast("timestamp").alias("at"))
        rows.write.mode("append").parquet(f"{self.home}/end")

    def _rows(self, files_per_batch: int | None) -> DataFrame:
        reader = self.spark.readStream.schema(self.schema)
        if files_per_batch:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        rows = self.prepare(reader.parquet(self.source)).select(
            F.col(self.time_col).cast("timestamp").alias(self.time_col), F.col(self.value_col).cast("double").alias(self.value_col))
        end = self.spark.readStream.schema("at timestamp").parquet(f"{self.home}/end").select(
            F.col("at").alias(self.time_col), F.lit(None).cast("double").alias(self.value_col))
        return rows.unionByName(end)

    def advance(self, files_per_batch: int | None = None) -> None:
        """Take in all files that have come since the last run, then stop; the state stays in the checkpoint.

        Rows older than the watermark of the batches before (the latest event time less
        ``watermark``) are dropped.  ``files_per_batch`` bounds a batch.
        """
        means = tumbling_mean_stream(self._rows(files_per_batch), self.time_col, self.value_col, self.duration, self.watermark)
        query = (means.writeStream.outputMode("append").format("parquet").option("path", f"{self.home}/windows")
                 .option("checkpointLocation", f"{self.home}/checkpoint").trigger(availableNow=True).start())
        query.awaitTermination()

    def closed(self) -> DataFrame:
        """The windows that the watermark has closed so far: window_start, window_end, n, mean."""
        schema = "window_start timestamp, window_end timestamp, n long, mean double"
        return self.spark.read.schema(schema).parquet(f"{self.home}/windows")

    def finish(self) -> DataFrame:
        """Take in what is left and close every window; the stream takes no row after this."""
        self.advance()
        self._end_rows(1)
        self.advance()
        return self.closed()
