"""The J10 operator on a streaming DataFrame equals the batch result."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_SMALL
from plover.operators.rolling import tumbling_mean
from plover.streaming import TumblingMeanStream, tumbling_mean_stream


def test_tumbling_mean_stream_matches_batch(spark, tmp_path):
    path = f"{SF_SMALL}/events.parquet"
    batch = spark.read.parquet(path)
    stream = spark.readStream.schema(batch.schema).parquet(f"{SF_SMALL}/event*.parquet")
    q = (tumbling_mean_stream(stream, "ts", "value", "4 hours").writeStream.outputMode("complete")
         .format("memory").queryName("plover_tumbling").option("checkpointLocation", str(tmp_path / "ck")).start())
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    fmt = "yyyy-MM-dd HH:mm:ss"

    def rows(df):
        return {(r.s, r.n, round(r.mean, 9))
                for r in df.select(F.date_format("window_start", fmt).alias("s"), "n", "mean").collect()}

    got = rows(spark.table("plover_tumbling"))
    want = rows(tumbling_mean(batch, "ts", "value", "4 hours"))
    assert got == want and len(want) > 0


def _add(spark, path, rows):
    df = spark.createDataFrame([(dt.datetime.fromisoformat(t) if t else None, v) for t, v in rows], "ts timestamp, v double")
    df.coalesce(1).write.mode("append").parquet(path)
    return df.schema


def _open(spark, path, schema, home=None):
    return TumblingMeanStream(spark, path, schema, "ts", "v", "1 hour", "30 minutes", home)


def _got(df):
    fmt = "HH:mm"
    return sorted((r.s, r.e, r.n, r.mean) for r in df.select(
        F.date_format("window_start", fmt).alias("s"), F.date_format("window_end", fmt).alias("e"), "n", "mean").collect())


def test_stream_goes_on_from_its_checkpoint_and_drops_late_rows(spark, tmp_path):
    path = str(tmp_path / "readings")
    schema = _add(spark, path, [("2024-01-01 10:10", 1.0), ("2024-01-01 10:50", 3.0), ("2024-01-01 11:20", 5.0), (None, 9.0)])
    first = _open(spark, path, schema)
    first.advance()
    assert _got(first.closed()) == []  # the watermark is 10:50: nothing is closed yet
    _add(spark, path, [("2024-01-01 10:55", 5.0), ("2024-01-01 12:40", None), ("2024-01-01 12:50", float("nan"))])
    second = _open(spark, path, schema, first.home)  # a new object on the same folder: state and offsets come from there
    second.advance()
    closed = [("10:00", "11:00", 3, 3.0), ("11:00", "12:00", 1, 5.0)]
    assert _got(second.closed()) == closed  # 10:55 was in time and met the state of the first run
    _add(spark, path, [("2024-01-01 10:59", 100.0), ("2024-01-01 12:30", 2.0), ("2024-01-01 15:00", 4.0)])
    third = _open(spark, path, schema, first.home)
    third.advance()
    done = _got(third.finish())
    assert done[:2] == closed  # 10:59 came too late and changed nothing
    assert [(w[0], w[2]) for w in done] == [("10:00", 3), ("11:00", 1), ("12:00", 3), ("15:00", 1)] and done[3][3] == 4.0
    assert done[2][3] != done[2][3]  # NaN among the values


def test_stream_without_rows(spark, tmp_path):
    path = str(tmp_path / "none")
    schema = _add(spark, path, [])
    assert _got(_open(spark, path, schema).finish()) == []
