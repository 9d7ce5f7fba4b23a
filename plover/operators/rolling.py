"""Time-range window features (E1) and tumbling-window means.

E1 in the reference is ``avg(c) over (order by epoch_seconds range between
-6h and -2h)`` with no partition key, which Spark executes in ONE partition.
``lagged_range_mean`` computes the same numbers in bounded pieces:

* rows are first reduced to one row per (key, second), so neither a hot second
  nor the size of the table shows in what follows;
* time is cut into blocks as long as the frame.  A frame then is the end of one
  block plus the beginning of the next, so its sum is a suffix sum plus a prefix
  sum: linear, and nothing is ever subtracted (differences of running sums
  cancel, and inf - inf is NaN);
* a block holds at most a few rows per second of the frame, whatever the data;
* the means go back to the rows by a null-safe join on (key, second).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from plover.functions.parse import epoch_seconds


def _secs(df: DataFrame, time_col: str):
    dtype = df.schema[time_col].dataType
    if dtype.typeName() in ("long", "integer"):
        return F.col(time_col).cast("bigint")
    return epoch_seconds(time_col, dtype if isinstance(dtype, TimestampNTZType) else None)


SOURCE, FRAME_START, FRAME_END = 0, 1, 2


def lagged_range_mean(
    df: DataFrame,
    time_col: str,
    value_cols: list[str],
    lo_seconds: int,
    hi_seconds: int,
    id_cols: list[str],
    partition_cols: list[str] | None = None,
    name_fmt: str = "rolling_{}_average",
    keep_cols: list[str] | None = None,
) -> DataFrame:
    """Mean of each value over rows whose time is in [t - lo, t - hi].

    Returns ``id_cols`` + ``partition_cols`` + ``keep_cols`` + one mean per value, one row
    per input row (ids need not be unique).  Like ``avg`` over the range window: null
    values are left out, an empty frame or a null time gives null, NaN or both
    infinities in a frame give NaN, one infinity gives it.  ``partition_cols`` gives the
    keyed variant (frames never cross keys; null is a key like any other).
    """
    assert lo_seconds >= hi_seconds >= 0, "frame must lie before the row: lo >= hi >= 0"
    parts = list(partition_cols or [])
    keys = [f"_k{i}" for i in range(len(parts))]
    carry = [c for c in dict.fromkeys([*id_cols, *parts, *(keep_cols or [])])]
    width, n = lo_seconds - hi_seconds + 1, len(value_cols)
    rows = df.select(*carry, _secs(df, time_col).alias("_t"), *[F.col(c).alias(k) for c, k in zip(parts, keys, strict=True)],
                     *[F.col(c).cast("double").alias(f"_v{i}") for i, c in enumerate(value_cols)])

    def parts_of(i):
        v = F.col(f"_v{i}")
        inf = F.lit(float("inf"))
        finite = v.isNotNull() & ~F.isnan(v) & (F.abs(v) < inf)
        return {f"_s{i}": F.sum(F.when(finite, v)), f"_c{i}": F.count(v), f"_n{i}": F.count_if(F.isnan(v)),
                f"_p{i}": F.count_if(v == inf), f"_m{i}": F.count_if(v == -inf)}

    sums = {k: a for i in range(n) for k, a in parts_of(i).items()}
    seconds = rows.filter("_t IS NOT NULL").groupBy(*keys, "_t").agg(*[a.alias(k) for k, a in sums.items()])
    t = F.col("_t")

    def mark(kind, at):
        return F.struct(F.lit(kind).alias("kind"), at.alias("at"), F.floor(at / width).alias("block"))

    # a frame that fills one block exactly needs its start only
    marks = F.array(mark(SOURCE, t), mark(FRAME_START, t - lo_seconds), mark(FRAME_END, t - hi_seconds))
    marks = F.filter(marks, lambda m: (m["kind"] != FRAME_END) | (m["block"] != F.floor((t - lo_seconds) / width)))
    placed = seconds.select("*", F.explode(marks).alias("_mark"))
    source = F.col("_mark.kind") == SOURCE
    placed = placed.select(*keys, "_t", F.col("_mark.kind").alias("_kind"), F.col("_mark.at").alias("_at"),
                           F.col("_mark.block").alias("_block"), *[F.when(source, F.col(k)).alias(k) for k in sums])
    block = Window.partitionBy(*keys, "_block")
    upto = block.orderBy("_at").rangeBetween(Window.unboundedPreceding, 0)
    after = block.orderBy(F.col("_at").desc()).rangeBetween(Window.unboundedPreceding, 0)
    placed = placed.withColumns({f"{k}_u": F.sum(k).over(upto) for k in sums}).withColumns(
        {f"{k}_a": F.sum(k).over(after) for k in sums}).filter(F.col("_kind") != SOURCE)
    side = {k: F.when(F.col("_kind") == FRAME_START, F.col(f"{k}_a")).otherwise(F.col(f"{k}_u")) for k in sums}
    frames = placed.groupBy(*keys, "_t").agg(*[F.sum(v).alias(k) for k, v in side.items()])

    def mean(i):
        s, c, nan, pos, neg = (F.coalesce(F.col(f"_{x}{i}"), F.lit(0)) for x in "scnpm")
        return (F.when(c == 0, F.lit(None).cast("double"))
                .when((nan > 0) | ((pos > 0) & (neg > 0)), F.lit(float("nan")))
                .when(pos > 0, F.lit(float("inf"))).when(neg > 0, F.lit(float("-inf"))).otherwise(s / c))

    names = [name_fmt.format(c) for c in value_cols]
    frames = frames.select(*[F.col(k).alias(k + "_f") for k in keys], F.col("_t").alias("_t_f"),
                           *[mean(i).alias(name) for i, name in enumerate(names)])
    same = F.col("_t") == F.col("_t_f")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(k + "_f"))
    # the rows of a hot second stay spread: the planner may split a skewed row side of this join
    return rows.join(frames, same, "left").select(*carry, *names)


def tumbling_mean(df: DataFrame, time_col: str, value_col: str, duration: str = "4 hours",
                  name: str = "mean") -> DataFrame:
    """Mean per tumbling window (window start/end, count, mean)."""
    return df.groupBy(F.window(time_col, duration).alias("w")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(value_col).alias(name)
    ).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n", name)
