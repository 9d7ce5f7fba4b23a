"""Joins and duplicate handling described by the reference.

Nothing here forces a broadcast: the planner broadcasts a side whose bytes it knows
to be small, and AQE one whose shuffled bytes turn out small.  Deduplication counts
the copies per key by hash first; only rows of keys with several copies are ordered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType


def join_by_date(left: DataFrame, right: DataFrame, left_date: str | Column, right_date: str,
                 how: str = "inner") -> DataFrame:
    """Equi-join on a calendar date (timestamps are cut to the date on the left)."""
    lcol = F.col(left_date) if isinstance(left_date, str) else left_date
    keyed = left.withColumn("_join_date", F.to_date(lcol))
    return keyed.join(right, keyed["_join_date"] == right[right_date], how).drop("_join_date")


def join_dimension(fact: DataFrame, dim: DataFrame, on: str | list[str], how: str = "left") -> DataFrame:
    """Attach a small dimension (codes, names) to a fact table; the planner picks the join by the sides' bytes."""
    return fact.join(dim, on, how)


def duplicate_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """How many keys occur once, twice, ... (copies, n_keys)."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    return per_key.groupBy("copies").agg(F.count(F.lit(1)).alias("n_keys"))


def deduplicate(df: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """One row per key -- the smallest by ``order`` (default: all other columns), nulls last.

    A hash aggregate counts the copies of each key (two longs per key cross the
    shuffle).  Rows of keys that occur once, nearly all, pass through; only the rows of
    repeated keys are packed and reduced by ``min``, map-side first.
    """
    rest = [c for c in df.columns if c not in keys]
    order = order or rest
    tail = [c for c in rest if c not in order]
    often = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies")).filter("_copies > 1").select(
        *[F.col(c).alias(f"_d{i}") for i, c in enumerate(keys)])
    same = F.lit(True)
    for i, c in enumerate(keys):
        same = same & F.col(c).eqNullSafe(F.col(f"_d{i}"))
    once = df.join(often, same, "left_anti").select(*keys, *rest)
    fields = []
    for i, c in enumerate(order + tail):
        fields += [F.col(c).isNull().alias(f"_n{i}"), F.col(c).alias(c)]
    least = df.join(often, same, "left_semi").groupBy(*keys).agg(F.min(F.struct(*fields)).alias("_r"))
    return once.unionByName(least.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]))


def aggregate_through_dimension(fact: DataFrame, fact_keys: list[str], dims: list[tuple[DataFrame, str, str]],
                                group_cols: list[str], means: dict[str, str] | None = None,
                                count_name: str | None = None) -> DataFrame:
    """Group means / counts of fact rows per dimension attribute, aggregated *before* the join.

    The fact table is reduced to one row per foreign key (partial + final
    aggregation, one shuffle), and only that small table is joined to the
    dimension chain ``dims`` = [(dim_df, fact_key, dim_key), ...] and
    re-aggregated.  Means are carried as (sum, count) so the result equals
    ``avg`` over the joined rows; inner-join semantics are kept.
    """
    means = means or {}
    aggs = []
    for name, src in means.items():
        aggs += [F.sum(src).alias(f"_s_{name}"), F.count(src).alias(f"_c_{name}")]
    if count_name:
        aggs.append(F.count(F.lit(1)).alias("_n"))
    pre = fact.groupBy(*fact_keys).agg(*aggs)
    for dim, fk, dk in dims:
        pre = pre.join(dim, pre[fk] == dim[dk])
    outs = [F.try_divide(F.sum(f"_s_{n}"), F.sum(f"_c_{n}")).alias(n) for n in means]
    if count_name:
        outs.append(F.sum("_n").alias(count_name))
    return pre.groupBy(*group_cols).agg(*outs)


def _micros(df: DataFrame, col: str) -> Column:
    if isinstance(df.schema[col].dataType, TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(col))
    return F.unix_micros(F.col(col).cast("timestamp"))


def join_as_of(left: DataFrame, right: DataFrame, left_time: str, right_time: str, keys: list[str], values: list[str],
               lag_seconds: int = 0, max_age_seconds: int | None = None, block_seconds: int = 6 * 3600) -> DataFrame:
    """Each left row with the last right row of its keys at or before ``left_time - lag_seconds``.

    Returns the columns of ``left``, then ``right_time`` and ``values`` of the match (null
    without one, or where it is more than ``max_age_seconds`` older than the lagged
    time).  Of right rows that share keys and time the greatest by ``values`` counts
    (nulls first); a null key or time matches nothing.

    Both sides are first reduced to one row per keys and instant.  Instants meet in
    blocks of time, so the busiest key is dealt out like any other; inside a block a
    window carries the last reading on, and a block without an earlier one takes over
    the last reading of the blocks before it (one row per keys and block is ordered for
    that, never the rows).  Left rows get their match by an equi-join on the instant.
    """
    mine = [f"_k{i}" for i in range(len(keys))]
    step = block_seconds * 1_000_000
    rows = left.withColumn("_t", _micros(left, left_time) - lag_seconds * 1_000_000)
    known = F.col("_t").isNotNull()
    for k in keys:
        known = known & F.col(k).isNotNull()
    as_keys = [F.col(k).alias(m) for k, m in zip(keys, mine, strict=True)]
    asked = rows.filter(known).select(*as_keys, "_t").distinct()
    found = right.withColumn("_t", _micros(right, right_time)).filter(known).select(
        *as_keys, "_t", F.struct(*[F.col(c).alias(f"v{i}") for i, c in enumerate([*values, right_time])]).alias("_row"))
    found = found.groupBy(*mine, "_t").agg(F.max("_row").alias("_row"))
    reading = F.struct(F.col("_t").alias("at"), F.col("_row").alias("row"))
    both = (found.select(*mine, "_t", F.lit(0).alias("_side"), reading.alias("_reading"))
            .unionByName(asked.withColumn("_side", F.lit(1)), allowMissingColumns=True)
            .withColumn("_block", F.floor(F.col("_t") / step)))
    upto = Window.partitionBy(*mine, "_block").orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
    inside = both.withColumn("_seen", F.last("_reading", ignorenulls=True).over(upto)).filter("_side = 1")
    ends = both.groupBy(*mine, "_block").agg(F.max_by("_reading", F.when(F.col("_side") == 0, F.col("_t"))).alias("_end"))
    before = Window.partitionBy(*mine).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*mine, "_block", F.last("_end", ignorenulls=True).over(before).alias("_carried"))
    match = inside.join(carried, [*mine, "_block"]).select(
        *mine, F.col("_t").alias("_at"), F.coalesce("_seen", "_carried").alias("_match"))
    if max_age_seconds is not None:
        fresh = F.col("_at") - F.col("_match.at") <= max_age_seconds * 1_000_000
        match = match.withColumn("_match", F.when(fresh, F.col("_match")))
    same = F.col("_t") == F.col("_at")
    for k, m in zip(keys, mine, strict=True):
        same = same & (F.col(k) == F.col(m))
    got = F.col("_match.row")
    return rows.join(match, same, "left").select(
        *left.columns, got[f"v{len(values)}"].alias(right_time), *[got[f"v{i}"].alias(c) for i, c in enumerate(values)])
