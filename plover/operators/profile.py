"""Profiling aggregates.

All statistics are Spark aggregates: partial aggregation per task, one
shuffle on the group key (or none for a global aggregate).  Only bounded
statistics (a min/max pair, a handful of quantiles) ever reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plover.functions.parse import is_missing
from plover.operators.clean import missing_any
from plover.operators.prefix import running_totals, with_buckets

CALENDAR = {"year": F.year, "month": F.month, "day": F.dayofmonth}


def summary_stats(df: DataFrame, col: str) -> DataFrame:
    """Mean, sample stddev, min, max of one column (one pass)."""
    c = F.col(col)
    return df.agg(F.mean(c).alias("mean"), F.stddev(c).alias("stddev"), F.min(c).alias("min"), F.max(c).alias("max"))


def group_count(df: DataFrame, keys: list[str], col: str | None = None, name: str = "n") -> DataFrame:
    """``count(col)`` (non-null) or ``count(*)`` per group."""
    agg = F.count(F.col(col)) if col else F.count(F.lit(1))
    return df.groupBy(*keys).agg(agg.alias(name))


def group_means(df: DataFrame, keys: list[str | object], cols: dict[str, str]) -> DataFrame:
    """Named means per group; ``cols`` maps output name -> input column."""
    return df.groupBy(*keys).agg(*[F.avg(src).alias(name) for name, src in cols.items()])


def mean_by_calendar(df: DataFrame, date_col: str, part: str, value_col: str, name: str = "mean_value") -> DataFrame:
    """Mean per year, month or day of month of a date."""
    return df.groupBy(CALENDAR[part](F.col(date_col)).alias(part)).agg(F.avg(value_col).alias(name))


def means_long(df: DataFrame, cols: list[str]) -> DataFrame:
    """Mean of several columns, no key, as a long table (column, mean)."""
    wide = df.agg(*[F.avg(c).alias(c) for c in cols])
    return wide.unpivot([], cols, "column", "mean")


def missing_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Rows missing per column, every column in one pass, as (column, n_missing, n_rows, missing_pct).

    Missing = null, or NaN for float/double columns (timestamps, text: null only).
    """
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    cols = cols or df.columns
    aggs = [F.count_if(is_missing(c, types[c])).alias(f"m{i}") for i, c in enumerate(cols)]
    wide = df.agg(F.count(F.lit(1)).alias("n_rows"), *aggs)
    stack = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("n_missing")) for i, c in enumerate(cols)
    ])).alias("s")
    long = wide.select("n_rows", stack).select("s.column", "s.n_missing", "n_rows")
    return long.withColumn(
        "missing_pct", F.when(F.col("n_rows") > 0, F.col("n_missing") * 100.0 / F.col("n_rows")))


def column_states(df: DataFrame, cols: list[str] | None = None, relative_sd: float = 0.02) -> DataFrame:
    """D13/D14 for very wide tables: (column, n_missing, n_rows, missing_pct, n_distinct) in one scan.

    Every row becomes one (column, state) row per column inside its task, the state being a
    hash of the value or null where it is missing; partial aggregates by column leave each
    task with one row per column.  The code has one small expression per column rather than
    an aggregate each.  ``n_distinct`` is a sketch's estimate of the distinct values present.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = cols or df.columns
    states = F.array(*[F.when(~is_missing(c, types[c]), F.xxhash64(F.col(c))) for c in cols])
    each = df.select(F.posexplode(states).alias("at", "state"))
    found = each.groupBy("at").agg(F.count(F.lit(1)).alias("n_rows"), F.count("state").alias("present"),
                                   F.approx_count_distinct("state", relative_sd).alias("n_distinct"))
    names = df.sparkSession.createDataFrame(list(enumerate(cols)), "at int, column string")
    found = names.join(found, "at", "left").fillna(0)
    missing = F.col("n_rows") - F.col("present")
    return found.select("column", missing.alias("n_missing"), "n_rows",
                        F.when(F.col("n_rows") > 0, missing * 100.0 / F.col("n_rows")).alias("missing_pct"), "n_distinct")


def columns_with_missing(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Columns with at least one missing value (one job, not one per column)."""
    return missing_counts(df, cols).filter(F.col("n_missing") > 0)


def columns_mostly_null(df: DataFrame, threshold_pct: float, cols: list[str] | None = None) -> DataFrame:
    """Columns whose missing share is at least ``threshold_pct`` percent."""
    return missing_counts(df, cols).filter(F.col("missing_pct") >= threshold_pct)


def histogram(df: DataFrame, col: str, bins: int = 20, log_scale: bool = False) -> DataFrame:
    """Equal-width histogram; last bin closed on the right; empty bins listed;
    a constant sample spans [v - 0.5, v + 0.5] as numpy's histogram does.

    One bounded pass for (min, max), then one grouped count.  With
    ``log_scale`` the bins are equal in log10 and only positive values count.
    Infinities lie in no bin of finite width and are left out, as are nulls and NaN.
    Columns: bin, lo, hi (edges on the binned scale), n.
    """
    x = F.col(col).cast("double")
    src = df.select(x.alias("x")).filter(F.col("x").isNotNull() & ~F.isnan("x") & (F.abs("x") < float("inf")))
    if log_scale:
        src = src.filter(F.col("x") > 0).select(F.log10("x").alias("x"))
    row = src.agg(F.min("x").alias("mn"), F.max("x").alias("mx")).first()
    spark = df.sparkSession
    if row is None or row["mn"] is None:
        return spark.range(bins).select(F.col("id").alias("bin"), F.lit(None).cast("double").alias("lo"),
                                        F.lit(None).cast("double").alias("hi"), F.lit(0).cast("bigint").alias("n"))
    mn, mx = float(row["mn"]), float(row["mx"])
    if mx == mn:  # numpy's rule for a constant sample: range [v - 0.5, v + 0.5]
        mn, mx = mn - 0.5, mx + 0.5
    width = mx - mn
    idx = F.floor((F.col("x") - F.lit(mn)) / F.lit(width) * F.lit(bins))
    counts = src.groupBy(F.least(idx, F.lit(bins - 1)).cast("bigint").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    edges = spark.range(bins).select(
        F.col("id").alias("bin"),
        (F.lit(mn) + F.col("id") * F.lit(width) / F.lit(bins)).alias("lo"),
        (F.lit(mn) + (F.col("id") + 1) * F.lit(width) / F.lit(bins)).alias("hi"),
    )
    return edges.join(counts, "bin", "left").select("bin", "lo", "hi", F.coalesce("n", F.lit(0)).alias("n"))


def value_counts_bucketed(df: DataFrame, cols: list[str], buckets: int | None = None) -> DataFrame:
    """(column, bucket, value, n) for the non-missing values of numeric columns, buckets in ascending order of the
    values and of about equal size per column: the distinct-value table every exact quantile works on (one shuffle)."""
    xs, bs = [f"_x{i}" for i in range(len(cols))], [f"_b{i}" for i in range(len(cols))]
    wide = df.select(*[F.col(c).cast("double").alias(x) for c, x in zip(cols, xs, strict=True)])
    bucketed = with_buckets(wide, xs, bs, buckets)
    stack = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(x).alias("value"), F.col(b).alias("bucket"))
        for c, x, b in zip(cols, xs, bs, strict=True)])).alias("s")
    long = bucketed.select(stack).select("s.column", "s.value", "s.bucket")
    long = long.filter(F.col("value").isNotNull() & ~F.isnan("value"))
    return long.groupBy("column", "bucket", "value").agg(F.count(F.lit(1)).alias("n"))


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float], buckets: int | None = None) -> DataFrame:
    """Exact linear-interpolated quantiles (like ``percentile`` / ``quantile_cont``).

    Distributed and skew-safe: one multi-column ``approxQuantile`` pass gives every
    column its own cut points, so a value's bucket holds at most ~N/B rows; the
    distinct values are counted per (column, bucket) and the exact running
    count comes from bucket offsets plus a window inside each bucket.  The
    values at the two ranks around each quantile are then picked by a filter.
    No group ever holds all values of a column; a column without values gives no
    row and changes nothing for the others.  Columns: column, n, q0.., min, max.
    """
    return quantiles_of(value_counts_bucketed(df, cols, buckets), probs)


def quantiles_of(vc: DataFrame, probs: list[float]) -> DataFrame:
    """The quantiles of counted values (``value_counts_bucketed``)."""
    cum = running_totals(vc, "value", ["n"], partition_cols=["column"], bucket_col="bucket").withColumnRenamed("total_n", "total")
    aggs = []
    for i, q in enumerate(probs):
        h = (F.col("total") - 1) * F.lit(q)
        lo_r = F.floor(h) + 1
        hi_r = F.ceil(h) + 1
        before = F.col("cum_n") - F.col("n")
        aggs.append(F.max(F.when((before < lo_r) & (lo_r <= F.col("cum_n")), F.col("value"))).alias(f"_lo{i}"))
        aggs.append(F.max(F.when((before < hi_r) & (hi_r <= F.col("cum_n")), F.col("value"))).alias(f"_hi{i}"))
        aggs.append(F.first(h - F.floor(h)).alias(f"_fr{i}"))
    per = cum.groupBy("column").agg(F.first("total").alias("n"), F.min("value").alias("min"),
                                    F.max("value").alias("max"), *aggs)
    qs = [(F.col(f"_lo{i}") + F.col(f"_fr{i}") * (F.col(f"_hi{i}") - F.col(f"_lo{i}"))).alias(f"q{i}")
          for i in range(len(probs))]
    return per.select("column", "n", *qs, "min", "max")


def boxplot_stats(df: DataFrame, cols: list[str], whisker: float = 1.5) -> DataFrame:
    """Quartiles, IQR, whiskers at ``whisker`` x IQR and outlier counts per column."""
    counted = value_counts_bucketed(df, cols)  # read twice below, shuffled once
    q = quantiles_of(counted, [0.25, 0.5, 0.75]).select(
        "column", "n", F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3"), "min", "max")
    q = q.withColumn("iqr", F.col("q3") - F.col("q1")).withColumns({
        "lower_fence": F.col("q1") - F.lit(whisker) * F.col("iqr"),
        "upper_fence": F.col("q3") + F.lit(whisker) * F.col("iqr"),
    })
    vc = counted.join(q.select("column", "lower_fence", "upper_fence"), "column")
    whis = vc.groupBy("column").agg(
        F.min(F.when(F.col("value") >= F.col("lower_fence"), F.col("value"))).alias("lower_whisker"),
        F.max(F.when(F.col("value") <= F.col("upper_fence"), F.col("value"))).alias("upper_whisker"),
        F.coalesce(F.sum(F.when((F.col("value") < F.col("lower_fence")) | (F.col("value") > F.col("upper_fence")),
                                F.col("n"))), F.lit(0)).alias("n_outliers"),
    )
    return q.join(whis, "column")


def correlation_long(df: DataFrame, cols: list[str], complete_rows: bool = True) -> DataFrame:
    """Pearson correlation of every column pair in one aggregate, long form.

    Rows with a missing value in any of ``cols`` are dropped first, as the
    reference's ``na.drop`` + ``Correlation.corr`` did.  Columns: col_a, col_b, corr.
    """
    src = df.select(*cols)
    if complete_rows:
        src = src.filter(~missing_any(src, cols))
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    # values as doubles in columns of their own; sums around a first mean keep their digits
    x = {c: f"_x{i}" for i, c in enumerate(cols)}
    src = src.select(*[F.col(c).cast("double").alias(x[c]) for c in cols])
    mean = src.agg(*[F.avg(x[c]) for c in cols]).first()
    around = src.select(*[(F.col(x[c]) - F.lit(m).cast("double")).alias(x[c]) for c, m in zip(cols, mean, strict=True)])
    n = F.count(F.lit(1))
    sums = around.agg(n.alias("n"), *[F.sum(x[c]).alias(f"s{i}") for i, c in enumerate(cols)],
                      *[F.sum(F.col(x[a]) * F.col(x[b])).alias(f"p{k}") for k, (a, b) in enumerate(pairs)])
    place, at = {c: i for i, c in enumerate(cols)}, {p: k for k, p in enumerate(pairs)}

    def spread_of(a, b):
        return F.col(f"p{at[(a, b)]}") - F.try_divide(F.col(f"s{place[a]}") * F.col(f"s{place[b]}"), F.col("n"))

    wide = sums.select(*[
        (F.when((spread_of(a, a) > 0) & (spread_of(b, b) > 0),
                spread_of(a, b) / F.sqrt(spread_of(a, a) * spread_of(b, b)))).alias(f"c{k}")
        for k, (a, b) in enumerate(pairs)])
    entries = []
    for k, (a, b) in enumerate(pairs):
        entries.append(F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"c{k}").alias("corr")))
        if a != b:
            entries.append(F.struct(F.lit(b).alias("col_a"), F.lit(a).alias("col_b"), F.col(f"c{k}").alias("corr")))
    return wide.select(F.explode(F.array(*entries)).alias("e")).select("e.col_a", "e.col_b", "e.corr")


def correlation_matrix_ml(df: DataFrame, cols: list[str]):
    """D19 vector form: MLlib ``Correlation.corr`` on assembled complete rows (DenseMatrix)."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import Correlation

    src = df.select(*cols).na.drop()
    vec = VectorAssembler(inputCols=cols, outputCol="features").transform(src).select("features")
    return Correlation.corr(vec, "features").first()[0]


def correlated_pairs(df: DataFrame, cols: list[str], threshold: float) -> DataFrame:
    """Pairs (a < b by position) with |corr| >= threshold, candidates to drop."""
    order = {c: i for i, c in enumerate(cols)}
    pos = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(order[c]))])
    long = correlation_long(df, cols)
    return long.filter((pos[F.col("col_a")] < pos[F.col("col_b")]) & (F.abs("corr") >= threshold))


def category_distribution(df: DataFrame, col: str) -> DataFrame:
    """Count and share of each category (share over all rows)."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()  # of the groups' counts, whose shuffle it shares
    return counts.select(col, "n", (F.col("n") / total).alias("share"))


def quantile_sketches(df: DataFrame, keys: list[str], cols: list[str], k: int = 400) -> DataFrame:
    """One mergeable quantile sketch per group and column: ``keys``, column, n, sketch (null and NaN left out).

    The sketch is the aggregation state itself: tasks build partial ones, the shuffle
    moves a few kilobytes per group, and a hot group is merged like any other.  Written
    to a table, sketches of days or files merge to any coarser group without the rows.
    ``k`` sets the size; a quantile's rank is off by about 2.3 / k at 99% confidence.
    """
    def number(c):
        v = F.col(c).cast("double")
        return F.when(~F.isnan(v), v)

    aggs = [a for i, c in enumerate(cols) for a in (
        F.kll_sketch_agg_double(number(c), F.lit(k)).alias(f"_s{i}"), F.count(number(c)).alias(f"_n{i}"))]
    wide = df.groupBy(*keys).agg(*aggs)
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_n{i}").alias("n"), F.col(f"_s{i}").alias("sketch"))
                               for i, c in enumerate(cols)])).alias("_e")
    return wide.select(*keys, each).select(*keys, "_e.*").filter("n > 0")


def merge_sketches(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches of finer groups merged by the coarser ``keys`` (and column)."""
    return sketches.groupBy(*keys, "column").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))


def sketch_quantiles(sketches: DataFrame, probs: list[float]) -> DataFrame:
    """The sketch replaced by its quantiles q0, q1, ... at ``probs``: values of the column, at approximate ranks."""
    at = [F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias(f"q{i}") for i, p in enumerate(probs)]
    return sketches.select(*[c for c in sketches.columns if c != "sketch"], *at)


def rank_errors(df: DataFrame, keys: list[str], cols: list[str], quantiles: DataFrame, probs: list[float]) -> DataFrame:
    """How far the quantiles' true ranks are from ``probs``: ``keys``, column, n, prob, rank_error (0: on the mark).

    A value's rank in its group spans (share below it, share up to it); the error is the
    distance of the wanted share from that span.
    """
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols]))
    rows = df.select(*keys, each.alias("_e")).select(*keys, "_e.*").filter("value IS NOT NULL AND NOT isnan(value)")
    joined = rows.join(quantiles, [*keys, "column"])
    spans = joined.groupBy(*keys, "column").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col("value") < F.col(f"q{i}")).alias(f"_lt{i}") for i in range(len(probs))],
        *[F.count_if(F.col("value") <= F.col(f"q{i}")).alias(f"_le{i}") for i in range(len(probs))])
    error = [F.greatest(F.lit(0.0), F.col(f"_lt{i}") / F.col("n") - p, F.lit(p) - F.col(f"_le{i}") / F.col("n"))
             for i, p in enumerate(probs)]
    each = F.explode(F.array(*[F.struct(F.lit(p).alias("prob"), e.alias("rank_error"))
                               for p, e in zip(probs, error, strict=True)])).alias("_p")
    return spans.select(*keys, "column", "n", each).select(*keys, "column", "n", "_p.*")
