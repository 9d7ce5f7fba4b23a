"""Length buckets with the least padding, and token-budget batches inside each bucket.

The histogram of all lengths up to the budget (so at most ``budget + 1`` rows, whatever
the corpus) goes to the driver, where a dynamic program picks the bucket
boundaries.  Rows are numbered inside a bucket without gathering it: in
(bucket, salt) groups, whose sizes give each group its first number.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plover.llm.common import materialise

WORD = r"[^ \t-\r]+"


def boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """At most ``buckets`` boundaries (the last is the largest length) with minimal total padding.

    Buckets are runs of the sorted distinct lengths padded to their largest.  The cost
    satisfies the quadrangle inequality, so the best cut never moves left as the run
    grows and each layer is solved by halving.
    """
    order = np.argsort(lengths)
    length, count = np.asarray(lengths, np.int64)[order], np.asarray(counts, np.int64)[order]
    n = len(length)
    if not n:
        return []
    rows = np.concatenate([[0], np.cumsum(count)]).astype(np.float64)
    used = np.concatenate([[0], np.cumsum(count * length)]).astype(np.float64)

    def cost(i, j):
        return length[j - 1] * (rows[j] - rows[i]) - (used[j] - used[i])

    best = np.full(n + 1, np.inf)
    best[0] = 0.0
    cuts = []
    for _ in range(min(buckets, n)):
        now, cut = np.full(n + 1, np.inf), np.zeros(n + 1, np.int64)
        now[0] = 0.0
        todo = [(1, n, 0, n - 1)]
        while todo:
            a, b, lo, hi = todo.pop()
            if a > b:
                continue
            j = (a + b) // 2
            i = np.arange(lo, min(hi, j - 1) + 1)
            total = best[i] + cost(i, j)
            at = int(np.argmin(total))
            now[j], cut[j] = total[at], i[at]
            todo += [(a, j - 1, lo, int(i[at])), (j + 1, b, int(i[at]), hi)]
        cuts.append(cut)
        best = now
    out, j = [], n
    for cut in reversed(cuts):
        if j <= 0:
            break
        out.append(int(length[j - 1]))
        j = int(cut[j])
    return sorted(set(out))


def number_rows(df: DataFrame, group: list[str], salt: Column, order: list[Column], out: str, parts: int) -> DataFrame:
    """``df`` plus ``out``: 0, 1, 2, ... inside each group, numbered by (salt, order); a hot group is dealt to ``parts`` salts."""
    salted = df.withColumn("_salt", F.pmod(salt, F.lit(parts)))
    size = salted.groupBy(*group, "_salt").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    first = materialise(size.withColumn("_first", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"), "offsets")
    inside = Window.partitionBy(*group, "_salt").orderBy(*order)
    numbered = salted.withColumn("_row", F.row_number().over(inside) - 1)
    return numbered.join(first, [*group, "_salt"]).withColumn(out, F.col("_row") + F.col("_first")).drop("_row", "_first", "_salt")


def spaced_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``n_tokens``, the white-space words of every row: a cheap stand-in for the tokens of a vocabulary."""
    count = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select(F.col(id_col).alias("doc_id"), count.alias("n_tokens"))


def pack(lengths: DataFrame, budget: int = 16_384, buckets: int = 12) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``bucket``, ``bucket_len``, ``batch``, ``padding`` of every row.

    ``lengths`` has ``doc_id`` and ``n_tokens`` of every row, from
    ``tokens.token_counts`` or ``spaced_words``.  A batch holds ``budget // bucket_len`` rows of one bucket, all padded to its
    length; only a bucket's last batch is smaller.  A text longer than the budget is
    never cut: it is a batch of its own in the bucket after the last, without
    padding.  Rows without tokens (or a null length) go to the first bucket.
    Repeated rows and null ids are packed like others (rows that agree in id and
    length are interchangeable); other columns are ignored; an empty table gives no rows.
    """
    spark = lengths.sparkSession
    size = F.coalesce(F.col("n_tokens"), F.lit(0)).cast("long")
    sized = materialise(lengths.select("doc_id", size.alias("n_tokens")), "lengths")
    seen = sized.filter(F.col("n_tokens") <= budget).groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")).collect()
    bounds = boundaries(np.array([r[0] for r in seen]), np.array([r[1] for r in seen]), buckets)
    bucket, size = F.lit(len(bounds)), F.col("n_tokens")
    for i in range(len(bounds) - 1, -1, -1):
        fits = F.col("n_tokens") <= bounds[i]
        bucket, size = F.when(fits, i).otherwise(bucket), F.when(fits, F.lit(bounds[i]).cast("long")).otherwise(size)
    placed = sized.withColumns({"bucket": bucket.cast("int"), "bucket_len": size})
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    placed = number_rows(placed, ["bucket"], F.xxhash64("doc_id", "n_tokens"), [F.col("n_tokens"), F.col("doc_id")], "_at", parts)
    room = F.when(F.col("bucket") == len(bounds), F.lit(1)).otherwise(
        F.greatest(F.floor(F.lit(budget) / F.greatest("bucket_len", F.lit(1))), F.lit(1)))
    return placed.select("doc_id", "n_tokens", "bucket", "bucket_len", F.floor(F.col("_at") / room).cast("long").alias("batch"),
                         (F.col("bucket_len") - F.col("n_tokens")).alias("padding"))
