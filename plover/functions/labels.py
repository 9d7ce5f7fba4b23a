"""Label columns (B6, B7) and the label audit aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def label_from_status(status: str | Column, good: str) -> Column:
    """B6: 'true' when the status is not the good one, as text (null stays null)."""
    s = F.col(status) if isinstance(status, str) else status
    return (~(s == F.lit(good))).cast("string")


def label_from_threshold(value: str | Column, threshold: float) -> Column:
    """1 when value >= threshold, else 0 (a null value gives 0)."""
    v = F.col(value) if isinstance(value, str) else value
    return F.when(v >= F.lit(threshold), F.lit(1)).otherwise(F.lit(0))


def label_audit(df: DataFrame, value: str, recorded: str, threshold: float) -> DataFrame:
    """Recompute the label and compare with the recorded one, in one pass.

    A null recorded label is not a discrepancy (the comparison is null, which
    a filter on ``== False`` drops); it is counted separately.
    """
    mine = label_from_threshold(value, threshold)
    rec = F.col(recorded)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(mine != rec).alias("n_discrepant"),
        F.count_if(rec.isNull()).alias("n_recorded_null"),
        F.count_if(~mine.eqNullSafe(rec)).alias("n_discrepant_null_safe"),
    )
