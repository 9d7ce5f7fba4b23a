"""Sorts and top-k.

The reference sorted in pandas without a tie-break; here every order ends in
the key columns, so results are deterministic.  ``orderBy(..).limit(k)`` is
planned as ``TakeOrderedAndProject``: each task keeps its own k best rows and
only k x tasks rows meet at the end — no full sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _order(by: str, ascending: bool, keys: list[str]):
    first = F.col(by).asc_nulls_last() if ascending else F.col(by).desc_nulls_last()
    return [first] + [F.col(k).asc() for k in keys]


def sort_by(df: DataFrame, by: str, keys: list[str], ascending: bool = True) -> DataFrame:
    """full sort with key tie-break."""
    return df.orderBy(*_order(by, ascending, keys))


def top_k(df: DataFrame, by: str, k: int, keys: list[str]) -> DataFrame:
    """k largest by ``by``."""
    return df.orderBy(*_order(by, False, keys)).limit(k)


def bottom_k(df: DataFrame, by: str, k: int, keys: list[str]) -> DataFrame:
    """k smallest by ``by``."""
    return df.orderBy(*_order(by, True, keys)).limit(k)
