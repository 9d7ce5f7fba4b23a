"""Dropping correlated columns (J5): a graph on the correlation matrix, thinned greedily.

The matrix comes from Spark (one aggregate, or MLlib for wide tables) and has as many
entries as there are column pairs, whatever the rows; only it reaches the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plover.operators.profile import correlation_long, correlation_matrix_ml

WIDE = 40  # columns from which one aggregate with a sum per pair would outgrow generated code


@dataclass(frozen=True)
class Decision:
    """What became of a column: ``step`` and ``n_links`` when it was dropped, and its strongest partner left then."""

    column: str
    kept: bool
    step: int | None = None
    n_links: int = 0
    partner: str | None = None
    corr: float | None = None


def correlation_edges(df: DataFrame, cols: list[str], threshold: float) -> dict[tuple[str, str], float]:
    """Correlation of every pair (in column order) with |corr| >= ``threshold``; constant columns have none."""
    order = {c: i for i, c in enumerate(cols)}
    if len(cols) < WIDE:
        long = correlation_long(df, cols).filter(~F.isnan("corr") & (F.abs("corr") >= threshold))
        found = {(r["col_a"], r["col_b"]): r["corr"] for r in long.collect()}
    else:
        doubles = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
        values = correlation_matrix_ml(doubles, cols).toArray()
        found = {(a, b): float(values[i, j]) for i, a in enumerate(cols) for j, b in enumerate(cols)
                 if abs(values[i, j]) >= threshold}
    return {(a, b): x for (a, b), x in found.items() if order[a] < order[b]}


def thin(cols: list[str], edges: dict[tuple[str, str], float]) -> list[Decision]:
    """Drop the column with most links, ties to the later column, until no link is left; in column order."""
    order = {c: i for i, c in enumerate(cols)}
    links: dict[str, dict[str, float]] = {c: {} for c in cols}
    for (a, b), x in edges.items():
        links[a][b] = links[b][a] = x
    out = {c: Decision(c, True) for c in cols}
    step = 0
    while True:
        worst = max(cols, key=lambda c: (len(links[c]), order[c]), default=None)
        if worst is None or not links[worst]:
            return [out[c] for c in cols]
        partner = min(links[worst], key=lambda c: (-round(abs(links[worst][c]), 9), order[c]))
        out[worst] = Decision(worst, False, step, len(links[worst]), partner, links[worst][partner])
        step += 1
        for c in links.pop(worst):
            del links[c][worst]
        links[worst] = {}


def drop_correlated(df: DataFrame, cols: list[str], threshold: float) -> tuple[DataFrame, list[Decision]]:
    """``df`` without the columns of ``cols`` that the greedy elimination drops, and a decision per column.

    A dropped column need not be linked to a kept one directly: in a chain a-b-c only
    b goes.  Rows with a missing value in any of ``cols`` are left out of the
    correlations, not of the result; columns outside ``cols`` stay.
    """
    decisions = thin(cols, correlation_edges(df, cols, threshold))
    return df.drop(*[d.column for d in decisions if not d.kept]), decisions
