"""All registered queries: importing the query modules fills the registry."""

from __future__ import annotations

from plover.plans import q_eval, q_explore, q_features, q_joins, q_loans  # noqa: F401
from plover.plans.registry import ORACLES, QUERIES


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLES)
