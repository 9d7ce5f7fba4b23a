"""Every registered query with an oracle agrees with DuckDB at sf0.001 (the driver's check, smaller)."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from plover.plans import catalog
from conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()
SLOW = {"lr_scores", "gbt_scores", "rf_scores", "cv_metrics", "cv_max_iter", "lr_training_summary", "lr_rolling",
        "loan_auc", "loan_roc_stacked", "loan_money_by_cell"}


def _norm(v):
    if v is None:
        return "None"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)) or hasattr(v, "as_integer_ratio"):
        f = float(v)
        return "nan" if math.isnan(f) else f"{f:.9g}"
    return str(v)


def _rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in recs)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["ORIGIN_CITY_NAME", "avg_arr_delay"]
    assert 0 < df.count() <= 10


PYTHON_NODES = ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas")


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    sdf = entry.queries()[name](spark, SF_SMALL)
    plan = sdf._jdf.queryExecution().executedPlan().toString()
    assert not any(p in plan for p in PYTHON_NODES), "no Python in the plan"
    res = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(ocols)
    assert _rows(sdf.columns, [tuple(r) for r in sdf.collect()]) == _rows(ocols, res.fetchall())


def test_every_query_has_oracle_or_is_a_model():
    assert set(catalog.queries()) - set(catalog.oracle_sql()) == SLOW
