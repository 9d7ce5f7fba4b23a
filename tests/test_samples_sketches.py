"""B11 samples of a stated size, D18 sketches."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from plover.operators import clean as C
from plover.operators import profile as P


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    out = [(i, rng.choice(["hot"] * 7 + ["a", "b", None]), rng.random()) for i in range(2000)]
    return out + [(5000, "rare", 0.5), (None, "rare", 0.5), (5000, "rare", 0.5)]


def md5(i):
    return hashlib.md5(("" if i is None else str(i)).encode()).hexdigest()


def test_samples(spark, rows):
    df = spark.createDataFrame(rows, "id long, s string, x double")
    want = sorted(md5(i) for i, _, _ in rows)[:50]
    for parts in (1, 6):
        got = C.sample_rows(df.repartition(parts), ["id"], 50)
        assert got.columns == df.columns and sorted(md5(r.id) for r in got.collect()) == want
        by = {}
        for r in C.sample_rows(df.repartition(parts), ["id"], 50, ["s"]).collect():
            by.setdefault(r.s, []).append(md5(r.id))
        assert set(by) == {s for _, s, _ in rows}
        for s, own in by.items():
            assert sorted(own) == sorted(md5(i) for i, t, _ in rows if t == s)[:50]
    assert len([1 for r in C.sample_rows(df, ["id"], 50, ["s"]).collect() if r.s == "rare"]) == 3  # smaller than the size
    assert C.sample_rows(df.limit(0), ["id"], 5, ["s"]).count() == 0


def test_tasks_keep_only_their_own_smallest(spark, rows):
    df = spark.createDataFrame(rows, "id long, s string, x double").repartition(4)
    plan = C.sample_rows(df, ["id"], 5, ["s"])._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    partial = next(i for i, x in enumerate(lines) if "WindowGroupLimit" in x and "Partial" in x)
    assert any("hashpartitioning(s" in x for x in lines[:partial])  # the limit runs below the shuffle
    assert "TakeOrderedAndProject" in C.sample_rows(df, ["id"], 5)._jdf.queryExecution().executedPlan().toString()


def test_sketches_merge_and_hold_their_rank_error(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["hot"] * 6 + ["a", "b"]), i % 7, rng.choice([rng.gauss(0, 5), 3.0, rng.expovariate(1)]),
             rng.choice([None, float("nan"), rng.random()])) for i in range(40_000)]
    df = spark.createDataFrame(rows, "g string, d int, x double, y double")
    probs = [0.01, 0.25, 0.5, 0.75, 0.99]
    fine = P.quantile_sketches(df, ["g", "d"], ["x", "y"])
    merged = P.merge_sketches(fine, ["g"])
    n = {(r.g, r.column): r.n for r in merged.collect()}
    assert n == {(g, c): sum(1 for r in rows if r[0] == g and (c == "x" or (r[3] is not None and r[3] == r[3])))
                 for g in ("hot", "a", "b") for c in ("x", "y")}
    errors = P.rank_errors(df, ["g"], ["x", "y"], P.sketch_quantiles(merged.drop("n"), probs), probs).collect()
    assert len(errors) == 30 and max(r.rank_error for r in errors) <= 0.01
    # ranks of the exact quantiles, on the same scale: no error but that of interpolation
    exact = P.exact_quantiles(df.filter("g = 'hot'"), ["x"], probs).select(
        F.lit("hot").alias("g"), "column", *[f"q{i}" for i in range(5)])
    assert max(r.rank_error for r in P.rank_errors(df.filter("g = 'hot'"), ["g"], ["x"], exact, probs).collect()) < 1e-3
    assert P.quantile_sketches(df.limit(0), ["g"], ["x"]).count() == 0
    assert P.quantile_sketches(df.withColumn("x", F.lit(None).cast("double")), ["g"], ["x"]).count() == 0
