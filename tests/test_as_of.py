"""As-of joins against a literal search."""

import datetime as dt
import random

import pytest

from plover.operators.joins import join_as_of

T0 = dt.datetime(2024, 3, 1)


def brute(left, right, lag, age=None):
    out = []
    for i, k, t in left:
        own = [(u, v is not None, v if v is not None else 0, v) for k2, u, v in right
               if k is not None and t is not None and u is not None and k == k2 and u <= t - dt.timedelta(seconds=lag)]
        best = max(own, key=lambda r: r[:3], default=None)
        if best is not None and age is not None and best[0] < t - dt.timedelta(seconds=lag + age):
            best = None
        out.append((i, k, t, best and best[0], best and best[3]))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def sides():
    rng = random.Random(4)

    def at(days):
        return T0 + dt.timedelta(days=rng.random() * days, microseconds=rng.randrange(3))

    left = [(i, rng.choice(["hot"] * 8 + ["a", "b", "none", None]), rng.choice([at(20), at(20), None])) for i in range(600)]
    left += [(i, "hot", T0 + dt.timedelta(days=2)) for i in range(600, 900)]  # a hot instant, repeated rows
    left += [(1, "a", T0 + dt.timedelta(days=9))] * 3
    right = [(rng.choice(["hot"] * 8 + ["a", None]), rng.choice([at(4), at(20), None]), rng.choice([None, float(rng.randrange(9))]))
             for _ in range(500)]
    right += [("b", T0 + dt.timedelta(days=1), 5.0)]  # then nothing for weeks
    right += [("hot", T0 + dt.timedelta(days=1, hours=22), v) for v in (1.0, 3.0, None, 3.0)]  # ties, exactly the lag before
    right += [("hot", T0 + dt.timedelta(days=1, hours=22, microseconds=1), 9.0)]
    return left, right


def joined(spark, left, right, kind="timestamp_ntz", parts=3, **how):
    lf = spark.createDataFrame(left, f"id long, k string, t {kind}").selectExpr("*", "1 AS _side").drop("_side").repartition(parts)
    rt = spark.createDataFrame(right, f"k string, u {kind}, v double")
    out = join_as_of(lf, rt, "t", "u", ["k"], ["v"], **how)
    assert out.columns == ["id", "k", "t", "u", "v"]
    return sorted(((r.id, r.k, r.t, r.u, r.v) for r in out.collect()), key=str)


def test_as_of(spark, sides):
    for lag, age, block in ((7200, None, 6 * 3600), (0, None, 60), (3600, 86400, 10**9)):
        assert joined(spark, *sides, lag_seconds=lag, max_age_seconds=age, block_seconds=block) == brute(*sides, lag, age)
    assert joined(spark, *sides, kind="timestamp", lag_seconds=7200) == brute(*sides, 7200)


def test_empty_sides(spark, sides):
    left, right = sides
    assert joined(spark, left[:0], right) == []
    assert joined(spark, left, right[:0]) == brute(left, [], 0)


def test_no_window_over_the_rows(spark, sides):
    """Windows run per (key, block) or over one row per key and block; the rows are never ordered per key."""
    lf = spark.createDataFrame(sides[0], "id long, k string, t timestamp_ntz")
    rt = spark.createDataFrame(sides[1], "k string, u timestamp_ntz, v double")
    plan = join_as_of(lf, rt, "t", "u", ["k"], ["v"])._jdf.queryExecution().optimizedPlan().toString()
    over = [line for line in plan.splitlines() if "Window [" in line]
    assert len(over) == 2 and sum("_block" in line.split("], [")[1] for line in over) == 1
    assert "Aggregate" in plan[plan.index([x for x in over if "_block" not in x.split("], [")[1]][0]):]
