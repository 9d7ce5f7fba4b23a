"""Operator semantics on tiny tables, plus properties."""

import math
import random

import pytest
from pyspark.sql import functions as F

from plover.operators import clean as C
from plover.operators import evaluate as E
from plover.operators import joins as J
from plover.operators import profile as P
from plover.operators.prefix import running_totals
from plover.operators.rolling import lagged_range_mean


# ---------------------------------------------------------------- evaluation
def _scores(spark, rows):
    return spark.createDataFrame(rows, "score double, label double")


def test_auc_edges(spark):
    tied = _scores(spark, [(0.5, 1.0), (0.5, 0.0), (0.5, 1.0), (0.5, 0.0)])
    assert E.auc_exact(tied, "score", "label").first().auc == pytest.approx(0.5)
    perfect = _scores(spark, [(0.9, 1.0), (0.8, 1.0), (0.2, 0.0), (0.1, 0.0)])
    assert E.auc_exact(perfect, "score", "label").first().auc == pytest.approx(1.0)
    one_class = _scores(spark, [(0.9, 1.0), (0.8, 1.0)])
    assert E.auc_exact(one_class, "score", "label").first().auc is None


def test_auc_matches_mllib_and_reverses(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    rnd = random.Random(7)
    rows = [(round(rnd.random(), 2), float(rnd.random() < 0.4)) for _ in range(3000)]
    df = _scores(spark, rows)
    auc = E.auc_exact(df, "score", "label").first().auc
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    assert auc == pytest.approx(ev.evaluate(df), abs=1e-9)
    rev = E.auc_exact(df.withColumn("score", -F.col("score")), "score", "label").first().auc
    assert auc + rev == pytest.approx(1.0, abs=1e-9)


def test_roc_and_best_f1(spark):
    df = _scores(spark, [(0.9, 1.0), (0.7, 0.0), (0.7, 1.0), (0.2, 0.0)])
    roc = sorted((r.fpr, r.tpr) for r in E.roc_curve(df, "score", "label").collect())
    assert roc == [(0.0, 0.0), (0.0, 0.5), (0.5, 1.0), (1.0, 1.0), (1.0, 1.0)]
    best = E.best_f1_threshold(df, "score", "label").first()
    # at 0.7: tp=2 fp=1 -> p=2/3 r=1 -> f1=0.8 (best); ties resolve to the smaller threshold
    assert best.threshold == 0.7 and best.f_measure == pytest.approx(0.8)


def test_running_totals_is_exact_and_partition_independent(spark):
    rnd = random.Random(3)
    rows = [(float(i), rnd.randint(0, 5)) for i in range(2000)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "v double, w long").repartition(7)
    got = {r.v: r.cum_w for r in running_totals(df, "v", ["w"], buckets=16).collect()}
    acc, want = 0, {}
    for v, w in sorted(rows):
        acc += w
        want[v] = acc
    assert got == want
    desc = {r.v: r.cum_w for r in running_totals(df, "v", ["w"], descending=True, buckets=16).collect()}
    total = sum(w for _, w in rows)
    assert all(desc[v] == total - want[v] + w for v, w in rows)


# ---------------------------------------------------------------- profile
def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (9.0,), (10.0,)], "x double")
    h = {r.bin: r.n for r in P.histogram(df, "x", 5).collect()}
    assert h == {0: 2, 1: 0, 2: 0, 3: 0, 4: 2}  # max in last bin, empty bins listed
    assert sum(h.values()) == 4


def test_exact_quantiles_match_percentile(spark):
    rnd = random.Random(11)
    vals = [float(rnd.randint(0, 50)) for _ in range(501)] + [None, float("nan")]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    q = P.exact_quantiles(df, ["x"], [0.25, 0.5, 0.75]).first()
    want = df.filter(~F.isnan("x")).agg(F.percentile("x", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))).first()[0]
    assert [q.q0, q.q1, q.q2] == pytest.approx(want)


def test_missing_counts_nan_rules(spark):
    df = spark.createDataFrame([(1.0, "a", None), (float("nan"), None, None), (None, "b", None)],
                               "d double, s string, t timestamp")
    got = {r.column: r.n_missing for r in P.missing_counts(df).collect()}
    assert got == {"d": 2, "s": 1, "t": 3}


def test_correlation_long_matches_mllib(spark):
    rnd = random.Random(5)
    rows = [(x, 2 * x + rnd.random(), rnd.random()) for x in (rnd.random() for _ in range(300))]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    long = {(r.col_a, r.col_b): r.corr for r in P.correlation_long(df, ["a", "b", "c"]).collect()}
    m = P.correlation_matrix_ml(df, ["a", "b", "c"]).toArray()
    for i, a in enumerate("abc"):
        for j, b in enumerate("abc"):
            assert long[(a, b)] == pytest.approx(m[i][j], abs=1e-9)


# ---------------------------------------------------------------- windows
def _same(a, b):
    if a is None or b is None:
        return a is None and b is None
    if math.isnan(a) or math.isnan(b):
        return math.isnan(a) and math.isnan(b)
    return a == b or a == pytest.approx(b, rel=1e-9)


def _global_means(df, keyed, lo, hi):
    from pyspark.sql import Window

    w = Window.partitionBy("k") if keyed else Window.partitionBy()
    return df.withColumn("m", F.avg("v").over(w.orderBy("t").rangeBetween(-lo, -hi))).collect()


@pytest.mark.parametrize("keyed", [False, True])
def test_lagged_window_equals_global(spark, keyed):
    """Repeated ids, null keys, infinities, tiny and huge values, and one second that holds most rows."""
    rnd = random.Random(1)
    odd = [None, float("nan"), float("inf"), float("-inf"), 1e-13, 1e30]
    rows = [(i % 700, rnd.randint(0, 2 * 86400), rnd.choice(odd) if i % 60 == 0 else rnd.random() * 100, rnd.choice([0, 1, None]))
            for i in range(1000)]
    rows += [(i % 9, 86400, rnd.random() * 1e-12, rnd.choice([0, None])) for i in range(2500)] + [(5, None, 1.0, 0)]
    df = spark.createDataFrame(rows, "id long, t long, v double, k long")
    for lo, hi in ((6 * 3600, 2 * 3600), (300, 300), (100, 0)):
        got = lagged_range_mean(df, "t", ["v"], lo, hi, ["id"], partition_cols=["k"] if keyed else None,
                                keep_cols=["t", "v", "k"]).collect()
        assert len(got) == len(rows)
        key = lambda r: tuple((x is None, 0.0 if x is None or x != x else x, x != x) for x in (r.id, r.t, r.v, r.k))
        # a null time has no frame here; the window would put all null times into one frame
        want = sorted((r for r in _global_means(df, keyed, lo, hi) if r.t is not None), key=key)
        mine = sorted((r for r in got if r.t is not None), key=key)
        assert all(_same(a.rolling_v_average, b.m) for a, b in zip(mine, want, strict=True)), (lo, hi)
        assert all(r.rolling_v_average is None for r in got if r.t is None)


def test_frame_edges(spark):
    t0 = 100_000
    rows = [(0, t0, None), (1, t0 - 6 * 3600, 1.0), (2, t0 - 2 * 3600, 3.0),
            (3, t0 - 2 * 3600 + 1, 100.0), (4, t0 - 6 * 3600 - 1, 100.0)]
    df = spark.createDataFrame(rows, "id long, t long, v double")
    r = {x.id: x.rolling_v_average for x in lagged_range_mean(df, "t", ["v"], 6 * 3600, 2 * 3600, ["id"]).collect()}
    assert r[0] == pytest.approx(2.0)  # only t-6h and t-2h are inside
    assert r[4] is None  # nothing before it


def test_keyless_window_plan_has_no_single_partition(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") * 37).alias("t"), F.rand(1).alias("v"))
    plan = lagged_range_mean(df, "t", ["v"], 600, 100, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


# ---------------------------------------------------------------- clean / joins
def test_hash_split_partitions_input(spark):
    df = spark.range(5000).select(F.col("id").alias("k"))
    a = C.hash_split(df, ["k"], [0.7, 0.3]).groupBy("split").count().collect()
    b = C.hash_split(df.repartition(13), ["k"], [0.7, 0.3]).groupBy("split").count().collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    assert sum(r[1] for r in a) == 5000
    assert abs(dict(map(tuple, a))[0] - 3500) < 250


def test_dropped_share_and_drop_missing(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (2.0,)], "x double")
    r = C.dropped_share(df).first()
    assert (r.n_before, r.n_after, r.dropped_pct) == (4, 2, 50.0)
    assert C.drop_missing(df).count() == 2


def test_deduplicate_picks_smallest(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 3, "z"), (2, 9, "a"), (1, 3, "a")], "k long, o long, s string")
    got = sorted(tuple(r) for r in J.deduplicate(df, ["k"]).collect())
    assert got == [(1, 3, "a"), (2, 9, "a")]
    counts = sorted(tuple(r) for r in J.duplicate_counts(df, ["k"]).collect())
    assert counts == [(1, 1), (3, 1)]


def test_prefix_families(spark):
    from plover.sources.schema import prefix_families

    names = spark.createDataFrame([("AB",), ("A",), ("AC",)], "column string")
    got = {r.family: r["count"] for r in prefix_families(names).collect()}
    assert got == {"A": 3}


def test_exact_quantiles_many_buckets_with_hot_value(spark):
    """Also beside a column without values, which must not undo the others' buckets."""
    rnd = random.Random(21)
    vals = [7.0] * 400 + [rnd.uniform(-1e6, 1e6) for _ in range(800)]  # one value holds a third
    df = spark.createDataFrame([(v, v * 2, None, float("nan")) for v in vals], "x double, y double, e double, n double")
    got = {r.column: [r.q0, r.q1, r.q2] for r in P.exact_quantiles(df, ["x", "e", "y", "n"], [0.1, 0.5, 0.9], 40).collect()}
    assert set(got) == {"x", "y"}
    for c in ("x", "y"):
        want = df.agg(F.percentile(c, F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9)))).first()[0]
        assert got[c] == pytest.approx(want, rel=1e-12)
    from plover.operators.prefix import with_buckets

    cut = with_buckets(df, ["x", "e"], ["bx", "be"], 40).agg(F.countDistinct("bx"), F.countDistinct("be")).first()
    assert cut[0] > 20 and cut[1] == 1


# ---------------------------------------------------------------- evaluation edge cases
def test_auc_of_billions_of_rows(spark):
    counts = spark.createDataFrame([(0.9, 6 * 10**9, 2 * 10**9), (0.1, 2 * 10**9, 6 * 10**9)], "threshold double, pos long, neg long")
    r = E.auc_of_counts(counts).first()
    assert r.auc == pytest.approx((6 * 6 + 0.5 * 6 * 2 + 0.5 * 2 * 6) / 64) and r.n_pos == 8 * 10**9


def test_one_class_nan_scores_and_no_predicted_positive(spark):
    one = spark.createDataFrame([(0.2, 1.0), (0.7, 1.0)], "score double, label double")
    assert E.auc_exact(one, "score", "label").first().auc is None
    assert {r.fpr for r in E.roc_curve(one, "score", "label").collect() if r.threshold is not None} == {None}
    r = E.precision_recall(one, "score", "label", 0.9).first()
    assert (r.tp, r.fp, r.precision, r.f1) == (0, 0, None, None) and r.recall == 0.0
    nan = spark.createDataFrame([(float("nan"), 1.0), (0.9, 1.0), (0.1, 0.0), (None, 0.0)], "score double, label double")
    assert E.auc_exact(nan, "score", "label").first().auc == 1.0
    assert E.precision_recall(nan, "score", "label", 0.5).first().tp == 1
    assert [x.prediction for x in E.apply_threshold(nan, "score", 0.5).collect()] == [0.0, 1.0, 0.0, 0.0]


# ---------------------------------------------------------------- key hash
@pytest.mark.parametrize("k", [2, 5, 10])
def test_folds_do_not_follow_key_arithmetic(spark, k):
    df = spark.range(-20000, 20000).select("id", (C.key_hash(["id"]) % 5).alias("fold"))
    share = df.groupBy(F.pmod("id", F.lit(k)).alias("r"), (F.col("id") < 0).alias("neg"), "fold").count().collect()
    want = 40000 / (2 * k * 5)
    assert len(share) == 2 * k * 5 and all(abs(r["count"] - want) < 6 * want ** 0.5 for r in share)


def test_running_totals_have_no_single_partition_over_rows(spark):
    df = spark.range(5000).select(F.col("id").cast("double").alias("v"), F.lit(1).alias("w"))
    plan = running_totals(df, "v", ["w"])._jdf.queryExecution().executedPlan().toString()
    import re

    for m in re.finditer("SinglePartition", plan):  # only the bucket table, which is aggregated by bucket first
        assert "partial_sum" in plan[m.end():m.end() + 1500]
