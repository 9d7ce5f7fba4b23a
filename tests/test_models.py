"""Planted-signal model tests: AUC above a floor, stable reruns, one score per row."""

import pytest
from pyspark.sql import functions as F

from plover.operators import evaluate as E
from plover.operators import models as M
from plover.session import written


@pytest.fixture(scope="module")
def planted(spark):
    df = spark.range(4000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, "b").otherwise("c").alias("cat"),
        (F.rand(3) * 10).alias("x"),
        F.when(F.col("id") % 17 == 0, None).otherwise(F.rand(4)).alias("noise"),
    )
    df = df.withColumn("bad", (F.col("x") + F.when(F.col("cat") == "a", 3).otherwise(0) + F.rand(5) * 4 > 8)
                       .cast("string"))
    return df


def test_glm_learns_planted_signal(spark, planted):
    pipe, _ = M.glm_pipeline(["cat"], ["x", "noise"], "bad", reg_param=0.01)
    model = pipe.fit(planted)
    s = M.score(model, planted, keep=["id"])
    assert s.count() == planted.count()
    auc = E.auc_exact(s, "p1", "label").first().auc
    assert auc > 0.85
    again = M.score(pipe.fit(planted), planted, keep=["id"]).agg(F.sum("p1")).first()[0]
    assert again == pytest.approx(s.agg(F.sum("p1")).first()[0], rel=1e-9)


def test_gbt_learns_planted_signal(spark, planted):
    pipe = M.gbt_pipeline(["cat"], ["x", "noise"], "bad", max_iter=5, max_depth=3)
    s = M.score(pipe.fit(planted), planted, keep=["id"])
    assert E.auc_exact(s, "p1", "label").first().auc > 0.85


def test_folds_are_repeatable(spark, planted):
    a = M.with_folds(planted, ["id"]).groupBy("fold").count().collect()
    b = M.with_folds(planted.repartition(5), ["id"]).groupBy("fold").count().collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_rf_learns_planted_signal_with_weights(spark, planted):
    w = M.class_weights(planted, "bad", "class_weight").select("bad", "class_weight")
    pipe = M.rf_pipeline(["cat"], ["x", "noise"], "bad", weight_col="class_weight")
    s = M.score(M.fit(pipe, planted.join(w, "bad")), planted, keep=["id"])
    assert s.count() == planted.count() and E.auc_exact(s, "p1", "label").first().auc > 0.85


def test_cross_validation_equals_mllib_with_one_feature_fit_per_fold(spark, planted, monkeypatch):
    from pyspark.ml import Pipeline
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator

    pipe, lr = M.glm_pipeline(["cat"], ["x", "noise"], "bad")
    grid = [{lr.regParam: x} for x in (5.0, 0.01, 0.1)]
    fits, fit = [], Pipeline.fit
    monkeypatch.setattr(Pipeline, "fit", lambda self, df, *a: fits.append(len(self.getStages())) or fit(self, df, *a))
    got = M.cross_validate(pipe, planted, ["id"], grid, folds=3)
    assert fits == [len(pipe.getStages()) - 1] * 3  # three folds, whatever the number of settings
    monkeypatch.undo()
    cv = CrossValidator(estimator=pipe, estimatorParamMaps=grid, evaluator=BinaryClassificationEvaluator(), numFolds=3, foldCol="fold")
    want = cv.fit(M.with_folds(planted, ["id"], 3)).avgMetrics
    assert got == pytest.approx(want, abs=1e-6) and got[1] > got[0]
    best = M.best_setting(grid, got)
    assert best == grid[max(range(3), key=lambda i: want[i])]
    assert E.auc_exact(M.score(pipe.fit(planted, best), planted), "p1", "label").first().auc > 0.85


def test_scores_follow_the_tables(spark, tmp_path):
    """No score table outlives a call: other rows under the same path give other scores."""
    import shutil

    from conftest import SF_SMALL
    from plover.plans.catalog import queries

    folder = str(tmp_path / "tables")
    shutil.copytree(SF_SMALL, folder)
    first = {(r.model, r.side): r.n for r in queries()["loan_scored_sides"](spark, folder).collect()}
    half = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").filter("l_orderkey % 2 = 0")
    half.write.parquet(f"{folder}/new")
    import os

    os.chmod(folder, 0o755)
    os.replace(f"{folder}/lineitem.parquet", f"{folder}/old.parquet")
    os.replace(f"{folder}/new", f"{folder}/lineitem.parquet")
    second = {(r.model, r.side): r.n for r in queries()["loan_scored_sides"](spark, folder).collect()}
    assert set(first) == set(second) and all(second[k] < first[k] for k in first)


def test_training_summary_agrees_with_the_exact_curve(spark, planted):
    pipe, _ = M.glm_pipeline(["cat"], ["x", "noise"], "bad", reg_param=0.01)
    with written(planted, "planted") as data:
        model = pipe.fit(data)
        best = model.stages[-1].summary.fMeasureByThreshold.agg(F.max("F-Measure")).first()[0]
    mine = E.best_f1_threshold(M.score(model, planted), "p1", "label").first().f_measure
    assert mine == pytest.approx(best, abs=0.01)  # MLlib bins its thresholds


def test_training_table_runs_once_and_is_removed(spark, planted):
    import os

    runs = spark.sparkContext.accumulator(0)

    def counted(batches):
        runs.add(1)
        yield from batches

    source = planted.repartition(1).mapInArrow(counted, planted.schema)
    with written(source, "once") as data:
        path = data.inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0]
        for _ in range(3):
            assert data.count() == 4000
        assert os.path.isdir(path)
    assert runs.value == 1 and not os.path.exists(path)


def test_written_files_have_many_row_groups(spark):
    """A task reads whole row groups, so a file of many rows must not be a single one."""
    import glob

    import pyarrow.parquet as pq

    with written(spark.range(2_000_000).select("id", F.rand(1).alias("x")).coalesce(1), "wide") as data:
        folder = data.inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0]
        assert min(pq.ParquetFile(f).num_row_groups for f in glob.glob(f"{folder}/*.parquet")) > 4


def test_blocks_of_written_tables_run_compiled(spark):
    from plover.session import HUGE_METHOD

    before = spark.conf.get(HUGE_METHOD)
    with written(spark.range(3), "outer") as data:
        assert int(spark.conf.get(HUGE_METHOD)) <= 8000
        with written(data, "inner"):
            pass
        assert int(spark.conf.get(HUGE_METHOD)) <= 8000
    assert spark.conf.get(HUGE_METHOD) == before


def test_folds_are_written_before_the_scaler(spark, planted, monkeypatch):
    columns = {}

    def noted(df, name):
        columns[name] = df.columns
        return written(df, name)

    monkeypatch.setattr(M, "written", noted)
    pipe, lr = M.glm_pipeline(["cat"], ["x", "noise"], "bad")
    assert M.cross_validate(pipe, planted, ["id"], [{lr.regParam: 0.01}], folds=2)[0] > 0.85
    assert columns["fold"] == ["features", "label", "held"]


def test_scaled_vectors_stay_sparse_with_the_centred_probabilities(spark, planted):
    """The fit must not hold every one-hot column of every row; the model is that of centred vectors."""
    from pyspark.ml import Pipeline
    from pyspark.ml.linalg import SparseVector

    from plover.operators import features as FT

    rows = planted.withColumn("many", (F.col("id") % 40).cast("string"))
    pipe, lr = M.glm_pipeline(["cat", "many"], ["x", "noise"], "bad", reg_param=0.01)
    model = pipe.fit(rows)
    assert all(isinstance(r[0], SparseVector) for r in model.transform(rows).select("scaledFeatures").take(50))
    centred = Pipeline(stages=[*pipe.getStages()[:-2], FT.scaler(), lr]).fit(rows)
    a, b = ({r.id: r.p1 for r in M.score(m, rows, keep=["id"]).collect()} for m in (model, centred))
    assert len(a) == 4000 and a == pytest.approx(b, abs=1e-9)
    assert list(model.stages[-1].coefficients) == pytest.approx(list(centred.stages[-1].coefficients), abs=1e-9)


def test_forest_rows_are_not_shuffled_by_class(spark, monkeypatch):
    from conftest import SF_SMALL
    from plover.plans import q_eval

    class Seen(Exception):
        pass

    def look(self, df):
        raise Seen(df._jdf.queryExecution().optimizedPlan().toString() + df._jdf.queryExecution().executedPlan().toString())

    class Forest:
        fit = look

    monkeypatch.setattr(q_eval.M, "rf_pipeline", lambda *a, **k: Forest())
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with pytest.raises(Seen) as seen:
            q_eval.rf_scores(spark, SF_SMALL)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "BroadcastHashJoin" in str(seen.value) and "SortMergeJoin" not in str(seen.value)


def test_models_read_their_own_columns_only(spark):
    from conftest import SF_SMALL
    from plover.plans import q_eval

    d = q_eval._model_data(spark, SF_SMALL)
    assert set(d.columns) == {"side", "net", *q_eval.flows.KEYS, *q_eval.SPEC.inputs, q_eval.SPEC.response}


@pytest.mark.parametrize("name", ["standardize", "uncorrelated_values"])
def test_results_do_not_join_again(spark, name):
    from conftest import SF_SMALL
    from plover.plans.catalog import queries

    out = queries()[name](spark, SF_SMALL)
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString() and out.count() > 0


@pytest.mark.parametrize("name", ["lr_rolling", "cv_max_iter", "lr_training_summary", "loan_auc", "loan_roc_stacked",
                                  "loan_money_by_cell"])
def test_model_queries(spark, name):
    from conftest import SF_SMALL
    from plover.plans.catalog import queries

    rows = queries()[name](spark, SF_SMALL).collect()
    if name == "lr_rolling":
        assert rows and all(0 <= r.p1 <= 1 for r in rows) and {r.prediction for r in rows} <= {0.0, 1.0}
    elif name == "cv_max_iter":
        assert [r.maxIter for r in rows] == [0, 1, 5] and all(0 <= r.avg_auc <= 1 for r in rows)
    elif name == "lr_training_summary":
        assert len(rows) == 1 and 0 <= rows[0]["F-Measure"] <= 1
    elif name == "loan_auc":
        assert {(r.model, r.side) for r in rows} == {(m, s) for m in ("glm", "gbt") for s in ("train", "valid")}
        assert all(r.auc is None or 0 <= r.auc <= 1 for r in rows)
    elif name == "loan_roc_stacked":
        assert len({r.model for r in rows}) == 4 and all(sum(x.model == m for x in rows) <= 102 for m in {r.model for r in rows})
    else:
        assert all((r.label, r.prediction) in E.CELL_MEANING and r.meaning for r in rows)
