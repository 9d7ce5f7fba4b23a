"""Evaluation, feature and model queries."""

from __future__ import annotations

from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from plover.operators import clean as C
from plover.operators import evaluate as E
from plover.operators import features as FT
from plover.operators import levels as LV
from plover.operators import models as M
from plover.plans import flows
from plover.plans import standins as S
from plover.plans.q_features import assembled
from plover.plans.registry import query, rounded, with_ctes
from plover.session import stored, written
from plover.sources.tables import scan

SC = S.scores_sql()
MUNGED = flows.loans_munged_sql()
R = 9
SPEC = flows.FeatureSpec()
TRAIN_CUTOFF = 1998.0
TIED_THRESHOLD = 0.5


# ------------------------------------------------------------------ SQL building blocks
def _counts_sql(score: str, src: str = "scores") -> str:
    return (f"SELECT {score} AS threshold, sum(CASE WHEN label > 0.5 THEN 1 ELSE 0 END) AS pos, "
            f"sum(CASE WHEN label > 0.5 THEN 0 ELSE 1 END) AS neg FROM {src} "
            f"WHERE {score} IS NOT NULL AND NOT isnan({score}) AND label IS NOT NULL GROUP BY 1")


def _cum_sql(counts: str) -> str:
    return ("SELECT *, sum(pos) OVER (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING) AS tp, "
            "sum(neg) OVER (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING) AS fp, "
            f"sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM ({counts}) c")


def _roc_sql(score: str, src: str = "scores", model: str | None = None) -> str:
    tag = f"'{model}' AS model, " if model else ""
    return (f"SELECT {tag}round(threshold, {R}) AS threshold, round(fp / N, {R}) AS fpr, round(tp / P, {R}) AS tpr "
            f"FROM ({_cum_sql(_counts_sql(score, src))}) k "
            f"UNION ALL SELECT {tag}NULL, 0.0, 0.0 UNION ALL SELECT {tag}NULL, 1.0, 1.0")


def _f1_sql(score: str) -> str:
    return (f"SELECT threshold, tp / (tp + fp) AS precision, CASE WHEN P > 0 THEN tp / P ELSE 0.0 END AS recall "
            f"FROM ({_cum_sql(_counts_sql(score))}) k")


def _f1_full_sql(score: str) -> str:
    return (f"SELECT threshold, precision, recall, CASE WHEN precision + recall > 0 "
            f"THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f_measure FROM ({_f1_sql(score)}) p")


# ------------------------------------------------------------------ H15, H20, H21, G1/C17/H22
@query("roc_curve", with_ctes(_roc_sql("score"), scores=SC))
def roc_curve(spark, sf):
    """Exact ROC of a near-distinct score."""
    return rounded(E.roc_curve(S.scores(spark, sf), "score", "label"), R)


@query("roc_curve_tied", with_ctes(_roc_sql("score_tied"), scores=SC))
def roc_curve_tied(spark, sf):
    """H21 with heavy ties (11 distinct scores)."""
    return rounded(E.roc_curve(S.scores(spark, sf), "score_tied", "label"), R)


@query("roc_thinned", with_ctes(
    "SELECT round(threshold, 9) AS threshold, round(fp / N, 9) AS fpr, round(tp / P, 9) AS tpr FROM ("
    "SELECT *, count(*) OVER () AS K, row_number() OVER (ORDER BY threshold DESC) AS pos_i FROM ("
    + _cum_sql(_counts_sql("score")) + ") k) z WHERE pos_i % CAST(ceil(K / 100.0) AS BIGINT) = 0 OR pos_i = K "
    "UNION ALL SELECT NULL, 0.0, 0.0 UNION ALL SELECT NULL, 1.0, 1.0", scores=SC))
def roc_thinned(spark, sf):
    """The curve kept at every k-th distinct threshold (<= 100 points + ends), as ``numBins=100`` asks."""
    return rounded(E.roc_thinned(S.scores(spark, sf), "score", "label", 100), R)


def _auc_sql(score: str) -> str:
    return (f"SELECT '{score}' AS score_column, round(CASE WHEN max(P) > 0 AND max(N) > 0 THEN "
            f"sum(neg * (2 * (tp - pos) + pos)) / (2.0 * max(P) * max(N)) END, {R}) AS auc, "
            f"CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg "
            f"FROM ({_cum_sql(_counts_sql(score))}) k")


@query("auc_exact", with_ctes(f"{_auc_sql('score')} UNION ALL {_auc_sql('score_tied')}", scores=SC))
def auc_exact(spark, sf):
    """Exact AUC (ties count one half) for both score columns."""
    s = S.scores(spark, sf)
    a = E.auc_exact(s, "score", "label").select(F.lit("score").alias("score_column"), "*")
    b = E.auc_exact(s, "score_tied", "label").select(F.lit("score_tied").alias("score_column"), "*")
    return rounded(a.unionByName(b), R)


_SPLIT_H = C.key_hash_sql(["l_orderkey", "l_linenumber"])


@query("roc_stacked", with_ctes(
    " UNION ALL ".join(_roc_sql(sc, src, f"{sc}_{side}") for sc in ("score", "score_tied")
                       for side, src in (("train", "train"), ("valid", "valid"))),
    scores=SC, train=f"SELECT * FROM scores WHERE {_SPLIT_H} < 800",
    valid=f"SELECT * FROM scores WHERE {_SPLIT_H} >= 800"))
def roc_stacked(spark, sf):
    """ROC per (model, split) tagged with a literal and stacked by name."""
    s = C.hash_split(S.scores(spark, sf), ["l_orderkey", "l_linenumber"], [0.8, 0.2])
    out = None
    for sc in ("score", "score_tied"):
        for side, idx in (("train", 0), ("valid", 1)):
            r = E.roc_curve(s.filter(F.col("split") == idx), sc, "label").select(
                F.lit(f"{sc}_{side}").alias("model"), "threshold", "fpr", "tpr")
            out = r if out is None else out.unionByName(r)
    return rounded(out, R)


# ------------------------------------------------------------------ H16-H18, J7, D12/H24
@query("f1_by_threshold", with_ctes(
    f"SELECT round(threshold, {R}) AS threshold, round(precision, {R}) AS precision, round(recall, {R}) AS recall, "
    f"round(f_measure, {R}) AS f_measure FROM ({_f1_full_sql('score_tied')}) f", scores=SC))
def f1_by_threshold(spark, sf):
    return rounded(E.f1_by_threshold(S.scores(spark, sf), "score_tied", "label"), R)


@query("best_f1_threshold", with_ctes(
    f"SELECT round(threshold, {R}) AS threshold, round(precision, {R}) AS precision, round(recall, {R}) AS recall, round(f_measure, {R}) "
    f"AS f_measure FROM ({_f1_full_sql('score')}) f ORDER BY f_measure DESC, threshold ASC LIMIT 1", scores=SC))
def best_f1_threshold(spark, sf):
    """Highest F1 over all distinct thresholds; ties -> smallest threshold."""
    return rounded(E.best_f1_threshold(S.scores(spark, sf), "score", "label"), R)


@query("apply_threshold", with_ctes(
    "SELECT label, CASE WHEN NOT isnan(score_tied) AND score_tied >= (SELECT threshold FROM best) THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS prediction, "
    "count(*) AS n FROM scores GROUP BY 1, 2", scores=SC,
    best=f"SELECT threshold FROM ({_f1_full_sql('score_tied')}) f ORDER BY f_measure DESC, threshold ASC LIMIT 1"))
def apply_threshold(spark, sf):
    """Predictions at the best-F1 threshold (one scalar reaches the driver)."""
    s = S.scores(spark, sf)
    t = E.best_f1_threshold(s, "score_tied", "label").first()["threshold"]
    p = E.apply_threshold(s, "score_tied", t)
    return p.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))


@query("precision_recall", with_ctes(
    f"SELECT tp, fp, fn, tn, round(tp / (tp + fp), {R}) AS precision, round(tp / (tp + fn), {R}) AS recall, "
    f"round(2 * (tp / (tp + fp)) * (tp / (tp + fn)) / ((tp / (tp + fp)) + (tp / (tp + fn))), {R}) AS f1, "
    f"round((tp + tn) / (tp + fp + fn + tn), {R}) AS accuracy FROM ("
    f"SELECT count_if(score_tied >= {TIED_THRESHOLD} AND label > 0.5) AS tp, "
    f"count_if(score_tied >= {TIED_THRESHOLD} AND NOT label > 0.5) AS fp, "
    f"count_if(NOT score_tied >= {TIED_THRESHOLD} AND label > 0.5) AS fn, "
    f"count_if(NOT score_tied >= {TIED_THRESHOLD} AND NOT label > 0.5) AS tn FROM scores WHERE NOT isnan(score_tied)) c", scores=SC))
def precision_recall(spark, sf):
    """Confusion counts and rates at one threshold."""
    return rounded(E.precision_recall(S.scores(spark, sf), "score_tied", "label", TIED_THRESHOLD), R)


@query("confusion_value", with_ctes(
    "SELECT label, prediction, round(sum(net), 2) AS sum_net, count(*) AS n, CASE "
    "WHEN label = 1.0 AND prediction = 1.0 THEN 'loss avoided' WHEN label = 1.0 AND prediction = 0.0 THEN 'loss incurred' "
    "WHEN label = 0.0 AND prediction = 1.0 THEN 'profit forfeited' ELSE 'profit kept' END AS meaning "
    f"FROM (SELECT *, CASE WHEN NOT isnan(score_tied) AND score_tied >= {TIED_THRESHOLD} THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS prediction FROM scores) s "
    "GROUP BY 1, 2", scores=SC))
def confusion_value(spark, sf):
    """Money by confusion cell with its business meaning."""
    p = E.apply_threshold(S.scores(spark, sf), "score_tied", TIED_THRESHOLD)
    return rounded(E.confusion_value(p), 2)


# ------------------------------------------------------------------ H1-H4, H7 on the loan table
def _train(spark, sf):
    return flows.loans_munged(spark, sf).filter(F.col("issue_year") <= TRAIN_CUTOFF)


_TRAIN_SQL = f"SELECT * FROM m WHERE issue_year <= {TRAIN_CUTOFF}"


def _index_sql(col: str, out: str) -> str:
    return with_ctes(
        f"SELECT a.{col}, coalesce(l.{out}, CAST((SELECT count(*) FROM levels) AS DOUBLE)) AS {out}, count(*) AS n "
        f"FROM m a LEFT JOIN levels l ON a.{col} = l.{col} GROUP BY 1, 2",
        m=MUNGED, train=_TRAIN_SQL,
        levels=f"SELECT {col}, CAST(row_number() OVER (ORDER BY count(*) DESC, {col}) - 1 AS DOUBLE) AS {out} "
               f"FROM train WHERE {col} IS NOT NULL GROUP BY {col}")


@query("string_index", _index_sql("purpose", "purpose_idx"))
def string_index(spark, sf):
    """H1: StringIndexer(handleInvalid='keep') fitted on train, applied to all loans."""
    model = StringIndexer(inputCol="purpose", outputCol="purpose_idx", handleInvalid="keep").fit(_train(spark, sf))
    out = model.transform(flows.loans_munged(spark, sf))
    return out.groupBy("purpose", "purpose_idx").agg(F.count(F.lit(1)).alias("n"))


@query("string_index_table", with_ctes(
    "SELECT purpose, count(*) AS n, CAST(row_number() OVER (ORDER BY count(*) DESC, purpose) - 1 AS DOUBLE) AS idx "
    "FROM train WHERE purpose IS NOT NULL GROUP BY purpose", m=MUNGED, train=_TRAIN_SQL))
def string_index_table(spark, sf):
    """H1 as a DataFrame (the indexer's label order)."""
    return FT.string_index_table(_train(spark, sf), "purpose")


@query("label_index", _index_sql("bad_loan", "label"))
def label_index(spark, sf):
    """H2: label indexer on the response (0 = most frequent; an unseen label is an error, as in the fits)."""
    model = StringIndexer(inputCol="bad_loan", outputCol="label", handleInvalid="error").fit(_train(spark, sf))
    return model.transform(flows.loans_munged(spark, sf)).groupBy("bad_loan", "label").agg(F.count(F.lit(1)).alias("n"))


@query("one_hot_long", with_ctes(
    "SELECT a.addr_state, CAST(coalesce(l.idx, -1) AS INTEGER) AS slot, CAST((SELECT count(*) FROM levels) AS INTEGER) "
    "AS vector_size, count(*) AS n FROM m a LEFT JOIN levels l ON a.addr_state = l.addr_state GROUP BY 1, 2",
    m=MUNGED, train=_TRAIN_SQL,
    levels="SELECT addr_state, row_number() OVER (ORDER BY count(*) DESC, addr_state) - 1 AS idx "
           "FROM train WHERE addr_state IS NOT NULL GROUP BY addr_state"))
def one_hot_long(spark, sf):
    """H3: one-hot after a keep-indexer: each known level its slot, unseen -> all zero (slot -1)."""
    train = _train(spark, sf)
    idx = StringIndexer(inputCol="addr_state", outputCol="addr_state_idx", handleInvalid="keep").fit(train)
    enc = OneHotEncoder(inputCols=["addr_state_idx"], outputCols=["addr_state_class"]).fit(idx.transform(train))
    out = enc.transform(idx.transform(flows.loans_munged(spark, sf)))
    arr = vector_to_array("addr_state_class")
    return out.select("addr_state", (F.array_position(arr, 1.0) - 1).cast("int").alias("slot"),
                      F.size(arr).alias("vector_size")).groupBy("addr_state", "slot", "vector_size").agg(
        F.count(F.lit(1)).alias("n"))


_MANY = ["l_partkey", "l_suppkey"]
_LEVELS_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS column, CAST({c} AS VARCHAR) AS level, row_number() OVER (ORDER BY count(*) DESC, CAST({c} AS VARCHAR)) - 1 "
    f"AS idx, count(*) AS n FROM lineitem WHERE l_linenumber <= 4 AND {c} IS NOT NULL GROUP BY {c}" for c in _MANY)


def _many_levels(spark, sf):
    li = scan(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", *_MANY])
    return li, LV.level_table(li.filter("l_linenumber <= 4"), _MANY)


@query("level_ranks", _LEVELS_SQL)
def level_ranks(spark, sf):
    """H1 for columns of very many levels: the index as a table of distributed ranks."""
    return _many_levels(spark, sf)[1]


@query("one_hot_sparse", with_ctes(" UNION ALL ".join(
    f"SELECT l_orderkey, l_linenumber, '{c}' AS column, idx AS slot FROM lineitem JOIN levels v ON v.column = '{c}' "
    f"AND v.level = CAST({c} AS VARCHAR)" for c in _MANY), levels=_LEVELS_SQL))
def one_hot_sparse(spark, sf):
    """H3 for columns of very many levels: a row per set slot; levels that the fit had not seen have none."""
    li, levels = _many_levels(spark, sf)
    return LV.one_hot_sparse(li, ["l_orderkey", "l_linenumber"], _MANY, levels)


_IMPUTE_COLS = ["annual_inc", "dti", "emp_length", "revol_util", "delinq_2yrs"]
R_MEAN = 6  # means of values up to ~1e6: 9 decimals would exceed double precision (sum-order noise)


@query("impute_mean", with_ctes(" UNION ALL ".join(
    f"SELECT '{c}' AS column, round(avg(CAST({c} AS DOUBLE)), {R_MEAN}) AS fill_value, "
    f"count_if({c} IS NULL OR isnan(CAST({c} AS DOUBLE))) AS n_filled FROM train" for c in _IMPUTE_COLS),
    m=MUNGED, train=_TRAIN_SQL))
def impute_mean(spark, sf):
    """H4: Imputer(strategy='mean') fitted on train (ints cast to double first)."""
    train = FT.as_double(_train(spark, sf), _IMPUTE_COLS)
    model = FT.mean_imputer(_IMPUTE_COLS).fit(train)
    fills = model.surrogateDF.unpivot([], _IMPUTE_COLS, "column", "fill_value")
    miss = train.agg(*[F.count_if(F.col(c).isNull() | F.isnan(c)).alias(c) for c in _IMPUTE_COLS]).unpivot(
        [], _IMPUTE_COLS, "column", "n_filled")
    return rounded(fills.join(miss, "column"), R_MEAN)


_Z_COLS = ["annual_inc", "dti", "loan_amnt"]


@query("standardize", with_ctes(
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, " + ", ".join(
        f"round((x{i} - (SELECT avg(x{i}) FROM f)) / (SELECT stddev_samp(x{i}) FROM f), {R}) + 0.0 AS z{i}"
        for i in range(len(_Z_COLS))) + " FROM f",
    m=MUNGED, train=_TRAIN_SQL,
    f="SELECT *, " + ", ".join(
        f"coalesce(CAST({c} AS DOUBLE), (SELECT avg(CAST({c} AS DOUBLE)) FROM train)) AS x{i}"
        for i, c in enumerate(_Z_COLS)) + " FROM train"))
def standardize(spark, sf):
    """H7: impute -> assemble -> StandardScaler(withMean, withStd) on the training loans.

    The loans' columns are written first: both fits and the result read them, and the join runs once.
    """
    train = stored(FT.as_double(_train(spark, sf), _Z_COLS).select(*flows.KEYS, *_Z_COLS), "training")
    imp = FT.mean_imputer(_Z_COLS).fit(train).transform(train)
    vec = VectorAssembler(inputCols=_Z_COLS, outputCol="features").transform(imp)
    sc = FT.scaler("features", "scaledFeatures").fit(vec).transform(vec)
    arr = vector_to_array("scaledFeatures")
    return rounded(sc.select(*flows.KEYS, *[arr[i].alias(f"z{i}") for i in range(len(_Z_COLS))]), R)


# ------------------------------------------------------------------ H14 folds, J9 weights (oracles)
@query("fold_assignment", with_ctes(
    f"SELECT CAST(({C.key_hash_sql(flows.KEYS)} % 5) AS INTEGER) AS fold, count(*) AS n FROM train GROUP BY 1",
    m=MUNGED, train=_TRAIN_SQL))
def fold_assignment(spark, sf):
    """The key-hash fold column CrossValidator uses (foldCol)."""
    return M.with_folds(_train(spark, sf), flows.KEYS).groupBy("fold").agg(F.count(F.lit(1)).alias("n"))


@query("class_weights", with_ctes(
    f"SELECT bad_loan, count(*) AS n, round((SELECT count(*) FROM train) / ((SELECT count(DISTINCT bad_loan) FROM train) "
    f"* count(*)), {R}) AS weight FROM train GROUP BY 1", m=MUNGED, train=_TRAIN_SQL))
def class_weights(spark, sf):
    """Inverse-frequency class weights."""
    return rounded(M.class_weights(_train(spark, sf), "bad_loan"), R)


# ------------------------------------------------------------------ H9-H14, J8 (rows-only: model outputs)
def _model_data(spark, sf):
    """The loans that models see, both sides, told apart by ``side``."""
    d = M.prepare(flows.loans_munged(spark, sf), SPEC.numerics)
    d = d.withColumn("side", C.temporal_side("issue_year", TRAIN_CUTOFF)).filter("side <> 'neither'")
    return d.select("side", *flows.KEYS, "net", *SPEC.inputs, SPEC.response)  # no other text is parsed or written


def _train_data(spark, sf):
    return _model_data(spark, sf).filter("side = 'train'")


def _score_table(model, data, name=None):
    """Both sides scored in one pass, tagged with the side (and the model's name)."""
    tags = [F.lit(name).alias("model")] if name else []
    out = M.score(model, data, keep=["side", *flows.KEYS, "net"])
    return out.select(*tags, *out.columns)


def _fit_and_score(spark, sf, fit):
    """The prepared loans written once: fitted on one side, both sides scored in one pass."""
    with written(_model_data(spark, sf), "loans") as data:
        return stored(_score_table(fit(data.filter("side = 'train'")), data), "scores")


@query("lr_scores")
def lr_scores(spark, sf):
    """GLM pipeline fitted on train, both sides scored (net, p0, p1, label, prediction)."""
    pipe, _ = M.glm_pipeline(SPEC.categoricals, SPEC.numerics, SPEC.response)
    return _fit_and_score(spark, sf, pipe.fit)


@query("gbt_scores")
def gbt_scores(spark, sf):
    """Gradient-boosted trees (20 trees, depth 5, 52 bins)."""
    return _fit_and_score(spark, sf, M.gbt_pipeline(SPEC.categoricals, SPEC.numerics, SPEC.response).fit)


@query("rf_scores")
def rf_scores(spark, sf):
    """J8 (+J9): random forest with inverse-frequency class weights."""
    pipe = M.rf_pipeline(SPEC.categoricals, SPEC.numerics, SPEC.response, weight_col="class_weight")

    def fit(train):
        w = M.class_weights(train, "bad_loan", "class_weight").select("bad_loan", "class_weight")
        return pipe.fit(train.join(F.broadcast(w), "bad_loan"))  # a row per class: a shuffle by class would be one task each

    return _fit_and_score(spark, sf, fit)


REG_PARAMS = [0.1, 0.01]


def _tuned(train):
    """5-fold CV over regParam on key-hash folds: the pipeline, its grid and the mean AUC of each setting."""
    pipe, lr = M.glm_pipeline(SPEC.categoricals, SPEC.numerics, SPEC.response)
    grid = [{lr.regParam: x} for x in REG_PARAMS]
    return pipe, grid, M.cross_validate(pipe, train, flows.KEYS, grid)


@query("cv_metrics")
def cv_metrics(spark, sf):
    """Mean AUC per setting of the grid."""
    _, _, auc = _tuned(_train_data(spark, sf))
    return spark.createDataFrame([(x, float(a)) for x, a in zip(REG_PARAMS, auc, strict=True)], "regParam double, avg_auc double")


@query("lr_training_summary")
def lr_training_summary(spark, sf):
    """H15-H17 the reference's way: the fitted model's training summary (ROC, F-measure) and best F1."""
    pipe, _ = M.glm_pipeline(SPEC.categoricals, SPEC.numerics, SPEC.response)
    with written(_train_data(spark, sf), "training") as data:  # the summary reads the training rows again
        f = pipe.fit(data).stages[-1].summary.fMeasureByThreshold
        best = f.orderBy(F.col("F-Measure").desc(), F.col("threshold").asc()).limit(1).collect()
    return spark.createDataFrame(best, f.schema)


# ------------------------------------------------------------------ the loan flow end to end
def _loan_flow(spark, sf):
    """Tuned GLM (best of the grid) and GBT, each scoring train and valid: one table, made from the tables as they are now."""
    with written(_model_data(spark, sf), "loans") as data:
        train = data.filter("side = 'train'")
        pipe, grid, auc = _tuned(train)
        glm = pipe.fit(train, M.best_setting(grid, auc))
        gbt = M.gbt_pipeline(SPEC.categoricals, SPEC.numerics, SPEC.response).fit(train)
        return stored(_score_table(glm, data, "glm").unionByName(_score_table(gbt, data, "gbt")), "loan-scores")


_SIDES_SQL = ("SELECT g.model, CASE WHEN issue_year <= {c} THEN 'train' ELSE 'valid' END AS side, count(*) AS n, "
              "count(*) AS n_sum_to_one, round(sum(net), 2) AS sum_net FROM m, (VALUES ('glm'), ('gbt')) AS g(model) "
              "WHERE issue_year IS NOT NULL GROUP BY 1, 2").format(c=TRAIN_CUTOFF)


@query("loan_scored_sides", with_ctes(_SIDES_SQL, m=MUNGED))
def loan_scored_sides(spark, sf):
    """The four score tables: rows, probabilities that sum to one, and money, per model and side."""
    unit = F.abs(F.col("p0") + F.col("p1") - 1) < 1e-9
    return rounded(_loan_flow(spark, sf).groupBy("model", "side").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(unit).alias("n_sum_to_one"), F.sum("net").alias("sum_net")), 2)


@query("loan_auc")
def loan_auc(spark, sf):
    """Exact AUC of each of the four score tables."""
    s, out = _loan_flow(spark, sf), None
    for model in ("glm", "gbt"):
        for side in ("train", "valid"):
            own = s.filter((F.col("model") == model) & (F.col("side") == side))
            a = E.auc_exact(own, "p1", "label").select(F.lit(model).alias("model"), F.lit(side).alias("side"), "*")
            out = a if out is None else out.unionByName(a)
    return out


@query("loan_roc_stacked")
def loan_roc_stacked(spark, sf):
    """The four ROC curves thinned to 100 points, tagged and stacked."""
    s, out = _loan_flow(spark, sf), None
    for model in ("glm", "gbt"):
        for side in ("train", "valid"):
            own = s.filter((F.col("model") == model) & (F.col("side") == side))
            r = E.roc_thinned(own, "p1", "label", 100).select(F.lit(f"{model}_{side}").alias("model"), "*")
            out = r if out is None else out.unionByName(r)
    return out


@query("loan_money_by_cell")
def loan_money_by_cell(spark, sf):
    """Money by (label, prediction) cell of the scored validation rows, per model."""
    s, out = _loan_flow(spark, sf).filter("side = 'valid'"), None
    for model in ("glm", "gbt"):
        c = E.confusion_value(s.filter(F.col("model") == model)).select(F.lit(model).alias("model"), "*")
        out = c if out is None else out.unionByName(c)
    return out


@query("cv_max_iter")
def cv_max_iter(spark, sf):
    """Grid over maxIter [0, 1, 5] for the rolling-feature logistic regression, 5 key-hash folds."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    a = assembled(spark, sf).filter(F.col("DEP_DEL15").isNotNull())
    lr = LogisticRegression(featuresCol="features_scaled", labelCol="DEP_DEL15")
    pipe = Pipeline(stages=[FT.scaler("features", "features_scaled", with_mean=False), lr])
    settings = [0, 1, 5]
    auc = M.cross_validate(pipe, a, ["event_id"], [{lr.maxIter: x} for x in settings],
                           evaluator=BinaryClassificationEvaluator(labelCol="DEP_DEL15"))
    return spark.createDataFrame([(x, float(m)) for x, m in zip(settings, auc, strict=True)], "maxIter int, avg_auc double")


@query("lr_rolling")
def lr_rolling(spark, sf):
    """Logistic regression (defaults) on scaled rolling weather features, label DEP_DEL15."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression

    a = assembled(spark, sf).filter(F.col("DEP_DEL15").isNotNull())
    pipe = Pipeline(stages=[FT.scaler("features", "features_scaled", with_mean=False),
                            LogisticRegression(featuresCol="features_scaled", labelCol="DEP_DEL15")])
    p = vector_to_array("probability")
    return M.fit(pipe, a).transform(a).select("event_id", "DEP_DEL15", p[1].alias("p1"), "prediction")
