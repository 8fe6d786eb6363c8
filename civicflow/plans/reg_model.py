"""Registered model operators.

SQL-checked: the encoded feature matrix with its split (M1-M6), scaler
statistics (M11), a one-feature least-squares fit with its metrics and fold
errors (M8, M9, M12), split sizes, and what is determined about the forest's
importances and scores (M10, M13, M15).  The forest's own numbers (M7, M9,
M14) and the 13-feature baseline get the row-count check.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .. import schema as S
from ..session import shared_path
from . import bundle as B
from . import forest as N
from . import model as M
from . import oracle_sql as O
from .registry import CK, R, cont, ev_clean, register, round_doubles, sql_round

Q = O.q


def _model_frame(s, d):
    """Model rows with engineered features, split flag and codes."""
    data = M.prepare(ev_clean(s, d))
    train = data.filter(~F.col("is_test"))
    return M.encode(train).transform(data), train


_CODE_COLS = [f"{c}_code" for c in S.CATEGORICAL_FEATURES]
_NUM = ["created_hour", "created_month", "quarter"]
_FLAG = [f"{c}_num" for c in S.BOOLEAN_FEATURES]
_MATRIX = ["unique_key", R, "is_test", "fold"] + _CODE_COLS + _NUM + _FLAG


def _txt(c: str) -> str:
    return f"COALESCE(CAST({c} AS VARCHAR), 'nan')"


_FEATURE_SQL = f""", m0 AS (
  SELECT *,
         {_txt('borough')} || '_' || {_txt('complaint_category')} AS borough_category,
         created_hour IN ({', '.join(map(str, S.PEAK_HOURS))}) AS is_peak_hour,
         created_month IN ({', '.join(map(str, S.YEAR_END_MONTHS))}) AS is_year_end,
         ('0x' || substr(md5('42:' || CAST(unique_key AS VARCHAR)), 1, 8))::BIGINT >= 3435973837
           AS is_test,
         CAST(('0x' || substr(md5('42:' || CAST(unique_key AS VARCHAR)), 9, 8))::BIGINT % 5 AS INTEGER)
           AS fold
  FROM clean WHERE {CK} AND {R} > 0 AND {R} <= 90.0::DOUBLE
),
m1 AS (
  SELECT *, {', '.join(f"{_txt(c)} AS {c}_txt" for c in S.CATEGORICAL_FEATURES)},
         {', '.join(f"CAST({c} AS INTEGER) AS {c}_num" for c in S.BOOLEAN_FEATURES)}
  FROM m0
),
""" + ",\n".join(
    f"codes_{c} AS (SELECT v, CAST(dense_rank() OVER (ORDER BY v) - 1 AS DOUBLE) AS code "
    f"FROM (SELECT DISTINCT {c}_txt AS v FROM m1 WHERE NOT is_test))"
    for c in S.CATEGORICAL_FEATURES) + """,
mx AS (
  SELECT m1.*, """ + ", ".join(
    f"COALESCE(codes_{c}.code, 0.0::DOUBLE) AS {c}_code" for c in S.CATEGORICAL_FEATURES) + """
  FROM m1 """ + " ".join(
    f"LEFT JOIN codes_{c} ON codes_{c}.v = m1.{c}_txt" for c in S.CATEGORICAL_FEATURES) + """
)"""

register("M1_M6_feature_matrix_ev", cont(O.with_ev_clean(
    _FEATURE_SQL + f"\nSELECT {', '.join(_MATRIX)} FROM mx")))(
    lambda s, d: _model_frame(s, d)[0].select(*_MATRIX))

_LABEL_SQL = cont(O.with_ev_clean(_FEATURE_SQL + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, v AS value, CAST(code AS BIGINT) AS code FROM codes_{c}"
    for c in S.CATEGORICAL_FEATURES)))
register("M4_label_codes_ev", _LABEL_SQL)(
    lambda s, d: M.label_codes(M.prepare(ev_clean(s, d)).filter(~F.col("is_test")))
    .withColumn("code", F.col("code").cast("long")))

# Scaler mean / sample std per feature on training rows.
_FEATURE_EXPR = {c: (f"{c}_code" if c in S.CATEGORICAL_FEATURES
                     else f"{c}_num" if c in S.BOOLEAN_FEATURES else c) for c in M.FEATURES}
register("M11_scaler_stats_ev", cont(O.with_ev_clean(_FEATURE_SQL + "\n" + sql_round(
    "\nUNION ALL\n".join(
        f"SELECT '{f}' AS feature, AVG(CAST({e} AS DOUBLE)) AS mean, "
        f"STDDEV_SAMP(CAST({e} AS DOUBLE)) AS std FROM mx WHERE NOT is_test"
        for f, e in _FEATURE_EXPR.items()), ["mean", "std"]))))(
    lambda s, d: round_doubles(M.scaler_stats(
        (lambda fr: fr[0].filter(~F.col("is_test")))(_model_frame(s, d)))))


# M8 + M12: one-feature OLS on training rows, metrics on test rows.
def _line(s, d):
    data = M.prepare(ev_clean(s, d))
    train, test = data.filter(~F.col("is_test")), data.filter(F.col("is_test"))
    model = M.fit_line(train, "created_hour")
    lr = model.stages[-1]
    met = M.metrics(model.transform(test))
    return round_doubles(met.select(
        F.lit(float(lr.intercept)).alias("intercept"),
        F.lit(float(lr.coefficients[0])).alias("slope"), "mae", "rmse", "r2", "n"))


register("M8_M12_line_fit_metrics_ev", cont(O.with_ev_clean(_FEATURE_SQL + f""",
fit AS (
  SELECT regr_intercept({R}, created_hour) AS a, regr_slope({R}, created_hour) AS b
  FROM mx WHERE NOT is_test
),
pred AS (SELECT {R} AS y, a + b * created_hour AS p FROM mx, fit WHERE is_test)
""" + sql_round(
    "SELECT (SELECT a FROM fit) AS intercept, (SELECT b FROM fit) AS slope, "
    "AVG(abs(y - p)) AS mae, sqrt(AVG((y - p) * (y - p))) AS rmse, "
    "1.0::DOUBLE - AVG((y - p) * (y - p)) / VAR_POP(y) AS r2, COUNT(*) AS n FROM pred",
    ["intercept", "slope", "mae", "rmse", "r2"]))))(_line)

# M1 on a view without the four derived base columns: every default rule runs.
_BASE_RULES = ["quarter", "is_weekend", "is_priority", "created_period"]
register("M1_default_rules_ev", O.with_ev_clean(
    f"SELECT unique_key, {', '.join(_BASE_RULES)} FROM clean"))(
    lambda s, d: M.supply_missing_features(ev_clean(s, d).drop(*_BASE_RULES)).select("unique_key", *_BASE_RULES))

# M6: rows of both parts.
register("M6_split_sizes_ev", cont(O.with_ev_clean(
    _FEATURE_SQL + "\nSELECT is_test, COUNT(*) AS n FROM m0 GROUP BY is_test")))(
    lambda s, d: M.prepare(ev_clean(s, d)).groupBy("is_test").agg(F.count(F.lit(1)).alias("n")))


# M9 with one feature: mean absolute error of five folds of a fitted line.
def _line_folds(s, d):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    train = M.prepare(ev_clean(s, d)).filter(~F.col("is_test"))
    # The view is worked out once; every pass of the five fits reads three kept numbers a row.
    parts = s.sparkContext.defaultParallelism
    kept = train.select("unique_key", "created_hour", R, "fold").repartition(parts, "unique_key").cache()
    try:
        rows = VectorAssembler(inputCols=["created_hour"], outputCol="features").transform(kept).select("features", R, "fold")
        mae = M.cross_validated_mae(rows, LinearRegression(featuresCol="features", labelCol=M.LABEL, regParam=0.0, solver="normal"))
        n = kept.count()
    finally:
        kept.unpersist()
    return round_doubles(s.createDataFrame([(M.FOLDS, mae, n)], "folds int, cv_mae double, train_rows long"))


register("M9_cv_mae_line_ev", cont(O.with_ev_clean(_FEATURE_SQL + f""",
tr AS (SELECT fold, created_hour AS x, {R} AS y FROM m0 WHERE NOT is_test),
fit AS (SELECT f.fold, regr_intercept(y, x) AS a, regr_slope(y, x) AS b
        FROM (SELECT DISTINCT fold FROM tr) AS f JOIN tr ON tr.fold <> f.fold GROUP BY f.fold),
err AS (SELECT tr.fold, AVG(abs(y - a - b * x)) AS e FROM tr JOIN fit ON tr.fold = fit.fold GROUP BY tr.fold)
""" + sql_round("SELECT CAST(5 AS INTEGER) AS folds, AVG(e) AS cv_mae, (SELECT COUNT(*) FROM tr) AS train_rows FROM err",
                ["cv_mae"]))))(_line_folds)


# The 13-feature scaled baseline with both parts' metrics.
register("M12_linear_baseline_ev")(lambda s, d: M.model_report(M.train_linear_regression(ev_clean(s, d))))

# Each query fits the forest on the tables as they are then; only M9 and M14 need the folds' fits.
def _forest(s, d, cv_folds=0):
    return M.train_random_forest(ev_clean(s, d), cv_folds=cv_folds)


def _saved_forest(s, d):
    """(path of the saved model, its result)."""
    result = _forest(s, d)
    return M.save_model(result, f"{shared_path(s, 'forest')}-{uuid.uuid4().hex}"), result


def _scored(s, d):
    """The forest saved, loaded again and applied to every clean ticket."""
    return M.score(M.load_model(s, _saved_forest(s, d)[0]), ev_clean(s, d))


register("M7_M14_forest_report_ev")(lambda s, d: M.model_report(_forest(s, d, M.FOLDS)))


def _forest_cv(s, d):
    result = _forest(s, d, M.FOLDS)
    return s.createDataFrame([("Random Forest", M.FOLDS, result.cv_mae, result.train_size)],
                             "model string, folds int, cv_mae double, train_rows long")


register("M9_cv_mae_forest_ev")(_forest_cv)
register("M10_top_features_ev")(lambda s, d: M.top_features(_forest(s, d).importance))
register("M13_batch_scoring_ev")(
    lambda s, d: _scored(s, d).select("unique_key", "predicted_days", "predicted_class", "off_hours"))

# The importances equal those worked out from the saved node table, one for each feature.
def _importances(s, d):
    path, result = _saved_forest(s, d)
    names = s.createDataFrame(list(enumerate(M.FEATURES)), "feature_no int, feature string")
    own = N.importances(_nodes(s, path)).withColumnRenamed("feature", "feature_no").withColumnRenamed("importance", "own")
    both = result.importance.join(names, "feature").join(own, "feature_no", "left")
    agrees = F.abs(F.col("importance") - F.coalesce(F.col("own"), F.lit(0.0))) < 1e-9
    return both.agg(
        F.count(F.lit(1)).alias("n_features"), F.round(F.sum("importance"), 6).alias("total"),
        F.count_if(F.col("importance") < 0).alias("n_negative"), F.count_if(agrees).alias("n_recomputed"),
        F.lit(result.train_size).cast("long").alias("train_rows"))


def _nodes(s, path):
    """The node table of a saved bundle's forest (its last stage)."""
    stage = len(B.read_manifest(s, path).stages) - 1
    return N.node_table(f"{path}/pipeline/stages/{stage}_*", s)


register("M10_importance_sums_ev", cont(O.with_ev_clean(
    _FEATURE_SQL + f"\nSELECT CAST({len(M.FEATURES)} AS BIGINT) AS n_features, 1.0::DOUBLE AS total, 0::BIGINT AS n_negative, "
    f"CAST({len(M.FEATURES)} AS BIGINT) AS n_recomputed, COUNT(*) FILTER (WHERE NOT is_test) AS train_rows FROM m0")))(_importances)


# M7: in the saved node table no node under the minimum split has children, leaves keep the leaf
# minimum, every tree's leaves hold its root's rows, and node numbers are places in preorder.
def _node_rules(s, d):
    path, result = _saved_forest(s, d)
    flat = _nodes(s, path).select("treeID", "nodeData.*")
    inner = F.col("leftChild") >= 0
    tree = flat.groupBy("treeID").agg(
        F.count_if(inner & (F.col("rawCount") < N.MIN_SPLIT)).alias("small"),
        F.count_if(~inner & (F.col("rawCount") < 2)).alias("thin"),
        (F.sum(F.when(~inner, F.col("rawCount"))) == F.max(F.when(F.col("id") == 0, F.col("rawCount")))).alias("whole"),
        ((F.max("id") + 1 == F.count(F.lit(1))) & F.bool_and(~inner | (F.col("leftChild") == F.col("id") + 1))).alias("numbered"))
    return tree.agg(
        F.count(F.lit(1)).alias("n_trees"), F.sum("small").alias("n_small_inner"), F.sum("thin").alias("n_thin_leaves"),
        F.bool_and("whole").alias("leaves_hold_all"), F.bool_and("numbered").alias("numbered"),
        F.lit(result.train_size).cast("long").alias("train_rows"))


register("M7_min_split_nodes_ev", cont(O.with_ev_clean(
    _FEATURE_SQL + "\nSELECT 100::BIGINT AS n_trees, 0::BIGINT AS n_small_inner, 0::BIGINT AS n_thin_leaves, true AS leaves_hold_all, "
    "true AS numbered, COUNT(*) FILTER (WHERE NOT is_test) AS train_rows FROM m0")))(_node_rules)


# IO9: the saved manifest's label maps are the label codes of the training rows.
def _label_maps(s, d):
    path, _ = _saved_forest(s, d)
    maps = B.read_manifest(s, path).label_maps
    return s.createDataFrame([(f, v, i) for f, labels in maps.items() for i, v in enumerate(labels)],
                             "feature string, value string, code long")


register("IO9_bundle_label_maps_ev", _LABEL_SQL)(_label_maps)

# M13 + P21-P23: scores of every ticket keep the floor, their class follows
# from the days, and the hour flag is the ticket's own.
def _rules(s, d):
    days = F.col("predicted_days")
    expected = F.when(days <= 1, "fast").when(days <= 7, "moderate").otherwise("slow")
    return _scored(s, d).agg(
        F.count(F.lit(1)).alias("n_scored"), F.count_if(days < 0.1).alias("n_below_floor"),
        F.count_if(F.col("predicted_class") != expected).alias("n_wrong_class"),
        F.count_if("off_hours").alias("n_off_hours"))


register("M13_scoring_rules_ev", O.with_ev_clean(
    "SELECT COUNT(*) AS n_scored, 0::BIGINT AS n_below_floor, 0::BIGINT AS n_wrong_class, "
    "COUNT(*) FILTER (WHERE created_hour < 6 OR created_hour > 22) AS n_off_hours FROM clean"))(_rules)


# M15 + IO9: train, save, load, score; the loaded model predicts as the fitted one.
def _reload(s, d):
    # The view is worked out once; training and both scores read the kept columns.
    tickets = ev_clean(s, d).select("unique_key", *S.BASE_FEATURES, "status", M.LABEL).cache()
    try:
        result = M.train_random_forest(tickets, cv_folds=0)
        path = M.save_model(result, f"{shared_path(s, 'forest')}-{uuid.uuid4().hex}")
        fitted = M.score(result.model, tickets).select("unique_key", F.col("predicted_days").alias("a"))
        loaded = M.score(M.load_model(s, path), tickets).select("unique_key", F.col("predicted_days").alias("b"))
        both = fitted.join(loaded, "unique_key")
        found = both.agg(F.count(F.lit(1)).alias("n_scored"), F.count_if(~F.col("a").eqNullSafe(F.col("b"))).alias("n_different"))
        return s.createDataFrame(found.collect(), found.schema)
    finally:
        tickets.unpersist()


register("M15_IO9_model_job_ev", O.with_ev_clean("SELECT COUNT(*) AS n_scored, 0::BIGINT AS n_different FROM clean"))(_reload)


# M8: the report's test metrics equal those worked out from the scored test rows.
def _metric_check(s, d):
    path, result = _saved_forest(s, d)
    test = M.prepare(ev_clean(s, d)).filter("is_test")
    pred = M.load_model(s, path).transform(test)
    e = F.abs(F.col(R) - F.col("prediction"))
    own = pred.agg(F.sum(e).alias("s"), F.sum(e * e).alias("q"), F.count(F.lit(1)).alias("n"))
    told = result.test_metrics.select("mae", "rmse", F.col("n").alias("told_n"))
    return own.crossJoin(F.broadcast(told)).select(
        "n", (F.abs(F.col("s") / F.col("n") - F.col("mae")) < 1e-9).alias("mae_agrees"),
        (F.abs(F.sqrt(F.col("q") / F.col("n")) - F.col("rmse")) < 1e-9).alias("rmse_agrees"))


register("M8_forest_metrics_recomputed_ev", cont(O.with_ev_clean(
    _FEATURE_SQL + "\nSELECT COUNT(*) AS n, true AS mae_agrees, true AS rmse_agrees FROM m0 WHERE is_test")))(_metric_check)
