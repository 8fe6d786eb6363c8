"""Response-time model (M1-M15) on Spark ML.

Features are derived with built-in expressions, encoded with
``StringIndexer`` (alphabetical codes, unseen values to code 0 as in the
reference) and assembled into one vector; forests and the linear baseline
train as distributed MLlib jobs.  Everything that leaves the executors is a
model parameter (a few numbers per feature), never rows.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.expressions import day_period
from ..operators.cleaning import floor_prediction, model_rows, off_hours, response_class
from ..session import ensure_checkpoint_dir, shared_path
from . import bundle as B
from .cells import CellForest
from .forest import MIN_SPLIT, node_memory_mb, with_min_split

LABEL = "response_time_days"
FEATURES = S.BASE_FEATURES + S.ENGINEERED_FEATURES

# Priority types in both languages: raw tickets carry English names, clean ones Portuguese.
MODEL_PRIORITY_TYPES = ["Heat/Hot Water", "Water System", "UNSANITARY CONDITION"] + S.PRIORITY_TYPES
FOLDS = 5
PARTITION_ROWS = 200_000
MAX_VECTORS = 200_000  # distinct model inputs whose predictions are sent to every executor


def supply_missing_features(df: DataFrame) -> DataFrame:
    """M1: derive absent base feature columns by their default rule."""
    have = set(df.columns)
    rules: dict[str, Column] = {
        "quarter": F.floor((F.col("created_month") - 1) / 3).cast("int") + 1,
        "is_weekend": F.col("created_weekday").isin("Saturday", "Sunday", "Sábado", "Domingo"),
        "is_priority": F.col("complaint_type").isin(MODEL_PRIORITY_TYPES),
        "created_period": day_period("created_hour"),
    }
    out = df
    for c in S.BASE_FEATURES:
        if c in have:
            continue
        if c == "is_business_hours":
            wk = F.col("is_weekend") if "is_weekend" in out.columns else F.lit(False)
            out = out.withColumn(c, F.col("created_hour").between(9, 17) & ~wk)
        elif c in rules:
            out = out.withColumn(c, rules[c])
        else:
            out = out.withColumn(c, F.lit("Unknown"))
    return out


def as_text(c: str) -> Column:
    """Encoded columns are text first; a missing value is its own label."""
    return F.coalesce(F.col(c).cast("string"), F.lit("nan"))


def engineer_features(df: DataFrame) -> DataFrame:
    """M1-M3 + M5: base columns, interaction, peak / year-end flags, bool -> int
    (``{flag}_num``; the boolean columns themselves are kept)."""
    df = supply_missing_features(df)
    df = df.withColumns({
        "borough_category": F.concat_ws("_", as_text("borough"), as_text("complaint_category")),
        "is_peak_hour": F.col("created_hour").isin(S.PEAK_HOURS),
        "is_year_end": F.col("created_month").isin(S.YEAR_END_MONTHS),
    })
    df = df.withColumns({f"{c}_txt": as_text(c) for c in S.CATEGORICAL_FEATURES})
    return df.withColumns({f"{c}_num": F.col(c).cast("int") for c in S.BOOLEAN_FEATURES})


def hash_part(part: int, key: str = "unique_key", seed: int = 42) -> Column:
    """A number of 32 bits per key: the ``part``-th eight digits of md5 of
    ``seed:key``; repeatable under any partitioning, unlike ``randomSplit``."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return F.conv(F.substring(h, 1 + 8 * part, 8), 16, 10).cast("long")


def with_split(df: DataFrame, test_size: float = 0.2, seed: int = 42,
               key: str = "unique_key") -> DataFrame:
    """M6: ``is_test`` flag for a deterministic (1 - test_size) / test_size
    split, and the cross-validation ``fold`` (M9) from other digits of the hash."""
    edge = int(round((1 - test_size) * (1 << 32)))
    return df.withColumns({"is_test": hash_part(0, key, seed) >= F.lit(edge),
                           "fold": (hash_part(1, key, seed) % FOLDS).cast("int")})


def label_codes(df: DataFrame, cols=tuple(S.CATEGORICAL_FEATURES)) -> DataFrame:
    """M4 as a table: (feature, value, code) with alphabetical codes from 0.

    One scan: each row gives its five (feature, value) pairs, reduced to
    distinct ones in each task.  These are few (boroughs x categories); the
    window runs over them only.
    """
    pairs = ", ".join(f"'{c}', {c}_txt" for c in cols)
    values = df.select(F.expr(f"stack({len(cols)}, {pairs}) AS (feature, value)")).distinct()
    w = Window.partitionBy("feature").orderBy("value")
    return values.withColumn("code", F.dense_rank().over(w) - 1)


def _indexer() -> StringIndexer:
    cats = S.CATEGORICAL_FEATURES
    return StringIndexer(inputCols=[f"{c}_txt" for c in cats], outputCols=[f"{c}_idx" for c in cats],
                         stringOrderType="alphabetAsc", handleInvalid="keep")


def _unseen_to_zero(indexer_model) -> SQLTransformer:
    """Map the 'unseen' index (== number of labels) to code 0 (M4)."""
    cats = S.CATEGORICAL_FEATURES
    sizes = [len(lbls) for lbls in indexer_model.labelsArray]
    exprs = ", ".join(
        f"CAST(CASE WHEN {c}_idx >= {n} THEN 0 ELSE {c}_idx END AS DOUBLE) AS {c}_code"
        for c, n in zip(cats, sizes))
    return SQLTransformer(statement=f"SELECT *, {exprs} FROM __THIS__")


def _assembler() -> VectorAssembler:
    cols = [f"{c}_code" if c in S.CATEGORICAL_FEATURES
            else f"{c}_num" if c in S.BOOLEAN_FEATURES else c for c in FEATURES]
    return VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="keep")


def encode(train: DataFrame) -> PipelineModel:
    """Fit the encoding part (M4) on training rows; returns a PipelineModel
    that turns engineered rows into a ``features`` vector."""
    idx = _indexer().fit(train)
    return PipelineModel(stages=[idx, _unseen_to_zero(idx), _assembler()])


def forest(num_trees: int = 100, max_depth: int = 15, min_leaf: int = 2, seed: int = 42,
           max_bins: int = 64, max_memory_mb: int = 256) -> RandomForestRegressor:
    """M7: random forest regressor with the reference's sizes.

    ``max_memory_mb`` bounds the node statistics of one task; it decides how
    many nodes a pass over the data trains, not the trees (see
    ``forest.node_memory_mb``).  ``minInstancesPerNode`` carries the leaf
    minimum; the minimum split is applied to the fitted trees
    (``forest.with_min_split``).  Node ids are cached and checkpointed to the
    shared checkpoint folder so deep trees do not grow an endless lineage.
    """
    return RandomForestRegressor(
        featuresCol="features", labelCol=LABEL, numTrees=num_trees, maxDepth=max_depth,
        minInstancesPerNode=min_leaf, featureSubsetStrategy="all", maxBins=max_bins, seed=seed,
        cacheNodeIds=True, checkpointInterval=10, maxMemoryInMB=max_memory_mb)


def metrics(pred: DataFrame, label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    """M8: MAE, RMSE and R² as one aggregate row."""
    err = F.col(label) - F.col(prediction)
    return pred.agg(
        F.avg(F.abs(err)).alias("mae"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        (F.lit(1.0) - F.try_divide(F.avg(err * err), F.var_pop(label))).alias("r2"),
        F.count(F.lit(1)).alias("n"),
    )


def _told(df: DataFrame) -> DataFrame:
    """A one-row result worked out now, so that it does not need its input again."""
    return df.sparkSession.createDataFrame([df.first()], df.schema)


@dataclass
class TrainResult:
    """Metrics and importances are small tables already worked out."""
    model: PipelineModel
    model_type: str
    train_metrics: DataFrame
    test_metrics: DataFrame
    train_size: int
    test_size: int
    cv_mae: float | None = None
    importance: DataFrame | None = None
    extra: dict = field(default_factory=dict)


def split_sizes(data: DataFrame) -> tuple[int, int]:
    """(train rows, test rows) from one grouped count."""
    sizes = {r["is_test"]: r["n"] for r in
             data.groupBy("is_test").agg(F.count(F.lit(1)).alias("n")).collect()}
    return int(sizes.get(False, 0)), int(sizes.get(True, 0))


def prepare(df: DataFrame, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """P16 + M1-M3 + M5 + M6 on a clean ticket table."""
    return with_split(engineer_features(model_rows(df)), test_size, seed)


_MODEL_COLUMNS = [f"{c}_txt" for c in S.CATEGORICAL_FEATURES] + [
    f"{c}_num" if c in S.BOOLEAN_FEATURES else c for c in FEATURES if c not in S.CATEGORICAL_FEATURES]


def train_random_forest(df: DataFrame, test_size: float = 0.2, seed: int = 42, num_trees: int = 100,
                        max_depth: int = 15, min_split: int = MIN_SPLIT, min_leaf: int = 2,
                        cv_folds: int = FOLDS, max_memory_mb: int | None = None) -> TrainResult:
    """Split, fit, minimum split, metrics on both parts, k-fold CV MAE, importances.

    The prepared rows are scanned once; all fits, folds and metrics read one
    cached table of encoded vectors, which is released at the end.  It is dealt
    out by ticket key, so every core has a share of a small table too.  Each
    fit draws its rows by that key and trains on distinct vectors
    (``cells.CellForest``).
    ``cv_folds`` is 0 (no cross-validation) or up to ``FOLDS``.
    ``max_memory_mb`` defaults to what the widest level of one tree needs
    (``forest.node_memory_mb``), so a level is one pass over the vectors.
    """
    spark, fitted = df.sparkSession, None
    data = prepare(df, test_size, seed).select("unique_key", *_MODEL_COLUMNS, LABEL, "is_test", "fold").cache()
    encoded = None
    try:
        n_train, n_test = split_sizes(data)
        enc = encode(data.filter(~F.col("is_test")))
        parts = max(spark.sparkContext.defaultParallelism, -(-(n_train + n_test) // PARTITION_ROWS))
        encoded = enc.transform(data).repartition(parts, "unique_key").select("unique_key", "features", LABEL, "is_test", "fold").cache()
        train = encoded.filter(~F.col("is_test"))
        if max_memory_mb is None:
            max_memory_mb = node_memory_mb(_bins(enc), 1, max_depth, n_train, min_leaf)
        rf = CellForest(forest(num_trees, max_depth, min_leaf, seed, max_memory_mb=max_memory_mb))
        fitted = rf.fit_folds(encoded, cv_folds if cv_folds > 1 else 0, min_split)
        rf_model = fitted.model
        cv_mae = cross_validated_mae(train, rf, cv_folds, lambda m: with_min_split(m, spark, min_split), fitted.errors) if cv_folds > 1 else None
        imp = rf_model.featureImportances.toArray().tolist()
        importance = spark.createDataFrame(
            [(f, float(v)) for f, v in zip(FEATURES, imp)], "feature string, importance double")
        # What the cells tell is what the model would, without sending all trees to every executor.
        pred = rf_model.transform(encoded) if fitted.predicted is None else fitted.predicted
        return TrainResult(
            model=PipelineModel(stages=list(enc.stages) + [rf_model]), model_type="Random Forest",
            train_metrics=_told(metrics(pred.filter(~F.col("is_test")))),
            test_metrics=_told(metrics(pred.filter(F.col("is_test")))),
            train_size=n_train, test_size=n_test, cv_mae=cv_mae, importance=importance,
            extra={"label_maps": label_maps(enc), "split": {"test_size": test_size, "seed": seed},
                   "sizes": {"num_trees": num_trees, "max_depth": max_depth, "min_split": min_split, "min_leaf": min_leaf}})
    finally:
        data.unpersist()
        if encoded is not None:
            encoded.unpersist()
        if fitted is not None and fitted.predicted is not None:
            fitted.predicted.unpersist()


def label_maps(enc: PipelineModel) -> dict[str, list[str]]:
    """Feature -> labels in the order of their codes, from a fitted encoding."""
    return {c: list(labels) for c, labels in zip(S.CATEGORICAL_FEATURES, enc.stages[0].labelsArray)}


def _bins(enc: PipelineModel, max_bins: int = 64) -> int:
    """Bins of all features: labels, months, hours, quarters and two for each flag."""
    labels = sum(min(max_bins, len(x) + 1) for x in enc.stages[0].labelsArray)
    return labels + 24 + 12 + 4 + 2 * len(S.BOOLEAN_FEATURES)


def cross_validated_mae(train: DataFrame, estimator, folds: int = FOLDS, finish=None, errors=None) -> float:
    """M9: k-fold CV mean absolute error.

    Folds are the rows' own ``fold`` (with fewer folds, modulo their number),
    so they repeat under any partitioning.  ``finish`` is applied to every
    fold's fitted model, as to the model itself.  ``errors`` has the folds' errors
    where one pass has worked them all out (``cells.CellForest.fit_folds``).  A
    fold without rows of its own does not count.
    """
    if not 2 <= folds <= FOLDS:
        raise ValueError(f"folds must be 2 to {FOLDS}")
    if errors is None:
        rows, errors = train.withColumn("fold", F.col("fold") % folds), []
        for k in range(folds):
            model = estimator.fit(rows.filter(F.col("fold") != k))
            model = finish(model) if finish else model
            held = model.transform(rows.filter(F.col("fold") == k))
            errors.append(held.agg(F.avg(F.abs(F.col(LABEL) - F.col("prediction")))).first()[0])
    errors = [e for e in errors if e is not None]
    return float(sum(errors) / len(errors))


def top_features(importance: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` most important features, sorted."""
    return importance.orderBy(F.col("importance").desc(), "feature").limit(n)


def train_linear_regression(df: DataFrame, test_size: float = 0.2, seed: int = 42,
                            features: list[str] | None = None) -> TrainResult:
    """M11 + M12: standardised features (sample std) and ordinary least squares."""
    data = prepare(df, test_size, seed).cache()
    try:
        train, test = data.filter(~F.col("is_test")), data.filter(F.col("is_test"))
        if features is None:
            stages, raw = list(encode(train).stages), "features"
        else:
            stages, raw = [VectorAssembler(inputCols=features, outputCol="raw_features")], "raw_features"
        scaler = StandardScaler(inputCol=raw, outputCol="scaled", withMean=True, withStd=True)
        lr = LinearRegression(featuresCol="scaled", labelCol=LABEL, regParam=0.0,
                              elasticNetParam=0.0, solver="normal")
        fitted = Pipeline(stages=[scaler, lr]).fit(PipelineModel(stages=stages).transform(train))
        model = PipelineModel(stages=stages + list(fitted.stages))
        n_train, n_test = split_sizes(data)
        return TrainResult(
            model=model, model_type="Linear Regression", train_metrics=_told(metrics(model.transform(train))),
            test_metrics=_told(metrics(model.transform(test))),
            train_size=n_train, test_size=n_test,
            extra={"scaler": fitted.stages[0], "lr": fitted.stages[1]})
    finally:
        data.unpersist()


def score(model: PipelineModel, tickets: DataFrame, floor: float = 0.1,
          default: float = 3.0) -> DataFrame:
    """Batch scoring of a ticket DataFrame with each ticket's own date.

    Adds ``predicted_days`` (floored at ``floor``, ``default`` when no
    prediction, P21), its class (P22) and the context flags (P23).  The model
    is applied to the tickets' distinct inputs, which are written once to the
    shared folder; where these are many, to every ticket.
    """
    spark, inputs = tickets.sparkSession, F.struct(*_MODEL_COLUMNS).alias("model_inputs")
    feats = engineer_features(tickets)
    pred = None
    if ensure_checkpoint_dir(spark) is not None:
        path = f"{shared_path(spark, 'inputs')}-{uuid.uuid4().hex}"
        feats.select(*_MODEL_COLUMNS).distinct().write.parquet(path)
        vectors = spark.read.parquet(path)
        if vectors.count() <= MAX_VECTORS:
            told = model.transform(vectors).select(inputs, "prediction")
            pred = feats.withColumn("model_inputs", inputs).join(F.broadcast(told), "model_inputs", "left")
    if pred is None:
        pred = model.transform(feats)
    return pred.select(
        *tickets.columns,
        floor_prediction("prediction", floor, default).alias("predicted_days"),
        response_class(floor_prediction("prediction", floor, default)).alias("predicted_class"),
        off_hours("created_hour").alias("off_hours"),
    )


def save_model(result: TrainResult, path: str) -> str:
    """IO9: persist the whole pipeline (encoders + model) with its manifest."""
    manifest = B.Manifest(
        model_type=result.model_type, features=list(FEATURES), label=LABEL,
        label_maps=result.extra.get("label_maps", {}), split=result.extra.get("split", {}),
        sizes=result.extra.get("sizes", {}), train_size=result.train_size, test_size=result.test_size,
        importance=[[r.feature, r.importance] for r in result.importance.collect()] if result.importance is not None else [],
        inputs=B.inputs_digest(S.CLEAN))
    return B.save(result.model, manifest, path)


def load_model(spark, path: str) -> PipelineModel:
    """IO9: load a persisted pipeline whose manifest fits this library's features and input schema."""
    model, _ = B.load(spark, path, features=list(FEATURES), label=LABEL, inputs=B.inputs_digest(S.CLEAN))
    return model


def model_report(result: TrainResult) -> DataFrame:
    """(model, split, metric, value) rows, plus sizes and CV MAE."""
    def long(m: DataFrame, split: str) -> DataFrame:
        return m.select(F.explode(F.array(*[
            F.struct(F.lit(k).alias("metric"), F.col(k).cast("double").alias("value"))
            for k in ("mae", "rmse", "r2")])).alias("x")) \
            .select(F.lit(result.model_type).alias("model"), F.lit(split).alias("split"), "x.*")
    out = long(result.train_metrics, "train").unionByName(long(result.test_metrics, "test"))
    spark = out.sparkSession
    extra = [(result.model_type, "train", "size", float(result.train_size)),
             (result.model_type, "test", "size", float(result.test_size))]
    if result.cv_mae is not None:
        extra.append((result.model_type, "cv", "mae", float(result.cv_mae)))
    return out.unionByName(spark.createDataFrame(
        extra, "model string, split string, metric string, value double"))


def run_model_job(df: DataFrame, model_path: str | None = None, **kw) -> dict:
    """Train, save, report and score the clean table."""
    result = train_random_forest(df, **kw)
    if model_path:
        save_model(result, model_path)
    return {
        "result": result,
        "report": model_report(result),
        "top_features": top_features(result.importance),
        "scored": score(result.model, df),
    }


def fit_line(train: DataFrame, feature: str, label: str = LABEL):
    """M12 with one feature: ordinary least squares (normal equations)."""
    va = VectorAssembler(inputCols=[feature], outputCol="x_vec")
    lr = LinearRegression(featuresCol="x_vec", labelCol=label, regParam=0.0, solver="normal")
    return PipelineModel(stages=[va, lr.fit(va.transform(train))])


def scaler_stats(train_features: DataFrame) -> DataFrame:
    """Per-feature mean and (sample) standard deviation used for scaling."""
    sc = StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True)
    m = sc.fit(train_features)
    rows = [(f, float(mu), float(sd)) for f, mu, sd in zip(FEATURES, m.mean.toArray(), m.std.toArray())]
    return train_features.sparkSession.createDataFrame(rows, "feature string, mean double, std double")
