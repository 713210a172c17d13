"""Feature preparation, regressors, training, search and model selection on Spark ML."""

from __future__ import annotations

import logging
import math
import random
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasOutputCol, HasPredictionCol
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storkline import schema as S
from storkline.functions.counts import centred_squares, quantiles, value_counts_long
from storkline.functions.partitions import spread
from storkline.functions.sampling import add_fold, sample_n
from storkline.operators.metrics import evaluate_split, metric_row, regression_columns
from storkline.operators.profile import sort_metric
from storkline.session import set_for, shared_folder, stored
from storkline.sources.run_tables import Run, append_run

log = logging.getLogger(__name__)

PREPARED = "x_"


# ---- feature preparation


def fit_statistics(
    df: DataFrame, numeric: list[str] = S.NUMERIC_FEATURES, binary: list[str] = S.BINARY_FEATURES
) -> DataFrame:
    """Strategy, fill value, mean and population deviation per feature, from one scan.

    Numeric features fill with the exact median, binary ones with the most frequent value (the
    lowest on a tie). Mean and deviation hold after filling. A feature without any value has a null
    fill value.
    """
    n, v = F.col("n"), F.col("value")
    known = F.when(v.isNotNull(), n)
    found = quantiles(value_counts_long(df, [*numeric, *binary]), ["feature"], {"median": 0.5}, [
        F.max_by(v, F.struct(known.alias("n"), -v)).alias("mode"),
        F.sum(n).alias("rows"), F.sum(known).alias("known"),
        F.max("_mean").alias("centre"), centred_squares().alias("squares"),
        (F.min(v) == F.max(v)).alias("constant"),
    ])
    is_numeric = F.col("feature").isin(list(numeric))
    fill, missing = F.col("fill"), F.col("rows") - F.col("known")
    filled = found.select(
        "feature", F.when(is_numeric, "median").otherwise("most_frequent").alias("strategy"),
        F.when(is_numeric, F.col("median")).otherwise(F.col("mode")).alias("fill"),
        "rows", "known", "centre", "squares", "constant",
    )
    mean = (F.col("known") * F.col("centre") + missing * fill) / F.col("rows")
    filled = filled.withColumn("mean", F.when(F.col("constant"), fill).otherwise(mean))
    # squares around the mean of the known values, moved to the mean after filling
    from_known, from_fill = F.col("centre") - F.col("mean"), fill - F.col("mean")
    moved = F.col("squares") + F.col("known") * from_known * from_known + missing * from_fill * from_fill
    variance = moved / F.col("rows")
    # rounding must not make a constant column look spread
    deviation = F.when(F.col("constant"), F.lit(0.0)).otherwise(F.sqrt(variance))
    return filled.select("feature", "strategy", "fill", "mean", deviation.alias("std_pop"))


def _literal(value: float) -> str:
    return f"{value!r}".upper() + "D"


def preparation_sql(statistics: dict[str, tuple[float, float, float]], scaled: set[str]) -> dict[str, str]:
    """SQL expression per feature: fill, and for scaled ones centre and divide."""
    out = {}
    for name, (fill, mean, std) in statistics.items():
        sql = f"coalesce(CAST(`{name}` AS DOUBLE), {_literal(fill)})"
        if name in scaled:
            sql = f"({sql} - ({_literal(mean)})) / {_literal(std if std > 0 else 1.0)}"
        out[name] = sql
    return out


class FeaturePrep(Estimator, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Imputes and optionally standardises the model features into a vector.

    Fits to built-in stages only, so a fitted pipeline saves, loads and streams like any other.
    """

    numericCols = Param(Params._dummy(), "numericCols", "median-filled columns", TypeConverters.toListString)
    binaryCols = Param(Params._dummy(), "binaryCols", "mode-filled columns", TypeConverters.toListString)
    scaleNumeric = Param(Params._dummy(), "scaleNumeric", "standardise numeric columns", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, numericCols=None, binaryCols=None, scaleNumeric=False, outputCol="features"):
        super().__init__()
        self._setDefault(
            numericCols=S.NUMERIC_FEATURES, binaryCols=S.BINARY_FEATURES, scaleNumeric=False, outputCol="features"
        )
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> PipelineModel:
        numeric = [c for c in self.getOrDefault(self.numericCols) if c in df.columns]
        binary = [c for c in self.getOrDefault(self.binaryCols) if c in df.columns]
        # one row per feature
        rows = {r.feature: (r.fill, r.mean, r.std_pop) for r in fit_statistics(df, numeric, binary).filter("fill is not null").collect()}
        kept = [c for c in [*numeric, *binary] if c in rows]
        dropped = [c for c in [*numeric, *binary] if c not in rows]
        if dropped:
            log.warning("features without any value are dropped: %s", dropped)
        scaled = set(numeric) if self.getOrDefault(self.scaleNumeric) else set()
        prepared = preparation_sql({c: rows[c] for c in kept}, scaled)
        columns = ", ".join(f"{sql} AS `{PREPARED}{c}`" for c, sql in prepared.items())
        return PipelineModel([
            SQLTransformer(statement=f"SELECT *, {columns} FROM __THIS__"),
            VectorAssembler(inputCols=[PREPARED + c for c in kept], outputCol=self.getOutputCol()),
        ])


def build_pipeline(
    model: Estimator, scale_numeric: bool = False, numeric: list[str] | None = None,
    binary: list[str] | None = None,
) -> Pipeline:
    """Unfitted preparation followed by any regressor."""
    prep = FeaturePrep(numericCols=numeric, binaryCols=binary, scaleNumeric=scale_numeric)
    return Pipeline(stages=[prep, model])


def prepared_features(model: PipelineModel) -> list[str]:
    """Feature names in the order of the vector."""
    prep = model.stages[0]
    return [c.removeprefix(PREPARED) for c in prep.stages[-1].getInputCols()]


# ---- regressors


class BaselineMean(Estimator, HasLabelCol, HasPredictionCol):
    """Predicts the mean of the training target."""

    def __init__(self, labelCol: str = S.TARGET):
        super().__init__()
        self._set(labelCol=labelCol)

    def _fit(self, df: DataFrame) -> Model:
        mean = df.agg(F.avg(self.getLabelCol())).first()[0]
        if mean is None:
            raise ValueError("no training rows with a target")
        return SQLTransformer(statement=f"SELECT *, {_literal(mean)} AS `{self.getPredictionCol()}` FROM __THIS__")


class Ridge(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol):
    """Least squares with an L2 penalty ``alpha * |w|^2`` on the total squared error, free intercept.

    The normal equations take one pass. The library penalises the mean squared error of a target
    divided by its deviation, hence the factor. The prepared vectors are held for the two passes.
    """

    def __init__(self, alpha: float = 1.0, labelCol: str = S.TARGET):
        super().__init__()
        self.alpha = alpha
        self._set(labelCol=labelCol)

    def _fit(self, df: DataFrame) -> Model:
        label = self.getLabelCol()
        held = df.select(self.getFeaturesCol(), label).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            n, deviation = held.agg(F.count(label), F.stddev_pop(label)).first()
            if not n:
                raise ValueError("no training rows with a target")
            return LinearRegression(
                featuresCol=self.getFeaturesCol(), labelCol=label, predictionCol=self.getPredictionCol(),
                elasticNetParam=0.0, standardization=False, solver="normal", regParam=self.alpha * deviation / n,
            ).fit(held)
        finally:
            held.unpersist()


def gbt(label: str = S.TARGET, **params) -> GBTRegressor:
    """Boosted trees from the usual names of their parameters.

    ``reg_alpha`` and ``reg_lambda`` have no counterpart and are ignored; ``num_leaves`` sets the
    depth of a full tree with as many leaves.
    """
    depth = params.get("max_depth")
    if depth is None:
        depth = math.ceil(math.log2(params["num_leaves"])) if "num_leaves" in params else 5
    return GBTRegressor(
        labelCol=label,
        maxIter=params.get("n_estimators", 300),
        maxDepth=depth,
        stepSize=params.get("learning_rate", 0.1),
        minInstancesPerNode=params.get("min_child_samples", params.get("min_child_weight", 1)),
        subsamplingRate=params.get("subsample", 1.0),
        featureSubsetStrategy=str(params.get("colsample_bytree", "all")),
        seed=params.get("random_state", 42),
        maxBins=params.get("max_bins", 64),
        checkpointInterval=10,
        # a row's node is found again from the few tests above it, which costs less than holding it for every level
        cacheNodeIds=False,
    )


# The search spaces of the two tuned models.
def leafwise_space(draw: random.Random) -> dict:
    return {
        "n_estimators": draw.randrange(200, 1001, 100),
        "num_leaves": draw.randint(31, 255),
        "learning_rate": _log_uniform(draw, 0.01, 0.3),
        "min_child_samples": draw.randint(20, 200),
        "subsample": draw.uniform(0.6, 1.0),
        "colsample_bytree": draw.uniform(0.6, 1.0),
        "reg_alpha": _log_uniform(draw, 1e-4, 10.0),
        "reg_lambda": _log_uniform(draw, 1e-4, 10.0),
    }


def depthwise_space(draw: random.Random) -> dict:
    return {
        "n_estimators": draw.randrange(200, 1001, 100),
        "max_depth": draw.randint(3, 10),
        "learning_rate": _log_uniform(draw, 0.01, 0.3),
        "subsample": draw.uniform(0.6, 1.0),
        "colsample_bytree": draw.uniform(0.6, 1.0),
        "reg_alpha": _log_uniform(draw, 1e-4, 10.0),
        "reg_lambda": _log_uniform(draw, 1e-4, 10.0),
        "min_child_weight": draw.randint(1, 50),
    }


def _log_uniform(draw: random.Random, low: float, high: float) -> float:
    return math.exp(draw.uniform(math.log(low), math.log(high)))


# ---- training and search


def _stored_columns(df: DataFrame, prep: FeaturePrep, label: str, name: str) -> DataFrame:
    used = {*prep.getOrDefault(prep.numericCols), *prep.getOrDefault(prep.binaryCols), label}
    return stored(df.select(*[c for c in df.columns if c in used]), name)


# an adaptive plan would run the exchange a second time, where Spark ML asks for the number of partitions
DEALT_ONCE = {"spark.sql.adaptive.enabled": "false"}


def fit_stored(pipeline: Pipeline, train: DataFrame) -> PipelineModel:
    """Fits a preparation and a regressor that pass over their rows many times.

    The columns they use are written once, so ``train`` is worked out once, and dealt once for the regressor.
    """
    prep, regressor = pipeline.getStages()
    label = regressor.getLabelCol()
    rows = _stored_columns(train, prep, label, "training")
    prepared = prep.fit(rows)
    vectors = prepared.transform(spread(rows)).select(regressor.getFeaturesCol(), label)
    with set_for(train.sparkSession, DEALT_ONCE):
        return PipelineModel([prepared, regressor.fit(vectors)])


def train_and_log(
    pipeline: Pipeline, name: str, train: DataFrame, val: DataFrame, runs: str | None = None,
    params: dict | None = None, tags: dict | None = None, save_model: bool = True,
) -> tuple[PipelineModel, Run]:
    """Fit, measure on both splits, and record the run (and the model) below the ``runs`` folder."""
    shared_folder(train.sparkSession)
    start = time.time()
    model = pipeline.fit(spread(train))
    seconds = time.time() - start
    metrics, sizes = {}, {}
    for split, df in (("train", train), ("val", val)):
        row = metric_row(model.transform(df))
        sizes[split] = row.pop("n")
        metrics |= {f"{split}_{k}": float(v) for k, v in row.items() if v is not None}
    metrics["train_time_sec"] = round(seconds, 2)
    run = Run.new(
        name, metrics,
        params={
            "model_name": name, "n_train": sizes["train"], "n_val": sizes["val"],
            "n_features": len([c for c in S.MODEL_FEATURES if c in train.columns]), **(params or {}),
        },
        tags={"model_type": name, **(tags or {})}, start_ms=int(start * 1000),
    )
    if runs:
        if save_model:
            model.write().overwrite().save(f"{runs}/models/{run.run_id}")
        append_run(train.sparkSession, runs, run)
    return model, run


def run_search(
    name: str, space: Callable[[random.Random], dict], make: Callable[[dict], Estimator],
    train: DataFrame, val: DataFrame, n_trials: int = 30, seed: int = 42, runs: str | None = None,
    minimize: bool = True, parallelism: int = 1, label: str = S.TARGET, prep: FeaturePrep | None = None,
) -> tuple[dict, list[Run]]:
    """Random search on the fixed validation rows: each trial is one distributed fit.

    The preparation (``prep``, unscaled unless given) is fitted once and shared by all trials. The columns it uses are
    written once and read trial by trial, so that executors hold no more than what a regressor holds of them.
    """
    spark = train.sparkSession
    shared_folder(spark)
    prep = prep or FeaturePrep()
    fit_columns, val_columns = (_stored_columns(df, prep, label, name) for df, name in ((train, "training"), (val, "validation")))
    prepared = prep.fit(fit_columns)
    fit_rows = prepared.transform(spread(fit_columns)).select("features", label)
    val_rows = prepared.transform(val_columns).select("features", label)
    draw = random.Random(seed)
    drawn = [space(draw) for _ in range(n_trials)]

    def trial(numbered: tuple[int, dict]) -> Run:
        number, params = numbered
        start = int(time.time() * 1000)
        row = make(params).fit(fit_rows).transform(val_rows).agg(*regression_columns(label)).first()
        metrics = {f"val_{k}": float(v) for k, v in row.asDict().items()}
        return Run.new(
            f"{name}_trial_{number}", metrics, params=params,
            tags={"model_type": name, "trial": str(number), "search": "random"}, start_ms=start,
        )

    with set_for(spark, DEALT_ONCE), ThreadPoolExecutor(parallelism) as pool:
        trials = list(pool.map(trial, enumerate(drawn)))
    best = (min if minimize else max)(range(n_trials), key=lambda i: trials[i].metrics["val_mae"])
    if runs:
        summary = Run.new(
            f"{name}_{n_trials}_trials", {"best_val_mae": trials[best].metrics["val_mae"]},
            params=drawn[best], tags={"model_type": name, "search": "random"},
        )
        append_run(spark, runs, *trials, summary)
    return drawn[best], trials


def screening_table(
    candidates: dict[str, tuple[Estimator, bool] | Pipeline], train: DataFrame, val: DataFrame, key: str,
    sample: int = 500_000, seed: int = 42, runs: str | None = None,
) -> DataFrame:
    """Candidates fitted on the same sample of training rows, best validation error first.

    A candidate is a regressor and whether its features are scaled, or a whole pipeline.
    """
    spark = train.sparkSession
    shared_folder(spark)
    # a limit leaves one partition
    cores = spark.sparkContext.defaultParallelism
    drawn = sample_n(train, sample, key, seed).repartition(cores).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        lines = []
        for name, candidate in candidates.items():
            pipeline = candidate if isinstance(candidate, Pipeline) else build_pipeline(*candidate)
            _, run = train_and_log(pipeline, name, drawn, val, runs, tags={"stage": "screening"}, save_model=False)
            m = run.metrics
            lines.append((name, m["val_mae"], m["val_rmse"], m["val_r2"], m["val_sensitivity"]))
    finally:
        drawn.unpersist()
    # one row per candidate
    table = spark.createDataFrame(lines, "model string, val_mae double, val_rmse double, val_r2 double, val_sensitivity double")
    return sort_metric(table, "val_mae")


def kfold_scores(df: DataFrame, make: Callable[[], Pipeline], k: int, key: str, seed: int = 42) -> DataFrame:
    """Regression metrics of k fits, each scored on the fold it did not see."""
    spark = df.sparkSession
    shared_folder(spark)
    folded = stored(add_fold(df, k, key, seed), "folds")
    scored = []
    for fold in range(k):
        model = make().fit(folded.filter(F.col("fold") != fold))
        held = model.transform(folded.filter(F.col("fold") == fold)).select("fold", S.TARGET, "prediction")
        scored.append(held)
    everything = scored[0]
    for part in scored[1:]:
        everything = everything.unionByName(part)
    return everything.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), *regression_columns())


def reload_predict(spark, path: str, df: DataFrame, n: int = 5, label: str = S.TARGET) -> DataFrame:
    """Load a saved model and score a few rows next to their true values."""
    model = PipelineModel.load(path)
    scored = model.transform(df.limit(n))
    return scored.select(
        F.col(label).alias("actual"), F.col("prediction").alias("predicted"),
        F.abs(F.col("prediction") - F.col(label)).alias("error"),
    )


__all__ = [
    "BaselineMean", "FeaturePrep", "Ridge", "build_pipeline", "depthwise_space", "evaluate_split",
    "fit_statistics", "fit_stored", "gbt", "kfold_scores", "leafwise_space", "prepared_features", "reload_predict",
    "run_search", "screening_table", "train_and_log",
]
