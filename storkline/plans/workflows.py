"""The two batch jobs from end to end: raw files to split sets, split sets to a registered model."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.ml import Estimator, PipelineModel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from storkline.functions.sampling import sample_n
from storkline.operators import explain, metrics, model, split
from storkline.operators.clean import run_preprocessing
from storkline.operators.features import engineer_features
from storkline.sources import raw_files, run_tables, split_files

log = logging.getLogger(__name__)

REGISTERED_NAME = "birth-weight"


def prepare_data(
    spark: SparkSession, data_dir: str, out_dir: str, nrows_per_file: int | None = None,
    files: list[str] | None = None,
) -> dict:
    """Raw files to cleaned, featured split sets: one stage from scan to write.

    Returns the counts of the cleaning steps, which the writing job observes on its way, and under ``splits``
    the size, share and years of each split. An empty split is logged as a warning.
    """
    seen = Observation("cleaning")
    raw = raw_files.load_all(spark, data_dir, files, nrows_per_file)
    split_files.save_splits(engineer_features(run_preprocessing(raw, seen)), out_dir)
    log.info("cleaning: %s", seen.get)
    info = split.split_info(spark.read.parquet(out_dir))
    split.warn_empty_splits(info)
    # three rows
    return {**seen.get, "splits": [r.asDict() for r in info.collect()]}


@dataclass
class Candidate:
    """A model family: how to build it from parameters and, when tuned, where to search."""

    make: Callable[..., Estimator]
    defaults: dict = field(default_factory=dict)
    space: Callable | None = None
    scale: bool = False


def default_candidates() -> dict[str, Candidate]:
    return {
        "ridge": Candidate(lambda alpha: model.Ridge(alpha), {"alpha": 1.0}, scale=True),
        "leafwise_trees": Candidate(lambda **p: model.gbt(**p), {"n_estimators": 300}, model.leafwise_space),
        "depthwise_trees": Candidate(lambda **p: model.gbt(**p), {"n_estimators": 300}, model.depthwise_space),
    }


@dataclass
class Outcome:
    best: str
    model: PipelineModel
    screening: DataFrame
    test: DataFrame
    gate: DataFrame
    importance: DataFrame
    shapley: DataFrame
    version: int
    path: str


def train_models(
    spark: SparkSession, splits_dir: str, tracking_dir: str, key: str,
    candidates: dict[str, Candidate] | None = None, n_trials: int = 30, screen_rows: int = 500_000,
    importance_rows: int | None = None, importance_repeats: int = 10, seed: int = 42, parallelism: int = 1,
    shapley_permutations: int = 8,
) -> Outcome:
    """Baseline, screening, search, final fits, one look at the test split, explanation, registration.

    ``key`` is an integer column that identifies records; screening draws by it. Importance and Shapley values
    take all validation records unless ``importance_rows`` asks for a sample. ``parallelism`` trials of a
    search run side by side.
    """
    candidates = candidates or default_candidates()
    if not any(c.space for c in candidates.values()):
        raise ValueError("no candidate names a space to search")
    splits = split_files.load_splits(spark, splits_dir)
    train, val, test = (split.model_matrix(df, keep=(key,)) for df in splits)

    baseline = model.build_pipeline(model.BaselineMean())
    model.train_and_log(baseline, "baseline_mean", train, val, tracking_dir, tags={"stage": "baseline"})
    screened = {f"{n}_default": (c.make(**c.defaults), c.scale) for n, c in candidates.items()}
    screening = model.screening_table(screened, train, val, key, screen_rows, seed, tracking_dir)

    finals = {}
    for name, candidate in candidates.items():
        if candidate.space is None:
            continue
        params, _ = model.run_search(
            f"{name}_search", candidate.space, lambda p, c=candidate: c.make(**p), train, val, n_trials, seed, tracking_dir,
            parallelism=parallelism, prep=model.FeaturePrep(scaleNumeric=candidate.scale),
        )
        finals[f"{name}_final"] = model.train_and_log(
            model.build_pipeline(candidate.make(**params), candidate.scale), f"{name}_final", train, val,
            tracking_dir, params, {"stage": "final", "family": name},
        )
    best = min(finals, key=lambda n: finals[n][1].metrics["val_mae"])
    fitted, run = finals[best]
    return finish_model(
        spark, tracking_dir, run.run_name, fitted, val, test, key, screening, importance_rows, importance_repeats, seed,
        run.run_id, shapley_permutations,
    )


def finish_model(
    spark: SparkSession, tracking_dir: str, run_name: str, fitted: PipelineModel | None, val: DataFrame,
    test: DataFrame, key: str, screening: DataFrame | None = None, importance_rows: int | None = None,
    importance_repeats: int = 10, seed: int = 42, run_id: str | None = None, shapley_permutations: int = 8,
) -> Outcome:
    """Evaluate on test, explain and register a run; loads its model when not given.

    Without ``run_id`` it is the newest run of the name, whose own model is loaded whatever ``fitted`` is.
    """
    if run_id is None:
        found = run_tables.find_run(run_tables.read_runs(spark, tracking_dir), run_name).first()
        if found is None:
            raise ValueError(f"no run named '{run_name}' in {tracking_dir}")
        run_id, fitted = found.run_id, None
    fitted = fitted or PipelineModel.load(f"{tracking_dir}/models/{run_id}")
    results = {k: v for k, v in metrics.metric_row(fitted.transform(test)).items() if k != "n"}
    row = spark.createDataFrame([{k: float(v) for k, v in results.items()}])
    explained = sample_n(val, importance_rows, key, seed) if importance_rows else val
    importance = explain.permutation_importance(fitted, explained, repeats=importance_repeats, seed=seed)
    phi = explain.sampled_shapley(fitted, explained, key, permutations=shapley_permutations, seed=seed)
    shapley = phi.groupBy("feature").agg(F.avg(F.abs("phi")).alias("mean_abs")).orderBy(F.desc("mean_abs"), "feature")
    version, path = run_tables.register_model(
        spark, tracking_dir, REGISTERED_NAME, run_id, {f"test_{k}": float(v) for k, v in results.items()},
        {"test_evaluated": "true"},
    )
    return Outcome(run_name, fitted, screening, row, metrics.acceptance_gate(row), importance, shapley, version, path)


def smoke_test(spark: SparkSession, tracking_dir: str, test: DataFrame, n: int = 5) -> DataFrame:
    """A few predictions of the newest registered model next to the true weights."""
    path = run_tables.registered_path(spark, tracking_dir, REGISTERED_NAME)
    return model.reload_predict(spark, path, test, n)
