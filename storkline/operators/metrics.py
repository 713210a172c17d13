"""Regression and clinical metrics as aggregates, for one frame or per group."""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storkline import schema as S
from storkline.functions.columns import ratio, rint_to

REGRESSION = ["mae", "rmse", "r2"]
CLINICAL = ["lbw_prevalence_pct", "sensitivity", "specificity", "precision", "f1", "n_lbw_true", "n_lbw_pred"]


def regression_columns(y: str = S.TARGET, p: str = "prediction") -> list[Column]:
    """MAE, RMSE and R2, null without rows; R2 of a constant target is 1 when every prediction is right, else 0."""
    truth, error = F.col(y).cast("double"), F.col(y) - F.col(p)
    left, spread = F.avg(error * error), F.var_pop(truth)
    r2 = F.when(F.min(truth) < F.max(truth), 1.0 - left / F.nullif(spread, F.lit(0.0))).when(left == 0, 1.0).when(left.isNotNull(), 0.0)
    return [
        rint_to(F.avg(F.abs(error)), 3).alias("mae"),
        rint_to(F.sqrt(left), 3).alias("rmse"),
        rint_to(r2, 4).alias("r2"),
    ]


def _clinical_counts(threshold: float, y: str, p: str) -> list[Column]:
    true, found = F.col(y) < threshold, F.col(p) < threshold
    cells = {"_tp": true & found, "_fn": true & ~found, "_fp": ~true & found, "_tn": ~true & ~found}
    return [F.count(F.when(c, 1)).alias(name) for name, c in cells.items()]


def _clinical_rates() -> dict[str, Column]:
    tp, fn, fp, tn = (F.col(c) for c in ("_tp", "_fn", "_fp", "_tn"))
    sensitivity, specificity = ratio(tp, tp + fn), ratio(tn, tn + fp)
    precision = ratio(tp, tp + fp)
    return {
        "lbw_prevalence_pct": rint_to(100.0 * ratio(tp + fn, tp + fn + fp + tn), 2),
        "sensitivity": rint_to(sensitivity, 4),
        "specificity": rint_to(specificity, 4),
        "precision": rint_to(precision, 4),
        "f1": rint_to(ratio(2.0 * precision * sensitivity, precision + sensitivity), 4),
        "n_lbw_true": tp + fn,
        "n_lbw_pred": tp + fp,
    }


def regression_metrics(
    df: DataFrame, keys: list[str] = (), y: str = S.TARGET, p: str = "prediction"
) -> DataFrame:
    return df.groupBy(*keys).agg(*regression_columns(y, p))


def clinical_metrics(
    df: DataFrame, threshold: float = S.LBW_GRAMS, keys: list[str] = (), y: str = S.TARGET,
    p: str = "prediction",
) -> DataFrame:
    """Truth and prediction cut at the threshold, compared; empty denominators give 0."""
    cells = df.groupBy(*keys).agg(*_clinical_counts(threshold, y, p))
    return cells.select(*keys, *[c.alias(name) for name, c in _clinical_rates().items()])


def all_metrics(
    df: DataFrame, keys: list[str] = (), threshold: float = S.LBW_GRAMS, y: str = S.TARGET,
    p: str = "prediction",
) -> DataFrame:
    """Regression and clinical metrics from one aggregate."""
    cells = df.groupBy(*keys).agg(*regression_columns(y, p), *_clinical_counts(threshold, y, p))
    return cells.select(*keys, *REGRESSION, *[c.alias(name) for name, c in _clinical_rates().items()])


def metric_row(scored: DataFrame, y: str = S.TARGET, p: str = "prediction") -> dict:
    """All metrics and the number of rows ``n`` as numbers, from one aggregate."""
    cells = scored.agg(
        F.count(F.lit(1)).alias("n"), *regression_columns(y, p), *_clinical_counts(S.LBW_GRAMS, y, p)
    )
    return cells.select("n", *REGRESSION, *[c.alias(name) for name, c in _clinical_rates().items()]).first().asDict()


def evaluate_split(model: Model, df: DataFrame, split_name: str = "val", y: str = S.TARGET) -> DataFrame:
    """One row of all metrics of a fitted model, named ``<split>_<metric>``."""
    row = all_metrics(model.transform(df), y=y)
    return row.select(*[F.col(c).alias(f"{split_name}_{c}") for c in row.columns])


def acceptance_gate(metrics: DataFrame, targets: dict[str, tuple[str, float]] = S.ACCEPTANCE, keys: list[str] = ()) -> DataFrame:
    """PASS or FAIL of each metric against its target, one row per metric."""
    checks = []
    for name, (direction, bound) in targets.items():
        value = F.col(name).cast("double")
        met = value < bound if direction == "<" else value > bound
        checks.append(F.struct(
            F.lit(name).alias("metric"), value.alias("value"), F.lit(direction).alias("direction"),
            F.lit(float(bound)).alias("bound"),
            F.when(met, "PASS").otherwise("FAIL").alias("verdict"),
        ))
    return metrics.select(*keys, F.inline(F.array(*checks)))
