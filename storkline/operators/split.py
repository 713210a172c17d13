"""Split by year, split summaries and column selection."""

from __future__ import annotations

import logging
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storkline import schema as S
from storkline.functions.columns import null_percent, rint_to

log = logging.getLogger(__name__)


class Splits(NamedTuple):
    train: DataFrame
    val: DataFrame
    test: DataFrame


def add_split(
    df: DataFrame, val_start: int = S.VAL_START, test_start: int = S.TEST_START,
    year_col: str = "year_fix",
) -> DataFrame:
    """Adds ``split``; a row without a year belongs to no split and is removed."""
    if year_col not in df.columns:
        raise ValueError(f"no year column '{year_col}'; columns are {df.columns}")
    year = F.col(year_col)
    name = (
        F.when(year < val_start, "train")
        .when((year >= val_start) & (year < test_start), "val")
        .when(year >= test_start, "test")
    )
    return df.filter(year.isNotNull()).withColumn("split", name)


def temporal_split(
    df: DataFrame, val_start: int = S.VAL_START, test_start: int = S.TEST_START,
    year_col: str = "year_fix",
) -> Splits:
    """Three lazy views of the same rows, each with the year filter pushed to its scan."""
    if year_col not in df.columns:
        raise ValueError(f"no year column '{year_col}'; columns are {df.columns}")
    year = F.col(year_col)
    return Splits(
        df.filter(year < val_start),
        df.filter((year >= val_start) & (year < test_start)),
        df.filter(year >= test_start),
    )


def split_info(df: DataFrame, target: str | None = None) -> DataFrame:
    """Rows, share and year range per split; with a target also the low-birth-weight rate.

    One global aggregate turned into three rows, so an empty split shows with zero rows.
    """
    aggregates = [F.count("split").alias("total")]
    rows = []
    for split in S.SPLITS:
        inside = F.col("split") == split
        year = F.when(inside, F.col("year_fix"))
        aggregates += [
            F.count(F.when(inside, 1)).alias(f"{split}_rows"),
            F.min(year).alias(f"{split}_min"),
            F.max(year).alias(f"{split}_max"),
        ]
        fields = [
            F.lit(split).alias("split"),
            F.col(f"{split}_rows").alias("n_rows"),
            rint_to(100.0 * F.col(f"{split}_rows") / F.greatest("total", F.lit(1)), 1).alias("pct"),
            F.col(f"{split}_min").alias("year_min"),
            F.col(f"{split}_max").alias("year_max"),
        ]
        if target:
            low = F.when(inside, F.coalesce(F.col(target) < S.LBW_GRAMS, F.lit(False)).cast("double"))
            aggregates.append(F.avg(low).alias(f"{split}_lbw"))
            fields.append(rint_to(100.0 * F.col(f"{split}_lbw"), 2).alias("lbw_pct"))
        rows.append(F.struct(*fields))
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


def split_summary(df: DataFrame, target: str = S.TARGET) -> DataFrame:
    return split_info(df, target)


def warn_empty_splits(info: DataFrame) -> list[str]:
    """Names of empty splits, logged; ``info`` is the three-row result of ``split_info``."""
    empty = [r.split for r in info.filter("n_rows = 0").select("split").collect()]
    for name in empty:
        log.warning("split %s is empty", name)
    return empty


def feature_columns(df: DataFrame) -> list[str]:
    """Every column but targets, flags and traceability columns."""
    return [c for c in df.columns if c not in S.NON_FEATURE_COLUMNS]


def _need_target(df: DataFrame, target: str) -> None:
    if target not in df.columns:
        raise ValueError(f"no target column '{target}'")


def get_xy(df: DataFrame, target: str = S.TARGET) -> DataFrame:
    """All generic feature columns and the target, in one frame so that rows stay aligned."""
    _need_target(df, target)
    return df.select(*[c for c in feature_columns(df) if c != target], target)


def model_matrix(
    df: DataFrame, target: str = S.TARGET, keep: tuple[str, ...] = (), dtype: str = "double"
) -> DataFrame:
    """The model features as ``dtype``, the target, and any columns to ``keep``."""
    _need_target(df, target)
    absent = [c for c in S.MODEL_FEATURES if c not in df.columns]
    if absent:
        log.warning("model features that are absent and skipped: %s", absent)
    present = [c for c in S.MODEL_FEATURES if c not in absent]
    return df.select(*keep, *[F.col(c).cast(dtype) for c in present], target)


def feature_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Name, type and % missing of each feature, from one aggregate row."""
    columns = columns or feature_columns(df)
    types = dict(df.dtypes)
    wide = df.agg(*[null_percent(c, 1).alias(c) for c in columns])
    out = wide.unpivot([], columns, "feature", "missing_pct")
    dtype = F.create_map(*[F.lit(x) for c in columns for x in (c, types[c])])
    return out.select("feature", dtype[F.col("feature")].alias("dtype"), "missing_pct")
