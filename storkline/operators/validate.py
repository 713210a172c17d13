"""Data expectations on the three splits: one aggregate pass, one row per check and split."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storkline import schema as S
from storkline.operators.split import Splits

FLAGS = ["is_male", "mother_married"]
ENGINEERED_FLAGS = ["gestation_preterm", "gestation_post_term", "is_multiple_birth", "lmp_known"]


def column_set_diff(left: DataFrame, right: DataFrame) -> tuple[set[str], set[str]]:
    """Columns only in the left and only in the right frame."""
    return set(left.columns) - set(right.columns), set(right.columns) - set(left.columns)


def _outside(column: str, low: float, high: float) -> Column:
    return (F.col(column) < low) | (F.col(column) > high)


def row_checks(columns: set[str]) -> dict[str, Column]:
    """Check name -> condition that a violating row meets; nulls violate only where said."""
    checks: dict[str, tuple[list[str], Column]] = {
        "target_not_null": ([S.TARGET], F.col(S.TARGET).isNull()),
        "target_in_range": ([S.TARGET], _outside(S.TARGET, *S.VALID_GRAMS)),
        "plurality_in_range": (["plurality"], _outside("plurality", 1, 9)),
        "mother_age_group_in_range": (["mother_age_group"], ~F.col("mother_age_group").isin(0, 1, 2, 3)),
        "grams_match_pounds": (
            [S.TARGET, "weight_pounds"],
            F.abs(F.col(S.TARGET) - F.col("weight_pounds") * S.GRAMS_PER_POUND) >= 1.0,
        ),
        "parity_not_negative": (["parity"], F.col("parity") < 0),
        "weight_gain_kg_not_negative": (["weight_gain_kg"], F.col("weight_gain_kg") < 0),
        "term_flags_exclusive": (
            ["gestation_preterm", "gestation_post_term"],
            (F.col("gestation_preterm") == 1) & (F.col("gestation_post_term") == 1),
        ),
        "year_within_split": (
            ["year_fix"],
            F.when(F.col("split") == "train", F.col("year_fix") >= S.VAL_START)
            .when(F.col("split") == "val", _outside("year_fix", S.VAL_START, S.TEST_START - 1))
            .otherwise(F.col("year_fix") < S.TEST_START),
        ),
    }
    for name, (low, high) in S.CLIP_RANGES.items():
        checks[f"{name}_in_range"] = ([name], _outside(name, low, high))
    for name in FLAGS + ENGINEERED_FLAGS:
        checks[f"{name}_is_flag"] = ([name], ~F.col(name).isin(0, 1))
    for name in ("birth_month_sin", "birth_month_cos"):
        checks[f"{name}_in_range"] = ([name], _outside(name, -1.0, 1.0))
    return {name: c for name, (needs, c) in checks.items() if columns.issuperset(needs)}


def run_expectations(splits: Splits, expected_files: int | None = None) -> DataFrame:
    """``(check, split, violations, passed)`` over all rows of all splits.

    Checks on columns are known from the schemas; a check whose optional column is absent is not
    listed.
    """
    frames = dict(zip(S.SPLITS, splits))
    columns = set().union(*[df.columns for df in frames.values()])
    by_row = row_checks(columns)

    # a marker row per split keeps an empty split in the result
    spark = frames["train"].sparkSession
    parts = [df.withColumns({"split": F.lit(name), "_row": F.lit(1)}) for name, df in frames.items()]
    parts.append(spark.createDataFrame([(name,) for name in frames], "split string"))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)

    real = F.col("_row").isNotNull()
    aggregates = [F.count("_row").alias("n")]
    aggregates += [F.count(F.when(real & c, 1)).alias(name) for name, c in by_row.items()]
    if S.TARGET in columns:
        low = F.when(F.col(S.TARGET) < S.LBW_GRAMS, 1.0).otherwise(0.0)
        aggregates += [F.avg(S.TARGET).alias("_mean"), (100.0 * F.avg(F.when(real, low))).alias("_lbw")]
    if expected_files is not None and "source_file" in columns:
        aggregates.append(F.collect_set("source_file").alias("_files"))
    per_split = rows.groupBy("split").agg(*aggregates)

    # windows over three rows
    everything = Window.partitionBy()
    share = F.col("n") * 100.0 / F.greatest(F.sum("n").over(everything), F.lit(1))
    per_split = per_split.withColumn("_share", share)

    def failed(condition: Column) -> Column:
        return F.when(condition, F.lit(0)).otherwise(F.lit(1)).cast("long")

    def by_split(values: dict[str, int]) -> Column:
        return F.create_map(*[F.lit(x) for item in values.items() for x in item])[F.col("split")].cast("long")

    results = {
        "required_columns": by_split({n: sum(c not in df.columns for c in S.REQUIRED_COLUMNS) for n, df in frames.items()}),
        "no_leakage_columns": by_split({n: sum(c in df.columns for c in S.APGAR_COLUMNS) for n, df in frames.items()}),
        "same_columns": by_split({n: len(columns - set(df.columns)) for n, df in frames.items()}),
        "split_not_empty": failed(F.col("n") > 0),
    }
    results |= {name: F.col(name) for name in by_row}
    train_only = {"train_share": failed(F.col("_share") >= 50.0)}
    if S.TARGET in columns:
        train_only["target_mean_plausible"] = failed(F.col("_mean").between(2800, 3800))
        train_only["lbw_rate_plausible"] = failed(F.col("_lbw").between(3.0, 20.0))
    if expected_files is not None and "source_file" in columns:
        files = F.size(F.array_distinct(F.flatten(F.collect_set("_files").over(everything))))
        per_split = per_split.withColumn("_n_files", files)
        train_only["all_files_present"] = failed(F.col("_n_files") == expected_files)

    lines = [F.struct(F.lit(n).alias("check"), c.alias("violations")) for n, c in results.items()]
    lines += [
        F.struct(F.lit(n).alias("check"), F.when(F.col("split") == "train", c).alias("violations"))
        for n, c in train_only.items()
    ]
    long = per_split.select("split", F.inline(F.array(*lines))).filter(F.col("violations").isNotNull())
    return long.select("check", "split", "violations", (F.col("violations") == 0).cast("int").alias("passed"))
