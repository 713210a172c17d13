"""Cleaning: narrow projections and one filter, fused by Catalyst into the scan stage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from storkline import schema as S
from storkline.functions.columns import clip, flag, rint_to, strip


def drop_leakage(df: DataFrame) -> DataFrame:
    """Remove what is measured after birth, and the day of birth."""
    return df.drop(*S.LEAKAGE_COLUMNS)


def cast_booleans(df: DataFrame, columns: list[str] = S.BOOLEAN_COLUMNS) -> DataFrame:
    """Texts and booleans become 0/1 bytes; any other text is unknown; numbers stay."""
    types = dict(df.dtypes)
    changed = {}
    for name in columns:
        if types.get(name) == "boolean":
            changed[name] = F.col(name).cast("byte")
        elif types.get(name) == "string":
            text = F.lower(strip(name))
            changed[name] = F.when(text == "true", 1).when(text == "false", 0).cast("byte")
    return df.withColumns(changed) if changed else df


def null_sentinel(df: DataFrame, sentinels: dict[str, list] = S.SENTINELS) -> DataFrame:
    """Codes that stand for "unknown" become null."""
    present = {c: codes for c, codes in sentinels.items() if c in df.columns}
    return df.withColumns({
        c: F.when(~F.col(c).isin(codes), F.col(c)) for c, codes in present.items()
    }) if present else df


def lmp_is_unknown(column: str = "lmp") -> Column:
    text = strip(column)
    return text.isin(S.LMP_UNKNOWN) | text.rlike("^9+$")


def null_unknown_lmp(df: DataFrame) -> DataFrame:
    """Unknown last-menstrual-period texts become null; a partly unknown date is kept."""
    if "lmp" not in df.columns:
        return df
    return df.withColumn("lmp", F.when(~lmp_is_unknown(), F.col("lmp")))


def clip_ranges(df: DataFrame, ranges: dict[str, tuple] = S.CLIP_RANGES) -> DataFrame:
    """Limit clinical measures to their valid range."""
    types = dict(df.dtypes)
    return df.withColumns({
        c: clip(F.col(c), low, high).cast(types[c])
        for c, (low, high) in ranges.items() if c in types
    })


def weight_is_extreme(column: str = "weight_pounds") -> Column:
    low, high = S.VALID_POUNDS
    return (F.col(column) < low) | (F.col(column) > high)


def flag_outlier_weight(df: DataFrame) -> DataFrame:
    """0/1 flag for a birth weight outside the valid range."""
    if "weight_pounds" not in df.columns:
        return df
    return df.withColumn("outlier_weight", flag(weight_is_extreme()))


def convert_target(df: DataFrame) -> DataFrame:
    """Birth weight in grams, to a tenth of a gram."""
    if "weight_pounds" not in df.columns:
        return df
    return df.withColumn(S.TARGET, rint_to(F.col("weight_pounds") * S.GRAMS_PER_POUND, 1))


def drop_invalid_target(df: DataFrame) -> DataFrame:
    """Keep rows whose birth weight is known and valid (a null fails the filter)."""
    return df.filter(F.col("weight_pounds").between(*S.VALID_POUNDS))


def _count_if(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def cleaning_count_columns(columns: list[str]) -> list[Column]:
    """Aggregates over *raw* rows: what each cleaning step replaces, caps, flags or removes."""
    known = set(columns)
    counts = [F.count(F.lit(1)).alias("rows_in")]
    for name, codes in S.SENTINELS.items():
        if name in known:
            counts.append(_count_if(F.col(name).isin(codes)).alias(f"{name}_sentinels"))
    if "lmp" in known:
        # an empty date field is a null by now and was already unknown in the file
        counts.append(_count_if(lmp_is_unknown() | F.col("lmp").isNull()).alias("lmp_unknown"))
    for name, (low, high) in S.CLIP_RANGES.items():
        if name in known:
            value = F.col(name)
            if name in S.SENTINELS:
                value = F.when(~value.isin(S.SENTINELS[name]), value)
            counts.append(_count_if((value < low) | (value > high)).alias(f"{name}_capped"))
    if "weight_pounds" in known:
        pounds = F.col("weight_pounds")
        kept = pounds.between(*S.VALID_POUNDS)
        grams = rint_to(pounds * S.GRAMS_PER_POUND, 1)
        counts += [
            _count_if(weight_is_extreme()).alias("weight_outliers"),
            _count_if(pounds.isNull()).alias("weight_missing"),
            _count_if(kept).alias("rows_out"),
            F.avg(grams).alias("grams_mean"),
            F.stddev(grams).alias("grams_std"),
        ]
    return counts


def cleaning_counts(df: DataFrame) -> DataFrame:
    """One row of cleaning counts in one pass over the raw rows."""
    counts = df.agg(*cleaning_count_columns(df.columns))
    if "rows_out" not in counts.columns:
        return counts
    removed = F.col("rows_in") - F.col("rows_out")
    return counts.withColumn(
        "removed_pct", rint_to(100.0 * removed / F.greatest(F.col("rows_in"), F.lit(1)), 2)
    ).withColumns({"grams_mean": rint_to(F.col("grams_mean"), 1), "grams_std": rint_to(F.col("grams_std"), 1)})


def run_preprocessing(df: DataFrame, observation: Observation | None = None) -> DataFrame:
    """All cleaning steps. An ``Observation`` receives the counts of the job that runs anyway."""
    if observation is not None:
        df = df.observe(observation, *cleaning_count_columns(df.columns))
    for step in (
        drop_leakage, cast_booleans, null_sentinel, null_unknown_lmp, clip_ranges,
        flag_outlier_weight, convert_target, drop_invalid_target,
    ):
        df = df.transform(step)
    return df


def filter_by_value(df: DataFrame, column: str, value) -> DataFrame:
    """Subset such as one sex."""
    return df.filter(F.col(column) == F.lit(value))
