"""Derived features: column expressions only, no shuffle."""

from __future__ import annotations

import logging
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storkline import schema as S
from storkline.functions.columns import flag, rint_to

log = logging.getLogger(__name__)


def add_weight_gain_kg(df: DataFrame) -> DataFrame:
    if "weight_gain_pounds" not in df.columns:
        return df
    return df.withColumn("weight_gain_kg", rint_to(F.col("weight_gain_pounds") * S.KG_PER_POUND, 2))


def add_parity(df: DataFrame) -> DataFrame:
    """Prior births, living, dead and stillborn; an unknown count adds nothing."""
    parts = ["born_alive_alive", "born_alive_dead", "born_dead"]
    absent = [c for c in parts if c not in df.columns]
    if absent:
        log.warning("parity needs columns that are absent: %s", absent)
        return df
    total = sum((F.coalesce(F.col(c), F.lit(0)) for c in parts), F.lit(0))
    return df.withColumn("parity", total.cast("short"))


def add_multiple_birth(df: DataFrame) -> DataFrame:
    if "plurality" not in df.columns:
        return df
    return df.withColumn("is_multiple_birth", flag(F.col("plurality") > 1))


def add_lmp_known(df: DataFrame) -> DataFrame:
    if "lmp" not in df.columns:
        return df
    return df.withColumn("lmp_known", F.col("lmp").isNotNull().cast("byte"))


def add_cyclical_month(df: DataFrame) -> DataFrame:
    """Month on the unit circle, so that December is next to January."""
    if "month" not in df.columns:
        return df
    angle = F.lit(2 * math.pi) * F.col("month") / F.lit(12)
    return df.withColumns({
        "birth_month_sin": rint_to(F.sin(angle), 6),
        "birth_month_cos": rint_to(F.cos(angle), 6),
    })


def cut(value: Column, edges: list[float], labels: list, include_lowest: bool = False) -> Column:
    """Label of the right-closed bin (edges[i], edges[i+1]]; null outside all bins."""
    out = None
    for low, high, label in zip(edges, edges[1:], labels):
        inside = (value > low) & (value <= high)
        if include_lowest and low == edges[0]:
            inside = (value >= low) & (value <= high)
        out = F.when(inside, F.lit(label)) if out is None else out.when(inside, F.lit(label))
    return out


def add_mother_age_group(df: DataFrame) -> DataFrame:
    """Ordinal 0 (teens) to 3 (forties and over)."""
    if "mother_age" not in df.columns:
        return df
    group = cut(F.col("mother_age"), S.MOTHER_AGE_EDGES, [0, 1, 2, 3], include_lowest=True)
    return df.withColumn("mother_age_group", group.cast("byte"))


def add_gestation_flags(df: DataFrame) -> DataFrame:
    if "gestation_weeks" not in df.columns:
        return df
    weeks = F.col("gestation_weeks")
    return df.withColumns({
        "gestation_preterm": flag(weeks < S.PRETERM_BELOW),
        "gestation_post_term": flag(weeks > S.POST_TERM_ABOVE),
    })


def engineer_features(df: DataFrame) -> DataFrame:
    for step in (
        add_weight_gain_kg, add_parity, add_multiple_birth, add_lmp_known, add_cyclical_month,
        add_mother_age_group, add_gestation_flags,
    ):
        df = df.transform(step)
    return df


def weight_category(
    grams: Column, edges: list[float] = (0, S.VLBW_GRAMS, S.LBW_GRAMS, S.MACROSOMIA_GRAMS, 9999)
) -> Column:
    """Clinical category of a weight; pass infinite outer edges to keep every weight."""
    return cut(grams, list(edges), S.WEIGHT_CATEGORIES)


OPEN_WEIGHT_EDGES = (
    float("-inf"), S.VLBW_GRAMS, S.LBW_GRAMS, S.MACROSOMIA_GRAMS, float("inf"),
)


def add_weight_category(df: DataFrame, source: str = S.TARGET, open_ended: bool = False) -> DataFrame:
    edges = OPEN_WEIGHT_EDGES if open_ended else (0, *OPEN_WEIGHT_EDGES[1:-1], 9999)
    return df.withColumn("weight_category", weight_category(F.col(source), edges))


def derived_columns(before: DataFrame, after: DataFrame) -> list[str]:
    """Names that ``after`` has and ``before`` has not, in order."""
    known = set(before.columns)
    return [c for c in after.columns if c not in known]
