"""Positions within large groups without ordering a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_TASK = 1_000
SLOT_LIMIT = 1 << 20


def slots_for(largest: int, rows_per_task: int = ROWS_PER_TASK) -> int:
    """Slots so that a group of ``largest`` rows gives about ``rows_per_task`` rows each."""
    return min(SLOT_LIMIT, max(1, -(-largest // rows_per_task)))


def slot_of(hashed: Column, slots: int) -> Column:
    """Which of ``slots`` equal ranges of the 64-bit hash a row falls in; grows with the hash."""
    return F.floor((F.shiftrightunsigned(hashed.bitwiseXOR(F.lit(-(1 << 63))), 11)) * (slots / float(1 << 53)))


def ranked(
    df: DataFrame, group: list[str], hashed: str, ties: list[str], slots: int, name: str, about: DataFrame | None = None
) -> DataFrame:
    """Adds ``name``, the 0-based position of a row within its group by ``hashed``, then ``ties``.

    Every group is dealt into ``slots`` ranges of the hash. A range is ordered on its own; the number
    of rows in the ranges before it, one row per group and range, gives its first position. Null is a
    group of its own. ``about`` holds further columns, one row per group, to be added.
    """
    slotted = df.withColumn("_slot", slot_of(F.col(hashed), slots))
    local = Window.partitionBy(*group, "_slot").orderBy(hashed, *ties)
    counts = slotted.groupBy(*group, "_slot").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], F.col("_slot").alias("_s"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"),
    )
    more = []
    if about is not None:
        more = [c for c in about.columns if c not in group]
        about = about.select(*[F.col(g).alias(f"_a{i}") for i, g in enumerate(group)], *more)
        same = [F.col(f"_g{i}").eqNullSafe(F.col(f"_a{i}")) for i in range(len(group))]
        firsts = firsts.join(about, same, "left").drop(*[f"_a{i}" for i in range(len(group))])
    same = [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(group)]
    placed = slotted.withColumn("_place", F.row_number().over(local) - 1)
    joined = placed.join(firsts, [*same, F.col("_slot") == F.col("_s")], "left")
    return joined.select(*df.columns, (F.col("_place") + F.col("_first")).alias(name), *more)
