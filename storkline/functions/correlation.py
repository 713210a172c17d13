"""Correlations of many column pairs as matrix products per task."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storkline.functions.columns import clip

# a deviation below 1e-14 of the mean is rounding: the column is constant
CONSTANT = 1e-28


def pair_moments(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(i, j, n, x, y, xx, yy, xy)`` per task and pair of columns, over rows where both are known.

    ``x`` and ``y`` are means, ``xx``, ``yy`` and ``xy`` sums of products around them. A task adds up products
    of masked matrices, batch by batch, and emits one row per pair whatever its number of rows. Values are
    taken relative to the first known one of a column, so that products keep their digits. NaN counts as
    unknown.
    """
    doubles = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    k = len(columns)

    def scan(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        shift = np.full(k, np.nan)
        n, x, xx, xy = (np.zeros((k, k)) for _ in range(4))
        for batch in batches:
            values = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1).astype(np.float64)
            known = ~np.isnan(values)
            fresh = np.flatnonzero(np.isnan(shift) & known.any(axis=0))
            shift[fresh] = values[known.argmax(axis=0)[fresh], fresh]
            values = np.where(known, values - np.nan_to_num(shift), 0.0)
            mask = known.astype(np.float64)
            n += mask.T @ mask
            x += values.T @ mask
            xx += (values * values).T @ mask
            xy += values.T @ values
        shift, some = np.nan_to_num(shift), np.maximum(n, 1.0)
        mean = x / some
        i, j = np.triu_indices(k, 1)
        around, both = xx - x * mean, xy - x * mean.T
        yield pa.RecordBatch.from_pydict({
            "i": i.astype(np.int32), "j": j.astype(np.int32), "n": n[i, j], "x": mean[i, j] + shift[i], "y": mean[j, i] + shift[j],
            "xx": around[i, j], "yy": around[j, i], "xy": both[i, j],
        })

    return doubles.mapInArrow(scan, "i int, j int, n double, x double, y double, xx double, yy double, xy double")


def pair_totals(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(i, j, n, mx, my, xx, yy, xy)`` per pair of positions, ``i < j``: means and sums of products around them.

    The tasks' moments are moved to the common mean before they are added up.
    """
    n, pair = F.col("n"), Window.partitionBy("i", "j")
    means = {f"m{c}": F.sum(n * F.col(c)).over(pair) / F.nullif(F.sum(n).over(pair), F.lit(0.0)) for c in "xy"}
    moved = pair_moments(df, columns).withColumns(means)
    dx, dy = F.col("x") - F.col("mx"), F.col("y") - F.col("my")
    return moved.groupBy("i", "j").agg(
        F.sum("n").alias("n"), F.max("mx").alias("mx"), F.max("my").alias("my"), F.sum(F.col("xx") + n * dx * dx).alias("xx"),
        F.sum(F.col("yy") + n * dy * dy).alias("yy"), F.sum(F.col("xy") + n * dx * dy).alias("xy"),
    )


def varies(squares: str, mean: str) -> Column:
    """The sum of squares around a mean, null where it is only rounding."""
    return F.when(F.col(squares) > CONSTANT * F.col("n") * F.col(mean) * F.col(mean), F.col(squares))


def pair_correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(i, j, r)``: Pearson correlation per pair of positions, ``i < j``; null where a side is constant."""
    r = F.col("xy") / F.nullif(F.sqrt(varies("xx", "mx")) * F.sqrt(varies("yy", "my")), F.lit(0.0))
    return pair_totals(df, columns).select("i", "j", clip(r, -1.0, 1.0).alias("r"))


def pair_lines(df: DataFrame, columns: list[str], target: str) -> DataFrame:
    """``(i, n, slope, intercept)``: least-squares line of the target on each column, null on a constant one."""
    last = len(columns)
    totals = pair_totals(df, [*columns, target]).filter(F.col("j") == last)
    slope = F.col("xy") / F.nullif(varies("xx", "mx"), F.lit(0.0))
    lines = totals.withColumn("slope", slope)
    return lines.select("i", F.col("n").cast("long").alias("n"), "slope", (F.col("my") - F.col("slope") * F.col("mx")).alias("intercept"))
