"""Partitioning ahead of iterative work."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Even partitions, as many as a shuffle has unless given.

    Iterative training passes over the same partitions many times, so a few large or unsplittable files are
    worth one exchange. The rule does not look at the data or the cores, so a fit that draws rows by
    partition draws alike on any cluster with the same setting.
    """
    return df.repartition(partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
