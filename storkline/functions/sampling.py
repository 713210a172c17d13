"""Reproducible samples and folds by an integer hash of the record key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PRIME = 2147483647
# a coarse hash has at most PRIME / COARSE = 2**20 values
COARSE = 2048


def key_hash(key: Column | str, seed: int = 42) -> Column:
    """Hash of an integer key in [0, 2**31 - 1), the same in any SQL engine (no overflow)."""
    key = F.col(key) if isinstance(key, str) else key
    mixed = F.pmod(F.pmod(key, F.lit(PRIME)) * 48271 + F.lit(seed), F.lit(PRIME)).cast("long")
    return F.pmod(F.pmod(mixed * mixed, F.lit(PRIME)) * 69621, F.lit(PRIME)).cast("long")


def sample_n(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows without replacement, all rows when there are fewer.

    A count per coarse hash finds how far the smallest ``n`` hashes reach, so that the final
    ordered limit sees about ``n`` rows instead of ``n`` from every task.
    """
    hashed = df.withColumn("_hash", key_hash(key, seed))
    coarse = F.floor(F.col("_hash") / COARSE)
    per_hash = hashed.groupBy(coarse.alias("_coarse")).agg(F.count(F.lit(1)).alias("_n"))
    reach = per_hash.withColumn("_upto", F.sum("_n").over(Window.orderBy("_coarse")))
    last = reach.filter(F.col("_upto") >= n).agg(F.min("_coarse")).scalar()
    near = hashed.filter(coarse <= F.coalesce(last, F.lit(PRIME)))
    return near.orderBy("_hash", key).limit(n).drop("_hash")


def add_fold(df: DataFrame, k: int, key: str, seed: int = 42, name: str = "fold") -> DataFrame:
    """Fold number 0..k-1 by key, so that copies of a record share a fold."""
    return df.withColumn(name, F.pmod(key_hash(key, seed), F.lit(k)).cast("int"))
