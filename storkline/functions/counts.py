"""Value counts and exact statistics on them.

Most profiling reads the data once: rows are counted by value with a map-side partial aggregate,
which also takes the skew out of hot values. Quantiles, histograms, densities and drift then work
on the counted values. Running totals never order a whole column in one task: approximate quantiles of
the distinct values cut them into ordered buckets of similar size, whatever their distribution; each
bucket is ordered on its own, and bucket totals give the offsets. Sums of squares are taken around the
mean, which those totals give as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 128
# accuracy of the splitting quantiles: 1 / SPLIT_ACCURACY of the distinct values
SPLIT_ACCURACY = 2_000


def value_counts_long(df: DataFrame, columns: list[str], keys: list[str] = ()) -> DataFrame:
    """``(keys..., feature, value, n)`` for numeric columns; nulls are counted under a null value.

    Rows are grouped by the position of a column, which hashes faster than its name. Rows with a
    null key belong to no group.
    """
    values = F.array(*[F.col(c).cast("double") for c in columns])
    long = df.dropna(subset=list(keys)) if keys else df
    long = long.select(*keys, F.posexplode(values).alias("_feature", "value"))
    counts = long.groupBy(*keys, "_feature", "value").agg(F.count(F.lit(1)).alias("n"))
    names = F.array(*[F.lit(c) for c in columns])
    # a join on a column that cannot be null needs no null filter, so scans stay identical and shared
    name = F.coalesce(F.get(names, F.col("_feature")), F.lit(""))
    return counts.select(*keys, name.alias("feature"), "value", "n")


def value_counts_of(df: DataFrame, column: str, keys: list[str] = ()) -> DataFrame:
    """``(keys..., value, n)`` of one numeric column, nulls left out."""
    known = df.dropna(subset=[*keys, column]).select(*keys, F.col(column).cast("double").alias("value"))
    return known.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("n"))


def bucketed(counts: DataFrame, keys: list[str], value: str, n: str) -> DataFrame:
    """Adds ``_bucket``, the number of splitting values not above a value; null is in bucket 0.

    The splitting values of a key are approximate quantiles of its distinct values, so a bucket gets
    about 1 / ``BUCKETS`` of them and the final ranks stay exact. One row per key is shared. ``n`` holds
    counts; looking at them keeps this branch's counting the same as the others', so that all share a scan.
    """
    levels = [i / BUCKETS for i in range(1, BUCKETS)]
    cuts = F.percentile_approx(F.when(F.col(n) >= 0, F.col(value)), levels, SPLIT_ACCURACY).alias("_cuts")
    if keys:
        split = counts.groupBy(*keys).agg(cuts)
        joined = counts.join(F.broadcast(split), keys, "left")
    else:
        joined = counts.crossJoin(F.broadcast(counts.agg(cuts)))
    below = F.size(F.filter("_cuts", lambda c: c <= F.col(value)))
    return joined.withColumn("_bucket", F.when(F.col("_cuts").isNull() | F.col(value).isNull(), 0).otherwise(below)).drop("_cuts")


def running_totals(counts: DataFrame, keys: list[str], value: str, sums: list[str]) -> DataFrame:
    """Adds ``<sum>_upto`` (total of rows with a value not above this one) and ``<sum>_total``.

    ``counts`` must hold each value once per key, without null keys; the first of ``sums`` is never negative.
    """
    dealt = bucketed(counts, keys, value, sums[0])
    inside = Window.partitionBy(*keys, "_bucket").orderBy(value)
    local = dealt.select("*", *[F.sum(s).over(inside).alias(f"_{s}_local") for s in sums])

    per_bucket = dealt.groupBy(*keys, "_bucket").agg(*[F.sum(s).alias(s) for s in sums])
    # at most one row per bucket, a number bounded above
    whole = Window.partitionBy(*keys)
    below = whole.orderBy("_bucket")
    offsets = per_bucket.select(
        *keys, "_bucket",
        *[(F.sum(s).over(below) - F.col(s)).alias(f"_{s}_below") for s in sums],
        *[F.sum(s).over(whole).alias(f"{s}_total") for s in sums],
    )
    joined = local.join(offsets, [*keys, "_bucket"])
    return joined.select(
        *counts.columns,
        *[(F.col(f"_{s}_local") + F.col(f"_{s}_below")).alias(f"{s}_upto") for s in sums],
        *[f"{s}_total" for s in sums],
    )


def quantiles(
    counts: DataFrame, keys: list[str], probabilities: dict[str, float], extra: list[Column] = ()
) -> DataFrame:
    """Exact, linearly interpolated quantiles per key; ``probabilities`` maps names to levels.

    ``extra`` aggregates over the counts' columns and ``_mean``, the key's mean, come from the same pass. A
    null value weighs nothing in the quantiles. Weighing instead of filtering leaves the counting scan as it is, so
    that it can be shared with other uses of the same counts.
    """
    weight = F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0)
    weighed = counts.select("*", weight.alias("_w"), F.coalesce(weight * F.col("value"), F.lit(0.0)).alias("_wv"))
    ranked = running_totals(weighed, keys, "value", ["_w", "_wv"])
    ranked = ranked.withColumn("_mean", F.col("_wv_total") / F.nullif(F.col("_w_total"), F.lit(0)))
    first, last = F.col("_w_upto") - F.col("_w"), F.col("_w_upto") - 1  # 0-based ranks held by a value
    picks = []
    for name, p in probabilities.items():
        position = F.lit(float(p)) * (F.col("_w_total") - 1)
        low, high = F.floor(position), F.ceil(position)
        picks += [
            F.max(F.when((first <= low) & (low <= last), F.col("value"))).alias(f"_{name}_low"),
            F.max(F.when((first <= high) & (high <= last), F.col("value"))).alias(f"_{name}_high"),
            F.max(position - low).alias(f"_{name}_part"),
        ]
    picked = ranked.groupBy(*keys).agg(*picks, *extra)
    others = [c for c in picked.columns if c not in keys][len(picks):]
    return picked.select(*keys, *[
        (F.col(f"_{n}_low") + (F.col(f"_{n}_high") - F.col(f"_{n}_low")) * F.col(f"_{n}_part")).alias(n)
        for n in probabilities
    ], *others)


QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def centred_squares() -> Column:
    """Aggregate next to quantiles: sum of squared differences from the mean, free of its rounding error."""
    apart = F.col("value") - F.col("_mean")
    known = F.sum(F.when(F.col("value").isNotNull(), F.col("n")))
    drift = F.sum(F.col("n") * apart)
    return F.greatest(F.sum(F.col("n") * apart * apart) - drift * drift / known, F.lit(0.0))


def moment_sums() -> list[Column]:
    """Aggregates next to quantiles that ``finish_moments`` turns into moments."""
    n, v = F.col("n"), F.col("value")
    known = F.when(v.isNotNull(), n)
    return [
        F.coalesce(F.sum(known), F.lit(0).cast("long")).alias("_n"), F.sum(n * v).alias("_s1"),
        centred_squares().alias("_s2"), F.min(v).alias("min"), F.max(v).alias("max"),
    ]


def finish_moments(sums: DataFrame, keep: list[str]) -> DataFrame:
    """n, mean, sample and population deviation, min and max next to the columns to ``keep``."""
    n = F.col("_n")
    squares = F.when(n > 0, F.col("_s2"))
    return sums.select(
        *keep, n.alias("n"),
        (F.col("_s1") / F.nullif(n, F.lit(0))).alias("mean"),
        F.sqrt(squares / F.nullif(n - 1, F.lit(0))).alias("std"),
        F.sqrt(squares / F.nullif(n, F.lit(0))).alias("std_pop"),
        "min", "max",
    )


def moments(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Moments per key from counted values: means first, one row per key, then squares around them."""
    n, v = F.col("n"), F.col("value")
    mean = (F.sum(n * v) / F.nullif(F.sum(F.when(v.isNotNull(), n)), F.lit(0))).alias("_mean")
    if keys:
        centred = counts.join(counts.groupBy(*keys).agg(mean), keys)
    else:
        centred = counts.crossJoin(F.broadcast(counts.agg(mean)))
    return finish_moments(centred.groupBy(*keys).agg(*moment_sums()), keys)


def describe(counts: DataFrame, keys: list[str], extra: list[Column] = ()) -> DataFrame:
    """Moments and quartiles per key; a column without values keeps its row with n = 0."""
    both = quantiles(counts, keys, QUARTILES, [*moment_sums(), *extra])
    sums = {"_n", "_s1", "_s2", "min", "max"}
    return finish_moments(both, [c for c in both.columns if c not in sums])
