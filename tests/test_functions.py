import math
import random
import statistics
from collections import Counter

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import values
from storkline.functions.columns import clip, flag, paired_columns, ratio, rint_to, strip
from storkline.functions.counts import (
    bucketed, describe, moments, quantiles, running_totals, value_counts_long, value_counts_of,
)
from storkline.functions.joins import join_lookup
from storkline.functions.normal import normal_quantile
from storkline.functions.sampling import PRIME, add_fold, key_hash, sample_n
from storkline.operators.model import fit_statistics


def numbers(spark, xs, name="x"):
    return spark.createDataFrame([(x,) for x in xs], f"{name} double")


def test_rounding_is_half_to_even(spark):
    xs = [0.25, 0.35, 2.5, -0.25, 1234.05, None]
    got = values(numbers(spark, xs).select(rint_to(F.col("x"), 1).alias("r")), "r")
    assert got[:-1] == [float(np.round(x, 1)) for x in xs[:-1]]
    assert got[-1] is None


def test_clip_keeps_null(spark):
    got = values(numbers(spark, [None, 1.0, 30.0, 99.0]).select(clip(F.col("x"), 20, 44).alias("c")), "c")
    assert got == [None, 20.0, 30.0, 44.0]


def test_flag_of_unknown_is_zero(spark):
    assert values(numbers(spark, [None, 1.0, 3.0]).select(flag(F.col("x") > 1).alias("f")), "f") == [0, 0, 1]


def test_ratio_of_empty_denominator(spark):
    df = spark.createDataFrame([(1, 0), (1, 2)], "a int, b int")
    assert values(df.select(ratio(F.col("a"), F.col("b")).alias("r")), "r") == [0.0, 0.5]


def test_strip_all_whitespace(spark):
    df = spark.createDataFrame([("\t True \n",)], "t string")
    assert values(df.select(strip("t").alias("s")), "s") == ["True"]


def test_paired_columns_are_row_wise(spark):
    df = spark.createDataFrame([(1, 2.0, None)], "a int, b double, c double")
    got = sorted(tuple(r) for r in paired_columns(df, [("a", "b"), ("b", "a")]).collect())
    assert got == [(0, 1.0, 2.0), (1, 2.0, 1.0)]


@pytest.mark.parametrize("xs", [
    [1.7e9 + i * 0.864 for i in range(100_000)], [i * 3e-8 for i in range(100_000)], [float(i) for i in range(-50_000, 50_000)],
    [1.7e308 * (i / 3000) for i in range(-3000, 3001)],
])
def test_buckets_are_even_and_ordered(spark, xs):
    counts = numbers(spark, xs).select(F.col("x").alias("value"), F.lit(1).alias("n"))
    rows = sorted((r.value, r._bucket) for r in bucketed(counts, [], "value", "n").collect())
    assert [b for _, b in rows] == sorted(b for _, b in rows)
    sizes = Counter(b for _, b in rows)
    assert max(sizes.values()) <= 0.1 * len(xs)


def test_moments_far_from_zero(spark):
    xs = [1.7e9, 1.7e9 + 1, 1.7e9 + 2, None]
    counts = value_counts_long(numbers(spark, xs), ["x"])
    got = describe(counts, ["feature"]).first()
    assert got.std == pytest.approx(1.0, rel=1e-12) and got.std_pop == pytest.approx(math.sqrt(2 / 3), rel=1e-12)
    assert moments(counts, ["feature"]).first().std == got.std
    fitted = fit_statistics(numbers(spark, xs), ["x"], []).first()
    # the median fills the missing value
    assert (fitted.fill, fitted.mean) == (1.7e9 + 1, 1.7e9 + 1) and fitted.std_pop == pytest.approx(math.sqrt(0.5), rel=1e-12)


def test_running_totals_match_a_plain_sum(spark):
    draw = random.Random(2)
    rows = [(k, float(v), draw.randint(1, 9)) for k in ("a", "b") for v in {draw.randint(-500, 500) for _ in range(200)}]
    df = spark.createDataFrame(rows, "k string, value double, n long")
    for r in running_totals(df, ["k"], "value", ["n"]).collect():
        same = [(v, n) for k, v, n in rows if k == r.k]
        assert r.n_upto == sum(n for v, n in same if v <= r.value)
        assert r.n_total == sum(n for _, n in same)


def test_quantiles_and_moments_match_numpy(spark):
    rng = np.random.default_rng(3)
    # a third of the rows hold one value
    data = {"x": np.concatenate([rng.normal(0, 100, 400), np.full(200, 7.0)]), "y": rng.integers(0, 5, 600).astype(float)}
    rows = [(float(a), None if i % 7 == 0 else float(b)) for i, (a, b) in enumerate(zip(data["x"], data["y"]))]
    df = spark.createDataFrame(rows, "x double, y double")
    levels = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    counts = value_counts_long(df, ["x", "y"])
    got = {r.feature: r for r in quantiles(counts, ["feature"], levels).collect()}
    shape = {r.feature: r for r in moments(counts, ["feature"]).collect()}
    for i, name in enumerate(("x", "y")):
        known = np.array([r[i] for r in rows if r[i] is not None])
        for level, p in levels.items():
            assert got[name][level] == pytest.approx(np.quantile(known, p), abs=1e-9)
        assert shape[name].n == len(known)
        assert shape[name].mean == pytest.approx(known.mean())
        assert shape[name].std == pytest.approx(known.std(ddof=1))
        assert shape[name].std_pop == pytest.approx(known.std())


def test_describe_keeps_a_column_without_values(spark):
    df = spark.createDataFrame([(1.0, None)], "x double, y double")
    got = {r.feature: r for r in describe(value_counts_long(df, ["x", "y"]), ["feature"]).collect()}
    assert got["y"].n == 0 and got["y"].median is None
    assert got["x"].n == 1 and got["x"].std is None and got["x"].median == 1.0


def test_value_counts_leave_out_null_keys(spark):
    df = spark.createDataFrame([("a", 1.0), (None, 1.0), ("a", None)], "k string, x double")
    assert [tuple(r) for r in value_counts_of(df, "x", ["k"]).collect()] == [("a", 1.0, 1)]


def test_normal_quantile(spark):
    ps = [1e-300, 1e-12, 1e-4, 0.02, 0.1, 0.425, 0.5, 0.6, 0.93, 0.9999, 1 - 1e-12]
    got = values(numbers(spark, ps).select("x", normal_quantile(F.col("x")).alias("z")).orderBy("x"), "z")
    for z, p in zip(got, sorted(ps)):
        assert z == pytest.approx(statistics.NormalDist().inv_cdf(p), rel=1e-12, abs=1e-12)


def test_key_hash_formula(spark):
    keys = [0, 1, 2**31, 599_999_123_456_789_012, -5]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    mixed = [((k % PRIME) * 48271 + 42) % PRIME for k in keys]
    assert values(df.select(key_hash("k").alias("h")), "h") == [m * m % PRIME * 69621 % PRIME for m in mixed]


def test_sample_is_exact_and_repeatable(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    one = set(values(sample_n(df, 700, "k"), "k"))
    again = set(values(sample_n(df.repartition(7), 700, "k"), "k"))
    assert len(one) == 700 and one == again
    assert one != set(values(sample_n(df, 700, "k", seed=1), "k"))
    assert sample_n(df, 10_000, "k").count() == 5000


def test_sample_with_one_hot_key(spark):
    df = spark.range(3000).select(F.when(F.col("id") < 1000, 7).otherwise(F.col("id")).alias("k"))
    assert sample_n(df, 1500, "k").count() == 1500


def test_sample_spreads_over_the_keys(spark):
    ks = values(sample_n(spark.range(10_000).withColumnRenamed("id", "k"), 2000, "k"), "k")
    per_tenth = np.histogram(ks, bins=10, range=(0, 10_000))[0]
    assert per_tenth.min() > 120 and per_tenth.max() < 280


def test_folds_cover_all_rows(spark):
    folded = add_fold(spark.range(1000).withColumnRenamed("id", "k"), 5, "k").groupBy("fold").count().collect()
    assert sorted(r.fold for r in folded) == [0, 1, 2, 3, 4]
    assert sum(r["count"] for r in folded) == 1000 and min(r["count"] for r in folded) > 120


@pytest.mark.parametrize("max_rows", [1, 100])
def test_lookup_join_is_the_same_with_and_without_broadcast(spark, max_rows):
    big = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "k string, v int")
    small = spark.createDataFrame([("a", 10), ("b", 20), ("c", 30)], "k string, w int")
    joined = join_lookup(big, small, ["k"], max_rows)
    assert sorted((r.v, r.w) for r in joined.collect()) == [(1, 10), (2, 10), (3, 20), (4, None)]
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert ("broadcast" in plan) == (max_rows == 100)
