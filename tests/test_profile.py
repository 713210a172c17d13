import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import values
from storkline.operators import profile
from storkline.operators.features import add_weight_category
from storkline.operators.validate import column_set_diff, run_expectations
from storkline.operators.split import temporal_split


@pytest.fixture(scope="module")
def people():
    rng = np.random.default_rng(5)
    n = 800
    pdf = pd.DataFrame({
        "birth_id": np.arange(n),
        "weight_grams": np.round(rng.normal(3300, 600, n), 1),
        "gestation_weeks": rng.integers(28, 44, n).astype(float),
        "is_male": rng.integers(0, 2, n).astype(float),
        "year_fix": rng.integers(1990, 1996, n),
        "gestation_preterm": rng.integers(0, 2, n),
    })
    pdf.loc[::9, "gestation_weeks"] = np.nan
    pdf.loc[::11, "is_male"] = np.nan
    # a hot value
    pdf.loc[: n // 3, "weight_grams"] = 3000.0
    return pdf


@pytest.fixture(scope="module")
def frame(spark, people):
    rows = [tuple(None if isinstance(v, float) and math.isnan(v) else v for v in r) for r in people.itertuples(index=False)]
    rows = [tuple(x.item() if hasattr(x, "item") else x for x in r) for r in rows]
    return spark.createDataFrame(rows, "birth_id long, weight_grams double, gestation_weeks double, is_male double, year_fix int, gestation_preterm int")


def by(df, key):
    return {r[key]: r for r in df.collect()}


def test_describe(frame, people):
    got = by(profile.describe_numeric(frame, ["weight_grams", "gestation_weeks"]), "feature")
    want = people[["weight_grams", "gestation_weeks"]].describe().round(3)
    names = {"count": "n", "mean": "mean", "std": "std", "min": "min", "25%": "q1", "50%": "median", "75%": "q3", "max": "max"}
    for feature in want:
        for pandas_name, ours in names.items():
            assert got[feature][ours] == pytest.approx(want[feature][pandas_name], abs=1e-9)


def test_target_stats(frame, people):
    got = profile.target_stats(frame).first()
    y = people.weight_grams
    for name, want in {"skew": y.skew(), "kurtosis": y.kurt(), "median": y.median(), "std": y.std(), "q1": y.quantile(0.25), "n": len(y)}.items():
        assert got[name] == pytest.approx(want, abs=1e-5), name


def test_prevalence_bounds(spark):
    df = spark.createDataFrame([(g,) for g in (1499.9, 1500.0, 2500.0, 4000.0, 4000.1, None)], "weight_grams double")
    row = profile.category_prevalence(df).first()
    assert (row.vlbw_pct, row.lbw_pct, row.normal_pct, row.macrosomia_pct) == (20.0, 40.0, 40.0, 20.0)
    counts = by(profile.category_counts(df), "category")
    assert [counts[c].n for c in ("VLBW", "LBW", "Normal", "Macrosomia")] == [2, 1, 1, 1]
    empty = by(profile.category_counts(df.filter("weight_grams > 4000")), "category")
    assert (empty["VLBW"].n, empty["Macrosomia"].pct) == (0, 100.0)


def test_value_counts_with_null_last(frame, people):
    got = [(r.value, r.n) for r in profile.value_counts(frame, ["is_male"]).collect()]
    want = people.is_male.value_counts(dropna=False).sort_index()
    assert got == [(0.0, want.iloc[0]), (1.0, want.iloc[1]), (None, want.iloc[2])]


def test_missing(frame, people):
    got = [(r.feature, r.missing_pct) for r in profile.missing_pct(frame).collect()]
    want = (people.isnull().mean() * 100).round(2).sort_values(ascending=False)
    assert got == [(f, v) for f, v in want.items() if v > 0]
    patterns = by(profile.missing_patterns(frame, ["gestation_weeks", "is_male"]), "pattern")
    both = (people.gestation_weeks.isna() & people.is_male.isna()).sum()
    assert patterns["11"].n == both and sum(r.n for r in patterns.values()) == len(people)
    known = by(profile.completeness(frame), "feature")
    assert known["is_male"].known == people.is_male.notna().sum()
    assert by(profile.schema_profile(frame, sample=True), "feature")["year_fix"].dtype == "int"


def test_correlations(frame, people):
    columns = ["weight_grams", "gestation_weeks", "is_male"]
    want = people[columns].corr()
    for r in profile.corr_matrix(frame, columns).collect():
        assert r.r == pytest.approx(want.loc[r.a, r.b], abs=1e-6)
    ranked = profile.corr_ranked(frame, ["gestation_weeks", "is_male", "year_fix"]).collect()
    sizes = [abs(r.r) for r in ranked]
    assert sizes == sorted(sizes, reverse=True)
    assert all(r.r > 0 for r in profile.corr_ranked(frame, ["gestation_weeks", "is_male", "year_fix"], sign=1).collect())


def test_correlations_far_from_zero_and_of_constants(spark):
    rows = [(1.7e9 + i, float(i % 7) - 2 * i, 5.1, None, float("nan") if i % 5 else float(i)) for i in range(200)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double")
    got = {(r.a, r.b): r.r for r in profile.corr_matrix(df, list("abcde"), digits=9).collect()}
    assert got["a", "b"] == pytest.approx(np.corrcoef(range(200), [i % 7 - 2 * i for i in range(200)])[0, 1], abs=1e-9)
    assert got["a", "e"] == 1.0 and [got[p] for p in (("a", "c"), ("b", "c"), ("a", "d"), ("c", "e"))] == [None] * 4


def test_trend_line(frame, people):
    known = people.dropna(subset=["gestation_weeks"])
    slope, intercept = np.polyfit(known.gestation_weeks, known.weight_grams, 1)
    got = profile.trend_line(frame, ["gestation_weeks"]).first()
    assert (got.slope, got.intercept, got.n) == (pytest.approx(slope, abs=1e-5), pytest.approx(intercept, abs=1e-4), len(known))


def test_yearly_trend(frame, people):
    got = by(profile.yearly_trend(frame), "year_fix")
    for year, g in people.groupby("year_fix"):
        y, r = g.weight_grams, got[year]
        assert (r.n, r.median) == (len(y), pytest.approx(y.median()))
        assert r.std == pytest.approx(y.std(), abs=1e-5) and r.lbw_pct == pytest.approx((y < 2500).mean() * 100, abs=1e-5)
        assert r.preterm_pct == pytest.approx(g.gestation_preterm.mean() * 100, abs=1e-5)


def test_histogram_matches_numpy(frame, people):
    rows = sorted(profile.histogram(frame, ["weight_grams", "gestation_weeks"], 17).collect(), key=lambda r: (r.feature, r.bin))
    for feature in ("weight_grams", "gestation_weeks"):
        counts, edges = np.histogram(people[feature].dropna(), bins=17)
        density, _ = np.histogram(people[feature].dropna(), bins=17, density=True)
        mine = [r for r in rows if r.feature == feature]
        assert [r.n for r in mine] == counts.tolist()
        assert [r.bin_low for r in mine] == pytest.approx(edges[:-1].tolist())
        assert [r.density for r in mine] == pytest.approx(density.tolist(), abs=1e-8)


def test_histogram_of_a_constant(spark):
    df = spark.createDataFrame([(5.0,)] * 4, "x double")
    rows = sorted(profile.histogram(df, ["x"], 2).collect(), key=lambda r: r.bin)
    assert [(r.bin_low, r.n) for r in rows] == [(4.5, 0), (5.0, 4)]


def test_kde_matches_the_definition(frame, people):
    y = people.weight_grams.to_numpy()
    h = y.std(ddof=1) * len(y) ** -0.2
    reach = y.max() - y.min()
    grid = np.linspace(y.min() - 0.5 * reach, y.max() + 0.5 * reach, 50)
    want = np.exp(-0.5 * ((grid[:, None] - y) / h) ** 2).sum(axis=1) / (len(y) * h * math.sqrt(2 * math.pi))
    got = sorted(profile.kde(frame, points=50).collect(), key=lambda r: r.point)
    assert [r.density for r in got] == pytest.approx(want.tolist(), abs=2e-9)


def test_kde_moments_keep_the_error_bound(spark):
    rng = np.random.default_rng(8)
    y = np.concatenate([rng.normal(0, 1, 3000), np.full(1500, 0.25), [-40.0, 55.5, 55.5]])
    h, reach, grid = y.std(ddof=1) * len(y) ** -0.2, np.ptp(y), np.arange(400)
    grid = y.min() - 0.5 * reach + grid * 2 * reach / 399
    want = np.exp(-0.5 * ((grid[:, None] - y) / h) ** 2).sum(axis=1) / (len(y) * h * math.sqrt(2 * math.pi))
    df = spark.createDataFrame(pd.DataFrame({"x": y}))
    got = sorted(profile.kde(df, "x", points=400, digits=16).collect(), key=lambda r: r.point)
    assert [r.density for r in got] == pytest.approx(want.tolist(), abs=2.2e-13 * want.max(), rel=0)
    assert all(math.copysign(1, r.density) > 0 for r in got)


def test_kde_skips_small_groups(spark, frame):
    sizes = {r.year_fix for r in profile.kde(frame, key="year_fix", points=5, min_rows=130).collect()}
    counts = {r.year_fix: r["count"] for r in frame.groupBy("year_fix").count().collect()}
    assert sizes == {y for y, n in counts.items() if n > 130}


def test_box_stats(frame, people):
    got = by(profile.box_stats(frame, ["weight_grams"], "is_male"), "is_male")
    for sex, g in people.dropna(subset=["is_male"]).groupby("is_male"):
        y = g.weight_grams
        q1, q3 = y.quantile([0.25, 0.75])
        inside = y[(y >= q1 - 1.5 * (q3 - q1)) & (y <= q3 + 1.5 * (q3 - q1))]
        r = got[sex]
        assert (r.whisker_low, r.whisker_high) == (min(inside.min(), q1), max(inside.max(), q3))
        assert r.outliers == len(y) - len(inside) and r.n == len(y)
    assert len(got) == 2


def test_qq_points(frame, people):
    import statistics

    ordered = sorted(r[0] for r in frame.filter("weight_grams is not null").select(F.col("weight_grams").cast("double")).collect())
    n = len(ordered)
    levels = [1 - 0.5 ** (1 / n), *[(i - 0.3175) / (n + 0.365) for i in range(2, n)], 0.5 ** (1 / n)]
    # every rank with more points than rows, evenly spread ranks otherwise, both ends included
    for k in (2, 7, 300, n, n + 50):
        points = profile.qq_points(frame, n=k)
        rows = sorted(points.collect(), key=lambda r: r.i)
        ranks = [i * (n - 1) // (min(k, n) - 1) for i in range(min(k, n))]
        assert [r.i for r in rows] == list(range(1, len(ranks) + 1)) and [r.ordered for r in rows] == [ordered[r] for r in ranks]
        assert [r.theoretical for r in rows] == pytest.approx([statistics.NormalDist().inv_cdf(levels[r]) for r in ranks], abs=1e-12)
    one = profile.qq_points(frame.filter("weight_grams is not null").limit(1)).collect()
    assert [(r.i, r.theoretical) for r in one] == [(1, 0.0)] and profile.qq_points(frame.limit(0)).isEmpty()
    slope, intercept = np.polyfit([r.theoretical for r in rows], [r.ordered for r in rows], 1)
    line = profile.qq_line(points).first()
    assert (line.slope, line.intercept) == (pytest.approx(slope, abs=1e-4), pytest.approx(intercept, abs=1e-4))


def test_files(spark):
    df = spark.createDataFrame([("a", 1990), ("a", 1991), ("b", 2000)], "source_file string, year_fix int")
    assert by(profile.file_row_share(df, expected_files=2), "source_file")["a"].pct == 66.7
    with pytest.raises(Exception, match="expected 5 files, found 2"):
        profile.file_row_share(df, expected_files=5).collect()
    assert by(profile.file_year_ranges(df), "source_file")["a"].n_years == 2
    summary = profile.data_summary(df).first()
    assert (summary.n_rows, summary.n_cols, summary.files_included, summary.year_max) == (3, 2, "a,b", 2000)


def test_ordering(spark):
    df = spark.createDataFrame([("a", 3.0), ("b", 1.0), ("c", 2.0)], "model string, val_mae double")
    assert values(profile.sort_metric(df, "val_mae"), "model") == ["b", "c", "a"]
    assert values(profile.top_k(df, 2, "val_mae"), "model") == ["a", "c"]
    assert tuple(profile.argmin_model(df).first()) == ("b", 1.0)


# ---- expectations


def test_expectations_on_good_data(features_frame):
    splits = temporal_split(features_frame.withColumns({"source_year": profile.F.lit(1986), "source_file": profile.F.lit("f")}))
    rows = {(r.check, r.split): r for r in run_expectations(splits, expected_files=1).collect()}
    failed = {k for k, r in rows.items() if not r.passed}
    # four records say nothing about rates
    assert failed <= {("lbw_rate_plausible", "train"), ("target_mean_plausible", "train")}
    assert rows[("train_share", "train")].passed == 1 and ("all_files_present", "train") in rows


def test_expectations_find_violations(spark, features_frame):
    F = profile.F
    train, val, test = temporal_split(features_frame)
    bad = train.withColumns({
        "weight_grams": F.lit(200.0), "gestation_weeks": F.lit(50.0), "plurality": F.lit(0.0), "is_male": F.lit(7),
        "gestation_preterm": F.lit(1), "gestation_post_term": F.lit(1), "birth_month_sin": F.lit(1.5),
        "parity": F.lit(-1), "apgar_1min": F.lit(9.0), "year_fix": F.lit(2012), "mother_age_group": F.lit(4),
    }).drop("month")
    rows = {(r.check, r.split): r.violations for r in run_expectations((bad, val.limit(0), test)).collect()}
    for check in (
        "target_in_range", "gestation_weeks_in_range", "plurality_in_range", "is_male_is_flag", "term_flags_exclusive",
        "birth_month_sin_in_range", "parity_not_negative", "year_within_split", "mother_age_group_in_range", "grams_match_pounds",
    ):
        assert rows[(check, "train")] == 2, check
        assert rows[(check, "test")] == 0, check
    assert rows[("no_leakage_columns", "train")] == 1 and rows[("no_leakage_columns", "val")] == 0
    assert rows[("required_columns", "train")] == 3 and rows[("same_columns", "val")] == 1
    assert rows[("split_not_empty", "val")] == 1 and rows[("split_not_empty", "test")] == 0
    assert rows[("target_mean_plausible", "train")] == 1


def test_column_sets(spark):
    left, right = spark.createDataFrame([], "a int, b int"), spark.createDataFrame([], "b int, c int")
    assert column_set_diff(left, right) == ({"a"}, {"c"})
    assert values(add_weight_category(spark.createDataFrame([(2500.0,)], "weight_grams double")), "weight_category") == ["LBW"]
