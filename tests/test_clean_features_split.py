import math

import numpy as np
import pytest
from pyspark.sql import Observation

from conftest import values
from storkline import schema as S
from storkline.operators import clean, features, split


# ---- cleaning


def test_leakage_columns_go_and_others_stay(raw):
    out = clean.drop_leakage(raw)
    assert not set(S.LEAKAGE_COLUMNS) & set(out.columns)
    assert out.columns == [c for c in raw.columns if c not in S.LEAKAGE_COLUMNS]
    assert clean.drop_leakage(out).columns == out.columns


def test_boolean_texts(spark):
    texts = ["true", " True ", "FALSE", "\tfalse", "yes", "nan", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "is_male string")
    out = clean.cast_booleans(df)
    assert values(out, "is_male") == [1, 1, 0, 0, None, None, None, None]
    assert dict(out.dtypes)["is_male"] == "tinyint"


def test_booleans_of_other_types(spark, raw):
    df = spark.createDataFrame([(True, 5), (None, 6)], "is_male boolean, mother_married int")
    out = clean.cast_booleans(df)
    assert values(out, "is_male") == [1, None] and values(out, "mother_married") == [5, 6]
    assert values(clean.cast_booleans(raw), "cigarette_use") == [None] * 5


def test_sentinels(spark):
    df = spark.createDataFrame(
        [(98.0, 47.0, 1.0), (99.0, 99.0, 0.0), (None, None, None)], "father_age double, gestation_weeks double, plurality double"
    )
    out = clean.null_sentinel(df)
    assert values(out, "father_age") == [98.0, None, None]
    assert values(out, "gestation_weeks") == [47.0, None, None]
    assert values(out, "plurality") == [1.0, None, None]


def test_unknown_lmp(spark):
    texts = ["01012000", "99", " 99 ", "9999", "99999999", "01992000", "nan", "", "  ", None, "9", "199"]
    df = spark.createDataFrame([(t,) for t in texts], "lmp string")
    assert values(clean.null_unknown_lmp(df), "lmp") == [
        "01012000", None, None, None, None, "01992000", None, None, None, None, None, "199"
    ]


def test_clip_edges(spark):
    df = spark.createDataFrame(
        [(19.0, 9.0), (20.0, 10.0), (44.0, 60.0), (45.0, 61.0), (None, None)], "gestation_weeks double, mother_age double"
    )
    out = clean.clip_ranges(df)
    assert values(out, "gestation_weeks") == [20.0, 20.0, 44.0, 44.0, None]
    assert values(out, "mother_age") == [10.0, 10.0, 60.0, 60.0, None]


def pounds(spark):
    return spark.createDataFrame([(x,) for x in (0.65, 0.66, 15.43, 15.44, None)], "weight_pounds double")


def test_outlier_flag_is_inclusive_and_zero_on_null(spark):
    assert values(clean.flag_outlier_weight(pounds(spark)), "outlier_weight") == [1, 0, 0, 1, 0]


def test_grams_match_numpy(spark):
    xs = np.random.default_rng(0).uniform(0, 20, 500).tolist()
    df = spark.createDataFrame([(x,) for x in xs], "weight_pounds double")
    got = {r.weight_pounds: r.weight_grams for r in clean.convert_target(df).collect()}
    assert all(got[x] == float(np.round(x * 453.592, 1)) for x in xs)


def test_invalid_targets_are_removed(spark):
    assert values(clean.drop_invalid_target(pounds(spark)), "weight_pounds") == [0.66, 15.43]


def test_preprocessing_of_the_sample(raw):
    out = clean.run_preprocessing(raw).orderBy("year_fix")
    assert values(out, "weight_grams") == [2857.6, 4195.7, 1496.9, 4989.5]
    assert values(out, "father_age") == [98.0, None, None, 52.0]
    assert values(out, "lmp") == [None, "12242008", None, "07042020"]
    assert values(out, "outlier_weight") == [0, 0, 0, 0]


def test_steps_skip_absent_columns(spark):
    df = spark.createDataFrame([(5.0,)], "weight_pounds double")
    assert clean.run_preprocessing(df).columns == ["weight_pounds", "outlier_weight", "weight_grams"]
    other = spark.createDataFrame([(1,)], "other int")
    assert clean.convert_target(clean.flag_outlier_weight(other)).columns == ["other"]
    assert features.engineer_features(other).columns == ["other"]


def test_counts_of_cleaning(raw):
    row = clean.cleaning_counts(raw).first()
    assert (row.rows_in, row.rows_out, row.weight_missing, row.weight_outliers) == (5, 4, 1, 0)
    assert (row.father_age_sentinels, row.lmp_unknown, row.gestation_weeks_capped, row.mother_age_capped) == (2, 3, 1, 1)
    assert row.removed_pct == 20.0


def test_observation_gives_the_same_counts(raw):
    seen = Observation("cleaning")
    clean.run_preprocessing(raw, seen).count()
    direct = clean.cleaning_counts(raw).first().asDict()
    for name in ("rows_in", "rows_out", "lmp_unknown", "father_age_sentinels"):
        assert seen.get[name] == direct[name]


# ---- features


def test_features_of_the_sample(features_frame):
    out = features_frame.orderBy("year_fix")
    expected = {
        "parity": [2, 0, 9, 1], "is_multiple_birth": [1, 0, 0, 0], "gestation_preterm": [1, 0, 0, 0],
        "gestation_post_term": [0, 1, 0, 0], "mother_age_group": [0, 1, 2, 3], "lmp_known": [0, 1, 0, 1],
        "weight_gain_kg": [18.6, 0.0, 44.0, 14.97],
    }
    for name, want in expected.items():
        assert values(out, name) == want, name
    types = dict(features_frame.dtypes)
    assert types["parity"] == "smallint" and types["is_multiple_birth"] == "tinyint"


def test_parity_counts_unknown_as_zero(spark):
    df = spark.createDataFrame([(1.0, None, 2.0), (None, None, None)], "born_alive_alive double, born_alive_dead double, born_dead double")
    assert values(features.add_parity(df), "parity") == [3, 0]
    assert "parity" not in features.add_parity(df.drop("born_dead")).columns


def test_flags_of_unknown_are_zero(spark):
    df = spark.createDataFrame([(None, None), (2.0, 36.9), (1.0, 37.0), (1.0, 41.0), (1.0, 41.1)], "plurality double, gestation_weeks double")
    out = features.engineer_features(df)
    assert values(out, "is_multiple_birth") == [0, 1, 0, 0, 0]
    assert values(out, "gestation_preterm") == [0, 1, 0, 0, 0]
    assert values(out, "gestation_post_term") == [0, 0, 0, 0, 1]


def test_age_group_edges(spark):
    ages = [0.0, 19.0, 19.5, 20.0, 29.0, 39.0, 40.0, 120.0, -1.0, 121.0, None]
    df = spark.createDataFrame([(a,) for a in ages], "mother_age double")
    assert values(features.add_mother_age_group(df), "mother_age_group") == [0, 0, 1, 1, 1, 2, 3, 3, None, None, None]


def test_month_on_the_circle(spark):
    df = spark.createDataFrame([(m,) for m in [*range(1, 13), None]], "month int")
    out = features.add_cyclical_month(df).collect()
    for r in out[:-1]:
        assert r.birth_month_sin == float(np.round(math.sin(2 * math.pi * r.month / 12), 6))
        assert r.birth_month_cos == float(np.round(math.cos(2 * math.pi * r.month / 12), 6))
    assert out[-1].birth_month_sin is None


def test_weight_categories_are_right_closed(spark):
    grams = [0.0, 1500.0, 1500.1, 2500.0, 4000.0, 4000.1, 9999.0, 10000.0, None]
    df = spark.createDataFrame([(g,) for g in grams], "weight_grams double")
    assert values(features.add_weight_category(df), "weight_category") == [
        None, "VLBW", "LBW", "LBW", "Normal", "Macrosomia", "Macrosomia", None, None
    ]
    assert values(features.add_weight_category(df, open_ended=True), "weight_category")[0] == "VLBW"
    assert values(features.add_weight_category(df, open_ended=True), "weight_category")[-2] == "Macrosomia"


def test_derived_columns(raw, features_frame):
    before = clean.run_preprocessing(raw)
    assert features.derived_columns(before, features_frame) == S.ENGINEERED_COLUMNS


# ---- split


def years(spark, ys):
    return spark.createDataFrame([(y, 2000.0) for y in ys], "year_fix int, weight_grams double")


def test_split_boundaries_and_null_year(spark):
    df = years(spark, [2009, 2010, 2015, 2016, None])
    assert values(split.add_split(df), "split") == ["train", "val", "val", "test"]
    assert [s.count() for s in split.temporal_split(df)] == [1, 2, 1]
    assert [s.count() for s in split.temporal_split(df, 2015, 2020)] == [2, 2, 0]


def test_split_by_another_column(spark):
    df = years(spark, [2009, 2016]).withColumnRenamed("year_fix", "yr")
    assert [s.count() for s in split.temporal_split(df, year_col="yr")] == [1, 0, 1]
    for function in (split.temporal_split, split.add_split):
        with pytest.raises(ValueError, match="year_fix"):
            function(df)


def test_split_info_shows_empty_splits(spark, caplog):
    info = split.split_summary(split.add_split(years(spark, [1990, 1991, 2020, 2020])))
    rows = {r.split: r for r in info.collect()}
    assert (rows["train"].n_rows, rows["train"].pct, rows["train"].year_max, rows["train"].lbw_pct) == (2, 50.0, 1991, 100.0)
    assert (rows["val"].n_rows, rows["val"].year_min, rows["val"].lbw_pct) == (0, None, None)
    assert split.warn_empty_splits(info) == ["val"] and "val" in caplog.text


def test_feature_columns_and_xy(features_frame):
    columns = split.feature_columns(features_frame)
    assert not set(S.NON_FEATURE_COLUMNS) & set(columns)
    assert {"state", "cigarette_use", "record_weight"} <= set(columns)
    xy = split.get_xy(features_frame)
    assert xy.columns == [*columns, "weight_grams"] and xy.count() == 4
    other = split.get_xy(features_frame, "mother_age")
    assert other.columns[-1] == "mother_age" and other.columns.count("mother_age") == 1
    with pytest.raises(ValueError, match="nothing"):
        split.get_xy(features_frame, "nothing")


def test_model_matrix(features_frame, caplog):
    matrix = split.model_matrix(features_frame)
    assert matrix.columns == [*S.MODEL_FEATURES, "weight_grams"]
    assert {t for _, t in matrix.dtypes} == {"double"}
    fewer = split.model_matrix(features_frame.drop("parity"))
    assert "parity" not in fewer.columns and "parity" in caplog.text
    with pytest.raises(ValueError):
        split.model_matrix(features_frame.drop("weight_grams"))


def test_feature_profile(features_frame):
    rows = {r.feature: r for r in split.feature_profile(features_frame).collect()}
    assert rows["cigarette_use"].missing_pct == 100.0 and rows["father_age"].missing_pct == 50.0
    assert rows["parity"].dtype == "smallint"
