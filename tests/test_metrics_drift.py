import datetime
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import values
from storkline.operators import drift, metrics


def scored(spark, pairs):
    return spark.createDataFrame(pairs, "weight_grams double, prediction double")


def test_regression_metrics(spark):
    y, p = [2000.0, 3000.0, 3500.0, 4100.0], [2100.0, 2900.0, 3600.0, 3900.0]
    row = metrics.regression_metrics(scored(spark, list(zip(y, p)))).first()
    y, p = np.array(y), np.array(p)
    assert row.mae == round(float(np.abs(y - p).mean()), 3)
    assert row.rmse == round(float(np.sqrt(((y - p) ** 2).mean())), 3)
    assert row.r2 == round(float(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum()), 4)


@pytest.mark.parametrize("p, r2", [(3000.0, 1.0), (3100.0, 0.0)])
def test_r2_of_a_constant_target(spark, p, r2):
    assert metrics.regression_metrics(scored(spark, [(3000.0, p)] * 3)).first().r2 == r2


def test_clinical_metrics(spark):
    pairs = [(2000.0, 2100.0), (2400.0, 2600.0), (2500.0, 2499.0), (3000.0, 3000.0), (3100.0, 2500.0)]
    row = metrics.clinical_metrics(scored(spark, pairs)).first()
    assert (row.lbw_prevalence_pct, row.sensitivity, row.specificity, row.precision) == (40.0, 0.5, 0.6667, 0.5)
    assert (row.f1, row.n_lbw_true, row.n_lbw_pred) == (0.5, 2, 2)
    assert metrics.clinical_metrics(scored(spark, pairs), 3050.0).first().n_lbw_true == 4


@pytest.mark.parametrize("pairs, sensitivity, specificity, f1", [
    ([(2000.0, 2000.0), (3000.0, 3000.0)], 1.0, 1.0, 1.0),
    ([(2000.0, 3000.0), (3000.0, 2000.0)], 0.0, 0.0, 0.0),
    ([(3000.0, 3000.0)], 0.0, 1.0, 0.0),
    ([(2000.0, 2000.0)], 1.0, 0.0, 1.0),
])
def test_clinical_metrics_on_empty_denominators(spark, pairs, sensitivity, specificity, f1):
    row = metrics.clinical_metrics(scored(spark, pairs)).first()
    assert (row.sensitivity, row.specificity, row.f1) == (sensitivity, specificity, f1)


def test_acceptance_gate(spark):
    table = spark.createDataFrame([(299.9, 0.7, 0.9, 0.5)], "mae double, r2 double, sensitivity double, specificity double")
    assert {r.metric: r.verdict for r in metrics.acceptance_gate(table).collect()} == {
        "mae": "PASS", "r2": "FAIL", "sensitivity": "PASS", "specificity": "FAIL"
    }


# ---- drift


@pytest.fixture(scope="module")
def two_periods(spark):
    rng = np.random.default_rng(11)
    rows = [("train", float(v)) for v in rng.normal(0, 1, 900)] + [("val", float(v)) for v in rng.normal(0.8, 1, 500)]
    rows += [("test", float(v)) for v in rng.normal(0, 1, 400)] + [("train", None), ("val", None)]
    return rows, spark.createDataFrame(rows, "split string, x double")


def plain_psi(reference, current, bins=10, floor=1e-4):
    edges = np.unique(np.quantile(reference, [i / bins for i in range(1, bins)]))
    e = np.bincount(np.searchsorted(edges, reference), minlength=len(edges) + 1) / len(reference)
    a = np.bincount(np.searchsorted(edges, current), minlength=len(edges) + 1) / len(current)
    e, a = np.maximum(e, floor), np.maximum(a, floor)
    return float(((a - e) * np.log(a / e)).sum())


def test_psi(two_periods):
    rows, df = two_periods
    of = {s: np.array([v for k, v in rows if k == s and v is not None]) for s in ("train", "val", "test")}
    got = {r.split: r for r in drift.split_psi(df, ["x"]).collect()}
    assert set(got) == {"val", "test"}
    for s in got:
        assert got[s].psi == pytest.approx(plain_psi(of["train"], of[s]), abs=1e-6)
    assert (got["val"].alert, got["test"].alert) == (1, 0)


def test_psi_with_a_hot_value(spark):
    reference = [5.0] * 70 + [float(i) for i in range(30)]
    current = [5.0] * 10 + [float(i) for i in range(90)]
    df = spark.createDataFrame([("train", v) for v in reference] + [("val", v) for v in current], "split string, x double")
    assert drift.split_psi(df, ["x"]).first().psi == pytest.approx(plain_psi(np.array(reference), np.array(current)), abs=1e-6)


def test_ks(two_periods):
    rows, df = two_periods
    of = {s: np.array([v for k, v in rows if k == s and v is not None]) for s in ("train", "val", "test")}
    grid = np.concatenate(list(of.values()))
    cdf = {s: (of[s][:, None] <= grid).mean(axis=0) for s in of}
    got = {r.split: r.ks for r in drift.ks_drift(df, ["x"]).collect()}
    for s in ("val", "test"):
        assert got[s] == pytest.approx(np.abs(cdf["train"] - cdf[s]).max(), abs=1e-6)


def test_weighted_prevalence(spark):
    df = spark.createDataFrame([(1000.0, 2), (3000.0, 1), (5000.0, 1), (None, 2)], "weight_grams double, record_weight int")
    row = drift.weighted_prevalence(df).first()
    assert (row.population, row.vlbw_pct, row.lbw_pct, row.macrosomia_pct) == (4, 50.0, 50.0, 25.0)


def test_subgroups(spark):
    df = spark.createDataFrame([(2000.0, 2100.0, 1), (3000.0, 3300.0, 1), (3000.0, 3000.0, None)], "weight_grams double, prediction double, sex int")
    got = {r.value: r for r in drift.subgroup_metrics(df, {"sex": F.col("sex"), "all": F.lit("x")}).collect()}
    assert (got["1"].mae, got["unknown"].mae, got["x"].mae) == (200.0, 0.0, 133.333)


def test_confusion_and_risk(spark):
    df = scored(spark, [(2499.0, 2500.0), (2500.0, 4000.0), (4000.1, 4100.0), (3000.0, 2450.0)])
    got = {(r.true_class, r.predicted_class): r.n for r in drift.category_confusion(df).collect()}
    assert got == {("LBW", "Normal"): 1, ("Normal", "Normal"): 1, ("Macrosomia", "Macrosomia"): 1, ("Normal", "LBW"): 1}
    risk = drift.risk_category(df)
    assert values(risk, "risk") == ["LBW", "Normal", "Macrosomia", "LBW"]
    assert values(risk, "near_limit") == [1, 0, 0, 1]


def test_residuals(spark):
    df = scored(spark, [(3000.0, 2900.0), (3000.0, 3200.0)])
    assert values(drift.residuals(df), "residual") == [100.0, -200.0]
    bands = {r.band: r for r in drift.residuals_by_prediction(df, [0, 3000, 9999]).collect()}
    assert bands[0].mean == 100.0 and bands[1].mae == 200.0


def test_lmp_date(spark):
    df = spark.createDataFrame([(t,) for t in ("03152010", "01992000", "9999", "02292001", None, "x")], "lmp string")
    assert values(drift.lmp_date(df), "lmp_date") == [datetime.date(2010, 3, 15), None, None, None, None, None]


def test_target_encoding_uses_training_rows_only(spark):
    train = spark.createDataFrame([("CA", 3000.0), ("CA", 3200.0), ("TX", 2800.0), (None, 9000.0)], "state string, weight_grams double")
    new = spark.createDataFrame([("CA", 1.0), ("NY", 1.0), (None, 1.0)], "state string, weight_grams double")
    got = {r.state: r.state_encoded for r in drift.target_encode(new, train, "state").collect()}
    assert got == {"CA": 3100.0, "NY": 4500.0, None: 4500.0}


def test_duplicates_across_files(spark):
    rows = [(1990, 7.0, "a")] * 500 + [(1990, 7.0, "b"), (1991, 6.0, "a"), (1991, 6.0, "a"), (1992, None, "a"), (1992, None, "b")]
    df = spark.createDataFrame(rows, "year_fix int, weight_pounds double, source_file string")
    got = {r.year_fix: (r.copies, r.first_file, r.last_file) for r in drift.cross_file_duplicates(df).collect()}
    assert got == {1990: (501, "a", "b"), 1992: (2, "a", "b")}


def test_retrain_trigger(spark):
    def one(mae):
        return spark.createDataFrame([(mae,)], "mae double")

    psi = spark.createDataFrame([("x", "val", 0.1), ("x", "test", 0.3), ("y", "val", 0.0)], "feature string, split string, psi double")
    got = {r.reason: (r.value, r.retrain) for r in drift.retrain_trigger(one(100.0), one(111.0), psi).collect()}
    assert got["mae"] == (pytest.approx(11.0), 1) and got["psi:x"] == (0.3, 1) and got["psi:y"] == (0.0, 0)
    calm = {r.reason: r.retrain for r in drift.retrain_trigger(one(100.0), one(109.0), psi).collect()}
    assert calm["mae"] == 0


def test_prediction_drift_by_year(spark):
    rows = [(2000 + i % 3, float(i)) for i in range(300)] + [(2012, float(i) / 10) for i in range(100)]
    df = spark.createDataFrame(rows, "year_fix int, prediction double")
    got = {r.year_fix: r.alert for r in drift.prediction_drift(df).collect()}
    assert got[2012] == 1 and got[2000] == 0 and len(got) == 4 and not math.isnan(sum(got.values()))
