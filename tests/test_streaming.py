import datetime

import pytest
from pyspark.sql import functions as F

from storkline.streaming import jobs

START = datetime.datetime(2024, 1, 1)


def events(spark, folder, rows, name):
    df = spark.createDataFrame(rows, "ts timestamp_ntz, event_type string, value double")
    df.coalesce(1).write.mode("append").parquet(str(folder))
    return name


@pytest.fixture()
def folder(spark, tmp_path):
    rows = []
    for hour in range(5):
        for i in range(20):
            kind = "error" if i < hour else "view"
            rows.append((START + datetime.timedelta(hours=hour, minutes=3 * i), kind, float(10 * hour + i)))
    events(spark, tmp_path / "in", rows, "in")
    return tmp_path / "in"


def stream(spark, folder):
    return jobs.stream_table(spark, str(folder), "*.parquet")


def test_closed_windows_only(spark, folder):
    rows = jobs.available_now(jobs.request_counts(stream(spark, folder)), "t").orderBy("window_start").collect()
    # the last hour is still open
    assert [(r.requests, r.errors, r.alert) for r in rows] == [(20, 0, 0), (20, 1, 0), (20, 2, 1), (20, 3, 1)]


def test_a_later_file_closes_the_window(spark, folder):
    events(spark, folder, [(START + datetime.timedelta(hours=9), "view", 1.0)], "more")
    rows = jobs.available_now(jobs.request_counts(stream(spark, folder)), "t").collect()
    assert len(rows) == 5 and sum(r.requests for r in rows) == 100


def test_value_drift(spark, folder):
    base = spark.read.parquet(str(folder)).filter(F.col("ts") < START + datetime.timedelta(hours=1))
    baseline = jobs.baseline_bins(base, "value", 0.0, 60.0, 6)
    parts = jobs.drift_parts(jobs.value_histograms(stream(spark, folder), 0.0, 60.0, 6, "1 hour", "10 minutes"), baseline, 6)
    rows = jobs.drift_report(jobs.available_now(parts, "d")).orderBy("window_start").collect()
    assert [r.n for r in rows] == [20] * 4
    assert rows[0].psi == 0.0 and rows[0].alert == 0 and rows[3].alert == 1


def test_score(spark, tmp_path):
    from storkline.operators import model
    from storkline.plans.queries import gestation_ridge

    rows = [(float(28 + i % 14), 100.0 * (28 + i % 14)) for i in range(200)]
    df = spark.createDataFrame(rows, "gestation_weeks double, weight_grams double").withColumn("k", F.monotonically_increasing_id())
    df.write.parquet(str(tmp_path / "in"))
    fitted = gestation_ridge(spark.read.parquet(str(tmp_path / "in")))
    scored = jobs.available_now(jobs.score(stream(spark, tmp_path / "in"), fitted, ["k"]), "s")
    batch = fitted.transform(spark.read.parquet(str(tmp_path / "in"))).select("k", "prediction")
    assert scored.count() == 200 and scored.join(batch, ["k", "prediction"]).count() == 200
    assert model.prepared_features(fitted) == ["gestation_weeks"]


def test_goes_on_from_its_checkpoint(spark, folder, tmp_path):
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    first = jobs.available_now(jobs.request_counts(stream(spark, folder)), "t", out, state)
    assert first.count() == 4
    events(spark, folder, [(START + datetime.timedelta(hours=4, minutes=59), "error", 1.0), (START + datetime.timedelta(hours=9), "view", 1.0)], "more")
    rows = jobs.available_now(jobs.request_counts(stream(spark, folder)), "t", out, state).orderBy("window_start").collect()
    assert [(r.requests, r.errors) for r in rows] == [(20, 0), (20, 1), (20, 2), (20, 3), (21, 5)]
    with pytest.raises(ValueError):
        jobs.available_now(jobs.request_counts(stream(spark, folder)), "t", out)
