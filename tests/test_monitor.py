"""Sketches, repeats and late truth as streams, against batch results."""

import datetime
import math
import random

import pytest
from pyspark.sql import functions as F

from storkline.streaming import jobs, monitor

START = datetime.datetime(2024, 3, 1)


def hours(n):
    return START + datetime.timedelta(hours=n)


def add(spark, folder, rows, kind):
    spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(str(folder))


def stream(spark, folder):
    return jobs.stream_table(spark, str(folder), "*.parquet")


def exact(values, p):
    return sorted(values)[max(1, math.ceil(p * len(values))) - 1]


@pytest.mark.parametrize("error", [0.01, 0.1])
def test_error_bound_of_sketches(spark, error):
    rng = random.Random(1)
    values = [rng.choice([-1, 1, 1]) * 10 ** rng.uniform(-8, 9) for _ in range(3000)] + [0.0] * 40 + [1e300, -1e-300]
    frame = spark.createDataFrame([(v,) for v in values + [None, float("nan"), float("inf")]], "value double").repartition(3)
    probabilities = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    # sketches of parts, merged
    part = F.pmod(F.xxhash64("value"), F.lit(4))
    sketch = None
    for i in range(4):
        one = monitor.batch_sketch(frame.filter(part == i), error=error)
        sketch = one if sketch is None else sketch.unionAll(one)
    row = monitor.sketch_quantiles(sketch.withColumn("k", F.lit(1)), ["k"], probabilities, error).first()
    assert row.n == len(values)
    for p in probabilities:
        true = exact(values, p)
        assert abs(row[f"q{round(100 * p)}"] - true) <= error * abs(true) * (1 + 1e-9)


def test_window_sketches(spark, tmp_path):
    rng = random.Random(2)
    rows = [(hours(h) + datetime.timedelta(seconds=i), rng.lognormvariate(h % 3, 1)) for h in range(6) for i in range(200)]
    rows += [(hours(1), None), (hours(1), float("nan"))]
    rng.shuffle(rows)
    kind = "ts timestamp_ntz, value double"
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    for part in (rows[:700], rows[700:]):
        add(spark, tmp_path / "in", part, kind)
    run = lambda: jobs.available_now(monitor.window_sketches(stream(spark, tmp_path / "in"), width="1 hour", lateness="10 hours"), "s", out, state)
    assert run().isEmpty()
    # windows end before the watermark, which is ten hours behind; the last row opens a window that stays open
    add(spark, tmp_path / "in", [(hours(15.5), 1.0)], kind)
    first = monitor.sketch_quantiles(run(), ["window_start"], [0.1, 0.5, 0.9]).orderBy("window_start").collect()
    assert len(first) == 5
    for h, r in enumerate(first):
        values = [v for t, v in rows if t.hour == h and v is not None and v == v]
        assert r.n == 200
        for p in (0.1, 0.5, 0.9):
            assert r[f"q{round(100 * p)}"] == pytest.approx(exact(values, p), rel=0.0101)
    # too late for a reported window
    add(spark, tmp_path / "in", [(hours(0.5), 9.0), (hours(16.5), 1.0)], kind)
    sketches = run()
    assert sketches.groupBy("window_start").agg(F.sum("n").alias("n")).filter("n <> 200").isEmpty()
    base = monitor.batch_sketch(spark.createDataFrame([(v,) for t, v in rows if t.hour == 0], "value double"))
    drift = monitor.quantile_drift(sketches, base).orderBy("window_start").collect()
    # the first hour is the baseline; those of another level are far from it
    assert len(drift) == 6 and drift[0].alert == 0 and all(r.alert for h, r in enumerate(drift) if h % 3)


def test_repeats_count_once(spark, tmp_path):
    kind = "id long, ts timestamp_ntz, event_type string"
    rows = [(i, hours(i / 20), "error" if i % 10 == 0 else "view") for i in range(100)]
    add(spark, tmp_path / "in", rows + [(i, t + datetime.timedelta(seconds=50), e) for i, t, e in rows[::2]], kind)
    add(spark, tmp_path / "in", [(i, t + datetime.timedelta(minutes=2), e) for i, t, e in rows[90:]] + [(200, hours(9), "view")], kind)
    once = jobs.available_now(jobs.request_counts(stream(spark, tmp_path / "in"), lateness="30 minutes", key="id"), "t").orderBy("window_start").collect()
    assert [(r.requests, r.errors) for r in once] == [(20, 2)] * 5
    every = jobs.available_now(jobs.request_counts(stream(spark, tmp_path / "in"), lateness="30 minutes"), "t")
    assert every.agg(F.sum("requests")).first()[0] == 160


def test_late_truth(spark, tmp_path):
    rng = random.Random(3)
    made = [(i, hours(i / 10), float(rng.randint(0, 50))) for i in range(300)]
    made += [(1000, hours(60), 1.0)]
    truth = [(i, t + datetime.timedelta(minutes=rng.choice([0, 30, 170])), v + rng.randint(-9, 9)) for i, t, v in made if i % 3]
    late = [(i, t + datetime.timedelta(hours=4), v) for i, t, v in made if i % 30 == 0]
    none = [(5000, hours(3), 1.0)]
    prediction, outcome = "k long, ts timestamp_ntz, prediction double", "k long, ts timestamp_ntz, actual double"
    for a, z in ((0, 150), (150, 301)):
        add(spark, tmp_path / "p", made[a:z], prediction)
    everything = sorted(truth + late + none, key=lambda r: r[1])
    for a, z in ((0, 100), (100, len(everything))):
        add(spark, tmp_path / "o", everything[a:z], outcome)
    add(spark, tmp_path / "o", [(9000, hours(60), 1.0)], outcome)
    errors = jobs.available_now(
        monitor.late_truth_errors(stream(spark, tmp_path / "p"), stream(spark, tmp_path / "o"), "k", "3 hours", "6 hours", "1 hour"), "late")
    known, held = {i: v for i, _, v in truth if i < 1000}, {}
    for i, t, v in made:
        if i in known:
            held.setdefault(hours(6 * int((t - START).total_seconds() // 21600)), []).append(abs(v - known[i]))
    found = {r.window_start: (r.n, r.mae) for r in errors.collect()}
    assert {w: (len(x), pytest.approx(sum(x) / len(x))) for w, x in held.items()} == found
    alerts = {r.window_start: r.retrain for r in monitor.late_retrain(errors, 4.0).collect()}
    assert alerts == {w: int(sum(x) / len(x) > 4.4) for w, x in held.items()}
