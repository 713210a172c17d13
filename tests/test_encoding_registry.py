"""Out-of-fold encoding, claimed versions, lines from matrix products."""

from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pytest
from pyspark.sql import functions as F

from storkline.functions.correlation import pair_lines
from storkline.operators import drift
from storkline.sources import run_tables


def test_out_of_fold_means(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.choice(["x", "y", None]), float(rng.integers(1, 9))) for i in range(200)]
    rows += [(900, "once", 5.0), (901, "y", None), (901, "y", None), (3, "x", 7.0)]
    frame = spark.createDataFrame(rows, "id long, c string, weight_grams double").withColumn("_s", F.lit(1))
    found = drift.target_encode_out_of_fold(frame, "c", "id", 4)
    assert found.columns == ["id", "c", "weight_grams", "_s", "fold", "c_encoded"]
    got = found.collect()
    assert len(got) == len(rows) and {r.fold for r in got} == {0, 1, 2, 3}
    for r in got:
        others = [x.weight_grams for x in got if x.fold != r.fold and x.weight_grams is not None]
        own = [x.weight_grams for x in got if x.fold != r.fold and x.c == r.c and r.c is not None and x.weight_grams is not None]
        assert r.c_encoded == pytest.approx(np.mean(own or others))
    assert drift.target_encode_out_of_fold(frame.limit(0), "c", "id").isEmpty()
    alone = drift.target_encode_out_of_fold(frame.filter("id = 900"), "c", "id").first()
    assert alone.c_encoded is None


def test_versions_of_parallel_writers(spark, tmp_path):
    folder = str(tmp_path / "tracking")
    with ThreadPoolExecutor(8) as pool:
        versions = list(pool.map(lambda i: run_tables.register_model(spark, folder, "a/b model", f"run{i}")[0], range(16)))
    assert sorted(versions) == list(range(1, 17))
    entries = run_tables.read_registry(spark, folder).collect()
    assert sorted(r.version for r in entries) == list(range(1, 17))
    assert run_tables.register_model(spark, folder, "other", "run0")[0] == 1
    newest = {r.version: r.path for r in entries}[16]
    assert run_tables.registered_path(spark, folder, "a/b model") == newest
    assert not run_tables.claim(spark, f"{folder}/registry-claims/other/1")


def test_lines(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(1e6, 3, 500)
    data = [(float(a), None if i % 9 == 0 else 2.5, None if i % 7 == 0 else float(3 * a + rng.normal())) for i, a in enumerate(x)]
    frame = spark.createDataFrame(data, "a double, flat double, y double").repartition(4)
    lines = {r.i: r for r in pair_lines(frame, ["a", "flat"], "y").collect()}
    known = np.array([(a, y) for a, _, y in data if y is not None])
    slope, intercept = np.polyfit(known[:, 0] - 1e6, known[:, 1], 1)
    assert lines[0].slope == pytest.approx(slope, rel=1e-9) and lines[0].n == len(known)
    assert lines[0].intercept == pytest.approx(intercept - slope * 1e6, abs=1e-4)
    assert lines[1].slope is None and lines[1].intercept is None
