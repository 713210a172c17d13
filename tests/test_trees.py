"""Shapley values of trees against all subsets, prefixes of trees, early stopping, successive halving."""

import itertools
import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from storkline.operators import model, trees
from storkline.plans.queries import QUERIES

NUMERIC, BINARY = ["a", "b", "c"], ["d"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(4)
    x = rng.integers(0, 12, (900, 3)).astype(float)
    d = rng.integers(0, 2, 900)
    y = 3000 + 40 * x[:, 0] - 25 * x[:, 1] * (x[:, 2] > 5) + 80 * d * (x[:, 0] > 6) + rng.normal(0, 60, 900)
    data = [(i, *(None if rng.random() < 0.05 else float(v) for v in x[i]), float(d[i]), float(y[i])) for i in range(900)]
    return spark.createDataFrame(data, "id long, a double, b double, c double, d double, weight_grams double").repartition(3)


def fitted(rows, **params):
    return model.build_pipeline(model.gbt(max_bins=32, **params), False, NUMERIC, BINARY).fit(rows)


def subsets(forest, weights, x):
    """Shapley values by their definition, from the library's own nodes."""
    def expected(node, known):
        if node.numDescendants() == 0:
            return node.prediction()
        split = node.split()
        left, right = node.leftChild(), node.rightChild()
        if split.featureIndex() in known:
            return expected(left if x[split.featureIndex()] <= split.threshold() else right, known)
        n, m = left.impurityStats().rawCount(), right.impurityStats().rawCount()
        return (n * expected(left, known) + m * expected(right, known)) / (n + m)

    p = len(x)
    worth = {s: sum(w * expected(t.rootNode(), s) for t, w in zip(forest, weights))
             for k in range(p + 1) for s in map(frozenset, itertools.combinations(range(p), k))}
    phi = [0.0] * p
    for s, v in worth.items():
        for i in range(p):
            k = len(s)
            phi[i] += v * math.factorial(k - 1) * math.factorial(p - k) / math.factorial(p) if i in s else \
                -v * math.factorial(k) * math.factorial(p - 1 - k) / math.factorial(p)
    return worth[frozenset()], phi


@pytest.mark.parametrize("table_bytes", [trees.TABLE_BYTES, 0])
def test_shapley_against_subsets(rows, monkeypatch, table_bytes):
    """With outcomes worked out ahead, and without."""
    monkeypatch.setattr(trees, "TABLE_BYTES", table_bytes)
    monkeypatch.setattr(trees, "WORK_BYTES", 40_000)
    found = fitted(rows, n_estimators=3, max_depth=4)
    some = rows.filter("id < 12").withColumn("base", F.lit("clash"))
    explained = {r.id: r for r in trees.tree_shapley(found, some, ["id", "weight_grams"]).collect()}
    forest, weights = list(found.stages[-1]._java_obj.trees()), found.stages[-1].treeWeights
    for r in found.transform(some).collect():
        base, phi = subsets(forest, weights, r.features.toArray().tolist())
        e = explained[r.id]
        assert e.base == pytest.approx(base) and e.weight_grams == r.weight_grams
        assert [e[f"phi_{c}"] for c in (*NUMERIC, *BINARY)] == pytest.approx(phi, abs=1e-8)
        assert e.base + sum(phi) == pytest.approx(r.prediction)


def test_shapley_of_no_rows_and_no_splits(rows):
    found = fitted(rows, n_estimators=1, max_depth=2)
    assert trees.tree_shapley(found, rows.limit(0), ["id"]).isEmpty()
    flat = fitted(rows.withColumn("weight_grams", F.lit(5.0)), n_estimators=1, max_depth=2)
    values = trees.tree_shapley(flat, rows.limit(3), ["id"]).select("base", "phi_a", "phi_d").distinct().collect()
    assert [tuple(r) for r in values] == [(5.0, 0.0, 0.0)]


def test_prefixes_and_stopping(spark, rows, tmp_path):
    train, val = rows.filter("id % 3 > 0"), rows.filter("id % 3 = 0")
    found = fitted(train, n_estimators=12, max_depth=4, learning_rate=0.8)
    errors = {r.trees: r for r in trees.prefix_errors(found, val).collect()}
    assert sorted(errors) == list(range(1, 13))
    for k in (1, 5, 12):
        cut = trees.first_trees(found, k)
        row = cut.transform(val).agg(F.avg(F.abs(F.col("weight_grams") - F.col("prediction"))).alias("mae"), F.count("*").alias("n")).first()
        assert errors[k].mae == pytest.approx(row.mae, abs=6e-4) and errors[k].n == row.n
    stopped = trees.stop_early(found, val)
    assert stopped.trees == min(errors, key=lambda k: (errors[k].mae, k)) < 12
    assert stopped.model.stages[-1].getNumTrees == stopped.trees
    stopped.model.write().overwrite().save(str(tmp_path / "cut"))
    again = PipelineModel.load(str(tmp_path / "cut"))
    difference = stopped.model.transform(val).join(again.transform(val).select("id", F.col("prediction").alias("p")), "id")
    assert difference.filter("abs(prediction - p) > 1e-9").isEmpty()
    with pytest.raises(ValueError):
        trees.stop_early(found, val.withColumn("weight_grams", F.lit(None).cast("double")))
    with pytest.raises(ValueError):
        trees.first_trees(found, 13)


def test_halving(rows):
    train, val = rows.filter("id % 3 > 0"), rows.filter("id % 3 = 0")
    space = [{"max_depth": d, "learning_rate": r, "max_bins": 32} for d, r in ((1, 0.01), (1, 0.5), (3, 0.5), (3, 0.01), (2, 0.3))]
    prep = model.FeaturePrep(numericCols=NUMERIC, binaryCols=BINARY)
    best, table = trees.halving_search(space, lambda p: model.gbt(**p), train, val, 2, prep=prep, max_trees=6)
    lines = table.collect()
    rounds = {}
    for r in lines:
        rounds.setdefault(r.round, []).append(r)
    assert [len(rounds[k]) for k in sorted(rounds)] == [5, 3, 2] and [rounds[k][0].trees for k in sorted(rounds)] == [2, 4, 6]
    for k, found in rounds.items():
        order = sorted(found, key=lambda r: (r.val_mae, r.trial))
        kept = {r.trial for r in order if r.survived}
        assert kept == {r.trial for r in order[: len(kept)]}
        if k + 1 in rounds:
            assert kept == {r.trial for r in rounds[k + 1]}
    last = min(rounds[max(rounds)], key=lambda r: (r.val_mae, r.trial))
    assert best == {**space[last.trial], "n_estimators": last.best_trees} and last.survived == 1


def test_the_query_fits_the_default_trees(spark, monkeypatch, tmp_path):
    columns = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_discount double, l_tax double, l_returnflag string, l_linestatus string"
    lines = [(i, 7 * i + 1, i % 50, 1 + i % 7, float(i % 50), 0.05, 0.02, "ANR"[i % 3], "OF"[i % 2]) for i in range(600)]
    spark.createDataFrame(lines, columns).write.parquet(str(tmp_path / "lineitem.parquet"))
    asked, plain = [], model.fit_stored

    def fewer(pipeline, train):
        prep, boosted = pipeline.getStages()
        asked.append((boosted.getMaxIter(), boosted.getMaxDepth(), boosted.getStepSize(), boosted.getMaxBins()))
        return plain(model.Pipeline(stages=[prep, boosted.copy({boosted.maxIter: 2})]), train)

    monkeypatch.setattr(model, "fit_stored", fewer)
    assert len(QUERIES["gbt"](spark, str(tmp_path)).collect()) == 3
    assert asked == [(300, 5, 0.1, 64)]
