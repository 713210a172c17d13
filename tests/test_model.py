import random

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from conftest import values
from storkline import schema as S
from storkline.operators import explain, model
from storkline.operators.metrics import all_metrics, evaluate_split
from storkline.operators.trees import leaf_changes, tree_shapley
from storkline.sources import run_tables


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    """Births with a known effect of gestation, plurality and sex; missing values in two columns."""
    rng = np.random.default_rng(0)
    n = 1500
    columns = {f: rng.integers(0, 4, n).astype(float) for f in S.MODEL_FEATURES}
    columns["gestation_weeks"] = rng.integers(28, 43, n).astype(float)
    columns["year_fix"] = rng.integers(1990, 2020, n).astype(float)
    columns["is_male"] = rng.integers(0, 2, n).astype(float)
    target = 100 * columns["gestation_weeks"] - 300 * columns["plurality"] + 120 * columns["is_male"] + rng.normal(0, 80, n)
    columns["father_age"][::4] = np.nan
    columns["mother_married"][::5] = np.nan
    columns |= {"weight_grams": target, "record": np.arange(n).astype(float)}
    rows = [tuple(None if np.isnan(columns[c][i]) else float(columns[c][i]) for c in columns) for i in range(n)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns)).withColumn("record", F.col("record").cast("long"))
    path = str(tmp_path_factory.mktemp("model") / "rows")
    df.write.parquet(path)
    df = spark.read.parquet(path)
    return df.filter("record < 1000"), df.filter("record >= 1000"), columns


SMALL = {"n_estimators": 8, "max_depth": 3, "learning_rate": 0.3, "max_bins": 16}


@pytest.fixture(scope="module")
def trees(data):
    return model.build_pipeline(model.gbt(**SMALL)).fit(data[0])


@pytest.fixture(scope="module")
def ridge(data):
    return model.build_pipeline(model.Ridge(1.0), True).fit(data[0])


def filled(columns, rows):
    out = {}
    for f in S.MODEL_FEATURES:
        train = columns[f][:1000]
        known = train[~np.isnan(train)]
        if f in S.NUMERIC_FEATURES:
            fill = np.median(known)
        else:
            found, n = np.unique(known, return_counts=True)
            fill = found[n.argmax()]
        x = np.where(np.isnan(columns[f]), fill, columns[f])
        out[f] = x[rows]
    return out


def test_fill_values(spark):
    df = spark.createDataFrame(
        [(1.0, 1.0, None), (2.0, 1.0, None), (4.0, 0.0, None), (9.0, 0.0, None), (None, None, None)], "a double, b double, c double"
    )
    got = {r.feature: (r.strategy, r.fill) for r in model.fit_statistics(df, ["a", "c"], ["b"]).collect()}
    assert got == {"a": ("median", 3.0), "b": ("most_frequent", 0.0), "c": ("median", None)}


def test_statistics_hold_after_filling(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (None, 5.0)], "a double, b double")
    got = {r.feature: r for r in model.fit_statistics(df, ["a", "b"], []).collect()}
    assert got["a"].mean == 2.0 and got["a"].std_pop == pytest.approx(np.std([1.0, 3.0, 2.0])) and got["b"].std_pop == 0.0


def test_preparation_drops_a_column_without_values(spark):
    train = spark.createDataFrame([(1.0, None, 2.0), (None, None, 4.0)], "a double, b double, c double")
    prep = model.FeaturePrep(numericCols=["a", "b", "c"], binaryCols=[], scaleNumeric=True).fit(train)
    rows = [r.features.toArray().tolist() for r in prep.transform(train).collect()]
    # a constant column is centred and divided by one
    assert rows == [[0.0, -1.0], [0.0, 1.0]]


def test_preparation_is_fitted_on_train_only(data):
    train, val, columns = data
    prep = model.FeaturePrep(scaleNumeric=True).fit(train)
    got = prep.transform(val).orderBy("record").select("x_father_age", "x_mother_married").collect()
    full = filled(columns, slice(None))
    x = full["father_age"]
    want = (x[1000:] - x[:1000].mean()) / x[:1000].std()
    assert [r.x_father_age for r in got] == pytest.approx(want.tolist())
    assert [r.x_mother_married for r in got] == full["mother_married"][1000:].tolist()


def test_ridge_equals_the_closed_form(data, ridge):
    _, val, columns = data
    full = filled(columns, slice(None))
    x = np.column_stack([
        (full[f] - full[f][:1000].mean()) / (full[f][:1000].std() or 1.0) if f in S.NUMERIC_FEATURES else full[f] for f in S.MODEL_FEATURES
    ])
    y = columns["weight_grams"]
    centre, mean = x[:1000].mean(axis=0), y[:1000].mean()
    xc = x[:1000] - centre
    w = np.linalg.solve(xc.T @ xc + np.eye(xc.shape[1]), xc.T @ (y[:1000] - mean))
    got = values(ridge.transform(val).orderBy("record"), "prediction")
    assert got == pytest.approx((mean + (x[1000:] - centre) @ w).tolist(), rel=1e-9)


def test_models_rank_as_expected(data, ridge, trees):
    train, val, _ = data
    mean = model.build_pipeline(model.BaselineMean()).fit(train)
    mae = {name: evaluate_split(m, val).first().val_mae for name, m in (("mean", mean), ("ridge", ridge), ("trees", trees))}
    assert mae["ridge"] < mae["mean"] and mae["trees"] < mae["mean"]
    assert set(values(mean.transform(val), "prediction")) == {train.agg(F.avg("weight_grams")).first()[0]}


def test_prediction_is_never_null(data, ridge, trees):
    _, val, _ = data
    hollow = val.withColumns({f: F.lit(None).cast("double") for f in S.MODEL_FEATURES})
    for m in (ridge, trees):
        assert m.transform(hollow).filter("prediction is null or isnan(prediction)").count() == 0


def test_parameter_names():
    tree = model.gbt(n_estimators=7, num_leaves=100, learning_rate=0.05, min_child_samples=30, subsample=0.8, colsample_bytree=0.7, reg_alpha=1.0)
    assert (tree.getMaxIter(), tree.getMaxDepth(), tree.getStepSize(), tree.getMinInstancesPerNode()) == (7, 7, 0.05, 30)
    assert (tree.getSubsamplingRate(), tree.getFeatureSubsetStrategy(), tree.getSeed()) == (0.8, "0.7", 42)
    for space in (model.leafwise_space, model.depthwise_space):
        drawn = [space(random.Random(i)) for i in range(50)]
        assert all(200 <= d["n_estimators"] <= 1000 and d["n_estimators"] % 100 == 0 for d in drawn)
        assert all(0.01 <= d["learning_rate"] <= 0.3 and 0.6 <= d["subsample"] <= 1.0 for d in drawn)
        model.gbt(**drawn[0])


def test_train_log_register_reload(spark, data, tmp_path):
    train, val, _ = data
    folder = str(tmp_path / "tracking")
    pipeline = model.build_pipeline(model.Ridge(1.0), True)
    fitted, run = model.train_and_log(pipeline, "ridge", train, val, folder, {"alpha": 1.0}, {"stage": "test"})
    row = run_tables.find_run(run_tables.read_runs(spark, folder), "ridge").first()
    assert row.run_id == run.run_id and row.params["alpha"] == "1.0" and row.tags["stage"] == "test"
    assert (row.params["n_train"], row.params["n_val"], row.params["n_features"]) == ("1000", "500", "21")
    direct = evaluate_split(fitted, val).first()
    assert row.metrics["val_mae"] == direct.val_mae and row.metrics["val_f1"] == direct.val_f1
    assert "train_time_sec" in row.metrics and "train_r2" in row.metrics
    run_tables.register_model(spark, folder, "weights", run.run_id)
    path = run_tables.registered_path(spark, folder, "weights")
    five = model.reload_predict(spark, path, val.orderBy("record"), 5).collect()
    want = fitted.transform(val.orderBy("record").limit(5)).select("prediction", "weight_grams").collect()
    assert [(r.predicted, r.actual) for r in five] == [tuple(r) for r in want]
    assert all(r.error == abs(r.predicted - r.actual) for r in five)


def test_tree_pipeline_survives_saving(data, trees, tmp_path):
    _, val, _ = data
    trees.write().overwrite().save(str(tmp_path / "m"))
    loaded = PipelineModel.load(str(tmp_path / "m"))
    rows = val.orderBy("record").limit(20)
    assert values(loaded.transform(rows), "prediction") == values(trees.transform(rows), "prediction")


def test_search_keeps_the_best_trial(spark, data, tmp_path):
    train, val, _ = data
    folder = str(tmp_path / "t")

    def space(draw):
        return {**SMALL, "n_estimators": draw.randint(1, 4), "max_depth": draw.randint(1, 3)}

    best, trials = model.run_search("trees", space, lambda p: model.gbt(**p), train, val, 3, runs=folder, parallelism=2)
    errors = [t.metrics["val_mae"] for t in trials]
    assert {k: str(v) for k, v in best.items()} == trials[errors.index(min(errors))].params
    runs = run_tables.read_runs(spark, folder)
    assert runs.count() == 4
    assert runs.filter("run_name = 'trees_3_trials'").first().metrics["best_val_mae"] == min(errors)
    again, _ = model.run_search("trees", space, lambda p: model.gbt(**p), train, val, 3)
    assert again == best


def test_search_holds_no_rows_itself(data, monkeypatch):
    """Trials read the columns that were written once; only the regressor keeps rows with the executors."""
    train, val, _ = data
    held = []
    monkeypatch.setattr(type(train), "persist", lambda self, *a: held.append(self) or self)
    model.run_search("trees", lambda draw: {**SMALL, "n_estimators": 1, "max_depth": 1}, lambda p: model.gbt(**p), train, val, 2)
    assert held == []


def test_screening(spark, data):
    train, val, _ = data
    table = model.screening_table({"mean": (model.BaselineMean(), False), "ridge": (model.Ridge(), True)}, train, val, "record", sample=400)
    assert values(table, "model") == ["ridge", "mean"]


def test_kfold(data):
    train, _, _ = data
    rows = model.kfold_scores(train, lambda: model.build_pipeline(model.Ridge(), True), 3, "record").collect()
    assert sorted(r.fold for r in rows) == [0, 1, 2] and sum(r.n for r in rows) == 1000
    assert all(r.r2 > 0.5 for r in rows)


# ---- explanation


def test_partner_is_a_permutation(data):
    _, val, _ = data
    for blocks in (1, 7):
        pairs = explain.with_partner(val.select("record"), ["record"], 3, blocks).select("record", "_partner.record").toDF("a", "b").collect()
        assert sorted(r.a for r in pairs) == sorted(r.b for r in pairs) == list(range(1000, 1500))
        assert sum(r.a != r.b for r in pairs) > 480


def test_permutation_importance(data, trees):
    train, val, _ = data
    rows = explain.permutation_importance(trees, val, repeats=3).collect()
    assert len(rows) == len(S.MODEL_FEATURES)
    assert {r.feature for r in rows[:2]} == {"gestation_weeks", "plurality"} and rows[0].importance > 100
    mean = model.build_pipeline(model.BaselineMean()).fit(train)
    assert {r.importance for r in explain.permutation_importance(mean, val, repeats=1).collect()} == {0.0}


def test_linear_shapley_adds_up(data, ridge):
    _, val, _ = data
    explained = explain.linear_shapley(ridge, val)
    total = sum((F.col(f"phi_{f}") for f in S.MODEL_FEATURES), F.lit(0.0))
    predicted = ridge.transform(val).agg(F.avg("prediction")).first()[0]
    for r in ridge.stages[-1].transform(explained.withColumn("total", total)).select("total", "prediction").collect():
        assert r.total == pytest.approx(r.prediction - predicted, abs=1e-6)
    ranked = values(explain.mean_absolute_shapley(explained, S.MODEL_FEATURES), "feature")
    assert set(ranked[:2]) == {"gestation_weeks", "plurality"}


def test_sampled_shapley_of_a_linear_model(data, ridge):
    """For a linear model each walk gives weight * (x - partner) exactly, so the sums must agree."""
    _, val, _ = data
    phi = explain.sampled_shapley(ridge, val, "record", permutations=4)
    sums = phi.groupBy("record").agg(F.sum("phi").alias("s"))
    predicted = ridge.transform(val).select("record", "prediction")
    mean = predicted.agg(F.avg("prediction")).first()[0]
    # partners run over all rows once per walk, so their mean prediction is the overall mean
    total = sums.join(predicted, "record").agg(F.avg("s"), F.avg(F.col("prediction"))).first()
    assert total[0] == pytest.approx(total[1] - mean, abs=1e-6)
    exact = explain.linear_shapley(ridge, val).select("record", "phi_gestation_weeks")
    both = phi.filter("feature = 'gestation_weeks'").join(exact, "record")
    assert both.agg(F.corr("phi", "phi_gestation_weeks")).first()[0] > 0.8
    assert phi.count() == 500 * len(S.MODEL_FEATURES)


def test_builtin_importance(trees):
    rows = explain.builtin_importance(trees).collect()
    assert len(rows) == len(S.MODEL_FEATURES) and sum(r.importance for r in rows) == pytest.approx(1.0)
    assert rows[0].feature == "gestation_weeks"


def test_metrics_of_all_splits(data, ridge):
    train, val, _ = data
    both = train.withColumn("split", F.lit("train")).unionByName(val.withColumn("split", F.lit("val")))
    got = {r.split: r.mae for r in all_metrics(ridge.transform(both), ["split"]).collect()}
    assert got["val"] == evaluate_split(ridge, val).first().val_mae


def test_equal_keys_are_explained_each(data, trees):
    _, val, _ = data
    same = val.limit(40).withColumn("record", F.lit(1).cast("long"))
    phi = explain.sampled_shapley(trees, same, "record", permutations=1)
    assert phi.groupBy("feature").count().select("count").distinct().collect() == [(40,)]


def test_no_rows(spark, data):
    train, _, _ = data
    none = train.limit(0)
    with pytest.raises(ValueError, match="no training rows"):
        model.BaselineMean().fit(none)
    scored = model.BaselineMean().fit(train).transform(none)
    row = all_metrics(scored).first()
    assert (row.mae, row.r2, row.n_lbw_true) == (None, None, 0)


def test_fit_works_rows_out_once(spark, data):
    """Statistics and all passes of the trees read what was written, not the rows' own source."""
    train, _, _ = data
    drawn = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def seen(value):
        drawn.add(1)
        return value

    pipeline = model.build_pipeline(model.gbt(n_estimators=2, max_depth=2), False, ["gestation_weeks", "plurality"], ["is_male"])
    watched = train.withColumn(S.TARGET, seen(F.col(S.TARGET).cast("double")))
    fitted = model.fit_stored(pipeline, watched)
    assert drawn.value == train.count()
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    plain = pipeline.fit(train)
    both = [values(m.transform(train).orderBy("record"), "prediction") for m in (fitted, plain)]
    assert both[0] == pytest.approx(both[1]) and not fitted.stages[-1].getCacheNodeIds()


@pytest.mark.parametrize("asked", [S.MODEL_FEATURES, ["gestation_weeks", "month", "plurality"]])
def test_swaps_by_leaves_equal_scoring(data, trees, monkeypatch, asked):
    """Only few rows are scored, and as before, whatever number of features is asked for."""
    val = data[1].coalesce(1)  # one file, so that both ways draw alike
    by_leaves = {r.feature: (r.importance, r.std) for r in explain.permutation_importance(trees, val, S.MODEL_FEATURES, repeats=2).collect()}
    some = {r.feature: r.importance for r in explain.permutation_importance(trees, val, asked, repeats=2).collect()}
    assert some == pytest.approx({f: by_leaves[f][0] for f in asked}, abs=1e-9)
    monkeypatch.setattr(explain, "is_boosted", lambda _: False)
    for r in explain.permutation_importance(trees, val, S.MODEL_FEATURES, repeats=2).collect():
        assert by_leaves[r.feature] == pytest.approx((r.importance, r.std), abs=1e-6)


def test_walks_by_leaves_equal_scoring(data, trees):
    """Step by step, with the model's own predictions."""
    groups, tested = leaf_changes(trees)
    at = [S.MODEL_FEATURES.index(f) for f in tested]
    rng = np.random.default_rng(5)
    x, z = (np.stack([filled(data[2], slice(n, n + 200))[f] for f in tested], axis=1) for n in (1000, 1200))
    place = np.argsort(rng.random((200, len(S.MODEL_FEATURES))), axis=1)[:, at] + 1
    phi, wanted, last = np.zeros_like(x), np.zeros_like(x), None
    for step in range(len(S.MODEL_FEATURES) + 1):
        now, mixed = np.zeros(200), np.where(place <= step, x, z)
        for g in groups:
            now += g.passed(mixed).all(axis=2) @ g.worth
        if last is not None:
            wanted += np.where(place == step, (now - last)[:, None], 0.0)
        last = now
    for g in groups:
        g.add_walk(phi, x, z, place)
    assert np.abs(phi - wanted).max() < 1e-9 and np.abs(phi).max() > 100


def test_walks_of_trees_carry_sums(data, trees):
    """Rows are not multiplied by steps or put together by row, and values add up as those of any model do."""
    val = data[1]
    phi = explain.sampled_shapley(trees, val, "record", permutations=3)
    plan = phi._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" not in plan and "_step" not in plan
    assert phi.count() == 500 * len(S.MODEL_FEATURES)
    sums = {r.record: r.s for r in phi.groupBy("record").agg(F.sum("phi").alias("s")).collect()}
    predicted = {r.record: r.prediction for r in trees.transform(val).collect()}
    assert np.mean(list(sums.values())) == pytest.approx(0.0, abs=1e-6)
    gaps = [predicted[k] - sums[k] for k in sums]
    assert np.mean(gaps) == pytest.approx(np.mean(list(predicted.values())))
    exact = tree_shapley(trees, val, ["record"]).select("record", "phi_gestation_weeks")
    both = phi.filter("feature = 'gestation_weeks'").join(exact, "record")
    assert both.agg(F.corr("phi", "phi_gestation_weeks")).first()[0] > 0.8
