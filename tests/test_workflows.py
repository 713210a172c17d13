import pytest
from pyspark.sql import functions as F

from storkline import schema as S
from storkline.operators import model
from storkline.plans import workflows
from storkline.sources import split_files
from storkline.sources.births import births


@pytest.fixture(scope="module")
def prepared(spark, tmp_path_factory):
    """The births view as raw CSV files, prepared into split sets."""
    folder = tmp_path_factory.mktemp("flow")
    view = births(spark, "/root/testdata/sf0.001")
    for name in S.ERA_FILES:
        rows = view.filter(F.col("source_file") == name)
        rows.select(*S.RAW_COLUMNS).coalesce(1).write.option("header", True).csv(str(folder / "raw" / name))
    counts = workflows.prepare_data(spark, str(folder / "raw"), str(folder / "splits"))
    return folder, view, counts


def test_prepare(spark, prepared):
    folder, view, counts = prepared
    assert counts["rows_in"] == view.count()
    assert sum(s["n_rows"] for s in counts["splits"]) == counts["rows_out"]
    splits = split_files.load_splits(spark, str(folder / "splits"))
    assert sum(s.count() for s in splits) == counts["rows_out"]
    valid = view.filter(F.col("weight_pounds").between(*S.VALID_POUNDS) & F.col("year_fix").between(2010, 2015))
    assert splits.val.count() == valid.count()
    assert set(S.ENGINEERED_COLUMNS) <= set(splits.train.columns)


def test_train(spark, prepared):
    folder, _, _ = prepared
    keyed = str(folder / "keyed")
    parts = split_files.load_splits(spark, str(folder / "splits"))
    rows = parts.train.unionByName(parts.val).unionByName(parts.test).withColumn("record", F.monotonically_increasing_id())
    split_files.save_splits(rows, keyed)

    def space(draw):
        return {"n_estimators": draw.randint(2, 4), "max_depth": 3, "max_bins": 16}

    candidates = {
        "ridge": workflows.Candidate(lambda alpha: model.Ridge(alpha), {"alpha": 1.0}, scale=True),
        "trees": workflows.Candidate(lambda **p: model.gbt(**p), {"n_estimators": 2, "max_bins": 16}, space),
    }
    out = workflows.train_models(
        spark, keyed, str(folder / "tracking"), "record", candidates, n_trials=2, importance_rows=300, importance_repeats=1,
        parallelism=2, shapley_permutations=1,
    )
    assert out.best == "trees_final" and out.version == 1
    assert {r.model for r in out.screening.collect()} == {"ridge_default", "trees_default"}
    assert {r.metric: r.verdict for r in out.gate.collect()}["mae"] == "FAIL"
    assert out.importance.count() == len(S.MODEL_FEATURES)
    assert {r.feature for r in out.shapley.collect()} == set(S.MODEL_FEATURES)
    with pytest.raises(ValueError, match="space"):
        workflows.train_models(spark, keyed, str(folder / "tracking"), "record", {"ridge": candidates["ridge"]})
    again = workflows.finish_model(
        spark, str(folder / "tracking"), "trees_final", None, split_files.load_splits(spark, keyed).val,
        split_files.load_splits(spark, keyed).test, "record", importance_rows=200, importance_repeats=1, shapley_permutations=1,
    )
    assert again.version == 2 and again.test.first().mae == out.test.first().mae
    with pytest.raises(ValueError, match="nothing"):
        workflows.finish_model(spark, str(folder / "tracking"), "nothing", None, rows, rows, "record")
    five = workflows.smoke_test(spark, str(folder / "tracking"), split_files.load_splits(spark, keyed).test)
    assert five.count() == 5
