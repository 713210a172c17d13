import pytest
from pyspark.sql import functions as F

from conftest import RAW_ROWS, values
from storkline import schema as S
from storkline.operators.clean import run_preprocessing
from storkline.operators.features import engineer_features
from storkline.operators.split import temporal_split
from storkline.sources import raw_files, run_tables, split_files

HEADER = ["weight_pounds", "year_fix", "lmp", "is_male", "gestation_weeks", "state", "extra"]


def write(path, header, *lines):
    path.write_text("\n".join([",".join(header), *lines]) + "\n")
    return str(path)


def test_scan_selects_types_and_drops_extra_columns(spark, tmp_path, caplog):
    path = write(tmp_path / "newborn_1994", HEADER, "7.5,1994,01012000,true,39,CA,zzz", "5.2,1995.0, 9999,false,abc,NA,zzz")
    df = raw_files.scan_csv(spark, path)
    assert df.columns[0] == "source_year" and "extra" not in df.columns
    assert df.columns[1:] == [c for c in S.RAW_COLUMNS if c in HEADER]
    assert "mother_age" in caplog.text
    first, second = df.collect()
    assert (first.source_year, first.year_fix, first.lmp, first.gestation_weeks) == (1994, 1994, "01012000", 39.0)
    # text that is no number becomes null, a missing-value text becomes null, zeros of a date stay
    assert (second.year_fix, second.gestation_weeks, second.state) == (1995, None, None)


def test_bad_lines(spark, tmp_path):
    path = write(
        tmp_path / "newborn_2002", ["year_fix", "month", "state"],
        "2003,1,CA", "2003,2,TX,surplus", "2003,3", "", '2003,4,"a,b"', '2003,5,"x ""q"", y"', "2003,6,CA,", "2003",
    )
    rows = raw_files.scan_csv(spark, path).orderBy("month").collect()
    assert [(r.month, r.state) for r in rows] == [(None, None), (1, "CA"), (3, None), (4, "a,b"), (5, 'x "q", y')]
    # the count alone must not see the dropped lines either
    assert raw_files.scan_csv(spark, path).count() == 5
    assert raw_files.scan_csv(spark, path).select("year_fix").count() == 5


def test_era_is_given_inferred_or_unknown(spark, tmp_path):
    path = write(tmp_path / "my_newborn_2010_part", ["year_fix"], "2011")
    assert raw_files.scan_csv(spark, path).first().source_year == 2010
    assert raw_files.scan_csv(spark, path, era_year=1990).first().source_year == 1990
    other = write(tmp_path / "other", ["year_fix"], "2011")
    assert raw_files.scan_csv(spark, other).first().source_year is None


def test_absent_file(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="nowhere"):
        raw_files.scan_csv(spark, str(tmp_path / "nowhere"))


def test_load_all_by_name_not_by_position(spark, tmp_path, caplog):
    write(tmp_path / "newborn_1986", ["year_fix", "month", "day"], "1987,1,2", "1988,3,4")
    write(tmp_path / "newborn_1994", ["day", "year_fix", "alcohol_use"], "20,1995,true")
    df = raw_files.load_all(spark, str(tmp_path))
    rows = {r.year_fix: r for r in df.collect()}
    assert (rows[1987].month, rows[1987].day, rows[1987].alcohol_use) == (1, 2, None)
    assert (rows[1995].month, rows[1995].day, rows[1995].alcohol_use) == (None, 20, "true")
    assert (rows[1995].source_year, rows[1995].source_file) == (1994, "newborn_1994")
    assert "newborn_2018" in caplog.text


def test_load_all_limits_and_filters(spark, tmp_path):
    for name in ("newborn_1986", "newborn_2018"):
        write(tmp_path / name, ["year_fix"], *["1990"] * 10)
    counts = raw_files.load_all(spark, str(tmp_path), nrows_per_file=3).groupBy("source_file").count()
    assert {r.source_file: r["count"] for r in counts.collect()} == {"newborn_1986": 3, "newborn_2018": 3}
    assert raw_files.load_all(spark, str(tmp_path), ["newborn_2018"]).count() == 10
    with pytest.raises(ValueError, match="newborn_2002"):
        raw_files.load_all(spark, str(tmp_path), ["newborn_2002"])


def test_peek(spark, tmp_path):
    path = write(tmp_path / "f", ["year_fix", "month"], "1990,1", "1991,2")
    plain, headed = raw_files.peek_raw(spark, path, 2)
    assert plain.first()[0] == "year_fix" and plain.count() == 2
    assert headed.columns == ["year_fix", "month"] and headed.first()[0] == "1990"


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"), "a"), (1.0, "b")], "x double, s string")
    assert values(raw_files.nan_to_null(df), "x") == [None, 1.0]


def test_splits_round_trip(spark, features_frame, tmp_path):
    folder = str(tmp_path / "new" / "splits")
    split_files.save_splits(features_frame, folder)
    original, loaded = temporal_split(features_frame), split_files.load_splits(spark, folder)
    for line in split_files.verify_reload(original, loaded):
        assert line["rows_match"] and line["columns_match"], line
    assert loaded.train.dtypes == features_frame.dtypes
    # saving again replaces
    split_files.save_splits(features_frame.filter("year_fix < 2010"), folder)
    assert [s.count() for s in split_files.load_splits(spark, folder)] == [2, 0, 0]
    assert split_files.load_splits(spark, folder).val.columns == features_frame.columns


def test_missing_split_is_named(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="train"):
        split_files.load_splits(spark, str(tmp_path / "none"))


def test_pruned_read(spark, features_frame, tmp_path):
    folder = str(tmp_path / "s")
    split_files.save_splits(features_frame, folder)
    df = split_files.read_pruned(spark, folder, "train")
    assert df.columns == [*S.MODEL_FEATURES, "weight_grams"] and {t for _, t in df.dtypes} == {"float"}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "source_file" not in plan.split("ReadSchema")[1]


def test_csv_to_splits(spark, raw, tmp_path):
    """From a raw file to saved splits."""
    raw.coalesce(1).write.option("header", True).csv(str(tmp_path / "newborn_1986"))
    df = raw_files.load_all(spark, str(tmp_path), ["newborn_1986"])
    assert df.count() == len(RAW_ROWS)
    out = engineer_features(run_preprocessing(df))
    assert [s.count() for s in temporal_split(out)] == [2, 1, 1]
    split_files.save_splits(out, str(tmp_path / "out"))
    assert split_files.load_splits(spark, str(tmp_path / "out")).test.first().weight_grams == 4989.5


def test_runs_and_registry(spark, tmp_path):
    folder = str(tmp_path / "tracking")
    older = run_tables.Run("a", "final", 1000, {"k": "1"}, {"mae": 2.0}, {})
    newer = run_tables.Run("b", "final", 2000, {}, {"mae": 1.0}, {"t": "x"})
    run_tables.append_run(spark, folder, older)
    run_tables.append_run(spark, folder, newer, run_tables.Run.new("other", {"mae": 3.0}))
    runs = run_tables.read_runs(spark, folder)
    assert runs.count() == 3
    assert run_tables.find_run(runs, "final").first().run_id == "b"
    assert run_tables.find_run(runs, "nothing").count() == 0
    assert run_tables.register_model(spark, folder, "m", "a", {"mae": 2.0})[0] == 1
    version, path = run_tables.register_model(spark, folder, "m", "b", tags={"stage": "test"})
    assert version == 2 and run_tables.registered_path(spark, folder, "m") == path
    assert run_tables.registered_path(spark, folder, "m", 1).endswith("/a")
    assert run_tables.register_model(spark, folder, "n", "a")[0] == 1
    with pytest.raises(ValueError):
        run_tables.registered_path(spark, folder, "unknown")


def test_source_year_column(spark):
    df = spark.createDataFrame([("x/newborn_2018",), ("newborn_1986.csv",), ("else",)], "f string")
    assert values(df.select(raw_files.source_year_from_file(F.col("f")).alias("y")), "y") == [2018, 1986, None]


def test_first_rows_are_the_first(spark, tmp_path):
    folder = tmp_path / "newborn_1986"
    folder.mkdir()
    # the later part is the larger one, which a scan takes first
    write(folder / "part-00000", ["year_fix", "state"], *[f"{1900 + i},A" for i in range(5)])
    write(folder / "part-00001", ["year_fix", "state"], *[f"{2000 + i},{'B' * 50}" for i in range(99)])
    got = raw_files.load_all(spark, str(tmp_path), ["newborn_1986"], nrows_per_file=7)
    assert sorted(values(got, "year_fix")) == [1900, 1901, 1902, 1903, 1904, 2000, 2001]
    plain, headed = raw_files.peek_raw(spark, str(folder), 2)
    assert values(headed, "year_fix") == ["1900", "1901"] and [r[0] for r in plain.collect()] == ["year_fix", "1900"]


def test_part_with_another_header_is_an_error(spark, tmp_path):
    folder = tmp_path / "newborn_1994"
    folder.mkdir()
    write(folder / "part-00000", ["year_fix", "month"], "1991,2")
    write(folder / "part-00001", ["month", "year_fix"], "3,1992")
    with pytest.raises(Exception, match="header"):
        raw_files.scan_csv(spark, str(folder)).collect()


def test_quoted_line_break(spark, tmp_path):
    path = write(tmp_path / "newborn_2010", ["year_fix", "state"], '2011,"a\nb"', "2012,CA")
    rows = raw_files.scan_csv(spark, path, multi_line=True).orderBy("year_fix").collect()
    assert [(r.year_fix, r.state) for r in rows] == [(2011, "a\nb"), (2012, "CA")]


def test_splits_are_written_without_a_sort(spark, features_frame, tmp_path):
    """A task has a file open for every part; what it would sort, it would spill."""
    folder = str(tmp_path / "unsorted")
    split_files.save_splits(features_frame, folder)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
    names = [f.name for f in (tmp_path / "unsorted").rglob("*.parquet")]
    assert names and all(".zstd." in n for n in names)
    assert [s.count() for s in split_files.load_splits(spark, folder)] == [s.count() for s in temporal_split(features_frame)]


def test_numbers_are_cast_once(spark, tmp_path):
    """Missing-value texts need no test of their own where a number is wanted."""
    texts = [*S.NA_TEXTS, " 12 ", "3.5", " nan", "x", "1e2"]
    path = str(tmp_path / "newborn_2002")
    spark.createDataFrame([(t, t, t) for t in texts], "mother_age string, year_fix string, state string").write.options(
        header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)
    df = raw_files.scan_csv(spark, path)
    assert sorted(r.mother_age for r in df.filter("mother_age is not null").collect()) == [3.5, 12.0, 100.0]
    assert sorted(r.year_fix for r in df.filter("year_fix is not null").collect()) == [3, 12, 100]
    assert sorted(r.state for r in df.filter("state is not null").collect()) == [" 12 ", "1e2", "3.5", "x"]
    plan = df.select("mother_age", "year_fix")._jdf.queryExecution().optimizedPlan().toString()
    assert "trim(" not in plan and "INSET" not in plan and " IN (" not in plan


def test_splits_are_written_by_compiled_code(spark, features_frame, tmp_path):
    """In a session without the limit on methods, too, the write has it, and the session's own value returns."""
    name, seen = "spark.sql.codegen.hugeMethodLimit", []

    class Frame:
        sparkSession = spark

        @property
        def write(self):
            seen.append(int(spark.conf.get(name)))
            return features_frame.withColumn("split", F.lit("train")).write

    usual = spark.conf.get(name)
    spark.conf.set(name, 65535)
    try:
        split_files._write_parts(Frame(), str(tmp_path / "compiled"))
        assert (seen, spark.conf.get(name)) == ([8000], "65535")
    finally:
        spark.conf.set(name, usual)
