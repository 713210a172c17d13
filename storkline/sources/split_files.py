"""Split sets as one Parquet data set partitioned by split."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storkline import schema as S
from storkline.operators.split import Splits, add_split, model_matrix
from storkline.session import COMPILED, set_for


def _part(folder: str, split: str) -> str:
    return f"{folder.rstrip('/')}/split={split}"


def _read_part(spark: SparkSession, folder: str, split: str) -> DataFrame:
    try:
        return spark.read.parquet(_part(folder, split))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no {split} split at {_part(folder, split)}") from error
        raise


def _write_parts(df: DataFrame, folder: str) -> None:
    """Writes every part of a task to a file of its own at once: a task need not sort its rows by ``split`` first.

    The write sets the limit of ``build_session`` itself: in a session of another's making the rows, too wide for one
    method that the JVM compiles, would be worked out by interpreted code.
    """
    # one file more for rows without a split
    settings = {"spark.sql.maxConcurrentOutputFileWriters": len(S.SPLITS) + 1, **COMPILED}
    with set_for(df.sparkSession, settings):
        df.write.mode("overwrite").option("compression", "zstd").partitionBy("split").parquet(folder)


def save_splits(df: DataFrame, folder: str) -> None:
    """Write all three sets in one pass over the data; ``split`` is added when absent.

    An empty split gets an empty file, so that it loads again with the same columns.
    """
    if "split" not in df.columns:
        df = add_split(df)
    _write_parts(df, folder)
    spark = df.sparkSession
    columns = df.drop("split").schema
    for split in S.SPLITS:
        try:
            _read_part(spark, folder, split)
        except FileNotFoundError:
            spark.createDataFrame([], columns).write.parquet(_part(folder, split))


def load_splits(spark: SparkSession, folder: str) -> Splits:
    """Three frames, each reading its own partition only."""
    return Splits(*[_read_part(spark, folder, split) for split in S.SPLITS])


def read_pruned(spark: SparkSession, folder: str, split: str, target: str = S.TARGET) -> DataFrame:
    """Model features and target as float; the scan reads no other column."""
    df = model_matrix(_read_part(spark, folder, split), target, dtype="float")
    return df.withColumn(target, F.col(target).cast("float"))


def verify_reload(original: Splits, reloaded: Splits) -> list[dict]:
    """Rows and column order of each split before and after a round trip."""
    report = []
    for split, before, after in zip(S.SPLITS, original, reloaded):
        rows_before, rows_after = before.count(), after.count()
        report.append({
            "split": split,
            "rows": rows_after,
            "rows_match": rows_before == rows_after,
            "columns_match": before.columns == after.columns,
        })
    return report
