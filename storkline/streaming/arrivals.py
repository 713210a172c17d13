"""Checks on arrival: rows that fail go to quarantine, the others on, in the same write."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from storkline.operators.validate import row_checks
from storkline.session import COMPILED, set_for

CHECKS = "check string, violations long, rows long"


def check_arrivals(stream: DataFrame, out: str, state: str) -> None:
    """Runs the row checks of the expectations on all files not seen yet, batch by batch.

    Each batch is written once below ``out``/rows, dealt by ``quarantined`` (0 or 1), with the names of its failed checks;
    the counts of violations are observed on the way and kept below ``out``/checks. Both replace what an earlier attempt
    at the same batch left, so a batch that is repeated counts once. ``state`` is the checkpoint.
    """
    checks = row_checks(set(stream.columns))
    met = {name: F.coalesce(condition, F.lit(False)) for name, condition in checks.items()}
    failed = F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c in met.items()]))
    counts = [F.count(F.when(c, 1)).alias(name) for name, c in met.items()]

    def write(batch: DataFrame, number: int) -> None:
        seen = Observation()
        judged = batch.observe(seen, F.count(F.lit(1)).alias("_rows"), *counts).withColumn("failed_checks", failed)
        judged = judged.withColumn("quarantined", (F.size("failed_checks") > 0).cast("int"))
        judged.write.mode("overwrite").partitionBy("quarantined").parquet(f"{out}/rows/batch={number}")
        found = seen.get
        lines = [(name, found[name], found["_rows"]) for name in met]
        # one row per check
        batch.sparkSession.createDataFrame(lines, CHECKS).coalesce(1).write.mode("overwrite").parquet(f"{out}/checks/batch={number}")

    # a stream takes over the settings it is started with
    with set_for(stream.sparkSession, COMPILED):
        query = stream.writeStream.foreachBatch(write).option("checkpointLocation", state).trigger(availableNow=True).start()
    query.awaitTermination()


def arrived(spark: SparkSession, out: str, quarantined: bool) -> DataFrame:
    """The rows that passed all checks, or those in quarantine with ``failed_checks``; other rows' folders are not read."""
    rows = spark.read.parquet(f"{out}/rows").filter(F.col("quarantined") == int(quarantined))
    return rows.drop("quarantined", "batch", *([] if quarantined else ["failed_checks"]))


def arrival_checks(spark: SparkSession, out: str) -> DataFrame:
    """``(check, violations, rows)`` over all batches."""
    table = spark.read.parquet(f"{out}/checks")
    return table.groupBy("check").agg(F.sum("violations").alias("violations"), F.sum("rows").alias("rows"))
