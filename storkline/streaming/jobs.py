"""Scoring and monitoring as Structured Streaming jobs.

Every job reads files as they arrive and appends to a Parquet table; progress and state live in a
checkpoint. The ``available_now`` runner processes what is there and stops; given the same output and
checkpoint again, it goes on where it stopped. A window is emitted once an event later than its end plus the
lateness has come, so the last window of a stream stays open until then.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storkline.functions.columns import rint_to
from storkline.operators.drift import risk_category
from storkline.session import work_path


def stream_table(spark: SparkSession, folder: str, file_name: str) -> DataFrame:
    """Stream of the Parquet files in a folder whose names match ``file_name``, or of all files of a table of that name."""
    table = spark.read.parquet(f"{folder}/{file_name}")
    arriving = spark.readStream.schema(table.schema)
    # a large table is a folder of part files, whose own names do not match
    if any(path.rsplit("/", 2)[1] == file_name for path in table.inputFiles()):
        return arriving.parquet(f"{folder}/{file_name}")
    return arriving.option("pathGlobFilter", file_name).parquet(folder)


def available_now(stream: DataFrame, name: str, out: str | None = None, state: str | None = None) -> DataFrame:
    """Run an append query over all files not seen yet, and read its whole output table.

    ``out`` and ``state`` name the output and the checkpoint of a job that is continued run by run; without
    them a job starts afresh below the shared folder.
    """
    if (out is None) != (state is None):
        raise ValueError("a continued job needs its output and its checkpoint")
    spark = stream.sparkSession
    out, state = out or work_path(spark, f"{name}-out"), state or work_path(spark, f"{name}-state")
    query = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", out).option("checkpointLocation", state)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def score(records: DataFrame, model: PipelineModel, keep: list[str]) -> DataFrame:
    """Prediction, risk label and near-limit flag of each arriving record."""
    return risk_category(model.transform(records)).select(*keep, "prediction", "risk", "near_limit")


def event_time(ts: str) -> Column:
    return F.col(ts).cast("timestamp")


def request_counts(
    events: DataFrame, width: str = "1 hour", lateness: str = "10 minutes", alert_pct: float = 5.0, key: str | None = None,
) -> DataFrame:
    """Requests, errors and error rate per tumbling window; a window appears once it is closed.

    With a ``key``, an event that was sent again counts once: a key is remembered until the watermark is ``lateness``
    beyond its first event, which is as long as a repeat of it can still arrive in time.
    """
    keys = [F.col(key).alias("_key")] if key else []
    timed = events.select(event_time("ts").alias("ts"), (F.col("event_type") == "error").alias("is_error"), *keys)
    timed = timed.withWatermark("ts", lateness)
    if key:
        timed = timed.dropDuplicatesWithinWatermark(["_key"])
    grouped = timed.groupBy(F.window("ts", width)).agg(
        F.count(F.lit(1)).alias("requests"), F.count(F.when(F.col("is_error"), 1)).alias("errors")
    )
    rate = 100.0 * F.col("errors") / F.col("requests")
    return grouped.select(
        F.col("window.start").alias("window_start"), "requests", "errors",
        rint_to(rate, 4).alias("error_pct"), (rate > alert_pct).cast("int").alias("alert"),
    )


def baseline_bins(values: DataFrame, column: str, low: float, high: float, bins: int) -> DataFrame:
    """Share of the baseline per equal-width bin; the outer bins are open."""
    counted = values.filter(F.col(column).isNotNull()).groupBy(
        value_bin(F.col(column), low, high, bins).alias("bin")
    ).agg(F.count(F.lit(1)).alias("n_base"))
    total = counted.agg(F.sum("n_base")).scalar()
    return counted.select("bin", (F.col("n_base") / total).alias("base_share"))


def value_bin(value: Column, low: float, high: float, bins: int) -> Column:
    raw = F.floor((value - low) * bins / (high - low))
    return F.greatest(F.lit(0), F.least(F.lit(bins - 1), raw)).cast("int")


def value_histograms(
    events: DataFrame, low: float, high: float, bins: int = 10, width: str = "1 day",
    lateness: str = "1 hour",
) -> DataFrame:
    """Histogram of ``value`` per closed window, one row per window."""
    timed = events.filter(F.col("value").isNotNull()).select(
        event_time("ts").alias("ts"), value_bin(F.col("value"), low, high, bins).alias("bin")
    )
    counts = [F.count(F.when(F.col("bin") == i, 1)).alias(f"bin_{i}") for i in range(bins)]
    grouped = timed.withWatermark("ts", lateness).groupBy(F.window("ts", width)).agg(F.count(F.lit(1)).alias("n"), *counts)
    return grouped.select(F.col("window.start").alias("window_start"), "n", *[f"bin_{i}" for i in range(bins)])


def drift_parts(histograms: DataFrame, baseline: DataFrame, bins: int, floor: float = 1e-4) -> DataFrame:
    """Each closed window's bins next to the static baseline, with their parts of the PSI.

    The baseline is joined to the stream as a broadcast table of at most ``bins`` rows.
    """
    counts = F.array(*[f"bin_{i}" for i in range(bins)])
    cells = histograms.select("window_start", "n", F.posexplode(counts).alias("bin", "in_bin"))
    joined = cells.join(F.broadcast(baseline), "bin", "left")
    a = F.greatest(F.col("in_bin") / F.col("n"), F.lit(floor))
    e = F.greatest(F.coalesce("base_share", F.lit(0.0)), F.lit(floor))
    return joined.select("window_start", "n", "bin", "in_bin", ((a - e) * F.ln(a / e)).alias("part"))


def drift_report(parts: DataFrame, alert: float = 0.2) -> DataFrame:
    """PSI and alert per window from the table of parts."""
    out = parts.groupBy("window_start", "n").agg(F.sum("part").alias("psi"))
    return out.select("window_start", "n", rint_to(F.col("psi"), 6).alias("psi"), (F.col("psi") > alert).cast("int").alias("alert"))
