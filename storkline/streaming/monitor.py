"""Monitoring with state of its own: quantile sketches per window, and errors once the truth is known."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from storkline.functions.columns import rint_to
from storkline.streaming.jobs import event_time

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# logarithms of doubles over that of the smallest base stay below this
SHIFT = 1_000_000
SKETCH_TYPE = "start_us long, part int, bucket int, n long"


def sketch_base(error: float) -> float:
    return (1 + error) / (1 - error)


def sketch_bucket(value: Column, error: float) -> Column:
    """Bucket of a value in a sketch of relative ``error``, in the order of the values.

    Bucket i of the positive values ends at base^i; negative values mirror them, 0 has its own.
    """
    index = F.ceil(F.ln(F.abs(value)) / math.log(sketch_base(error))).cast("int") + SHIFT
    return F.when(value > 0, index).when(value < 0, -index).when(value == 0, 0)


def bucket_value(bucket: Column, error: float) -> Column:
    """The value that is within the relative error of everything in the bucket."""
    base = sketch_base(error)
    size = 2 * F.pow(F.lit(base), F.abs(bucket) - SHIFT) / (base + 1)
    return F.when(bucket == 0, 0.0).otherwise(F.signum(bucket.cast("double")) * size)


class WindowSketches(StatefulProcessor):
    """Counts per bucket of a key (start and end of a window in microseconds, part); reported and forgotten when the watermark passes its end."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getMapState("counts", "bucket int", "n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        end = int(key[1]) // 1000
        found = pd.concat([r["bucket"] for r in rows]).value_counts()
        # rows of a window that was reported are too late
        if timerValues.getCurrentWatermarkInMs() < end:
            for bucket, n in found.items():
                held = self.counts.getValue((int(bucket),))
                self.counts.updateValue((int(bucket),), ((held[0] if held else 0) + int(n),))
            if not any(self.handle.listTimers()):
                self.handle.registerTimer(end)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        sketch = [(int(key[0]), int(key[2]), b[0], n[0]) for b, n in self.counts.iterator()]
        self.counts.clear()
        yield pd.DataFrame(sketch, columns=["start_us", "part", "bucket", "n"])

    def close(self) -> None:
        pass


def window_sketches(
    events: DataFrame, column: str = "value", error: float = 0.01, width: str = "1 day", lateness: str = "1 hour", parts: int = 8,
) -> DataFrame:
    """Stream ``(window_start, part, bucket, n)``: the quantile sketch of every closed window, in ``parts`` to be added up.

    A sketch counts values in buckets whose ends grow by a constant factor, so every quantile read from it is
    within the relative ``error`` of the true one, whatever the values; no range is fixed ahead. Its state is a
    counter per bucket in use. Rows of one window are dealt to several keys by their hash, so a busy window is not
    one task's; sketches are merged by adding their counters. Null and undefined values are left out, infinite ones too.
    """
    events.sparkSession.conf.set(STATE_STORE, ROCKSDB)
    value = F.col(column).cast("double")
    known = events.filter(value.isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf")))
    timed = known.select(event_time("ts").alias("ts"), sketch_bucket(value, error).alias("bucket"), F.xxhash64(*known.columns).alias("_hash"))
    window = F.window("ts", width)
    keyed = timed.withWatermark("ts", lateness).select(
        "ts", "bucket", F.unix_micros(window.start).alias("start_us"), F.unix_micros(window.end).alias("end_us"),
        F.pmod("_hash", F.lit(parts)).cast("int").alias("part"),
    )
    found = keyed.groupBy("start_us", "end_us", "part").transformWithStateInPandas(WindowSketches(), SKETCH_TYPE, "append", "eventTime")
    return found.select(F.timestamp_micros("start_us").alias("window_start"), "part", "bucket", "n")


def batch_sketch(values: DataFrame, column: str = "value", error: float = 0.01) -> DataFrame:
    """``(bucket, n)`` of a table, as a baseline."""
    value = F.col(column).cast("double")
    known = values.filter(value.isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf")))
    return known.groupBy(sketch_bucket(value, error).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def sketch_quantiles(sketches: DataFrame, keys: list[str], probabilities: list[float], error: float = 0.01) -> DataFrame:
    """``keys``, ``n`` and ``q<percent>`` from sketches that are merged by adding up equal buckets."""
    merged = sketches.groupBy(*keys, "bucket").agg(F.sum("n").alias("n"))
    order = Window.partitionBy(*keys).orderBy("bucket")
    upto = merged.select(
        *keys, "bucket", F.sum("n").over(order).alias("_upto"), F.sum("n").over(Window.partitionBy(*keys)).alias("n"),
    )
    reached = [
        bucket_value(F.min(F.when(F.col("_upto") >= F.greatest(F.lit(1), F.ceil(F.col("n") * p)), F.col("bucket"))), error).alias(f"q{round(100 * p)}")
        for p in probabilities
    ]
    return upto.groupBy(*keys, "n").agg(*reached)


def quantile_drift(
    sketches: DataFrame, baseline: DataFrame, probabilities: list[float] = (0.1, 0.5, 0.9), error: float = 0.01, alert: float = 0.1,
) -> DataFrame:
    """Quantiles of each window, their largest relative distance from the baseline's, and an alert beyond ``alert``.

    ``baseline`` is the result of ``batch_sketch``: one row of quantiles, joined to every window.
    """
    names = [f"q{round(100 * p)}" for p in probabilities]
    base = sketch_quantiles(baseline.withColumn("_all", F.lit(1)), ["_all"], list(probabilities), error).select(
        *[F.col(n).alias(f"_{n}") for n in names]
    )
    found = sketch_quantiles(sketches, ["window_start"], list(probabilities), error).crossJoin(F.broadcast(base))
    moved = F.greatest(*[F.abs(F.col(n) - F.col(f"_{n}")) / F.nullif(F.abs(f"_{n}"), F.lit(0.0)) for n in names], F.lit(0.0))
    return found.select("window_start", "n", *names, moved.alias("moved"), (moved > alert).cast("int").alias("alert"))


def late_truth_errors(
    predictions: DataFrame, outcomes: DataFrame, key: str, wait: str = "6 hours", width: str = "1 day", lateness: str = "1 hour",
) -> DataFrame:
    """Stream ``(window_start, n, mae)`` of predictions whose outcome came within ``wait``, per window of the prediction.

    ``predictions(key, ts, prediction)`` and ``outcomes(key, ts, actual)`` are streams with watermarks of their own.
    State holds a prediction until outcomes later than its wait can no longer come; a window is reported once no
    outcome for it can. Predictions without an outcome, and outcomes that come too late, count nowhere; an
    outcome sent twice counts twice.
    """
    made = predictions.select(F.col(key).alias("_key"), event_time("ts").alias("made"), "prediction").withWatermark("made", lateness)
    known = outcomes.select(F.col(key).alias("_of"), event_time("ts").alias("known"), "actual").withWatermark("known", lateness)
    within = F.expr(f"_key = _of AND known >= made AND known <= made + INTERVAL {wait}")
    joined = made.join(known, within).select("made", F.abs(F.col("prediction") - F.col("actual")).alias("off"))
    errors = joined.groupBy(F.window("made", width)).agg(F.count("off").alias("n"), F.avg("off").alias("mae"))
    return errors.select(F.col("window.start").alias("window_start"), "n", "mae")


def late_retrain(errors: DataFrame, baseline_mae: float, max_increase_pct: float = 10.0) -> DataFrame:
    """Each window's error against the baseline's, and whether it calls for training again."""
    increase = 100.0 * (F.col("mae") - baseline_mae) / baseline_mae
    return errors.select(
        "window_start", "n", rint_to(F.col("mae"), 6).alias("mae"), rint_to(increase, 4).alias("increase_pct"),
        (increase > max_increase_pct).cast("int").alias("retrain"),
    )
