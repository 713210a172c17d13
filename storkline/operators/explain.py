"""What a fitted model relies on: permutation importance, Shapley values, built-in importance."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storkline import schema as S
from storkline.operators.model import PREPARED, prepared_features
from storkline.operators.trees import is_boosted, leaf_changes, matrix
from storkline.session import stored

BLOCK_ROWS = 100_000


def with_partner(rows: DataFrame, columns: list[str], seed: int, blocks: int) -> DataFrame:
    """Adds ``_partner``: the columns of another row, each row serving exactly one other.

    Rows go to random blocks and take the next row of their block in random order, the last one
    taking the first: a random permutation without a global order. Position, not the key, decides
    the block, so copies of one record spread over all blocks. ``rows`` must be read from a table
    (see ``stored``), so that a repeated task draws the same numbers.
    """
    return met(rows.withColumns(draws(seed, blocks)), columns).drop("_block", "_order")


def draws(seed: int, blocks: int, name: str = "") -> dict[str, Column]:
    return {f"_block{name}": F.floor(F.rand(seed) * blocks), f"_order{name}": F.rand(seed + 1_000_003)}


def met(drawn: DataFrame, columns: list[str], name: str = "") -> DataFrame:
    """Adds ``_partner`` by the ``draws`` of that name."""
    order = Window.partitionBy(f"_block{name}").orderBy(f"_order{name}")
    values = F.struct(*columns)
    return drawn.withColumn("_partner", F.coalesce(F.lead(values).over(order), F.first(values).over(order)))


def _blocks(rows: DataFrame) -> int:
    return max(1, -(-rows.count() // BLOCK_ROWS))


def permutation_importance(
    model: PipelineModel, df: DataFrame, features: list[str] = S.MODEL_FEATURES, repeats: int = 10,
    seed: int = 42, target: str = S.TARGET,
) -> DataFrame:
    """Rise of the mean absolute error when a feature is shuffled, mean and deviation over repeats.

    A repeat shuffles once: each row meets its partner and is scored with every feature in turn
    taken from there, so the only exchange carries the rows themselves. Boosted trees are not scored anew for every
    feature: their leaves tell which of them a change reaches.
    """
    features = [f for f in features if f in df.columns]
    if is_boosted(model):
        mae = _boosted_swaps(model, df, features, repeats, seed, target)
        rise = mae.select(F.inline(F.array(*[F.struct(F.lit(f).alias("feature"), (F.col(f"_mae_{i}") - F.col("_mae")).alias("rise")) for i, f in enumerate(features)])))
    else:
        rise = _scored_swaps(model, df, features, repeats, seed, target)
    return rise.groupBy("feature").agg(
        F.avg("rise").alias("importance"), F.coalesce(F.stddev_pop("rise"), F.lit(0.0)).alias("std")
    ).orderBy(F.desc("importance"), "feature")


def _boosted_swaps(model: PipelineModel, df: DataFrame, features: list[str], repeats: int, seed: int, target: str) -> DataFrame:
    """``(repeat, _mae, _mae_0, ..)``: the error of boosted trees, and with each of ``features`` shuffled.

    Rows carry the features that the trees test, prepared once; a task adds up the errors of its rows.
    """
    groups, tested = leaf_changes(model)
    x, z = [f"_x_{i}" for i in range(len(tested))], [f"_z_{i}" for i in range(len(tested))]
    prepared = model.stages[0].transform(df)
    rows = stored(prepared.select(
        *[F.col(PREPARED + n).cast("double").alias(c) for n, c in zip(tested, x)], F.col(target).cast("double").alias("_y")
    ), "importance")
    blocks, shared = _blocks(rows), df.sparkSession.sparkContext.broadcast(groups)
    # a column of an unused feature has the errors of the rows as they are
    own = [tested.index(f) if f in tested else None for f in features]
    sums = ["_sum", *[f"_sum_{i}" for i in range(len(features))]]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            here, there = matrix(batch, x), matrix(batch, z)
            base, rise = np.zeros(len(here)), np.zeros(here.shape)
            for group in shared.value:
                group.add_swaps(base, rise, here, there)
            known = batch.column("_y").is_valid().to_numpy(zero_copy_only=False)
            y, repeat = batch.column("_y").to_numpy(zero_copy_only=False), batch.column("repeat").to_numpy()
            error = np.abs(y[:, None] - np.column_stack([base, *[base if i is None else base + rise[:, i] for i in own]]))
            for r in np.unique(repeat).tolist():
                of = known & (repeat == r)
                n, total = found.get(r, (0, np.zeros(len(sums))))
                found[r] = n + int(of.sum()), total + error[of].sum(axis=0)
        for r, (n, total) in found.items():
            yield pa.RecordBatch.from_pydict({"repeat": pa.array([r], pa.int32()), "_n": [n], **{c: [v] for c, v in zip(sums, total.tolist())}})

    taken = [F.col(f"_partner.{c}").alias(d) for c, d in zip(x, z)]
    parts = [
        with_partner(rows, x or ["_y"], seed + r, blocks).select(F.lit(r).cast("int").alias("repeat"), "_y", *x, *taken) for r in range(repeats)
    ]
    schema = "repeat int, _n long, " + ", ".join(f"{c} double" for c in sums)
    found = reduce(DataFrame.unionByName, parts).mapInArrow(scan, schema)
    # all errors of a repeat are added up in one order, so a feature without effect has exactly the same
    n = F.nullif(F.sum("_n"), F.lit(0))
    return found.groupBy("repeat").agg(*[(F.sum(c) / n).alias(c.replace("_sum", "_mae")) for c in sums])


def _scored_swaps(model: PipelineModel, df: DataFrame, features: list[str], repeats: int, seed: int, target: str) -> DataFrame:
    """``(feature, rise)`` of any model, a row per repeat: every row is scored once per feature."""
    rows = stored(
        df.select(*[F.col(f).cast("double").alias(f) for f in features], F.col(target).cast("double").alias(target)),
        "importance",
    )
    blocks = _blocks(rows)

    def variant(changed: str) -> Column:
        return F.struct(
            F.lit(changed).alias("feature"),
            *[F.col(f"_partner.{f}" if f == changed else f).alias(f) for f in features],
        )

    variants = F.array(*[variant(f) for f in ["", *features]])
    parts = [
        with_partner(rows, features, seed + r, blocks).select(
            F.lit(r).alias("repeat"), target, F.inline(variants)
        )
        for r in range(repeats)
    ]
    scored = model.transform(reduce(DataFrame.unionByName, parts))
    error = F.avg(F.abs(F.col(target) - F.col("prediction")))
    # from here on one row per repeat and feature
    mae = scored.groupBy("repeat", "feature").agg(error.alias("mae"))
    base = F.max(F.when(F.col("feature") == "", F.col("mae"))).over(Window.partitionBy("repeat"))
    return mae.withColumn("rise", F.col("mae") - base).filter("feature <> ''")


def linear_shapley(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Exact Shapley values of a linear model as columns ``phi_<feature>``, against the mean row."""
    names = prepared_features(model)
    weights = dict(zip(names, model.stages[-1].coefficients.toArray().tolist()))
    prepared = model.stages[0].transform(df)
    # one number per feature
    means = prepared.agg(*[F.avg(PREPARED + n).alias(n) for n in names]).first()
    return prepared.withColumns({
        f"phi_{n}": F.lit(weights[n]) * (F.col(PREPARED + n) - F.lit(means[n])) for n in names
    })


def mean_absolute_shapley(explained: DataFrame, names: list[str]) -> DataFrame:
    """Mean size of each contribution, largest first."""
    wide = explained.agg(*[F.avg(F.abs(f"phi_{n}")).alias(n) for n in names])
    return wide.unpivot([], list(names), "feature", "mean_abs").orderBy(F.desc("mean_abs"), "feature")


def sampled_shapley(
    model: PipelineModel, df: DataFrame, key: str, features: list[str] = S.MODEL_FEATURES,
    permutations: int = 8, seed: int = 42,
) -> DataFrame:
    """``(key, feature, phi)``: Shapley values of any model, estimated by permutation sampling.

    For each permutation a row walks from its random partner to itself, one feature after the
    other in random order; a feature earns the change of the prediction at its step. The values of
    a row add up to its prediction minus the mean of its partners' predictions, and the error
    shrinks with the square root of ``permutations``. Records that share a key are explained each. The leaves of
    boosted trees tell at which steps a prediction changes, so their rows are not scored step by step.
    """
    features = [f for f in features if f in df.columns]
    if is_boosted(model) and set(prepared_features(model)) <= set(features):
        return _boosted_walks(model, df, key, features, permutations, seed)
    p = len(features)
    numbered = F.monotonically_increasing_id().alias("_row")
    rows = stored(df.select(key, numbered, *[F.col(f).cast("double").alias(f) for f in features]), "shapley")
    blocks = _blocks(rows)
    numbers = F.array(*[F.lit(i) for i in range(p)])
    names = F.array(*[F.lit(f) for f in features])

    def walk(r: int) -> DataFrame:
        paired = with_partner(rows, features, seed + r, blocks).withColumn("_walk", F.shuffle(numbers, seed + 7919 * (r + 1)))
        steps = paired.select("*", F.explode(F.sequence(F.lit(0), F.lit(p))).alias("_step"))
        return steps.select(
            key, "_row", "_step",
            F.get(names, F.get("_walk", F.col("_step") - 1)).alias("_gains"),
            F.get(names, F.get("_walk", F.col("_step"))).alias("_loses"),
            *[
                F.when(F.array_position("_walk", F.lit(i)) <= F.col("_step"), F.col(f)).otherwise(F.col(f"_partner.{f}")).alias(f)
                for i, f in enumerate(features)
            ],
        )

    scored = model.transform(reduce(DataFrame.unionByName, [walk(r) for r in range(permutations)]))
    ends = F.array(
        F.struct(F.col("_gains").alias("feature"), F.col("prediction").alias("part")),
        F.struct(F.col("_loses").alias("feature"), (-F.col("prediction")).alias("part")),
    )
    parts = scored.select(key, "_row", F.inline(ends)).filter(F.col("feature").isNotNull())
    return parts.groupBy("_row", key, "feature").agg((F.sum("part") / permutations).alias("phi")).drop("_row")


def _boosted_walks(
    model: PipelineModel, df: DataFrame, key: str, features: list[str], permutations: int, seed: int,
) -> DataFrame:
    """The values of ``sampled_shapley`` for boosted trees: rows go from one permutation's blocks to the next and carry
    the sums of the features that the trees test, so nothing is multiplied by steps or put together again by row."""
    groups, tested = leaf_changes(model)
    x, z, phi = ([f"_{c}_{i}" for i in range(len(tested))] for c in ("x", "z", "phi"))
    prepared = model.stages[0].transform(df)
    rows = stored(prepared.select(
        F.col(key).alias("_key"), *[F.col(PREPARED + n).cast("double").alias(c) for n, c in zip(tested, x)]
    ), "shapley")
    blocks, shared = _blocks(rows), df.sparkSession.sparkContext.broadcast(groups)
    numbers, at = F.array(*[F.lit(i) for i in range(len(features))]), [features.index(f) for f in tested]
    kept = [[f"_{c}_r{q}" for q in range(r + 1, permutations) for c in ("block", "order")] for r in range(permutations)]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            here, there = matrix(batch, x), matrix(batch, z)
            steps = batch.column("_walk").flatten().to_numpy().reshape(batch.num_rows, len(features))
            place, total = np.argsort(steps, axis=1)[:, at] + 1, matrix(batch, phi)
            for group in shared.value:
                group.add_walk(total, here, there, place)
            held = [c for c in batch.schema.names if c not in (*z, *phi, "_walk")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in held), *(pa.array(v) for v in total.T)], [*held, *phi])

    found = rows.withColumns({k: v for r in range(permutations) for k, v in draws(seed + r, blocks, f"_r{r}").items()})
    found = found.withColumns({c: F.lit(0.0) for c in phi})
    for r in range(permutations):
        paired = met(found, x or ["_key"], f"_r{r}").withColumn("_walk", F.shuffle(numbers, seed + 7919 * (r + 1)))
        paired = paired.select("_key", *x, *kept[r], *[F.col(f"_partner.{c}").alias(d) for c, d in zip(x, z)], *phi, "_walk")
        types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in paired.schema if f.name not in (*z, *phi, "_walk"))
        found = paired.mapInArrow(walk, ", ".join([types, *(f"{c} double" for c in phi)]))
    held = dict(zip(tested, phi))
    ends = [F.struct(F.lit(f).alias("feature"), (F.col(held[f]) / permutations if f in held else F.lit(0.0)).alias("phi")) for f in features]
    return found.select(F.col("_key").alias(key), F.inline(F.array(*ends)))


def builtin_importance(model: PipelineModel) -> DataFrame:
    """The tree model's own importances, one row per feature."""
    from pyspark.sql import SparkSession

    values = model.stages[-1].featureImportances.toArray().tolist()
    rows = list(zip(prepared_features(model), values))
    table = SparkSession.getActiveSession().createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature")
