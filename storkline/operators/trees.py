"""Boosted trees by their structure: exact Shapley values, errors of every prefix, growth that stops in time.

A fitted model is small (trees times leaves), so its nodes are read once and shared with the tasks as arrays; rows
are only scanned, batch by batch, and never shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storkline import schema as S
from storkline.functions.columns import rint_to
from storkline.functions.partitions import spread
from storkline.operators.model import PREPARED, FeaturePrep, prepared_features
from storkline.session import shared_folder, work_path

# bytes of work arrays in a task, and of a table of all outcomes along the paths
WORK_BYTES, TABLE_BYTES = 64 << 20, 64 << 20


@dataclass
class Leaves:
    """All leaves whose paths test the same number of features.

    A leaf is reached when ``low < x <= high`` for each of its ``features``; ``share`` is the part of the training
    rows that its tests on one feature let through, multiplied along the path.
    """

    tree: np.ndarray
    value: np.ndarray
    features: np.ndarray
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray


def model_leaves(trees: GBTRegressionModel) -> tuple[list[Leaves], np.ndarray]:
    """The leaves of a boosted model, grouped by features on the path, and the weights of its trees."""
    spark = SparkSession.getActiveSession()
    path = work_path(spark, "tree-model")
    trees.save(path)
    nodes: dict[int, dict[int, object]] = {}
    # bounded by the model
    for row in spark.read.parquet(f"{path}/data").collect():
        nodes.setdefault(row.treeID, {})[row.nodeData.id] = row.nodeData
    found: dict[int, list[tuple]] = {}
    for tree, held in nodes.items():
        todo: list[tuple[int, dict[int, tuple[float, float, float]]]] = [(0, {})]
        while todo:
            at, tests = todo.pop()
            node = held[at]
            if node.leftChild < 0:
                found.setdefault(len(tests), []).append((tree, node.prediction, sorted(tests.items())))
                continue
            if node.split.numCategories >= 0:
                raise ValueError("splits by category have no order to test")
            feature, cut = node.split.featureIndex, node.split.leftCategoriesOrThreshold[0]
            low, high, share = tests.get(feature, (-math.inf, math.inf, 1.0))
            for child, bounds in ((node.leftChild, (low, min(high, cut))), (node.rightChild, (max(low, cut), high))):
                todo.append((child, {**tests, feature: (*bounds, share * held[child].rawCount / node.rawCount)}))
    groups = []
    for width, leaves in sorted(found.items()):
        tests = np.array([[(f, *x) for f, x in t] for *_, t in leaves], np.float64).reshape(len(leaves), width, 4)
        groups.append(Leaves(
            np.array([t for t, *_ in leaves]), np.array([v for _, v, _ in leaves]), tests[:, :, 0].astype(np.int64),
            tests[:, :, 1], tests[:, :, 2], tests[:, :, 3],
        ))
    return groups, np.array(trees.treeWeights)


def path_values(share: np.ndarray, passed: np.ndarray) -> np.ndarray:
    """Shapley values of a game along a path, by the players of the last axis.

    The game's worth for a set of features is the product of ``passed`` (0 or 1) over the set and of ``share`` over the
    others. All sets of one size share a weight, so it is enough to have, for each feature, the sums over all sets of a size
    among the others: the coefficients of the product of (share + passed * t).
    """
    d = share.shape[-1]
    out = np.zeros(np.broadcast_shapes(share.shape, passed.shape))
    weights = [math.factorial(k) * math.factorial(d - 1 - k) / math.factorial(d) for k in range(d)]
    for i in range(d):
        sums = [np.ones(out.shape[:-1])]
        for j in range(d):
            if j != i:
                z, o = share[..., j], passed[..., j]
                sums = [
                    (sums[k] * z if k < len(sums) else 0.0) + (sums[k - 1] * o if k else 0.0) for k in range(len(sums) + 1)
                ]
        out[..., i] = (passed[..., i] - share[..., i]) * sum(w * s for w, s in zip(weights, sums))
    return out


class LeafGame:
    """Contributions of one group of leaves, ready for batches of rows."""

    def __init__(self, leaves: Leaves, weights: np.ndarray):
        # columns of one feature lie together, so that a batch is summed up by runs
        self.leaves, self.worth = leaves, leaves.value * weights[leaves.tree]
        self.base = float((self.worth * leaves.share.prod(axis=1)).sum())
        count, self.width = leaves.features.shape
        self.order = np.argsort(leaves.features.ravel(), kind="stable")
        in_order = leaves.features.ravel()[self.order]
        self.runs = np.flatnonzero(np.diff(in_order, prepend=-1))
        self.owners = in_order[self.runs]
        self.table = None
        if 8 * count * self.width << self.width <= TABLE_BYTES:
            # every outcome of the tests is worked out once
            outcomes = (np.arange(1 << self.width)[:, None] >> np.arange(self.width) & 1).astype(np.float64)
            self.table = path_values(leaves.share[:, None, :], outcomes[None]) * self.worth[:, None, None]

    def add_to(self, phi: np.ndarray, x: np.ndarray) -> None:
        if not self.width:
            return
        count = len(self.leaves.tree)
        rows = max(1, WORK_BYTES // (32 * count * self.width))
        for at in range(0, len(x), rows):
            tested = x[at : at + rows][:, self.leaves.features]
            passed = (tested > self.leaves.low) & (tested <= self.leaves.high)
            if self.table is None:
                parts = path_values(self.leaves.share[None], passed.astype(np.float64)) * self.worth[:, None]
            else:
                outcome = (passed << np.arange(self.width)).sum(axis=2)
                parts = self.table[np.arange(count), outcome]
            by_feature = parts.reshape(len(parts), -1)[:, self.order]
            phi[at : at + rows, self.owners] += np.add.reduceat(by_feature, self.runs, axis=1)


class LeafChanges:
    """What one group of leaves adds to predictions whose features come from a row ``x`` or its partner ``z``."""

    def __init__(self, leaves: Leaves, weights: np.ndarray):
        self.leaves, self.worth = leaves, leaves.value * weights[leaves.tree]
        # columns of one feature lie together, so that a batch is summed up by runs
        self.order = np.argsort(leaves.features.ravel(), kind="stable")
        in_order = leaves.features.ravel()[self.order]
        self.runs = np.flatnonzero(np.diff(in_order, prepend=-1))
        self.owners = in_order[self.runs]

    def passed(self, x: np.ndarray) -> np.ndarray:
        tested = x[:, self.leaves.features]
        return (tested > self.leaves.low) & (tested <= self.leaves.high)

    def by_feature(self, parts: np.ndarray) -> np.ndarray:
        return np.add.reduceat(parts.reshape(len(parts), -1)[:, self.order], self.runs, axis=1)

    def chunks(self, rows: int) -> Iterator[slice]:
        step = max(1, WORK_BYTES // (64 * max(1, self.leaves.features.size)))
        return (slice(at, at + step) for at in range(0, rows, step))

    def add_swaps(self, base: np.ndarray, rise: np.ndarray, x: np.ndarray, z: np.ndarray) -> None:
        """Adds predictions of ``x`` to ``base`` and, per feature, their change when it alone is taken from ``z``."""
        for at in self.chunks(len(x)):
            own, other = self.passed(x[at]), self.passed(z[at])
            failed = (~own).sum(axis=2)
            reached = failed == 0
            base[at] += reached @ self.worth
            if self.leaves.features.size:
                # the leaf is reached if the row passes all tests on other features and the partner this one
                swapped = (failed[..., None] == ~own) & other
                rise[at, self.owners] += self.by_feature((swapped * 1.0 - reached[..., None]) * self.worth[:, None])

    def add_walk(self, phi: np.ndarray, x: np.ndarray, z: np.ndarray, place: np.ndarray) -> None:
        """Adds what each feature changes when ``z`` turns into ``x`` feature by feature; ``place`` counts from 1.

        A leaf is reached from the place of the last feature that only the row passes to that of the first one that
        only the partner passes.
        """
        if not self.leaves.features.size:
            return
        never = np.iinfo(place.dtype).max
        for at in self.chunks(len(x)):
            own, other, turn = self.passed(x[at]), self.passed(z[at]), place[at][:, self.leaves.features]
            begins, ends = np.where(other, 0, turn), np.where(own, never, turn)
            first, last = begins.max(axis=2, keepdims=True), ends.min(axis=2, keepdims=True)
            gained = (begins == first) & (first > 0) & (first < last)
            lost = (ends == last) & (last < never) & (first < last)
            phi[at, self.owners] += self.by_feature((gained * 1.0 - lost) * self.worth[:, None])


def is_boosted(model: PipelineModel) -> bool:
    """A preparation feature by feature and boosted trees, whose leaves tell how a prediction changes."""
    return len(model.stages) == 2 and isinstance(model.stages[-1], GBTRegressionModel) and isinstance(model.stages[0], PipelineModel)


def leaf_changes(model: PipelineModel) -> tuple[list[LeafChanges], list[str]]:
    """Groups of leaves, and the features that they test in the order of their numbers."""
    groups, weights = model_leaves(model.stages[-1])
    tested = sorted({int(f) for g in groups for f in g.features.ravel()})
    number = np.zeros(max(tested, default=0) + 1, np.int64)
    number[tested] = np.arange(len(tested))
    names = prepared_features(model)
    for g in groups:
        g.features = number[g.features]
    return [LeafChanges(g, weights) for g in groups], [names[f] for f in tested]


def matrix(batch: pa.RecordBatch, columns: list[str]) -> np.ndarray:
    """Columns of numbers side by side; NaN is an error, as it is where a vector is assembled."""
    out = np.empty((batch.num_rows, len(columns)))
    for i, c in enumerate(columns):
        out[:, i] = batch.column(c).to_numpy(zero_copy_only=False)
    if np.isnan(out).any():
        raise ValueError("NaN or null among the features")
    return out


def tree_shapley(model: PipelineModel, df: DataFrame, keep: list[str]) -> DataFrame:
    """``keep``, ``base`` and ``phi_<feature>``: exact Shapley values of boosted trees, without a shuffle.

    What a tree predicts where only some features are known is the mean over its training rows on the branches that the
    others leave open. A row's values add up to its prediction minus ``base``, the prediction with nothing
    known. Missing features are filled first, as for a prediction. ``keep`` names columns of ``df``.
    """
    names = prepared_features(model)
    groups, weights = model_leaves(model.stages[-1])
    games = [LeafGame(g, weights) for g in groups]
    base = sum(g.base for g in games)
    shared = df.sparkSession.sparkContext.broadcast(games)
    kept = [f"_kept_{i}" for i in range(len(keep))]
    prepared = model.stages[0].transform(df)
    rows = prepared.select(
        *[F.col(c).alias(k) for c, k in zip(keep, kept)], *[F.col(PREPARED + n).cast("double").alias(f"_x_{i}") for i, n in enumerate(names)]
    )

    def explain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack([batch.column(f"_x_{i}").to_numpy(zero_copy_only=False) for i in range(len(names))], axis=1)
            phi = np.zeros_like(x)
            for game in shared.value:
                game.add_to(phi, x)
            columns = [*(batch.column(k) for k in kept), pa.array(np.full(len(x), base)), *(pa.array(p) for p in phi.T)]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "base", *(f"phi_{n}" for n in names)])

    types = [f"{k} {df.schema[c].dataType.simpleString()}" for c, k in zip(keep, kept)]
    found = rows.mapInArrow(explain, ", ".join([*types, "base double", *(f"`phi_{n}` double" for n in names)]))
    return found.withColumnsRenamed(dict(zip(kept, keep)))


# ---- prefixes of the trees


def prefix_errors(model: PipelineModel, df: DataFrame, target: str = S.TARGET) -> DataFrame:
    """``(trees, n, mae, rmse)`` of the first 1, 2, .. trees on the rows of ``df`` with a target, from one scan.

    A task adds up the errors of its rows for every number of trees and reports one row for each.
    """
    return _prefix_errors(model.stages[-1], model.stages[0].transform(df), prepared_features(model), target)


def _prefix_errors(trees: GBTRegressionModel, prepared: DataFrame, names: list[str], target: str) -> DataFrame:
    groups, weights = model_leaves(trees)
    shared = prepared.sparkSession.sparkContext.broadcast(groups)
    rows = prepared.filter(F.col(target).isNotNull()).select(
        F.col(target).cast("double").alias("_y"), *[F.col(PREPARED + n).cast("double").alias(f"_x_{i}") for i, n in enumerate(names)]
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, off, squared = 0, np.zeros(len(weights)), np.zeros(len(weights))
        for batch in batches:
            columns = [batch.column(f"_x_{i}").to_numpy(zero_copy_only=False) for i in range(len(names))]
            y = batch.column("_y").to_numpy(zero_copy_only=False)
            x = np.stack(columns, axis=1) if columns else np.zeros((len(y), 0))
            part = np.zeros((len(x), len(weights)))
            for g in shared.value:
                chunk = max(1, WORK_BYTES // (32 * len(g.tree) * max(1, g.features.shape[1])))
                for at in range(0, len(x), chunk):
                    tested = x[at : at + chunk][:, g.features]
                    row, leaf = np.nonzero(((tested > g.low) & (tested <= g.high)).all(axis=2))
                    part[at + row, g.tree[leaf]] = g.value[leaf]
            error = y[:, None] - np.cumsum(part * weights, axis=1)
            n, off, squared = n + len(y), off + np.abs(error).sum(axis=0), squared + np.square(error).sum(axis=0)
        yield pa.RecordBatch.from_pydict({
            "trees": np.arange(1, len(weights) + 1), "n": np.full(len(weights), n), "off": off, "squared": squared,
        })

    parts = rows.mapInArrow(scan, "trees long, n long, off double, squared double")
    n = F.nullif(F.sum("n"), F.lit(0))
    return parts.groupBy("trees").agg(
        F.sum("n").alias("n"), rint_to(F.sum("off") / n, 3).alias("mae"), rint_to(F.sqrt(F.sum("squared") / n), 3).alias("rmse"),
    ).orderBy("trees")


def first_trees(model: PipelineModel, count: int) -> PipelineModel:
    """The model with only its first ``count`` trees."""
    whole = model.stages[-1]
    if not 1 <= count <= whole.getNumTrees:
        raise ValueError(f"the model has {whole.getNumTrees} trees")
    context = SparkSession.getActiveSession().sparkContext
    java = context._jvm.org.apache.spark.ml.regression
    trees = context._gateway.new_array(java.DecisionTreeRegressionModel, count)
    weights = context._gateway.new_array(context._jvm.double, count)
    held = whole._java_obj.trees()
    for i in range(count):
        trees[i], weights[i] = held[i], float(whole.treeWeights[i])
    cut = GBTRegressionModel(java.GBTRegressionModel(f"{whole.uid}_first_{count}", trees, weights))
    cut.setFeaturesCol(whole.getFeaturesCol()).setPredictionCol(whole.getPredictionCol())
    return PipelineModel([*model.stages[:-1], cut])


@dataclass
class Stopped:
    """A model cut to its best prefix, and the errors that chose it."""

    model: PipelineModel
    trees: int
    errors: list[tuple[int, float]]


def stop_early(model: PipelineModel, val: DataFrame, target: str = S.TARGET) -> Stopped:
    """Keeps the first trees of a boosted model up to the least validation error, the fewest on a tie."""
    # one row per tree
    errors = [(r.trees, r.mae) for r in prefix_errors(model, val, target).collect()]
    known = [(mae, trees) for trees, mae in errors if mae is not None]
    if not known:
        raise ValueError("no validation rows with a target")
    best = min(known)[1]
    return Stopped(first_trees(model, best), best, errors)


# ---- successive halving


TRIALS = "round int, trial int, trees int, best_trees int, val_mae double, survived int, params map<string,string>"


def halving_search(
    space: list[dict], make: Callable[[dict], Estimator], train: DataFrame, val: DataFrame, start_trees: int = 10,
    keep: float = 0.5, max_trees: int | None = None, label: str = S.TARGET, prep: FeaturePrep | None = None,
) -> tuple[dict, DataFrame]:
    """The parameters that win a tournament, and its table (``TRIALS``), one row per trial and round.

    All trials fit ``start_trees`` trees. The better part of them (``keep``, rounded up) goes on, with as many times
    more trees as trials dropped out, so that every round costs about the same, until one is left and has grown too or
    ``max_trees`` are reached. A trial's own ``n_estimators`` bounds its trees. Its error in a round is the
    least over its prefixes, ``best_trees`` that prefix, so it is not judged by trees it would not keep; the earlier
    trial wins a tie. Features are prepared once and held in memory and on disk for all fits.
    """
    spark = train.sparkSession
    shared_folder(spark)
    prepared = (prep or FeaturePrep()).fit(train)
    inputs = prepared.stages[-1].getInputCols()
    columns = [*inputs, "features", label]
    fit_rows = prepared.transform(spread(train)).select(columns).persist(StorageLevel.MEMORY_AND_DISK)
    val_rows = prepared.transform(spread(val)).select(columns).persist(StorageLevel.MEMORY_AND_DISK)
    names = [c.removeprefix(PREPARED) for c in inputs]
    table: list[tuple] = []
    alive, trees, number = list(range(len(space))), start_trees, 0
    try:
        while True:
            trees = trees if max_trees is None else min(trees, max_trees)
            scored = []
            for trial in alive:
                params = {**space[trial], "n_estimators": min(trees, space[trial].get("n_estimators", trees))}
                # one row per tree
                errors = _prefix_errors(make(params).fit(fit_rows), val_rows, names, label).collect()
                if errors[0].mae is None:
                    raise ValueError("no validation rows with a target")
                mae, best = min((r.mae, r.trees) for r in errors)
                scored.append((mae, trial, best))
            scored.sort()
            last = len(alive) == 1 or trees == max_trees
            left = 1 if last else min(math.ceil(keep * len(alive)), len(alive) - 1)
            chosen = sorted(trial for _, trial, _ in scored[:left])
            table += [
                (number, t, trees, best, mae, int(t in chosen), {k: str(v) for k, v in space[t].items()}) for mae, t, best in scored
            ]
            if last:
                break
            trees, alive, number = math.ceil(trees * len(alive) / left), chosen, number + 1
    finally:
        fit_rows.unpersist()
        val_rows.unpersist()
    _, winner, best = scored[0]
    return {**space[winner], "n_estimators": best}, spark.createDataFrame(table, TRIALS)
