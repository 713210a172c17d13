"""Hard negatives by exact integer scores, with angles as a filter.

Every vector's angles to a few reference directions are stored. Vectors of one label whose nearest reference is
the same lie together, ordered by their angle to it, in windows of some hundred; a window keeps, for every
reference, the interval of its vectors' angles, and the interval of their norms. By the triangle inequality
of angles, an anchor's own angles then bound its angle to any vector of the window from both sides; cosines of
the bounds, times norms, widened by more than rounding can lose, bound the integer scores. Only windows whose
bounds overlap what an anchor still looks for are scored, by a matrix product in which every sum is exact.

The windows stay where they are: tasks scan them and read the anchors, a fiftieth of the rows, batch by batch from
the shared folder. A window belongs to a random level, each level four times as large as the ones before;
levels are scanned in turn, so that what is found in the small ones leaves little to report from the large.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
import pyarrow.fs as fs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storkline.llm.warc import open_store
from storkline.session import stored, work_path

REFERENCES = 12
SAMPLE_ROWS = 1024
WINDOW_ROWS = 512
# vectors of the first level, and of a task's windows held at a time
LEVEL_ROWS, HELD_ROWS = 1 << 16, 1 << 16
ANCHORS_PER_BATCH = 4096
SEED = 42
# angles are stored as 32-bit numbers, whose error is below 3e-7; cosines near 1 lose some 2e-8 more
ANGLE_MARGIN, SCORE_MARGIN = 2e-6, 4e-6
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1


def usable(column: str) -> Column:
    """Vectors without null, infinite or undefined components."""
    x = F.col(column)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return x.isNotNull() & ~bad


def padded(column: pa.Array, dims: int) -> np.ndarray:
    """Lists of integers as rows of a matrix; missing components are 0."""
    if not len(column):
        return np.zeros((0, dims), np.int64)
    begins = column.offsets.to_numpy()
    flat = column.values.to_numpy()[begins[0] : begins[-1]]
    lengths = np.diff(begins)
    out = np.zeros((len(column), dims), np.int64)
    place = np.arange(len(flat)) - np.repeat(begins[:-1] - begins[0], lengths)
    out[np.repeat(np.arange(len(column)), lengths), place] = flat
    return out


def narrow(values: np.ndarray) -> tuple[bytes, int]:
    """The bytes of integers in the smallest type that holds them, and its width."""
    reach = max(int(values.max(initial=0)), -int(values.min(initial=0)) - 1)
    width = 2 if reach < 1 << 15 else 4 if reach < 1 << 31 else 8
    return values.astype(f"<i{width}").tobytes(), width


def norms_of(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt(np.square(vectors.astype(np.float64)).sum(axis=1))


def angles_to(vectors: np.ndarray, norms: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Angles to unit directions; a zero vector, whose scores are all 0, is given right angles."""
    cosines = vectors.astype(np.float64) @ references.T / np.maximum(norms, 1e-300)[:, None]
    return np.arccos(np.clip(cosines, -1.0, 1.0)).astype(np.float32)


def choose_references(sample: np.ndarray, count: int) -> np.ndarray:
    """Unit directions far from one another: each next one has the widest angle to those chosen."""
    norms = norms_of(sample)
    units = sample[norms > 0] / norms[norms > 0][:, None]
    if not len(units):
        return np.zeros((0, sample.shape[1]))
    chosen, nearest = [0], units @ units[0]
    while len(chosen) < min(count, len(units)):
        chosen.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, units @ units[chosen[-1]])
    return units[chosen]


def products(a: np.ndarray, b: np.ndarray, largest: float) -> np.ndarray:
    """Exact inner products of integer rows as 64-bit integers; ``largest`` bounds every partial sum.

    Beyond 64 bits a product stays at the largest or smallest number.
    """
    if largest < 1 << 24:
        return (a.astype(np.float32) @ b.astype(np.float32).T).astype(np.int64)
    if largest < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    exact = a.astype(object) @ b.astype(object).T
    return np.clip(exact, LOWEST, HIGHEST).astype(np.int64)


def score_bounds(
    angles: np.ndarray, norms: np.ndarray, low: np.ndarray, high: np.ndarray, short: np.ndarray, long: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score of every anchor with every window, from angles and norms alone."""
    nearest = np.zeros((len(angles), len(low)))
    farthest = np.full(nearest.shape, math.pi)
    for r in range(angles.shape[1]):
        own = angles[:, r : r + 1].astype(np.float64)
        nearest = np.maximum(nearest, np.maximum(own - high[:, r], low[:, r] - own))
        farthest = np.minimum(farthest, np.minimum(own + high[:, r], 2 * math.pi - own - low[:, r]))
    nearest = np.clip(nearest - ANGLE_MARGIN, 0.0, math.pi)
    farthest = np.clip(farthest + ANGLE_MARGIN, 0.0, math.pi)
    most, least = np.cos(nearest), np.cos(farthest)
    upper = norms[:, None] * most * np.where(most > 0, long, short)
    lower = norms[:, None] * least * np.where(least > 0, short, long)
    slack = SCORE_MARGIN * norms[:, None] * long + 1.0
    # products beyond 64 bits stay at the ends of their range
    return np.minimum(lower - slack, float(HIGHEST)), np.maximum(upper + slack, float(LOWEST))


def leading(group: np.ndarray, score: np.ndarray, ident: np.ndarray, at: np.ndarray, keep: int) -> np.ndarray:
    """Positions of the first ``keep`` entries of every group: higher scores, then smaller ids, then rows."""
    order = np.lexsort((at, ident, ~score, group))
    sorted_group = group[order]
    first = np.flatnonzero(np.diff(sorted_group, prepend=-1) != 0)
    rank = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
    return order[rank < keep]


class Held:
    """Windows of a task that are scored together."""

    def __init__(self, rows: list[dict], dims: int):
        self.labels = [r["label"] for r in rows]
        self.vectors = [np.frombuffer(r["vectors"], f"<i{r['width']}").reshape(-1, dims) for r in rows]
        self.ids = [np.frombuffer(r["ids"], "<i8") for r in rows]
        self.ats = [np.frombuffer(r["ats"], "<i8") for r in rows]
        self.low, self.high = (np.array([np.frombuffer(r[c], "<f4") for r in rows]).reshape(len(rows), -1) for c in ("low", "high"))
        self.short, self.long = (np.array([r[c] for r in rows]) for c in ("short", "long"))


class Slots:
    """What a batch of anchors looks for: per slot a range of scores and the best found, from the task's own windows.

    A slot is an anchor with one range: an anchor's positives are one slot, its negatives one for every positive.
    """

    def __init__(self, low: np.ndarray, high: np.ndarray, worst: np.ndarray, keep: int):
        self.low, self.high, self.worst, self.keep = low, high, worst, keep
        empty = np.zeros(0, np.int64)
        self.slot = self.score = self.ident = self.at = empty

    def floor(self) -> np.ndarray:
        return np.maximum(self.low, self.worst)

    def offer(self, slot: np.ndarray, score: np.ndarray, ident: np.ndarray, at: np.ndarray) -> None:
        good = (score >= self.floor()[slot]) & (score <= self.high[slot])
        if not good.any():
            return
        slot, score, ident, at = (
            np.concatenate([old, new[good]]) for old, new in zip((self.slot, self.score, self.ident, self.at), (slot, score, ident, at))
        )
        best = leading(slot, score, ident, at, self.keep)
        self.slot, self.score, self.ident, self.at = slot[best], score[best], ident[best], at[best]
        full = np.bincount(self.slot, minlength=len(self.low)) == self.keep
        least = np.full(len(self.low), HIGHEST)
        np.minimum.at(least, self.slot, self.score)
        self.worst = np.where(full, np.maximum(self.worst, least), self.worst)


def score_windows(held: Held, anchors: dict[str, np.ndarray], same: bool, keep: int) -> Iterator[tuple]:
    """The best of a task's windows for a batch of anchors: arrays (anchor row, slot, score, id, row)."""
    n, per = anchors["low"].shape
    slots = Slots(anchors["low"].ravel(), anchors["high"].ravel(), anchors["worst"].ravel(), keep)
    open_ = (anchors["low"] <= anchors["high"]).any(axis=1)
    lower, upper = score_bounds(anchors["angles"], anchors["norms"], held.low, held.high, held.short, held.long)
    # windows that promise most come first, so that what is looked for narrows early
    for w in np.argsort(-upper.max(axis=0), kind="stable") if n else ():
        floor = slots.floor().reshape(n, per)
        wanted = open_ & ((anchors["labels"] == held.labels[w]) == same)
        wanted &= ((floor <= upper[:, w : w + 1]) & (anchors["high"] >= lower[:, w : w + 1])).any(axis=1)
        rows = np.flatnonzero(wanted)
        if not len(rows):
            continue
        largest = float(anchors["norms"][rows].max() * held.long[w])
        scores = products(anchors["vectors"][rows], held.vectors[w], largest * 1.001)
        a, b = np.nonzero((scores >= floor[rows].min(axis=1)[:, None]) & (scores <= anchors["high"][rows].max(axis=1)[:, None]))
        score, ident, at = scores[a, b], held.ids[w][b], held.ats[w][b]
        a = rows[a]
        other = at != anchors["ats"][a]
        a, score, ident, at = a[other], score[other], ident[other], at[other]
        for k in range(per):
            slots.offer(a * per + k, score, ident, at)
    yield slots.slot // per, slots.slot % per, slots.score, slots.ident, slots.at


WINDOW_TYPE = (
    "label long, n int, vectors binary, width int, ids binary, ats binary, low binary, high binary, short double, long double, draw long"
)
FOUND_TYPE = "anchor_at long, slot int, score long, id long, at long"


def scan_windows(windows: DataFrame, anchors: str, dims: int, slots: int, same: bool, keep: int) -> DataFrame:
    """Candidates (``FOUND_TYPE``) of all anchors in the table at ``anchors`` among ``windows``."""

    def batches_of(store: fs.FileSystem, root: str) -> Iterator[dict[str, np.ndarray]]:
        table = ds.dataset(root, filesystem=store, format="parquet")
        for batch in table.to_batches(batch_size=ANCHORS_PER_BATCH):
            if batch.num_rows:
                out = {c: batch.column(c).to_numpy() for c in ("at", "label", "norm")}
                flat = np.frombuffer(b"".join(batch.column("angles").to_pylist()), "<f4")
                ranges = {c: batch.column(c).flatten().to_numpy().reshape(-1, slots) for c in ("low", "high", "worst")}
                yield {
                    "ats": out["at"], "labels": out["label"], "norms": out["norm"], "angles": flat.reshape(batch.num_rows, -1),
                    "vectors": padded(batch.column("vector"), dims), **ranges,
                }

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(anchors)

        def report(rows: list[dict]) -> Iterator[pa.RecordBatch]:
            held = Held(rows, dims)
            for batch in batches_of(store, root):
                for a, k, score, ident, at in score_windows(held, batch, same, keep):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(batch["ats"][a]), pa.array(k.astype(np.int32)), pa.array(score), pa.array(ident), pa.array(at)],
                        ["anchor_at", "slot", "score", "id", "at"],
                    )

        rows: list[dict] = []
        size = 0
        for batch in batches:
            for row in batch.to_pylist():
                rows.append(row)
                size += row["n"]
                if size >= HELD_ROWS:
                    yield from report(rows)
                    rows, size = [], 0
        if rows:
            yield from report(rows)

    return windows.mapInArrow(scan, FOUND_TYPE)


def window_table(rows: DataFrame, references: np.ndarray, dims: int, levels: int, path: str) -> None:
    """Writes all rows as windows, with the intervals of their angles and norms, one folder for each level.

    ``rows(at, id, label, vector)``; labels and cells are ranges of the order, so a hot one spreads over tasks.
    """

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = padded(batch.column("vector"), dims)
            angles = angles_to(vectors, norms_of(vectors), references)
            cell = angles.argmin(axis=1) if angles.shape[1] else np.zeros(len(angles), np.int64)
            own = angles[np.arange(len(angles)), cell] if angles.shape[1] else np.zeros(len(angles), np.float32)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("at", "id", "label", "vector")), pa.array(cell.astype(np.int32)), pa.array(own)],
                ["at", "id", "label", "vector", "cell", "angle"],
            )

    placed = rows.mapInArrow(place, "at long, id long, label long, vector array<long>, cell int, angle float")
    order = ["label", "cell", "angle", "at"]
    ordered = placed.repartitionByRange(*order).sortWithinPartitions(*order)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ats, ids, labels, cells = (batch.column(c).to_numpy() for c in ("at", "id", "label", "cell"))
            vectors = padded(batch.column("vector"), dims)
            norms = norms_of(vectors)
            angles = angles_to(vectors, norms, references)
            turns = np.flatnonzero((np.diff(labels) != 0) | (np.diff(cells) != 0)) + 1
            out: list[dict] = []
            for a, z in zip([0, *turns.tolist()], [*turns.tolist(), len(ats)]):
                for at in range(a, z, WINDOW_ROWS):
                    here = slice(at, min(at + WINDOW_ROWS, z))
                    data, width = narrow(vectors[here])
                    # zero vectors have no direction, so a window with one spans all angles
                    low, high = angles[here].min(axis=0), angles[here].max(axis=0)
                    if not norms[here].all():
                        low, high = np.zeros_like(low), np.full_like(high, math.pi)
                    out.append({
                        "label": int(labels[at]), "n": here.stop - at, "vectors": data, "width": width, "ids": ids[here].astype("<i8").tobytes(),
                        "ats": ats[here].astype("<i8").tobytes(), "low": low.astype("<f4").tobytes(), "high": high.astype("<f4").tobytes(),
                        "short": float(norms[here].min()), "long": float(norms[here].max()), "draw": int(ats[at]),
                    })
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    schema = pa.schema([
        ("label", pa.int64()), ("n", pa.int32()), ("vectors", pa.binary()), ("width", pa.int32()), ("ids", pa.binary()),
        ("ats", pa.binary()), ("low", pa.binary()), ("high", pa.binary()), ("short", pa.float64()), ("long", pa.float64()),
        ("draw", pa.int64()),
    ])
    windows = ordered.mapInArrow(cut, WINDOW_TYPE)
    # the share of level l among all is 4^(l - levels)
    draw = F.pmod(F.xxhash64("draw", F.lit(SEED)), F.lit(1 << 20)) / float(1 << 20)
    level = F.lit(0)
    for l in range(1, levels):
        level = level + (draw >= 4.0 ** (l - levels)).cast("int")
    windows.withColumn("level", level).write.partitionBy("level").parquet(path)


def best_of(found: DataFrame, keep: int) -> DataFrame:
    """The first ``keep`` candidates of every anchor and slot."""
    order = Window.partitionBy("anchor_at", "slot").orderBy(F.desc("score"), "id", "at")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= keep)


def with_worst(anchors: DataFrame, found: DataFrame | None, slots: int, keep: int, name: str) -> str:
    """Stores the anchors with the score that a slot's next candidate must reach; the table's path."""
    path = work_path(anchors.sparkSession, name)
    open_ = F.array_repeat(F.lit(LOWEST), slots)
    if found is None:
        anchors.withColumn("worst", open_).write.parquet(path)
        return path
    full = found.filter(F.col("rank") == keep).groupBy(F.col("anchor_at").alias("_at")).agg(
        F.map_from_entries(F.collect_list(F.struct("slot", "score"))).alias("_found"))
    numbers = F.sequence(F.lit(0), F.lit(slots - 1))
    worst = F.transform(numbers, lambda k: F.coalesce(F.try_element_at("_found", k), F.lit(LOWEST)))
    joined = anchors.join(full, F.col("at") == F.col("_at"), "left")
    joined.withColumn("worst", F.coalesce(worst, open_)).drop("_at", "_found").write.parquet(path)
    return path


def search(index: str, levels: int, anchors: DataFrame, dims: int, slots: int, same: bool, keep: int, name: str) -> DataFrame:
    """The first ``keep`` of every anchor and slot over all windows, level by level."""
    spark = anchors.sparkSession
    found = None
    for level in range(levels):
        path = with_worst(anchors, found, slots, keep, f"{name}-anchors")
        windows = spark.read.schema(f"{WINDOW_TYPE}, level int").parquet(index).filter(F.col("level") == level).drop("level")
        more = scan_windows(windows, path, dims, slots, same, keep)
        if found is not None:
            more = more.unionByName(found.drop("rank"))
        found = stored(best_of(more, keep), f"{name}-found")
    return found


def mine_hard_negatives(
    embeddings: DataFrame, positives: int = 5, negatives: int = 3, low_pct: int = 50, high_pct: int = 95, scale: int = 256,
    anchors_every: int = 50, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | Column = "label",
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    Components are scaled and rounded down to integers; a score is an integer inner product. Anchors are rows
    whose id is divisible by ``anchors_every``. An anchor's positives are its ``positives`` best other rows of
    the same label; for each of them the ``negatives`` best rows of other labels are returned whose score s
    satisfies low_pct * p <= 100 * s <= high_pct * p, where p is the positive's. Higher scores come first, ties by
    smaller id; fewer rows are returned where there are fewer.

    Rows without id, label or vector, or with a null or non-finite component, take no part. Rows that repeat
    an id are rows of their own, also as anchors, and equal ones come in any order. Shorter vectors are filled with
    zeros. Scores beyond 64 bits stay at the largest or smallest number. An empty table gives an empty result; other
    columns are ignored.

    The results are exact, whatever the bounds leave out. References are fitted on at most ``SAMPLE_ROWS`` vectors,
    the ones with the smallest hashes of their ids; every row is indexed.
    """
    label = F.col(label_col) if isinstance(label_col, str) else label_col
    known = embeddings.filter(F.col(id_col).isNotNull() & label.isNotNull() & usable(vector_col))
    scaled = F.transform(F.col(vector_col), lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    rows = stored(known.select(
        F.monotonically_increasing_id().alias("at"), F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"),
        scaled.alias("vector"),
    ), "vectors")
    n, dims = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    dims = max(1, dims)
    levels = 1 + max(0, math.ceil(math.log(max(n, 1) / LEVEL_ROWS, 4)))
    # a bounded sample
    sample = pa.array([r[0] for r in rows.orderBy(F.xxhash64("id"), "at").select("vector").limit(SAMPLE_ROWS).collect()], pa.list_(pa.int64()))
    references = choose_references(padded(sample, dims), REFERENCES) if len(sample) else np.zeros((0, dims))
    index = work_path(embeddings.sparkSession, "angle-windows")
    window_table(rows, references, dims, levels, index)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = padded(batch.column("vector"), dims)
            norms = norms_of(vectors)
            angles = [a.astype("<f4").tobytes() for a in angles_to(vectors, norms, references)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(norms), pa.array(angles, pa.binary())], ["at", "id", "label", "vector", "norm", "angles"]
            )

    asking = rows.filter(F.col("id") % anchors_every == 0)
    described = stored(asking.mapInArrow(describe, "at long, id long, label long, vector array<long>, norm double, angles binary"), "anchors")
    anything = described.withColumns({"low": F.array(F.lit(LOWEST)), "high": F.array(F.lit(HIGHEST))})
    best = search(index, levels, anything, dims, 1, True, positives, "positives")

    # the range of a slot: ceil(low_pct * p / 100) to floor(high_pct * p / 100), by whole numbers
    p = F.col("score").cast("decimal(20,0)")
    least = -F.floor(-p * low_pct / F.lit(100).cast("decimal(3,0)"))
    most = F.floor(p * high_pct / F.lit(100).cast("decimal(3,0)"))
    limits = best.select(
        F.col("anchor_at").alias("_at"), (F.col("rank") - 1).alias("k"), least.cast("long").alias("low"), most.cast("long").alias("high"),
    )
    # a slot without a positive is a range that nothing lies in
    none = {"low": HIGHEST, "high": LOWEST}
    ranges = limits.groupBy("_at").agg(*[
        F.array(*[F.coalesce(F.max(F.when(F.col("k") == k, F.col(c))), F.lit(none[c])) for k in range(positives)]).alias(c) for c in none
    ])
    asked = described.join(ranges, F.col("at") == F.col("_at")).drop("_at")
    worst = search(index, levels, asked, dims, positives, False, negatives, "negatives")
    named = described.select(F.col("at").alias("anchor_at"), F.col("id").alias("anchor_id"))
    pairs = best.select("anchor_at", (F.col("rank") - 1).cast("int").alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return worst.join(pairs, ["anchor_at", "slot"]).join(named, "anchor_at").select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"),
    )
