"""Hard negatives against all pairs, and the bounds against all angles."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from storkline.llm import hard_negatives as hn
from storkline.llm.queries import QUERIES

TYPE = "vec_id long, embedding array<float>, label int"


def plain(rows, positives=5, negatives=3):
    """(anchor, positive, rank, negative, scores) over all pairs, with whole numbers of any size."""
    held = []
    for at, (i, vector, label) in enumerate(rows):
        if i is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        held.append((at, i, label, [math.floor(256 * float(np.float32(x))) for x in vector]))
    out = []
    for at, i, label, vector in held:
        if i % 50:
            continue
        scored = [(-sum(x * y for x, y in zip(vector, v)), j, b, l == label) for b, j, l, v in held if b != at]
        scored = [(-max(min(-s, (1 << 63) - 1), -(1 << 63)), j, b, same) for s, j, b, same in scored]
        for s, j, _, _ in sorted(x for x in scored if x[3])[:positives]:
            fit = sorted(x for x in scored if not x[3] and 50 * -s <= 100 * -x[0] <= 95 * -s)[:negatives]
            out += [(i, j, r + 1, x[1], -s, -x[0]) for r, x in enumerate(fit)]
    return sorted(out)


def clusters(seed, n, dims=12, spread=0.25):
    """Vectors around a few centres, some of them repeated, of lengths from tiny to large."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dims))
    rows = []
    for i in range(n):
        v = centres[i % 6] + spread * rng.normal(size=dims)
        v *= rng.choice([0.2, 1.0, 1.0, 3.0]) / np.linalg.norm(v)
        rows.append((i, [float(np.float32(x)) for x in v], int(rng.integers(0, 3)) if i % 3 else 0))
    return rows


def mined(spark, rows, **changes):
    frame = spark.createDataFrame(rows, TYPE).repartition(3)
    frame = frame.withColumns({c: F.lit("clash") for c in ("at", "id", "vector", "score", "slot", "low", "high", "worst", "rank", "norm")})
    return sorted(tuple(r) for r in hn.mine_hard_negatives(frame, **changes).collect())


def test_against_all_pairs(spark):
    rows = clusters(1, 420)
    rows += [(1000 + i, [0.0] * 12, i % 2) for i in range(4)] + [(1050, [0.0] * 12, 1), (1100, [-x for x in rows[0][1]], 2)]
    rows += [(2000 + i, rows[50][1], i % 3) for i in range(30)]
    rows += [(None, rows[1][1], 1), (1150, None, 1), (1151, rows[1][1], None), (1152, [1.0, None], 1), (1153, [float("nan")] * 12, 1),
             (1200, [float("inf")] * 12, 1), (1250, [], 0), (1251, [0.5], 1), (1300, [0.5, 0.25], 7)]
    assert mined(spark, rows) == plain(rows)


def test_levels_and_windows(spark, monkeypatch):
    rows = clusters(2, 600)
    expected = plain(rows)
    for name, value in {"LEVEL_ROWS": 20, "WINDOW_ROWS": 8, "HELD_ROWS": 30, "ANCHORS_PER_BATCH": 3}.items():
        monkeypatch.setattr(hn, name, value)
    assert mined(spark, rows) == expected


def test_repeated_ids(spark):
    rows = clusters(3, 120) + [(50, clusters(4, 1)[0][1], 0)] * 2
    assert mined(spark, rows) == plain(rows)


@pytest.mark.parametrize("size", [100.0, 3e4, 1e8, 1e30])
def test_large_components(spark, size):
    rng = np.random.default_rng(5)
    rows = [(i, [float(np.float32(size * x)) for x in rng.normal(size=3)], i % 2) for i in range(120)]
    if size < 1e20:
        assert mined(spark, rows) == plain(rows)
    else:
        assert all(len(r) == 6 for r in mined(spark, rows))


def test_nothing(spark):
    assert hn.mine_hard_negatives(spark.createDataFrame([], TYPE)).isEmpty()
    assert mined(spark, [(50, [1.0], 1)]) == [] and mined(spark, [(51, [1.0], 1), (52, [1.0], 2)]) == []


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(6)
    centres = 300 * rng.normal(size=(8, 16))
    vectors = np.floor(np.repeat(centres, 50, axis=0) + 20 * rng.normal(size=(400, 16))).astype(np.int64)
    norms = hn.norms_of(vectors)
    references = hn.choose_references(vectors[::7], 12)
    angles = hn.angles_to(vectors, norms, references)
    cut = lambda f, x: np.stack([f(x[a : a + 25], axis=0) for a in range(0, 400, 25)])
    lower, upper = hn.score_bounds(angles, norms, cut(np.min, angles), cut(np.max, angles), cut(np.min, norms), cut(np.max, norms))
    scores = (vectors @ vectors.T).reshape(400, 16, 25)
    assert (scores >= lower[:, :, None]).all() and (scores <= upper[:, :, None]).all()
    # most windows cannot hold any of an anchor's ten best
    tenth = np.sort(scores.reshape(400, -1), axis=1)[:, -10]
    assert (upper < tenth[:, None]).mean() > 0.6


def test_query(spark, tmp_path):
    rows = clusters(7, 400)
    spark.createDataFrame(rows, TYPE).write.parquet(str(tmp_path / "embeddings.parquet"))
    moved = [(i, v, (l + 1) % 10 if i % 7 == 0 else l) for i, v, l in rows]
    found = QUERIES["op12_hard_negatives"](spark, str(tmp_path))
    columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(tuple(r) for r in found.select(*columns).collect()) == plain(moved)
