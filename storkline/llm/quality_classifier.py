"""Supervised text quality with averaged subword embeddings.

Words and character n-grams of a text are hashed into buckets; every bucket has a learned vector. A text
is the mean of its vectors, a softmax layer on it gives the class. Training is plain stochastic gradient
descent in numpy on a bounded sample. As mean and layer are linear, a bucket's share in the score can be
worked out once, so scoring needs one number per bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storkline.llm.words import mixed, pieces, run_hashes, text_bytes, word_hashes, word_spans

BUCKET_BITS = 18
NGRAMS = (3, 4)
BASES = (0x9FB21C651E98DF25, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
SAME_WORD = np.uint64(0x27D4EB2F165667C5)
FOLDS = 5


def text_features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all features, text by text, and where each text begins.

    Features are words, of which one equal to the word before counts as a mark of its own, and runs of
    code points, blanks made equal.
    """
    data, offsets = text_bytes(column)
    starts, ends, firsts = word_spans(data, offsets)
    words = word_hashes(data, starts, ends)
    again = np.zeros(len(words), bool)
    again[1:] = words[1:] == words[:-1]
    again[firsts[:-1][firsts[:-1] < len(words)]] = False
    words = mixed(np.where(again, SAME_WORD, words) ^ np.uint64(BASES[0]))

    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32).astype(np.uint64)
    points = np.where((points >= 9) & (points <= 13), np.uint64(32), points)
    begins = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    parts, bounds = [words], [firsts]
    for n, base in zip(NGRAMS, BASES[1:]):
        runs = run_hashes(points, n, base)
        inside = np.zeros(len(runs) + 1, np.int64)
        text = np.searchsorted(begins, np.arange(len(runs)), side="right") - 1
        valid = np.arange(len(runs)) + n <= begins[text + 1]
        inside[1:] = np.cumsum(valid)
        parts.append(runs[valid])
        bounds.append(inside[np.minimum(begins, len(runs))])
    # interleave the kinds text by text
    sizes = np.stack([np.diff(b) for b in bounds], axis=1)
    upto = np.concatenate([[0], np.cumsum(sizes.sum(axis=1))])
    out = np.zeros(int(upto[-1]), np.int64)
    shift = upto[:-1]
    for part, bound, size in zip(parts, bounds, sizes.T):
        at = np.arange(len(part)) + np.repeat(shift - bound[:-1], size)
        out[at] = (part >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
        shift = shift + size
    return out, upto


def train(
    texts: list[str], labels: list[int], dim: int = 8, epochs: int = 4, rate: float = 4.0, seed: int = 42
) -> tuple[np.ndarray, float]:
    """One number per bucket and a constant: log odds of label 1 are their mean over a text, plus constant."""
    y = np.array(labels, np.int64)
    if len(np.unique(y)) < 2:
        return np.zeros(1 << BUCKET_BITS, np.float32), float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dim, 1 / dim, (1 << BUCKET_BITS, dim)).astype(np.float32)
    layer = np.zeros((dim, 2), np.float32)
    bias = np.log(np.bincount(y, minlength=2) / len(y)).astype(np.float32)
    rows = []
    for text in texts:
        buckets, _ = text_features(pa.array([text], pa.string()))
        index, n = np.unique(buckets, return_counts=True)
        rows.append((index.astype(np.int32), (n / max(len(buckets), 1)).astype(np.float32)))
    total, done = epochs * len(rows), 0
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            index, share = rows[i]
            pace = rate * (1 - done / total)
            done += 1
            mean = (share[:, None] * vectors[index]).sum(axis=0)
            odds = mean @ layer + bias
            p = np.exp(odds - odds.max())
            error = p / p.sum()
            error[y[i]] -= 1
            back = layer @ error
            layer -= pace * 0.1 * np.outer(mean, error)
            bias -= pace * 0.01 * error
            vectors[index] -= (pace * len(index) ** 0.5 * share)[:, None] * back
    part = vectors @ (layer[:, 1] - layer[:, 0])
    return part.astype(np.float32), float(bias[1] - bias[0])


def fold_of(key: Column) -> Column:
    """crc32 of the id as text, modulo 5; null counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % FOLDS


def training_sample(docs: DataFrame, labels: DataFrame, rows: int, id_col: str, text_col: str, label_col: str) -> list:
    """About ``rows`` labelled texts outside the held-out fold, chosen by a hash of the id."""
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & (fold_of(F.col(id_col)) != 0))
    known = known.groupBy(F.col(id_col).alias("_id")).agg((F.avg(label_col) >= 0.5).cast("int").alias("_label"))
    share = min(1.0, rows / max(1, known.count()))
    drawn = F.pmod(F.xxhash64(F.col("_id").cast("string")), F.lit(1 << 30)) < int(share * (1 << 30))
    texts = docs.select(F.col(id_col).alias("_key"), F.col(text_col).alias("_text"))
    texts = texts.join(F.broadcast(known.filter(drawn)), F.col("_key") == F.col("_id"))
    # one text per id, so that repeated rows cannot grow the sample
    found = texts.groupBy("_id", "_label").agg(F.min(F.coalesce("_text", F.lit(""))).alias("_text")).collect()
    return sorted(((r["_id"], r["_text"], r["_label"]) for r in found), key=lambda r: r[0])


def score_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    threshold: float = 0.3, train_rows: int = 4_000, prefix: str = "",
) -> DataFrame:
    """The rows of ``docs`` with all columns and ``held_out``, ``score``, ``predicted``.

    ``score`` is the probability of label 1 from the whole text alone, ``predicted`` 1 if it reaches
    ``threshold``. The model learns from about ``train_rows`` labelled rows at most (a documented bound,
    drawn by a hash of the id) whose crc32(id as text) modulo 5 is not 0; rows where it is 0 are
    ``held_out``, and so are rows with a null id. Several labels of an id count as their majority, null
    labels not at all. Null and empty texts get the score of a text without features; without labels of
    both kinds every text gets the smoothed share of label 1. Repeated rows are scored each; an empty table
    gives an empty result. The new columns begin with ``prefix``; an input column of the same name is
    replaced.
    """
    sample = training_sample(docs, labels, train_rows, id_col, text_col, label_col)
    part, constant = train([r[1] for r in sample], [r[2] for r in sample])
    shared = docs.sparkSession.sparkContext.broadcast(part)
    new = [f"{prefix}held_out", f"{prefix}score", f"{prefix}predicted"]
    kept = [c for c in docs.columns if c not in new]
    rows = docs.select(F.struct(*kept).alias("row"), F.col(text_col).alias("text"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            for piece in pieces(batch, "text", 1 << 20):
                buckets, begins = text_features(piece.column("text"))
                upto = np.concatenate([[0.0], np.cumsum(table[buckets], dtype=np.float64)])[begins]
                odds = np.diff(upto) / np.maximum(np.diff(begins), 1) + constant
                yield pa.RecordBatch.from_arrays([piece.column("row"), pa.array(1 / (1 + np.exp(-odds)))], ["row", "score"])

    fields = rows.schema["row"].dataType.simpleString()
    scored = rows.mapInArrow(scan, f"row {fields}, score double")
    return scored.select(
        *[F.col("row")[c].alias(c) for c in kept], (fold_of(F.col("row")[id_col]) == 0).alias(new[0]),
        F.col("score").alias(new[1]), (F.col("score") >= threshold).cast("int").alias(new[2]),
    )
