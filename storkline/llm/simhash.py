"""SimHash near-duplicates, found with vantage-point trees.

Fingerprints that differ in few bits must be almost equal on one of a few bit blocks: with ``b`` blocks
and at most ``d`` differing bits, some block differs in at most ``d // b``. Distance on a block is a
metric too, so every block gets a vantage-point tree: at each level a fingerprint goes to the branch of
its distance from the level's vantage point, and its leaf is the list of these distances. By the triangle
inequality a partner within the block's radius has distances that differ by at most the radius, so a
fingerprint also visits the neighbouring branches; those that no value within the radius can reach are
pruned. Leaves are shards: pairs are compared exactly, on all 64 bits, within a shard.

A shard reports a spanning forest of its links rather than the links, so a dense group of copies costs
as many rows as it has members.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storkline.functions.joins import join_lookup
from storkline.llm.components import connected_components
from storkline.llm.words import pieces, text_bytes, word_spans
from storkline.session import stored

BITS = 64
SEED = 42
# blocks of 22, 21 and 21 bits: at most 4 differing bits leave one block with at most 1
BLOCKS = ((0, 22), (22, 21), (43, 21))
LEAF_ROWS = 512
TILE_ROWS = 16_384
MAX_LEVELS = 8


def fingerprints_of(column: pa.Array, shingle: int) -> np.ndarray:
    """64-bit SimHash of every text: a bit is 1 if it is set in over half of the shingles' hashes."""
    data, offsets = text_bytes(column)
    upper = (data >= 65) & (data <= 90)
    data = np.where(upper, data + 32, data).astype(np.uint8)
    starts, ends, firsts = word_spans(data, offsets)
    # the words of all texts joined by one space
    lengths = ends - starts
    ends = np.cumsum(lengths + 1) - 1
    joined = np.full(int(ends[-1]) if len(ends) else 0, 32, np.uint8)
    place = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    joined[place + np.repeat(ends - lengths, lengths)] = data[place + np.repeat(starts, lengths)]
    text, starts = joined.tobytes(), ends - lengths
    out = np.zeros(len(column), np.uint64)
    digest = xxhash.xxh64_intdigest
    for i in np.flatnonzero(firsts[1:] > firsts[:-1]):
        a, z = int(firsts[i]), int(firsts[i + 1])
        k = min(shingle, z - a)
        counts = np.zeros(BITS, np.int64)
        for at in range(a, z - k + 1, 1 << 16):
            until = min(at + (1 << 16), z - k + 1)
            spans = zip(starts[at:until].tolist(), ends[at + k - 1 : until + k - 1].tolist())
            hashes = np.array([digest(text[s:e], SEED) for s, e in spans], dtype=">u8")
            counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        out[i] = np.packbits(2 * counts > z - a - k + 1).view(">u8")[0]
    return out


def add_fingerprints(docs: DataFrame, shingle: int, id_col: str, text_col: str, columns: list[str]) -> DataFrame:
    """``(doc_id, fp, row, at)``: the fingerprint as a signed 64-bit number, ``columns`` in a struct, and a number
    that tells rows apart."""
    row = F.struct(*[F.col(c) for c in columns]) if columns else F.lit(None).cast("struct<none:int>")
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), row.alias("row"),
        F.monotonically_increasing_id().alias("at"),
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                fps = fingerprints_of(part.column("text"), shingle).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(fps), part.column("row"), part.column("at")], ["doc_id", "fp", "row", "at"]
                )

    return rows.mapInArrow(scan, f"doc_id long, fp long, row {rows.schema['row'].dataType.simpleString()}, at long")


def vantage_points(levels: int) -> np.ndarray:
    """Vantage values per block and level, from a seeded generator."""
    drawn = np.random.default_rng(SEED).integers(0, 1 << 63, (len(BLOCKS), MAX_LEVELS), dtype=np.int64)
    widths = np.array([[(1 << width) - 1] for _, width in BLOCKS])
    return (drawn & widths)[:, :levels].astype(np.uint64)


def leaf(values: np.ndarray, vantages: np.ndarray) -> np.ndarray:
    """The leaf of block values as one number: their distances from the vantage points, 6 bits each."""
    out = np.zeros(values.shape, np.int64)
    for v in vantages:
        out = out << 6 | np.bitwise_count(values ^ v).astype(np.int64)
    return out


def tree_levels(n: int) -> int:
    """Levels so that leaves hold about ``LEAF_ROWS``; a level tells some 8 distances apart."""
    return min(MAX_LEVELS, max(1, math.ceil(math.log(max(n, 1) / LEAF_ROWS, 8)))) if n > LEAF_ROWS else 1


def shards_of(fps: np.ndarray, block: int, vantages: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf) pairs to visit: a row's own leaf first, then leaves of values one bit away.

    Of two values that differ in one bit, only the one where the bit is 0 visits the other's leaf.
    """
    low, width = BLOCKS[block]
    values = fps >> np.uint64(low) & np.uint64((1 << width) - 1)
    own = leaf(values, vantages)
    near = np.stack([own] + [
        np.where(values >> np.uint64(j) & np.uint64(1) == 0, leaf(values ^ np.uint64(1 << j), vantages), own)
        for j in range(width)
    ], axis=1)
    first = near[:, :1]
    near = np.sort(near, axis=1)
    fresh = np.ones(near.shape, bool)
    fresh[:, 1:] = near[:, 1:] != near[:, :-1]
    fresh &= near != first
    rows, cols = np.nonzero(fresh)
    return np.concatenate([np.arange(len(fps)), rows]), np.concatenate([own, near[rows, cols]])


def shard_rows(fingerprints: DataFrame, levels: int) -> DataFrame:
    """``(shard, home, fp)``: a row for the leaf a fingerprint lives in and one per leaf it visits."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vantages = vantage_points(levels)
        for batch in batches:
            whole = batch.column("fp").to_numpy().view(np.uint64)
            for at, block in itertools.product(range(0, len(whole), 8192), range(len(BLOCKS))):
                fps = whole[at : at + 8192]
                rows, leaves = shards_of(fps, block, vantages[block])
                home = np.arange(len(rows)) < len(fps)
                shard = leaves * len(BLOCKS) + block
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard), pa.array(home), pa.array(fps[rows].view(np.int64))], ["shard", "home", "fp"]
                )

    return fingerprints.mapInArrow(scan, "shard long, home boolean, fp long")


def forest(left: np.ndarray, right: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join every fingerprint of a tile with the least one it can reach within the tile."""
    nodes, at = np.unique(np.concatenate([left, right]), return_inverse=True)
    label = np.arange(len(nodes))
    home, near = np.unique(at[: len(left)]), np.unique(at[len(left) :])
    for start in range(0, len(near), 256):
        rows = near[start : start + 256]
        close = np.bitwise_count(nodes[rows][:, None] ^ nodes[home][None, :]) <= distance
        for r in np.flatnonzero(close.sum(axis=1) > 0):
            linked = np.append(home[close[r]], rows[r])
            found = np.unique(label[linked])
            if len(found) > 1:
                label[np.isin(label, found)] = found[0]
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def near_links(fingerprints: DataFrame, distance: int) -> DataFrame:
    """``(a, b)``: links with the same components as all links between distinct ``fingerprints(fp)``.

    A shard above ``TILE_ROWS`` is cut into tiles: every part of its residents meets every part of its
    visitors, so no task holds a whole large shard.
    """
    if distance // len(BLOCKS) > 1:
        raise ValueError(f"at most {2 * len(BLOCKS) - 1} differing bits")
    levels = tree_levels(fingerprints.count())
    rows = stored(shard_rows(fingerprints, levels), "shard-rows")
    counts = rows.groupBy("shard").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > TILE_ROWS)
    large = stored(counts.select("shard", F.ceil(F.col("_n") / TILE_ROWS).cast("int").alias("_parts")), "large-shards")
    parts = F.coalesce(F.col("_parts"), F.lit(1))
    rows = join_lookup(rows, large, ["shard"]).withColumn("_own", F.pmod(F.xxhash64("fp"), parts).cast("int"))
    both = F.explode(F.sequence(F.lit(0), parts - 1))
    # a resident of part p is in the tiles (p, *) and, as everyone compares with residents, in (*, p)
    as_home = rows.filter("home").select("shard", "fp", F.lit(True).alias("home"), F.col("_own").alias("i"), both.alias("j"))
    as_guest = rows.select("shard", "fp", F.lit(False).alias("home"), both.alias("i"), F.col("_own").alias("j"))

    def compare(table: pa.Table) -> pa.Table:
        fps, home = table["fp"].to_numpy().view(np.uint64), table["home"].to_numpy(zero_copy_only=False)
        a, b = forest(fps[home], fps[~home], distance)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return as_home.unionAll(as_guest).groupBy("shard", "i", "j").applyInArrow(compare, "a long, b long")


def with_groups(rows: DataFrame, least: DataFrame, links: DataFrame) -> DataFrame:
    """``rows`` with ``_first``, the least ``_lead`` of their component; ``least(fp, _lead)`` has one row per node."""
    linked = connected_components(links)
    known = least.join(linked, F.col("fp") == F.col("node"), "left")
    known = known.select(F.col("fp").alias("_fp"), "_lead", F.coalesce("component", "fp").alias("_component"))
    names = known.groupBy(F.col("_component").alias("_c")).agg(F.min("_lead").alias("_first"))
    named = stored(known.join(names, F.col("_component") == F.col("_c")).select("_fp", "_first"), "components")
    return rows.join(named, F.col("fp") == F.col("_fp"), "left")


def near_duplicates(
    docs: DataFrame, shingle: int = 4, distance: int = 4, id_col: str = "doc_id", text_col: str = "text",
    keep_columns: bool = False, prefix: str = "",
) -> DataFrame:
    """``(doc_id, fingerprint, component_id, first)``, one row per input row.

    Texts are lower-cased (A-Z) and cut into words; shingles of ``shingle`` words, repeats included, are
    hashed with XXH64. A text with fewer words is one shingle; without words, as for null and empty texts,
    the fingerprint is zero and links like any other. Fingerprints link at ``distance`` or fewer differing
    bits; ``component_id`` is the smallest id that links reach. ``first`` marks one row of a component: the
    one with that id, and any one of rows that repeat it. Rows with a null id belong to their component but
    never name it; a component without ids has a null name. An empty table gives an empty result.
    ``keep_columns`` puts all columns of ``docs`` in place of ``doc_id``; the others then begin with
    ``prefix``, and an input column of the same name is replaced.

    Work after hashing is on distinct fingerprints, so copies cost one row; hot fingerprints are reduced
    before they are shuffled, and documents meet their component in a join that adaptive execution splits.
    """
    new = [f"{prefix}{c}" for c in ("fingerprint", "component_id", "first")]
    columns = [c for c in docs.columns if c not in new] if keep_columns else []
    rows = stored(add_fingerprints(docs, shingle, id_col, text_col, columns), "fingerprints")
    lead = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("at")))
    least = stored(rows.groupBy("fp").agg(lead.alias("_lead")), "distinct-fingerprints")
    links = stored(near_links(least.select("fp"), distance), "fingerprint-links")
    found = with_groups(rows, least, links)
    return found.select(
        *([F.col("row")[c].alias(c) for c in columns] if keep_columns else ["doc_id"]),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias(new[0]), F.col("_first.id").alias(new[1]),
        (F.col("at") == F.col("_first.at")).alias(new[2]),
    )
