"""Near copies by the Jaccard similarity of word shingles, every link checked exactly.

Candidates come from SimHash fingerprints first: the vantage-point trees of ``simhash`` link those within a few bits, and
texts whose fingerprints are linked share a bucket. Few texts at similarity 0.8 are that close, so MinHash bands give the
other candidates: texts that agree on all minima of a band share a bucket, too. With 32 bands of five minima, a pair at similarity 0.8 misses every band with a probability of 3 in a million, a more
similar pair still less often. What shares a bucket is compared on the shingles themselves, so no link is an
estimate.

A bucket's texts are first compared with one of them, its leader. Links only matter for components, so
pairs within a component need no comparison of their own. Where a bucket still holds several components, every
text is compared with those few of other components whose minima agree best with its own, in rounds, until a
round links nothing more. A round compares a bounded number of pairs per text, also in a bucket of very many.
What the rounds leave apart is compared in full at last: all texts of other components in a bucket whose minima
agree well enough for the similarity, tile by tile, so that only links leave a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F

from storkline.functions.joins import join_lookup
from storkline.llm.components import connected_components
from storkline.llm.simhash import fingerprints_of, near_links, with_groups
from storkline.llm.words import mixed, pieces, run_hashes, text_bytes, word_hashes, word_spans
from storkline.session import stored

BANDS, BAND_ROWS = 32, 5
SHINGLE_BASE, BAND_BASE = 0xA24BAED4963EE407, 0x9FB21C651E98DF25
SEED = 42
TILE_ROWS, TILE_BYTES = 2048, 1 << 24
# a pair at similarity 0.8 agrees on 128 of the 160 minima, with a deviation of 5
LEAST_AGREEING = 105
# texts of other components that a text is compared with in one bucket and round
PARTNERS = 3
MAX_ROUNDS = 20
# bits of a fingerprint, the most that the trees search
DISTANCE = 5


def shingles_of(column: pa.Array, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles, text by text, and where each text's begin (one more entry than texts).

    A text with fewer words than ``shingle`` is one shingle, one without words has none.
    """
    data, offsets = text_bytes(column)
    upper = (data >= 65) & (data <= 90)
    data = np.where(upper, data + 32, data).astype(np.uint8)
    starts, ends, firsts = word_spans(data, offsets)
    words, n = word_hashes(data, starts, ends), np.diff(firsts)
    counts = np.where(n >= shingle, n - shingle + 1, np.minimum(n, 1))
    begins = np.concatenate([[0], np.cumsum(counts)])
    place = np.arange(begins[-1]) - np.repeat(begins[:-1], counts) + np.repeat(firsts[:-1], counts)
    size = np.repeat(np.minimum(n, shingle), counts)
    out = np.zeros(len(place), np.uint64)
    for k in np.unique(size):
        out[size == k] = run_hashes(words, int(k), SHINGLE_BASE)[place[size == k]]
    return out, begins


def signatures(hashes: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A key of each text's shingles, equal for equal multisets, its buckets, one per band, and a byte of every minimum."""
    n = np.diff(begins)
    keys, buckets = np.zeros(len(n), np.uint64), np.zeros((len(n), BANDS), np.uint64)
    sketch = np.zeros((len(n), BANDS * BAND_ROWS), np.uint8)
    filled = np.flatnonzero(n)
    if not len(filled):
        return keys, buckets, sketch
    at = begins[:-1][filled]
    keys[filled] = mixed(np.add.reduceat(mixed(hashes ^ np.uint64(SEED)), at) + n[filled].astype(np.uint64))
    drawn = np.random.default_rng(SEED).integers(0, 1 << 63, (BANDS, BAND_ROWS, 2), dtype=np.uint64)
    for band in range(BANDS):
        held = np.full(len(filled), band, np.uint64)
        for i, (flip, factor) in enumerate(drawn[band]):
            least = mixed(np.minimum.reduceat((hashes ^ flip) * (factor << np.uint64(1) | np.uint64(1)), at))
            held = held * np.uint64(BAND_BASE) + least
            sketch[filled, band * BAND_ROWS + i] = least.astype(np.uint8)
        buckets[filled, band] = mixed(held)
    return keys, buckets, sketch


def add_signatures(docs: DataFrame, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """``(doc_id, fp, simhash, bands, sketch, row, at)``: the SimHash fingerprint and what ``signatures`` gives, all columns
    in a struct, a number of the row."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.struct(*docs.columns).alias("row"),
        F.monotonically_increasing_id().alias("at"),
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                keys, buckets, sketch = signatures(*shingles_of(part.column("text"), shingle))
                ends = pa.array(np.arange(0, buckets.size + 1, BANDS, dtype=np.int32))
                bands = pa.ListArray.from_arrays(ends, pa.array(buckets.ravel().view(np.int64)))
                bytes_ = pa.array([x.tobytes() for x in sketch], pa.binary())
                prints = pa.array(fingerprints_of(part.column("text"), shingle).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(keys.view(np.int64)), prints, bands, bytes_, part.column("row"), part.column("at")],
                    ["doc_id", "fp", "simhash", "bands", "sketch", "row", "at"],
                )

    return rows.mapInArrow(scan, f"doc_id long, fp long, simhash long, bands array<long>, sketch binary, row {rows.schema['row'].dataType.simpleString()}, at long")


def shingle_sets(texts: DataFrame, shingle: int) -> DataFrame:
    """``(fp, shingles)`` of ``(fp, text)``: the distinct hashes in order, eight bytes each."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                hashes, begins = shingles_of(part.column("text"), shingle)
                sets = [np.unique(hashes[a:z]).tobytes() for a, z in zip(begins[:-1], begins[1:])]
                yield pa.RecordBatch.from_arrays([part.column("fp"), pa.array(sets, pa.binary())], ["fp", "shingles"])

    return texts.mapInArrow(scan, "fp long, shingles binary")


def close(x: bytes, y: bytes, similarity: float) -> bool:
    """Whether two sets of shingles have at least the Jaccard ``similarity``."""
    if min(len(x), len(y)) < similarity * max(len(x), len(y)):
        return False
    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both >= similarity * (len(x) + len(y) - both)


def checked(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Those of ``pairs(a, b)`` whose sets of shingles have at least the Jaccard ``similarity``."""
    left = sets.select(F.col("fp").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("fp").alias("b"), F.col("shingles").alias("y"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column("x").to_pylist(), batch.column("y").to_pylist())
            yield batch.select(["a", "b"]).filter(pa.array([close(x, y, similarity) for x, y in both], pa.bool_()))

    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(scan, "a long, b long")


def ordered_pairs(rows: DataFrame) -> DataFrame:
    return rows.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def mixed_buckets(members: DataFrame, links: DataFrame, done: DataFrame | None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Buckets above two texts whose texts ``links`` leave in several components, but for those ``done`` as they are.

    A table ``(bucket, fp, was, label, _parts)`` of their texts, one of the buckets with a hash of their labels, and
    all ``members(bucket, fp, label)`` with their new labels; ``was`` is the label before, null at first.
    """
    labels = connected_components(links)
    known = members.withColumnRenamed("label", "was").join(labels, F.col("fp") == F.col("node"), "left")
    known = stored(known.select("bucket", "fp", "was", F.coalesce("component", "fp").alias("label")), "bucket-labels")
    several = known.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("_n"), F.min("label").alias("_a"), F.max("label").alias("_z"), F.bit_xor(F.xxhash64("fp", "label")).alias("_state")
    )
    several = several.filter("_n > 2 and _a <> _z").select("bucket", F.ceil(F.col("_n") / TILE_ROWS).cast("int").alias("_parts"), "_state")
    if done is not None:
        several = several.join(done, ["bucket", "_state"], "left_anti")
    several = stored(several, "bucket-states")
    rest = join_lookup(known, several.select("bucket", "_parts"), ["bucket"]).filter("_parts is not null")
    return rest, several.select("bucket", "_state"), known.drop("was")


def agreements(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """How many minima 64 rows of ``a`` at a time share with the rows of ``b``, and the first one's place."""
    for at in range(0, len(a), 64):
        agreeing = np.zeros((len(a[at : at + 64]), len(b)), np.int16)
        for column in range(a.shape[1]):
            agreeing += a[at : at + 64, column, None] == b[:, column]
        yield at, agreeing


def best_partners(
    a: np.ndarray, b: np.ndarray, a_labels: list[np.ndarray], b_labels: list[np.ndarray]
) -> tuple[np.ndarray, np.ndarray]:
    """For every row of ``a`` up to ``PARTNERS`` rows of ``b`` in other components that agree on most minima.

    Labels come in one or two versions: what the first one gives is left out of what the second one does.
    """
    rows, partners = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    keep = min(PARTNERS, len(b))
    for at, agreeing in agreements(a, b):
        here = slice(at, at + 64)
        chosen = np.zeros(agreeing.shape, bool)
        for a_label, b_label in zip(a_labels, b_labels):
            apart = np.where(a_label[here, None] == b_label, 0, agreeing)
            best = np.argpartition(-apart, keep - 1, axis=1)[:, :keep]
            before, chosen = chosen, np.zeros(agreeing.shape, bool)
            np.put_along_axis(chosen, best, np.take_along_axis(apart, best, axis=1) >= LEAST_AGREEING, axis=1)
        i, k = np.nonzero(chosen & ~before)
        rows.append(at + i)
        partners.append(k)
    return np.concatenate(rows), np.concatenate(partners)


def closest_across(rows: DataFrame) -> DataFrame:
    """``(a, b)``: the closest texts of other components for every text of ``(bucket, fp, was, label, sketch, _parts)``,
    without those that the labels before gave.

    """

    def meet(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # in the same order every round, so that ties fall alike
        table = pa.Table.from_batches(list(batches)).sort_by("fp")
        fps, label, sketch, here, there = tile(table)
        labels = [label] if table["was"].null_count else [table["was"].to_numpy(), label]
        for one, other in ((here, there), (there, here)) if key[1].as_py() != key[2].as_py() else ((here, there),):
            if len(one) and len(other):
                a, b = best_partners(sketch[one], sketch[other], [x[one] for x in labels], [x[other] for x in labels])
                yield pa.RecordBatch.from_arrays([pa.array(fps[one[a]]), pa.array(fps[other[b]])], ["a", "b"])

    return tiles(rows, ["bucket", "fp", "was", "label", "sketch"]).applyInArrow(meet, "a long, b long")


def tiles(rows: DataFrame, columns: list[str]) -> GroupedData:
    """Rows of a bucket that meet; a large bucket is dealt into ``_parts``, every two of them meet in a task of their own."""
    own = rows.withColumn("_own", F.pmod(F.xxhash64("fp"), F.col("_parts")).cast("int"))
    both = F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))
    sides = own.select(*columns, F.lit(True).alias("home"), F.col("_own").alias("i"), both.alias("j")).unionAll(
        own.select(*columns, F.lit(False).alias("home"), both.alias("i"), F.col("_own").alias("j"))
    )
    return sides.filter("i <= j").groupBy("bucket", "i", "j")


def tile(table: pa.Table) -> tuple[np.ndarray, ...]:
    """Numbers, labels and minima of the rows of a tile, and which rows are on either side."""
    fps, label, home = (table[c].to_numpy() for c in ("fp", "label", "home"))
    sketch = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint8).reshape(len(fps), -1)
    return fps, label, sketch, np.flatnonzero(home), np.flatnonzero(~home)


def links_across(rows: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """``(a, b)``: all texts of other components in a bucket of ``(bucket, fp, label, sketch)`` that are similar.

    Minima that agree less often than those of similar texts spare a comparison.
    """
    known = rows.select("bucket", "fp", "label", "sketch").join(sets, "fp")
    needed = F.ceil(F.greatest(F.count(F.lit(1)) / TILE_ROWS, F.sum(F.octet_length("shingles")) / TILE_BYTES)).cast("int")
    known = join_lookup(known, stored(known.groupBy("bucket").agg(needed.alias("_parts")), "bucket-parts"), ["bucket"])

    def meet(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        fps, label, sketch, here, there = tile(table)
        held = table["shingles"].to_pylist()
        for at, agreeing in agreements(sketch[here], sketch[there]):
            apart = (label[here[at : at + 64], None] != label[there]) & (fps[here[at : at + 64], None] < fps[there] if key[1] == key[2] else True)
            i, k = np.nonzero(apart & (agreeing >= LEAST_AGREEING))
            a, b = here[at + i], there[k]
            found = np.array([close(held[x], held[y], similarity) for x, y in zip(a, b)], bool)
            yield pa.RecordBatch.from_arrays([pa.array(fps[a[found]]), pa.array(fps[b[found]])], ["a", "b"])

    return ordered_pairs(tiles(known, ["bucket", "fp", "label", "sketch", "shingles"]).applyInArrow(meet, "a long, b long"))


def fingerprint_buckets(least: DataFrame) -> DataFrame:
    """``(fp, bucket)`` of ``(fp, simhash)``: a bucket for all fingerprints that the trees link."""
    prints = stored(least.select(F.col("simhash").alias("fp")).distinct(), "fingerprints")
    linked = connected_components(stored(near_links(prints, DISTANCE), "fingerprint-links"))
    found = least.select("fp", "simhash").join(linked, F.col("simhash") == F.col("node"), "left")
    return found.select("fp", F.xxhash64(F.lit("simhash"), F.coalesce("component", "simhash")).alias("bucket"))


def similar_links(rows: DataFrame, least: DataFrame, shingle: int, similarity: float, text_col: str) -> DataFrame:
    """``(a, b)``: links between candidates, enough of them to join their components."""
    alike = stored(fingerprint_buckets(least), "fingerprint-buckets")
    entries = least.select("fp", F.explode("bands").alias("bucket")).unionAll(alike)
    sums = F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("fp")).alias("all"), F.min_by("fp", F.xxhash64("fp", "bucket")).alias("leader")
    buckets = stored(entries.groupBy("bucket").agg(*sums).filter("n > 1"), "buckets")
    # most buckets hold the same texts as another one
    buckets = stored(buckets.groupBy("n", "all").agg(F.min_by(F.struct("bucket", "leader"), "bucket").alias("b")).select("b.*"), "distinct-buckets")
    members = stored(join_lookup(entries, buckets, ["bucket"]).filter("leader is not null"), "members")
    wanted = stored(members.select("fp").distinct().withColumn("_wanted", F.lit(True)), "candidates")
    places = least.join(wanted, "fp").select(F.col("_lead.at").alias("at"), F.lit(True).alias("_here"))
    texts = join_lookup(rows.select("at", "fp", F.col("row")[text_col].alias("text")), places, ["at"]).filter("_here")
    sets = stored(shingle_sets(texts.select("fp", "text"), shingle), "shingle-sets")

    asked = stored(ordered_pairs(members.select(F.col("fp").alias("a"), F.col("leader").alias("b"))), "leader-pairs")
    links = stored(checked(asked, sets, similarity), "leader-links")
    done, labelled = None, members.select("bucket", "fp", F.lit(None).cast("long").alias("label"))
    for _ in range(MAX_ROUNDS):
        rest, states, labelled = mixed_buckets(labelled, links, done)
        # a bucket whose components stay would only offer the pairs that it has offered
        done = states if done is None else done.unionAll(states)
        rest = stored(rest.join(least.select("fp", "sketch"), "fp"), "mixed-buckets")
        more = stored(ordered_pairs(closest_across(rest)).join(asked, ["a", "b"], "left_anti"), "closest-pairs")
        found = stored(checked(more, sets, similarity), "closest-links")
        if found.isEmpty():
            break
        links, asked = links.unionAll(found), asked.unionAll(more)
    # a text may be like one that was none of its closest, and the rounds may have ended before they settled
    rest, _, _ = mixed_buckets(labelled, links, None)
    apart = stored(rest.join(least.select("fp", "sketch"), "fp"), "apart-buckets")
    return links.unionAll(stored(links_across(apart, sets, similarity), "apart-links"))


def mark_near_copies(
    docs: DataFrame, shingle: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text", prefix: str = "",
) -> DataFrame:
    """The rows of ``docs`` with all columns, ``component_id`` and ``first``.

    Texts are lower-cased (A-Z) and cut into words; a text is the set of its shingles of ``shingle`` words. One
    with fewer words is one shingle; those without words, null ones too, are copies of each other. Texts link
    at a Jaccard similarity of at least ``similarity``; ``component_id`` is the smallest id that links
    reach, ``first`` marks one row of a component, as in ``simhash.near_duplicates``. Shingles are compared
    by 64-bit hashes. An empty table gives an empty result. The new columns begin with ``prefix``; an input
    column of the same name is replaced.
    """
    new = [f"{prefix}{c}" for c in ("component_id", "first")]
    columns = [c for c in docs.columns if c not in new]
    rows = stored(add_signatures(docs, shingle, id_col, text_col), "signatures")
    lead = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("at")))
    least = stored(rows.groupBy("fp").agg(lead.alias("_lead"), F.first("simhash").alias("simhash"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")), "distinct-sets")
    links = stored(similar_links(rows, least, shingle, similarity, text_col), "links")
    found = with_groups(rows, least.select("fp", "_lead"), links)
    return found.select(
        *[F.col("row")[c].alias(c) for c in columns], F.col("_first.id").alias(new[0]), (F.col("at") == F.col("_first.at")).alias(new[1])
    )
