"""Removal of word sequences that occur earlier, behind a count-min prefilter.

Windows of 20 words that occur once need no grouping, and nearly all do. A count-min sketch tells most of
them: every task counts its windows in sparse cells, the cells are summed, and the cells that reached two
are shared as bitmaps. The sketch never counts too little, so a second pass that emits only windows
estimated as repeated loses none, and grouping those exactly decides.

Windows are not counted one by one. Of the 8-word runs within a window, the one with the least hash is its
anchor. Equal windows have equal anchors at equal places, so the count of an anchor bounds the count of
its windows from above, and consecutive windows mostly share an anchor: the sketch takes one entry, and
the second pass one row, for about seven windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storkline.llm.words import mixed, pieces, run_hashes, text_bytes, word_hashes, word_spans
from storkline.session import stored

WINDOW = 20
ANCHOR = 8
ANCHOR_BASE, WINDOW_BASE = 0xD6E8FEB86659FD93, 0xA0761D6478BD642F
# a row of the sketch gets a cell for so many bytes of text, at most 2 ** MAX_BITS cells
BYTES_PER_CELL = 12
MAX_BITS = 28
SEEDS = (0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)
# exact groups of about this much text each
BUCKET_BYTES = 4 << 20
# an anchor counted this often is first reduced in parts; if more cells than HOT_CELLS are, all are
HOT_ROWS = 50_000
HOT_CELLS = 100_000
BITMAP_BITS = 8 * 4096  # of Spark's bitmap functions
LAST = (1 << 63) - 1


class Windows:
    """Windows of a batch of texts, run by run: consecutive windows of one text with one anchor."""

    def __init__(self, column: pa.Array, window: int):
        data, offsets = text_bytes(column)
        starts, ends, self.firsts = word_spans(data, offsets)
        words = word_hashes(data, starts, ends)
        reach = window - ANCHOR + 1
        anchors = run_hashes(words, ANCHOR, ANCHOR_BASE)
        self.hashes = run_hashes(words, window, WINDOW_BASE)
        # a window lies within the text of its first word
        text = np.searchsorted(self.firsts, np.arange(len(self.hashes)), side="right") - 1
        self.windows = np.flatnonzero(np.arange(len(self.hashes)) + window <= self.firsts[text + 1])
        self.text = text[self.windows]
        if not len(self.windows):
            self.runs, self.anchor = np.zeros(0, np.int64), np.zeros(0, np.uint64)
            return
        least = np.concatenate([
            np.lib.stride_tricks.sliding_window_view(anchors[a : a + 65536 + reach - 1], reach).argmin(axis=1)
            for a in range(0, len(self.hashes), 65536)
        ])
        place = self.windows + least[self.windows]
        fresh = np.ones(len(place), bool)
        fresh[1:] = (place[1:] != place[:-1]) | (self.text[1:] != self.text[:-1])
        self.runs = np.flatnonzero(fresh)
        self.anchor = anchors[place[self.runs]]


def cells_of(anchor: np.ndarray, bits: int) -> list[np.ndarray]:
    """One cell per row of the sketch; rows follow each other in the numbering."""
    cells = [(mixed(anchor ^ np.uint64(seed)) >> np.uint64(64 - bits)).astype(np.int64) for seed in SEEDS]
    return [cell + (row << bits) for row, cell in enumerate(cells)]


def sketch(texts: DataFrame, bits: int, window: int) -> DataFrame:
    """``(cell, n)`` of the merged sketch for cells that reached two.

    A slice counts a cell up to two, so sums tell a repeated anchor exactly and, where they are large, in
    how many slices it occurs.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                found = Windows(part.column("text"), window)
                for cells in cells_of(found.anchor, bits):
                    cell, n = np.unique(cells, return_counts=True)
                    counts = np.minimum(n, 2).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(counts)], ["cell", "n"])

    cells = texts.select("text").mapInArrow(scan, "cell long, n long")
    return cells.groupBy("cell").agg(F.sum("n").alias("n")).filter("n > 1")


def bitmap_of(cells: DataFrame, bits: int) -> np.ndarray:
    """The cells as packed bits; (rows << bits) / 8 bytes whatever the corpus."""
    size = len(SEEDS) << bits
    grouped = cells.groupBy(F.bitmap_bucket_number(F.col("cell") + 1).alias("k")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.col("cell") + 1)).alias("bitmap")
    )
    out = np.zeros(-(-size // BITMAP_BITS) * (BITMAP_BITS // 8), np.uint8)
    # Spark's buckets are numbered from 1, and so are the values within them
    for row in grouped.collect():
        at = (row["k"] - 1) * (BITMAP_BITS // 8)
        out[at : at + BITMAP_BITS // 8] = np.frombuffer(row["bitmap"], np.uint8)
    return out


def has_bit(bitmap: np.ndarray, cells: np.ndarray) -> np.ndarray:
    return (bitmap[cells >> 3] >> (cells & 7).astype(np.uint8) & 1).astype(bool)


def unpacked(mask: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, bit) of every set bit, row by row and upwards."""
    return np.nonzero(mask[:, None] >> np.arange(reach)[None, :] & 1)


def packed(rows: np.ndarray, bits: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(rows, weights=(1 << bits).astype(np.float64), minlength=n).astype(np.int64)


def payload(values: np.ndarray, rows: np.ndarray, n: int) -> pa.Array:
    """One binary value per row from 8-byte values ordered by row."""
    begins = np.zeros(n + 1, np.int32)
    begins[1:] = 8 * np.cumsum(np.bincount(rows, minlength=n))
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(begins.tobytes()), pa.py_buffer(values.tobytes())])


ROW_COLUMNS = ["anchor", "salt", "doc", "key", "start", "mask", "hashes"]
ROW_TYPE = "anchor long, salt int, doc long, key long, start int, mask int, hashes binary"


def first_of_equal(
    anchor: np.ndarray, salt: np.ndarray, doc: np.ndarray, key: np.ndarray, start: np.ndarray, mask: np.ndarray,
    hashes: np.ndarray, reach: int, final: bool,
) -> Iterator[pa.RecordBatch]:
    """Splits runs of windows into those that begin earlier elsewhere, and the rest.

    A window is known by its anchor's hash and its own, 128 bits. Of equal windows those with the smallest
    (doc, start) stay contenders, which are dropped if this is the ``final`` look at them; the others are
    rows without hashes.
    """
    rows, bits = unpacked(mask, reach)
    at = start[rows].astype(np.int64) + bits
    order = np.lexsort((at, doc[rows], hashes, anchor[rows]))
    a, h, d, s = anchor[rows][order], hashes[order], doc[rows][order], at[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (h[1:] != h[:-1])
    lead = np.flatnonzero(new)[np.cumsum(new) - 1] if len(order) else np.zeros(0, np.int64)
    later = np.zeros(len(order), bool)
    later[order] = (d != d[lead]) | (s != s[lead])
    for gone in (True, False) if not final else (True,):
        taken = later == gone
        masks = packed(rows[taken], bits[taken], len(mask))
        keep = np.flatnonzero(masks)
        kept_rows = np.searchsorted(keep, rows[taken])
        yield pa.RecordBatch.from_arrays([
            pa.array(anchor[keep].view(np.int64)), pa.array(salt[keep].astype(np.int32)), pa.array(doc[keep]), pa.array(key[keep]),
            pa.array(start[keep].astype(np.int32)), pa.array(masks[keep].astype(np.int32)),
            pa.nulls(len(keep), pa.binary()) if gone else payload(hashes[taken], kept_rows, len(keep)),
        ], ROW_COLUMNS)


def candidates(texts: DataFrame, bitmap: np.ndarray, hot: np.ndarray | None, bits: int, window: int) -> DataFrame:
    """Rows for runs of windows estimated as repeated, and for windows repeated within one slice.

    Equal windows of a slice are reduced to the first. ``salt`` spreads an anchor in hot cells (all
    anchors if ``hot`` is None) for a first reduction; others have salt 0.
    """
    reach = window - ANCHOR + 1
    shared = texts.sparkSession.sparkContext.broadcast((bitmap, hot))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, often = shared.value
        for batch in batches:
            for part in pieces(batch, "text"):
                found = Windows(part.column("text"), window)
                cells = cells_of(found.anchor, bits)
                maybe = has_bit(seen, cells[0]) & has_bit(seen, cells[1])
                ends = np.append(found.runs[1:], len(found.windows))
                first, size, anchor = found.runs[maybe], (ends - found.runs)[maybe], found.anchor[maybe]
                if not len(first):
                    continue
                text = found.text[first]
                doc = part.column("doc").to_numpy()[text]
                key = part.column("key").to_numpy()[text]
                start = found.windows[first] - found.firsts[text]
                mask = (1 << size) - 1
                rows = np.repeat(np.arange(len(first)), size)
                place = np.repeat(first - np.cumsum(size) + size, size) + np.arange(len(rows))
                hashes = found.hashes[found.windows[place]]
                salt = np.zeros(len(first), np.int64)
                if often is None or len(often):
                    spread = 1 + int(mixed(np.array([doc[0] ^ start[0]], np.int64).view(np.uint64))[0] % np.uint64(1000))
                    salt[:] = spread if often is None else np.where(np.isin(cells[0][maybe], often), spread, 0)
                yield from first_of_equal(anchor, salt, doc, key, start, mask, hashes, reach, False)

    return texts.mapInArrow(scan, ROW_TYPE)


def reduced(rows: DataFrame, keys: list[str], reach: int, final: bool) -> DataFrame:
    """One more look at rows, by bucket; see ``first_of_equal``."""

    def look(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        done = table.filter(table["hashes"].is_null()).select(ROW_COLUMNS)
        rest = table.filter(table["hashes"].is_valid())
        binary = rest["hashes"].combine_chunks()
        binary = binary.chunk(0) if isinstance(binary, pa.ChunkedArray) else binary
        hashes = text_bytes(binary)[0].tobytes() if len(rest) else b""
        columns = [rest[c].to_numpy() for c in ROW_COLUMNS[:-1]]
        columns[0] = columns[0].view(np.uint64)
        out = first_of_equal(*columns, np.frombuffer(hashes, np.uint64), reach, final)
        schema = done.schema
        return pa.Table.from_batches([*done.to_batches(), *(b.cast(schema) for b in out)], schema)

    return rows.groupBy(*keys).applyInArrow(look, ROW_TYPE)


def cut(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Leaves out the words of windows to be removed; the kept words are joined by one space."""
    reach = window - ANCHOR + 1
    for batch in batches:
        for part in pieces(batch, "text"):
            data, offsets = text_bytes(part.column("text"))
            starts, ends, firsts = word_spans(data, offsets)
            runs = part.column("runs")
            owner = np.repeat(np.arange(part.num_rows), np.diff(runs.offsets.to_numpy()) * ~runs.is_null().to_numpy(zero_copy_only=False))
            flat = runs.flatten()
            rows, bits = unpacked(flat.field("mask").to_numpy().astype(np.int64), reach)
            at = firsts[owner[rows]] + flat.field("start").to_numpy()[rows] + bits
            edge = np.zeros(len(starts) + 1, np.int64)
            np.add.at(edge, at, 1)
            np.add.at(edge, at + window, -1)
            keep = np.cumsum(edge[:-1]) == 0
            kept = np.concatenate([[0], np.cumsum(keep)])[firsts]
            lengths = (ends - starts)[keep]
            # the kept words and a space behind each, the last space of a text left out
            out = np.full(int(lengths.sum()) + len(lengths), 32, np.uint8)
            begin = np.cumsum(lengths + 1) - lengths - 1
            inner = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            out[inner + np.repeat(begin, lengths)] = data[inner + np.repeat(starts[keep], lengths)]
            bounds = np.append(begin, len(out))
            buffer = out.tobytes()
            texts = [buffer[bounds[a] : max(bounds[a], bounds[z] - 1)].decode() for a, z in zip(kept[:-1], kept[1:])]
            n = np.diff(firsts)
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(n), pa.array(n - np.diff(kept)), pa.array(texts, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_text"],
            )


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_text)``, one row per input row.

    A word goes if it lies in a window of ``window`` consecutive words whose sequence also starts earlier:
    in a document with a smaller id, or earlier in the same one. All windows are judged on the input. The
    kept words are joined by one space. Null and empty texts have no words. Rows that share an id count
    as one document, so repeated rows are treated alike; null is an id of its own, the largest. An empty
    table gives an empty result; other columns are ignored.

    The sketch has a fixed largest size; for a larger corpus more windows pass it and are grouped, none is
    lost. A frequent passage is reduced within each slice of a task before it is shuffled, and in parts
    before it is grouped.
    """
    if not ANCHOR <= window <= ANCHOR + 30:
        raise ValueError(f"windows of {ANCHOR} to {ANCHOR + 30} words")
    reach = window - ANCHOR + 1
    id_ = F.coalesce(F.col(id_col).cast("long"), F.lit(LAST))
    texts = docs.select(id_.alias("doc"), text_key(F.col(text_col)).alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = docs.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0
    bits = min(MAX_BITS, max(16, int(size // BYTES_PER_CELL).bit_length()))

    cells = stored(sketch(texts, bits, window), "sketch")
    hot = cells.filter((F.col("n") >= HOT_ROWS) & (F.col("cell") < 1 << bits)).select("cell").limit(HOT_CELLS + 1)
    hot = np.array([r[0] for r in hot.collect()], np.int64)
    hot = None if len(hot) > HOT_CELLS else hot

    buckets = max(1, int(size // BUCKET_BYTES))
    rows = candidates(texts, bitmap_of(cells, bits), hot, bits, window)
    # rows without hashes are done with and only need to come through, whichever way
    dealt = F.when(F.col("hashes").isNull(), F.xxhash64("doc", "start")).otherwise(F.col("anchor"))
    rows = rows.withColumn("bucket", F.pmod(dealt, F.lit(buckets)))
    if hot is None or len(hot):
        rows = rows.withColumn("_hot", F.col("salt") > 0)
        parts = stored(reduced(rows.filter("_hot").drop("_hot"), ["bucket", "salt"], reach, False), "reduced")
        parts = parts.withColumn("bucket", F.pmod(dealt, F.lit(buckets)))
        rows = rows.filter("not _hot").drop("_hot").unionByName(parts)
    removed = reduced(rows, ["bucket"], reach, True)
    runs = removed.groupBy("doc", "key").agg(F.collect_list(F.struct("start", "mask")).alias("runs"))

    whole = docs.select(F.col(id_col).alias("id"), id_.alias("_doc"), text_key(F.col(text_col)).alias("_key"), F.col(text_col).alias("text"))
    found = whole.join(runs, (F.col("_doc") == F.col("doc")) & (F.col("_key") == F.col("key")), "left")
    kind = docs.schema[id_col].dataType.simpleString()
    return found.select("id", "text", "runs").mapInArrow(
        lambda batches: cut(batches, window), f"doc_id {kind}, n_words long, n_removed long, kept_text string"
    )
