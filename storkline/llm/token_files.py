"""Token ids of a corpus in binary files of shuffled planes.

A file holds the ids of consecutive documents. Ids are cut into blocks of fixed size; a block of n 32-bit ids
is transposed into planes (the four bytes, or the 32 bits, of all ids), and every plane is compressed with
zstandard on its own. The upper planes of a small vocabulary are all zero and take no bytes.

Layout, little-endian: magic; the planes of all blocks; the documents (ids, null flags, token counts), compressed;
the chunk index (per block: offset, ids, bytes of each plane), compressed; footer (places of these two, the
block size, the kind of planes, magic). A reader finds any range of ids through the index and reads only the
blocks it lies in.
"""

from __future__ import annotations

import itertools
import re
import struct
import unicodedata
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from storkline.llm.warc import open_store
from storkline.llm.words import pieces, text_bytes
from storkline.llm.workers import held_by_worker

MAGIC = b"IDPLANE1"
# docs offset, docs bytes, docs, index offset, index bytes, blocks, ids, ids of a block, planes of an id
FOOTER = "<9q8s"
BLOCK_IDS = 1 << 16
LEVEL = 3
END = 0
PLANES = {"byte": 4, "bit": 32}
# pieces a worker remembers the ids of before it forgets the rarer ones, and the bytes of the longest of these
REMEMBERED_PIECES = 700_000
REMEMBERED_BYTES = 64
# bytes of texts that are looked up together
SLICE_CHARS = 4 << 20
# kinds of ASCII characters (letter, digit, blank, other), and the bytes of characters that are not cut on bytes
BLANK = 0x20
KINDS = np.array([0 if chr(b).isalpha() else 1 if chr(b).isdigit() else 2 if b in b"\t\n\r " else 3 for b in range(128)] + [3] * 128, np.uint8)
STRANGE = np.array([b not in b"\t\n\r" and not 0x20 <= b < 0x7F for b in range(256)])
# behind pieces, for the model: a blank that no piece shows, and a character that no merge has
GAP, MARK = "\v", "\ue000"


def split_planes(ids: np.ndarray, planes: int) -> list[bytes]:
    """The planes of a block, lowest first; an all-zero plane is empty."""
    table = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if planes == 32:
        table = np.packbits(np.unpackbits(table, axis=1, bitorder="little"), axis=0, bitorder="little")
    return [np.ascontiguousarray(p).tobytes() if p.any() else b"" for p in table.T]


def join_planes(parts: list[bytes], n: int) -> np.ndarray:
    """The ``n`` ids of a block from its planes."""
    planes = len(parts)
    table = np.zeros((planes, n if planes == 4 else -(-n // 8)), np.uint8)
    for row, part in zip(table, parts):
        if part:
            row[:] = np.frombuffer(part, np.uint8)
    if planes == 4:
        return np.ascontiguousarray(table.T).view("<u4").ravel()
    bits = np.unpackbits(table, axis=1, count=n, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u4").ravel()


class PlaneWriter:
    """Writes one file: ``add`` ids of whole documents in order, then ``close``."""

    def __init__(self, out, block_ids: int = BLOCK_IDS, planes: str = "byte"):
        self.out, self.block_ids, self.planes = out, block_ids, PLANES[planes]
        self.compressor = zstandard.ZstdCompressor(level=LEVEL)
        self.held: list[np.ndarray] = []
        self.n_held = self.n_ids = 0
        self.index: list[list[int]] = []
        self.docs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.at = self.out.write(MAGIC)

    def put(self, data: bytes) -> int:
        self.out.write(data)
        self.at += len(data)
        return len(data)

    def block(self, ids: np.ndarray) -> None:
        place, sizes = self.at, []
        for part in split_planes(ids, self.planes):
            sizes.append(self.put(self.compressor.compress(part)) if part else 0)
        self.index.append([place, len(ids), *sizes])
        self.n_ids += len(ids)

    def add(self, doc_ids: np.ndarray, missing: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
        """Documents with their ids end to end; ``missing`` flags documents without an id."""
        self.docs.append((doc_ids, missing, counts))
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= self.block_ids:
            ids = np.concatenate(self.held)
            whole = len(ids) // self.block_ids * self.block_ids
            for a in range(0, whole, self.block_ids):
                self.block(ids[a : a + self.block_ids])
            self.held, self.n_held = [ids[whole:]], len(ids) - whole

    def close(self) -> tuple[int, int]:
        """Finishes the file; the number of its documents and ids."""
        if self.n_held:
            self.block(np.concatenate(self.held))
        kinds = ("<i8", "|u1", "<i8")
        columns = [np.concatenate([np.zeros(0, k), *(d[i] for d in self.docs)]).astype(k) for i, k in enumerate(kinds)]
        n_docs, docs_at = len(columns[0]), self.at
        docs_bytes = self.put(self.compressor.compress(b"".join(c.tobytes() for c in columns)))
        index_at = self.at
        index_bytes = self.put(self.compressor.compress(np.array(self.index, "<i8").tobytes()))
        self.put(struct.pack(
            FOOTER, docs_at, docs_bytes, n_docs, index_at, index_bytes, len(self.index), self.n_ids, self.block_ids, self.planes, MAGIC
        ))
        self.out.close()
        return n_docs, self.n_ids


class PlaneReader:
    """Reads one file by its chunk index."""

    def __init__(self, store, path: str):
        self.file = store.open_input_file(path)
        head, foot = self.read(0, len(MAGIC)), self.tail(struct.calcsize(FOOTER))
        docs_at, docs_bytes, self.n_docs, index_at, index_bytes, blocks, self.n_ids, self.block_ids, self.planes, magic = struct.unpack(FOOTER, foot)
        if head != MAGIC or magic != MAGIC:
            raise ValueError(f"not a file of id planes: {path}")
        self.expand = zstandard.ZstdDecompressor().decompress
        self.docs_place = docs_at, docs_bytes
        index = np.frombuffer(self.expand(self.read(index_at, index_bytes)), "<i8")
        self.index = index.reshape(blocks, 2 + self.planes)

    def read(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def tail(self, n: int) -> bytes:
        return self.read(self.file.size() - n, n)

    def documents(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the documents, flags of those without one, token counts."""
        raw, n = self.expand(self.read(*self.docs_place)), self.n_docs
        return np.frombuffer(raw, "<i8", n), np.frombuffer(raw, np.uint8, n, 8 * n), np.frombuffer(raw, "<i8", n, 9 * n)

    def block(self, number: int) -> np.ndarray:
        place, n, *sizes = self.index[number].tolist()
        raw, parts, at = self.read(place, sum(sizes)), [], 0
        for size in sizes:
            parts.append(self.expand(raw[at : at + size]) if size else b"")
            at += size
        return join_planes(parts, n)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids from ``start`` up to ``stop``, counted within the file; reads only the blocks they lie in."""
        start, stop = max(start, 0), min(stop, self.n_ids)
        if start >= stop:
            return np.zeros(0, np.uint32)
        first, last = start // self.block_ids, (stop - 1) // self.block_ids
        found = np.concatenate([self.block(b) for b in range(first, last + 1)])
        return found[start - first * self.block_ids : stop - first * self.block_ids]


def chunk_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """First bytes of the chunks of all texts: where a text begins, and blanks right behind a visible character."""
    before = data[:-1]
    visible = (before >= 0x21) & (before <= 0x7E)
    # the last byte of U+00C0 to U+023F, which has two
    visible[1:] |= (before[1:] >= 0x80) & (before[:-1] >= 0xC3) & (before[:-1] <= 0xC8)
    begins = np.zeros(len(data), bool)
    begins[1:] = visible & (data[1:] == BLANK)
    begins[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    return np.flatnonzero(begins)


def piece_starts(data: np.ndarray, offsets: np.ndarray, strange: np.ndarray) -> np.ndarray:
    """First bytes of the pieces of all texts; a chunk that has a ``strange`` byte stays whole.

    Pieces are runs of letters, digits, or other visible characters, each with the blank before it; endings like
    ``'s``; and runs of blanks without the last one before a visible character.
    """
    kind, first = KINDS[data], np.zeros(len(data) + 1, bool)
    first[offsets] = True
    blank = kind == KINDS[BLANK]
    begins = first[:-1].copy()
    # a new kind begins a piece, unless the character before is a blank that goes with it
    begins[1:] |= (kind[1:] != kind[:-1]) & (blank[1:] | (data[:-1] != BLANK))
    # so does the last of several blanks, if a visible character follows
    begins[1:-1] |= blank[1:-1] & blank[:-2] & ~blank[2:] & ~first[2:-1]
    spots = np.flatnonzero(begins & (data == ord("'")))
    tail = np.concatenate([data, np.zeros(2, np.uint8)])
    one, two = tail[spots + 1], tail[spots + 2]
    short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
    pair = one.astype(np.int64) << 8 | two
    long = np.isin(pair, [int.from_bytes(e, "big") for e in (b"re", b"ve", b"ll")]) & ~first[np.minimum(spots + 2, len(data))]
    ending = (short | long) & ~first[spots + 1]
    spots, size = spots[ending], np.where(short, 2, 3)[ending]
    begins[spots + 1] = False
    begins[(spots + size)[spots + size < len(data)]] = True
    if strange.any():
        chunks = chunk_starts(data, offsets)
        whole = np.logical_or.reduceat(strange, chunks)
        begins &= ~np.repeat(whole, np.diff(chunks, append=len(data)))
        begins[chunks] = True
    return np.flatnonzero(begins)


class PieceTokenizer:
    """Ids of whole texts by a byte-level tokenizer.

    The tokenizer cuts a text into pieces and encodes each on its own, so the ids of a piece are worked out once, by
    its model, and remembered. ASCII texts are cut on their bytes; equal pieces of a slice are looked up together, and
    the model sees its new ones in one call. A blank behind a visible character always begins a piece. Chunks between
    two such blanks are looked up whole if they have other characters: common Latin ones are cut by the tokenizer's
    expression; others, where the rules for letters depend on versions of Unicode, and chunks that may hold a special
    token go through the whole tokenizer.
    """

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        config = json.loads(self.tokenizer.to_str())
        cut, model = config["pre_tokenizer"], config["model"]
        self.special = [t["content"] for t in config["added_tokens"]]
        usual = cut["type"] == "ByteLevel" and cut["use_regex"] and not cut["add_prefix_space"]
        self.cacheable = usual and config["normalizer"] is None and model["type"] == "BPE" and not any(" " in s for s in self.special)
        if not self.cacheable:
            return
        common = [0x09, 0x0A, 0x0D, *range(0x20, 0x7F), *range(0xA1, 0x250)]
        letters, digits = (
            "".join(re.escape(chr(c)) for c in common if unicodedata.category(chr(c)).startswith(kind)) for kind in "LN"
        )
        self.common = re.compile("[\\t\\n\\r\\x20-\\x7e\\xa1-\\u024f]*").fullmatch
        # the tokenizer's own cut, with its classes spelled out for the common characters
        self.cut = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{digits}]+| ?[^\s{letters}{digits}]+|\s+(?!\S)|\s+").findall
        shown = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.shown = {c: "".join(p for p, _ in shown.pre_tokenize_str(chr(c))) for c in common}
        # the model alone, for pieces between blanks, with one more token that tells where what was looked up ends
        self.mark = max(model["vocab"].values()) + 1
        plain = {"normalizer": None, "post_processor": None, "added_tokens": [], "pre_tokenizer": {"type": "WhitespaceSplit"}}
        self.bare = Tokenizer.from_str(json.dumps(config | plain | {"model": model | {"vocab": model["vocab"] | {MARK: self.mark}}}))
        self.known: dict[bytes, int] = {}
        self.ids = np.zeros(1 << 20, np.uint32)
        self.begins = np.zeros(1 << 18, np.int64)
        self.uses = np.zeros(1 << 18, np.uint32)

    def forget(self) -> None:
        """Forgets what was met in one slice only and, beyond half of what may be remembered, what was met least."""
        uses, half = self.uses[: len(self.known)], REMEMBERED_PIECES // 2
        keep = np.flatnonzero(uses > 1)
        if len(keep) > half:
            keep = np.sort(keep[np.argsort(uses[keep], kind="stable")[len(keep) - half :]])
        begin, length = self.begins[keep], self.begins[keep + 1] - self.begins[keep]
        upto = np.concatenate([[0], np.cumsum(length)])
        self.ids[: upto[-1]] = self.ids[np.arange(upto[-1]) + np.repeat(begin - upto[:-1], length)]
        self.begins[: len(upto)] = upto
        kept = uses[keep] // 2
        self.uses[:] = 0
        self.uses[: len(keep)] = kept
        met = list(self.known)  # in the order of their numbers
        self.known = {met[i]: n for n, i in enumerate(keep.tolist())}

    def is_common(self, text: str) -> bool:
        return self.common(text) is not None and not any(s in text for s in self.special)

    def by_model(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces and of common chunks, end to end, and how many each has."""
        if not texts:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        shown = "".join(f"{t if t.isascii() else GAP.join(self.cut(t))}{MARK}{GAP}" for t in texts).translate(self.shown)
        ids = np.array(self.bare.encode_batch_fast([shown], add_special_tokens=False)[0].ids, np.uint32)
        marks = ids == self.mark
        return ids[~marks], np.diff(np.flatnonzero(marks), prepend=-1) - 1

    def learn(self, fresh: list[bytes]) -> np.ndarray:
        """The numbers of new pieces and chunks. Those of long ones, which are not remembered, hold until others are learned."""
        texts = [f.decode() for f in fresh]
        plain = np.full(len(fresh), self.is_common("".join(texts)))
        if not plain.all():
            plain[:] = [self.is_common(t) for t in texts]
        short = np.fromiter(map(len, fresh), np.int64, len(fresh)) <= REMEMBERED_BYTES
        order = np.lexsort([~plain, ~short]).tolist()
        flat, length = self.by_model([texts[i] for i in order if plain[i]])
        if not plain.all():
            by_model, found = iter(np.split(flat, np.cumsum(length)[:-1])), []
            for i in order:
                ids = next(by_model) if plain[i] else self.tokenizer.encode(texts[i], add_special_tokens=False).ids
                found.append(np.asarray(ids, np.uint32))
            flat, length = np.concatenate(found), np.fromiter(map(len, found), np.int64, len(found))
        n, at = len(self.known), int(self.begins[len(self.known)])
        while at + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while n + len(fresh) >= len(self.begins):
            self.begins = np.concatenate([self.begins, np.zeros_like(self.begins)])
            self.uses = np.concatenate([self.uses, np.zeros_like(self.uses)])
        self.ids[at : at + len(flat)] = flat
        self.begins[n + 1 : n + 1 + len(fresh)] = at + np.cumsum(length)
        self.uses[n : n + len(fresh)] = 0
        self.known.update(zip((fresh[i] for i in order[: int(short.sum())]), itertools.count(n)))
        numbers = np.empty(len(fresh), np.int64)
        numbers[order] = np.arange(n, n + len(fresh))
        return numbers

    def looked_up(self, slice_of: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces and chunks of a slice, end to end, and how many each has."""
        if len(self.known) > REMEMBERED_PIECES:
            self.forget()
        met = slice_of.dictionary_encode()
        different = met.dictionary.to_numpy(zero_copy_only=False).tolist()
        number = np.fromiter(map(self.known.get, different, itertools.repeat(-1)), np.int64, len(different))
        fresh = np.flatnonzero(number < 0)
        if len(fresh):
            number[fresh] = self.learn([different[i] for i in fresh.tolist()])
        self.uses[number] += 1
        at = met.indices.to_numpy()
        begin, length = self.begins[number][at], (self.begins[number + 1] - self.begins[number])[at]
        upto = np.cumsum(length) - length
        return self.ids[np.arange(int(length.sum())) + np.repeat(begin - upto, length)], length

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, null as empty, each with an end, and how many each has."""
        if not self.cacheable:
            found = [[*self.tokenizer.encode(t or "", add_special_tokens=False).ids, END] for t in texts.to_pylist()]
            return np.array(list(itertools.chain.from_iterable(found)), np.uint32), np.fromiter(map(len, found), np.int64, len(found))
        data, offsets = text_bytes(texts)
        strange = STRANGE[data]
        for special in self.special:
            strange[[m.start() for m in re.finditer(re.escape(special.encode()), data)]] = True
        starts = piece_starts(data, offsets, strange) if len(data) else np.zeros(0, np.int64)
        edges, held, first = np.append(starts, len(data)), [(np.zeros(0, np.uint32), np.zeros(0, np.int64))], 0
        while first < len(starts):
            last = max(first + 1, int(np.searchsorted(edges, edges[first] + SLICE_CHARS, side="right")) - 1)
            begins = pa.py_buffer(edges[first : last + 1])
            held.append(self.looked_up(pa.Array.from_buffers(pa.large_binary(), last - first, [None, begins, pa.py_buffer(data)])))
            first = last
        ids, length = (np.concatenate(parts) for parts in zip(*held))
        upto = np.concatenate([[0], np.cumsum(length)])[np.searchsorted(starts, offsets)]
        return np.insert(ids, upto[1:], END), np.diff(upto) + 1

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of one text, null as empty, without an end."""
        return self.encode_all(pa.array([text], pa.large_string()))[0][:-1]


MANIFEST_TYPE = "part int, file string, n_docs long, n_ids long"


def write_ids(
    docs: DataFrame, folder: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
    planes: str = "byte", block_ids: int = BLOCK_IDS,
) -> None:
    """Writes the ids of all texts to ``folder`` in ascending order of document ids.

    A text's ids are followed by id 0; null and empty texts have that one. Null document ids come first;
    rows that repeat an id follow one another in the order of their texts' hashes, each a document of its own.
    An empty table gives a folder without ids; other columns are ignored.

    Rows are dealt to tasks by ranges of (id, hash of the text), so that copies under one id spread too; a
    task streams its rows into one file. Files of lost or repeated attempts stay unlisted: the table
    ``manifest`` below ``folder`` names those of committed tasks, with their order.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("hash"),
        F.monotonically_increasing_id().alias("at"),
    )
    order = ["doc_id", "hash", "at"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tokenizer = held_by_worker(PieceTokenizer, tokenizer_path)
        name, writer = f"ids-{uuid.uuid4().hex}.planes", None
        for batch in batches:
            for part in pieces(batch, "text", SLICE_CHARS):
                if writer is None:
                    store, root = open_store(folder)
                    store.create_dir(root, recursive=True)
                    writer = PlaneWriter(store.open_output_stream(f"{root}/{name}", compression=None), block_ids, planes)
                ids, counts = tokenizer.encode_all(part.column("text"))
                key = part.column("doc_id")
                writer.add(key.fill_null(0).to_numpy(), key.is_null().to_numpy(zero_copy_only=False), counts, ids)
        if writer is not None:
            n_docs, n_ids = writer.close()
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([TaskContext.get().partitionId()], pa.int32()), "file": [name], "n_docs": [n_docs], "n_ids": [n_ids],
            })

    ordered.mapInArrow(write, MANIFEST_TYPE).write.parquet(f"{folder}/manifest")


def read_ids(spark: SparkSession, folder: str, keep_ids: bool = False) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32, ids)`` of every document in the files below ``folder``.

    ``start`` counts the ids of all documents before it, ``n_tokens`` includes the closing id, ``ids_crc32`` is
    over little-endian 32-bit ids, ``ids`` holds these bytes if ``keep_ids``, else null. A file is one row of the
    manifest and one task; blocks are read one after the other.
    """
    manifest = spark.read.schema(MANIFEST_TYPE).parquet(f"{folder}/manifest")
    # one row per file, in the order of the files
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0))).select("file", "base")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(folder)
        for batch in batches:
            for name, base in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist()):
                reader = PlaneReader(store, f"{root}/{name}")
                keys, missing, counts = reader.documents()
                ends = np.cumsum(counts)
                begun, crc, held = 0, 0, []
                for number in range(len(reader.index)):
                    raw = memoryview(reader.block(number).tobytes())
                    low = number * reader.block_ids
                    done = int(np.searchsorted(ends, low + len(raw) // 4, side="right"))
                    crcs, values, at = [], [], 0
                    for end in (4 * (ends[begun:done] - low)).tolist():
                        crcs.append(zlib.crc32(raw[at:end], crc))
                        values.append(b"".join([*held, raw[at:end]]) if keep_ids else None)
                        at, crc, held = end, 0, []
                    crc = zlib.crc32(raw[at:], crc)
                    if keep_ids:
                        held.append(raw[at:])
                    if done > begun:
                        here = slice(begun, done)
                        yield pa.RecordBatch.from_arrays([
                            pa.array(keys[here], mask=missing[here].astype(bool)), pa.array(base + ends[here] - counts[here]),
                            pa.array(counts[here]), pa.array(crcs, pa.int64()), pa.array(values, pa.binary()),
                        ], ["doc_id", "start", "n_tokens", "ids_crc32", "ids"])
                    begun = done

    tasks = max(1, manifest.count())
    return files.repartition(tasks).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")


def ids_between(spark: SparkSession, folder: str, start: int, stop: int) -> np.ndarray:
    """A stretch of the whole corpus by position, for samplers; reads the blocks it lies in."""
    found, base = [np.zeros(0, np.uint32)], 0
    store, root = open_store(folder)
    # one row per file
    for row in spark.read.schema(MANIFEST_TYPE).parquet(f"{folder}/manifest").orderBy("part").toLocalIterator():
        if base < stop and base + row.n_ids > start:
            found.append(PlaneReader(store, f"{root}/{row.file}").ids(start - base, stop - base))
        base += row.n_ids
    return np.concatenate(found)
