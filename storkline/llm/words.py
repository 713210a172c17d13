"""Words of whole texts as numpy arrays, batch by batch inside a task.

A word is a maximal run of bytes other than space, tab, line feed, vertical tab, form feed and
carriage return. None of these bytes occurs inside a longer UTF-8 sequence, so words can be found on
the bytes of a text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"
BLANK_BYTES = [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]
# bytes of a word that is hashed on its own
LONG_WORD = 1024
# odd multipliers of the hashes below, arbitrary
BYTE_BASE, MIX_A, MIX_B = 0x9E3779B97F4A7C15, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53


def pieces(batch: pa.RecordBatch, column: str, max_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The batch cut into slices of about ``max_bytes`` of text, so that work arrays stay small.

    A text is never cut; one that is longer makes a slice of its own.
    """
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    total = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        before = total[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(total, before + max_bytes, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and where each begins (one more entry than texts); null is empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, begins, values = column.buffers()
    offsets = np.frombuffer(begins, np.int64)[column.offset : column.offset + len(column) + 1]
    if values is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(values, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and end of each word, and the first word of each text (one more entry than texts)."""
    table = np.zeros(256, bool)
    table[BLANK_BYTES] = True
    blank = table[data]
    filled = offsets[:-1] < offsets[1:]
    first, last = offsets[:-1][filled], offsets[1:][filled] - 1
    begins, ends = ~blank, ~blank
    begins[1:] &= blank[:-1]
    begins[first] = ~blank[first]
    ends[:-1] &= blank[1:]
    ends[last] = ~blank[last]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads every bit of a 64-bit hash over all bits (a finaliser with two multiplications)."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(MIX_A)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(MIX_B)
    return h ^ (h >> np.uint64(33))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word's bytes: eight bytes at a time, every bit mixed before the next eight.

    Sums of byte values times powers would collide for some words whatever the base; a chain of mixers has no such
    structure. Words of up to eight bytes of one length never collide. Very long words are hashed by XXH64.
    """
    lengths = ends - starts
    out = mixed(lengths.astype(np.uint64) * np.uint64(BYTE_BASE))
    tail = np.concatenate([data, np.zeros(8, np.uint8)])
    # the eight bytes from every place on
    eights = np.ndarray(len(data) + 1, "<u8", tail, strides=(1,))
    live, at = np.flatnonzero(lengths <= LONG_WORD), 0
    while len(live):
        left = lengths[live] - at
        part = eights[starts[live] + at]
        part &= np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - 8 * np.minimum(left, 8).astype(np.uint64))
        out[live] = mixed(out[live] ^ part)
        live, at = live[left > 8], at + 8
    for i in np.flatnonzero(lengths > LONG_WORD):
        out[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i]].tobytes(), int(out[i]))
    return out


def run_hashes(items: np.ndarray, k: int, base: int) -> np.ndarray:
    """Rolling hash of every run of ``k`` consecutive items, one entry per start.

    The polynomial of a run of 2n items comes from two runs of n, so a run of k takes about
    2 log2(k) passes over the array.
    """
    n = len(items) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, covered = np.zeros(n, np.uint64), 0
    block, size, power = items, 1, np.full(1, base, np.uint64)
    while covered < k:
        if k & size:
            out = out * power[0] + block[covered : covered + n]
            covered += size
        if 2 * size <= k:
            block = block[:-size] * power[0] + block[size:]
        size, power = 2 * size, power * power
    return mixed(out)
