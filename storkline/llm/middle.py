"""Fill-in-the-middle: a text is cut at two token ends and its parts change places.

Tokens are runs of ASCII letters and single other characters. The ends of a text's tokens are kept as a
compressed set of code point offsets in the manner of Roaring bitmaps: offsets that share their upper bits
share a container, which is an array, a bitmap or a list of runs, whichever is smallest. Cumulative
cardinalities lead to the container of the k-th end, a select within the container to its offset.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storkline.llm.words import pieces, text_bytes

LOW_BITS = 16
ARRAY_LIMIT = 4096
BITMAP_BYTES = (1 << LOW_BITS) // 8
# bytes of one text that are looked at together; work arrays take some 20 bytes for each
SLICE_BYTES = 1 << 20
# The marks in front of prefix, suffix and middle, the shares of forms in percent.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
CHANGED_PCT, SUFFIX_FIRST_PCT = 90, 20


class ArrayContainer:
    """The values themselves, two bytes each."""

    def __init__(self, values: np.ndarray):
        self.values = values.astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.values[k])


class BitmapContainer:
    """A bit for every possible value, with the number of bits before each word of 64."""

    def __init__(self, values: np.ndarray):
        bits = np.zeros(1 << LOW_BITS, np.uint8)
        bits[values] = 1
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(counts) - counts

    def select(self, k: int) -> int:
        word = int(np.searchsorted(self.before, k, side="right")) - 1
        bits = np.unpackbits(self.words[word : word + 1].view(np.uint8), bitorder="little")
        return 64 * word + int(np.flatnonzero(bits)[k - int(self.before[word])])


class RunContainer:
    """First values of runs, with the number of values before each run."""

    def __init__(self, first: np.ndarray, before: np.ndarray):
        self.first, self.before = first.astype(np.uint16), before

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.before, k, side="right")) - 1
        return int(self.first[run]) + k - int(self.before[run])


def container(values: np.ndarray) -> ArrayContainer | BitmapContainer | RunContainer:
    """The smallest container of ascending values below 2^16."""
    opens = np.flatnonzero(np.diff(values, prepend=-2) != 1)
    if 4 * len(opens) < min(2 * len(values), BITMAP_BYTES):
        return RunContainer(values[opens], opens)
    return ArrayContainer(values) if len(values) <= ARRAY_LIMIT else BitmapContainer(values)


class OffsetSet:
    """Ascending offsets in containers; ``select(k)`` is the k-th of them, counted from 0."""

    def __init__(self, parts: Iterator[np.ndarray]):
        """``parts`` are ascending arrays that follow one another."""
        self.keys: list[int] = []
        self.containers: list[ArrayContainer | BitmapContainer | RunContainer] = []
        sizes: list[int] = []
        open_key, held = -1, []

        def close() -> None:
            if held:
                low = np.concatenate(held) if len(held) > 1 else held[0]
                self.keys.append(open_key)
                self.containers.append(container(low))
                sizes.append(len(low))

        for part in parts:
            keys = part >> LOW_BITS
            cuts = np.flatnonzero(np.diff(keys)) + 1
            for a, z in zip([0, *cuts.tolist()], [*cuts.tolist(), len(part)]):
                if a == z:
                    continue
                if int(keys[a]) != open_key:
                    close()
                    open_key, held = int(keys[a]), []
                held.append(part[a:z] & ((1 << LOW_BITS) - 1))
        close()
        # cumulative cardinalities
        self.upto = np.cumsum(np.array(sizes, np.int64))

    def __len__(self) -> int:
        return int(self.upto[-1]) if len(self.upto) else 0

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.upto, k, side="right"))
        before = int(self.upto[at - 1]) if at else 0
        return (self.keys[at] << LOW_BITS) + self.containers[at].select(k - before)


def token_starts(data: np.ndarray) -> Iterator[np.ndarray]:
    """Code point offsets of the tokens of one UTF-8 text, slice by slice, then its length in code points."""
    chars, letter_before = 0, False
    for at in range(0, len(data), SLICE_BYTES):
        part = data[at : at + SLICE_BYTES]
        first = (part & 0xC0) != 0x80
        letter = ((part | 0x20) - np.uint8(97)) < 26
        after_letter = np.empty_like(letter)
        after_letter[0], after_letter[1:] = letter_before, letter[:-1]
        opens = np.flatnonzero(first & ~(letter & after_letter))
        number = np.cumsum(first)
        yield chars + number[opens] - 1
        chars, letter_before = chars + int(number[-1]), bool(letter[-1])
    yield np.array([chars], np.int64)


def cuts_of(column: pa.Array, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of each text and the code point offsets of the two cuts that its two numbers choose."""
    data, offsets = text_bytes(column)
    n, low, high = (np.zeros(len(column), np.int64) for _ in range(3))
    for i in range(len(column)):
        ends = OffsetSet(token_starts(data[offsets[i] : offsets[i + 1]]))
        n[i] = len(ends) - 1
        one, two = int(first[i] % (n[i] + 1)), int(second[i] % (n[i] + 1))
        low[i], high[i] = ends.select(min(one, two)), ends.select(max(one, two))
    return n, low, high


def draws(id_col: str, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers from the SHA-256 of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(
    docs: DataFrame, seed: int = 1, changed_pct: int = CHANGED_PCT, suffix_first_pct: int = SUFFIX_FIRST_PCT,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``(doc_id, n, form, prefix_chars, middle_chars, output)``, one row per row of ``docs``.

    ``n`` counts tokens. The SHA-256 of seed and id gives four numbers: the first two, modulo ``n`` + 1, are
    the tokens before the cuts, the third leaves a text plain or not (``changed_pct``), the fourth puts
    its suffix first or not (``suffix_first_pct``). Forms: ``psm`` is prefix, suffix, middle, each behind its
    mark; ``spm`` is suffix, prefix, middle; ``plain`` is the text, also where it is empty or holds a mark.
    Counts of characters are code points, null for ``plain``. A null text is empty; a null id draws
    as an empty one; rows that repeat an id draw alike. An empty table gives an empty result; other columns
    are ignored. Only whole texts are cut, whatever their length; a row needs no other row.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    h = dict(zip(("h1", "h2", "h3", "h4"), draws("doc_id", seed)))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumns(h)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                found = cuts_of(part.column("text"), part.column("h1").to_numpy(), part.column("h2").to_numpy())
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("doc_id", "text", "h3", "h4")), *map(pa.array, found)],
                    ["doc_id", "text", "h3", "h4", "n", "low", "high"],
                )

    cut = rows.mapInArrow(scan, f"doc_id {kind}, text string, h3 long, h4 long, n long, low long, high long")
    text = F.col("text")
    marked = F.lit(False)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked |= F.contains(text, F.lit(mark))
    plain = (text == "") | marked | (F.col("h3") % 100 >= changed_pct)
    form = F.when(plain, "plain").when(F.col("h4") % 100 < suffix_first_pct, "spm").otherwise("psm")
    low, middle = F.col("low").cast("int"), (F.col("high") - F.col("low")).cast("int")
    prefix = F.concat(F.lit(PREFIX), F.substring(text, F.lit(1), low))
    suffix = F.concat(F.lit(SUFFIX), F.substring(text, F.col("high").cast("int") + 1, F.length(text)))
    centre = F.concat(F.lit(MIDDLE), F.substring(text, low + 1, middle))
    output = F.when(F.col("form") == "plain", text).when(F.col("form") == "psm", F.concat(prefix, suffix, centre))
    return cut.withColumn("form", form).select(
        "doc_id", "n", "form", F.when(F.col("form") != "plain", F.col("low")).alias("prefix_chars"),
        F.when(F.col("form") != "plain", F.col("high") - F.col("low")).alias("middle_chars"),
        output.otherwise(F.concat(suffix, prefix, centre)).alias("output"),
    )


def restored(output: Column, form: Column) -> Column:
    """The text that an output of ``fill_in_middle`` was made from; no part of it holds a mark."""
    part = F.split(output, "|".join((PREFIX, SUFFIX, MIDDLE)), -1)
    order = {"psm": (1, 3, 2), "spm": (2, 3, 1)}
    text = F.when(form == "plain", output)
    for name, places in order.items():
        text = text.when(form == name, F.concat(*[F.get(part, F.lit(i)) for i in places]))
    return text
