"""Bitmaps of hashes, so that rows without a partner need not travel to a join.

A bitmap may take a hash for another, never miss one: rows that pass it still have to be joined or grouped exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: bits of one row, fixed by Spark's bitmap functions
ROW_BITS = 1 << 15
#: bits for each hash, as long as the whole bitmap stays within MOST_ROWS rows (64 MB)
HASH_BITS = 16
MOST_ROWS = 1 << 14


def marks_of(hashes: DataFrame, hash_col: str, most_rows: int = MOST_ROWS) -> tuple[DataFrame, int]:
    """The bitmap of a stored table's 64-bit hashes as rows ``(_mark, _bits)``, and the number that rows are dealt by."""
    wanted = -(-hashes.count() * HASH_BITS // ROW_BITS)
    rows = min(1 << max(wanted - 1, 0).bit_length(), most_rows)
    mark, at = _place(F.col(hash_col), rows)
    return hashes.groupBy(mark.alias("_mark")).agg(F.bitmap_construct_agg(at).alias("_bits")), rows


def with_marked(df: DataFrame, hash_col: str, marks: tuple[DataFrame, int], name: str) -> DataFrame:
    """``df`` and a boolean: whether the bitmap, sent to every task, has the row's hash."""
    bits, rows = marks
    mark, at = _place(F.col(hash_col), rows)
    byte = F.conv(F.hex(F.substring("_bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.call_function("shiftright", byte, (at % 8).cast("int")).bitwiseAND(1)
    found = df.join(F.broadcast(bits), mark == F.col("_mark"), "left")
    return found.withColumn(name, F.coalesce(bit == 1, F.lit(False))).drop("_mark", "_bits")


def _place(h: Column, rows: int) -> tuple[Column, Column]:
    """A hash's row of the bitmap and its bit there, from different bits of the hash."""
    return h.bitwiseAND(F.lit(rows - 1).cast("long")), F.shiftrightunsigned(h, 40).bitwiseAND(F.lit(ROW_BITS - 1).cast("long"))
