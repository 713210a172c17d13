"""Removal of repeated line chunks with content-defined boundaries.

A rolling hash over the hashes of the last lines decides where a chunk ends: at its local minima. A boundary
depends on the lines near it only, so an inserted line shifts no boundary further on, and no chunk is shorter than
the distance that a minimum must hold over. Chunks of several lines that occur again anywhere are removed once
their bytes have been compared, and so are the lines around them that equal those around the first occurrence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storkline.llm.marks import marks_of, with_marked
from storkline.session import stored

ROLL = 2  # lines the rolling hash looks at
BASE = 31
HASH_DIGITS = 7


def line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line), 1, HASH_DIGITS), 16, 10).cast("long")


def line_digest(line: Column) -> Column:
    """128 bits of SHA-256."""
    return F.substring(F.unhex(F.sha2(line, 256)), 1, 16)


def chunked(docs: DataFrame, min_lines: int) -> DataFrame:
    """Adds ``_lines`` and ``_ends``, the positions of the last lines of chunks, to rows with ``_text``.

    A line ends a chunk if its rolling hash is less than those of the ``min_lines - 1`` lines before and no more
    than those of as many lines after it, and both sides keep ``min_lines`` lines; the last line always does.
    """
    df = docs.withColumn("_lines", F.split(F.coalesce("_text", F.lit("")), "\n", -1))
    df = df.withColumn("_hashes", F.transform("_lines", line_hash))
    last = F.size("_lines") - 1
    every = F.sequence(F.lit(0), last)

    def rolling(i: Column) -> Column:
        total = F.lit(0).cast("long")
        for back in range(ROLL - 1, -1, -1):
            total = total * BASE + F.coalesce(F.get("_hashes", i - back), F.lit(0))
        return total

    def least(i: Column) -> Column:
        own, found = F.get("_rolls", i), (i >= min_lines - 1) & (last - i >= min_lines)
        for away in range(1, min_lines):
            found = found & (own < F.get("_rolls", i - away)) & (own <= F.get("_rolls", i + away))
        return found

    df = df.withColumn("_rolls", F.transform(every, rolling))
    return df.withColumn("_ends", F.filter(every, lambda i: (i == last) | least(i))).drop("_hashes", "_rolls")


def first_of(k: Column) -> Column:
    """The position of the first line of chunk ``k``."""
    return F.coalesce(F.get("_ends", k - 1), F.lit(-1)) + 1


def between(start: Column, end: Column) -> Column:
    """The lines of positions ``start`` to ``end - 1``."""
    return F.slice("_lines", start + 1, F.greatest(end - start, F.lit(0)))


def common_prefix(a: Column, b: Column) -> Column:
    """How many first entries two arrays share."""
    differs = F.array_position(F.zip_with(a, b, lambda x, y: ~x.eqNullSafe(y)), True).cast("int")
    return F.when(differs > 0, differs - 1).otherwise(F.size(a))


def remove_repeated_chunks(
    docs: DataFrame, min_lines: int = 2, id_col: str = "doc_id", text_col: str = "text", prefix: str = ""
) -> DataFrame:
    """The rows of ``docs`` with all columns and ``n_lines``, ``n_chunks``, ``n_removed``, ``kept_text``.

    Lines are the parts of a text between line feeds. A chunk of at least ``min_lines`` lines goes if an
    earlier chunk (smaller id, or same document and further up) has the same bytes; the first one stays.
    With it go lines right before and after it that equal those around the first one, over the next chunk and
    ``min_lines`` lines more; lines equal beyond that have the same boundaries, so they are in chunks that meet
    by themselves. So every line that goes equals one further up that
    stays, and copies of a text of ``min_lines`` lines or more lose all of them. ``n_removed`` counts lines,
    ``kept_text`` joins the others by line feeds. A null text counts as empty, with one empty line, and stays
    null. Null ids come last; rows that share id and text lose the same chunks. An empty table gives an empty
    result. The new columns begin with ``prefix``; an input column of the same name is replaced.

    Chunks meet by a 64-bit hash first, reduced within tasks; only those that a bitmap of the hashes that occur
    again lets pass are grouped by their bytes. Neighbouring lines travel as 128 bits of SHA-256. Of the texts, only
    those that lose lines (and the few that share their bits of a second bitmap) travel, once each, at every size.
    """
    apart = {id_col: "_id", text_col: "_text"}
    rest = F.struct(*[c for c in docs.columns if c not in apart]).alias("_row")
    rows = docs.select(rest, *[F.col(c).alias(name) for c, name in apart.items()])
    parts = chunked(rows, min_lines)
    key = F.xxhash64(F.coalesce("_text", F.lit(""))).alias("_key")

    def chunk_around(k: Column) -> Column:
        start, end, n = first_of(k), F.get("_ends", k) + 1, F.size("_lines")
        up = F.greatest(first_of(k - 1) - min_lines, F.lit(0))
        down = F.least(F.coalesce(F.get("_ends", k + 1) + 1 + min_lines, n), n)
        return F.struct(
            between(start, end).alias("lines"), F.reverse(between(up, start)).alias("before"), between(end, down).alias("after"),
        )

    around = F.transform(F.sequence(F.lit(0), F.size("_ends") - 1), chunk_around)
    numbered = parts.select("_id", key, F.posexplode(around).alias("_k", "_c")).filter(F.size("_c.lines") >= min_lines)
    chunks = numbered.withColumn("_bytes", F.array_join("_c.lines", "\n")).withColumn("_h", F.xxhash64("_bytes"))

    again = chunks.groupBy("_h").agg(F.count(F.lit(1)).alias("_times")).filter("_times > 1")
    again = stored(again.select("_h"), "repeated-hashes")
    likely = with_marked(chunks, "_h", marks_of(again, "_h"), "_again").filter("_again").select(
        "_id", "_key", "_k", "_bytes", F.transform("_c.before", line_digest).alias("_before"),
        F.transform("_c.after", line_digest).alias("_after"), "_h",
    )
    likely = stored(likely, "likely-chunks")
    place = F.struct(F.col("_id").isNull().alias("none"), "_id", "_k")
    first = likely.groupBy("_h", F.col("_bytes").alias("_same")).agg(
        F.min(F.struct(place.alias("at"), "_key", "_before", "_after")).alias("_first"), F.count(F.lit(1)).alias("_times")
    )
    first = stored(first.filter("_times > 1").select(F.col("_h").alias("_g"), "_same", "_first"), "first-chunks")
    later = likely.join(first, (F.col("_h") == F.col("_g")) & (F.col("_bytes") == F.col("_same"))).filter(place != F.col("_first.at"))
    later = later.select(
        "_id", "_key", "_k", common_prefix(F.col("_before"), F.col("_first._before")).alias("_up"),
        common_prefix(F.col("_after"), F.col("_first._after")).alias("_down"),
    ).distinct()
    gone = later.groupBy(F.col("_id").alias("_i"), F.col("_key").alias("_t")).agg(F.collect_list(F.struct("_k", "_up", "_down")).alias("_gone"))

    gone = stored(gone.withColumn("_d", F.xxhash64("_i", "_t")), "gone-chunks")

    whole = rows.withColumn("_key", key).withColumn("_d", F.xxhash64("_id", "_key"))
    whole = with_marked(whole, "_d", marks_of(gone, "_d"), "_loses").drop("_d")
    same = F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_key") == F.col("_t"))
    # sent by key at every size, so that the texts' share of the disk grows with the input and not in a jump
    losing = whole.filter("_loses").join(gone.drop("_d").hint("merge"), same, "left").select(*whole.columns, "_gone")
    others = whole.filter("NOT _loses").withColumn("_gone", F.lit(None).cast(gone.schema["_gone"].dataType))
    cut = chunked(losing.unionAll(others), min_lines)
    every = F.sequence(F.lit(0), F.size("_lines") - 1)
    runs = F.transform("_gone", lambda g: F.sequence(first_of(g["_k"]) - g["_up"], F.get("_ends", g["_k"]) + g["_down"]))
    kept = F.transform(F.array_except(every, F.flatten(runs)), lambda i: F.get("_lines", i))
    cut = cut.withColumn("_kept", F.when(F.col("_gone").isNull(), F.col("_lines")).otherwise(kept))
    new = {
        f"{prefix}n_lines": F.size("_lines"), f"{prefix}n_chunks": F.size("_ends"),
        f"{prefix}n_removed": F.size("_lines") - F.size("_kept"),
        f"{prefix}kept_text": F.when(F.col("_text").isNotNull(), F.array_join("_kept", "\n")),
    }
    old = {c: F.col(apart[c]) if c in apart else F.col("_row")[c] for c in docs.columns if c not in new}
    return cut.select(*[v.alias(n) for n, v in (old | new).items()])
