"""Sharding by extendible hashing.

A shard is a bucket of all documents whose hash begins with some bits. Starting from one bucket, only a
bucket above the byte limit splits on further bits, so shards are as large as the limit lets them be and
a shard's documents can be found from its prefix alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storkline.functions.joins import join_lookup
from storkline.llm.ranks import ranked, slots_for
from storkline.session import stored

ID_DIGITS, TEXT_DIGITS = 8, 7  # hex digits of the hash taken from the id and from the text
BITS = 4 * (ID_DIGITS + TEXT_DIGITS)


def shard_hash(key: Column, text: Column) -> Column:
    """A 60-bit hash, of the id first and of the text where ids are equal; null counts as empty."""
    digits = [F.substring(F.md5(F.coalesce(c.cast("string"), F.lit(""))), 1, n) for c, n in ((key, ID_DIGITS), (text, TEXT_DIGITS))]
    return F.conv(F.concat(*digits), 16, 10).cast("long")


def bits_of(value: Column, depth: Column) -> Column:
    """The first ``depth`` bits of a hash as text."""
    return F.substr(F.lpad(F.bin(value), BITS, "0"), F.lit(1), depth)


def extendible_shards(docs: DataFrame, max_bytes: int, id_col: str = "doc_id", text_col: str = "text", step: int = 5) -> DataFrame:
    """``(doc_id, bytes, depth, shard)``: the shard of each document, named by its prefix of ``depth`` bits.

    ``bytes`` is the UTF-8 size of the text, 0 for null. No shard is above ``max_bytes`` but one that holds
    a single larger document. Rows alike in id and text cannot be told apart by a hash: if they exceed the
    limit together, their bucket is dealt out by position and the shard's name gets a number. An empty
    table gives an empty result; other columns are ignored.

    Buckets split ``step`` bits a round, and a round reads only rows of buckets that are still too large.
    Sums of bytes are reduced by prefix before they are shuffled.
    """
    text = F.col(text_col)
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
    rest = stored(docs.select(
        F.col(id_col).alias("doc_id"), size.alias("bytes"), shard_hash(F.col(id_col), text).alias("_h")
    ), "hashes")
    done, depth = [], 0
    while depth < BITS:
        low, depth = depth + (depth > 0), min(BITS, depth + step)
        cell = F.shiftright("_h", BITS - depth).alias("_cell")
        cells = rest.groupBy(cell).agg(
            F.sum("bytes").alias("_sum"), F.min("_h").alias("_min"), F.max("_h").alias("_max")
        )
        cells = stored(cells, "cells")
        levels = cells.select("*", F.explode(F.sequence(F.lit(low), F.lit(depth))).alias("_depth"))
        levels = levels.withColumn("_prefix", F.expr(f"shiftright(_cell, {depth} - _depth)"))
        buckets = levels.groupBy("_depth", "_prefix").agg(
            (F.sum("_sum") <= max_bytes).alias("_fits"), (F.min("_min") == F.max("_max")).alias("_one")
        )
        settled = levels.join(buckets.filter("_fits or _one"), ["_depth", "_prefix"])
        settled = settled.groupBy("_cell").agg(F.min(F.struct("_depth", (~F.col("_fits")).alias("over"))).alias("_at"))
        settled = settled.select("_cell", F.col("_at._depth").alias("depth"), F.col("_at.over").alias("_over"))
        settled = stored(settled, "directory")
        rows = join_lookup(rest.withColumn("_cell", cell), settled, ["_cell"]).drop("_cell")
        done.append(rows.filter("depth is not null"))
        rest = stored(rows.filter("depth is null").drop("depth", "_over"), "rest")
        if rest.isEmpty():
            break
    placed = done[0]
    for rows in done[1:]:
        placed = placed.unionByName(rows)
    named = placed.withColumn("shard", bits_of(F.col("_h"), F.col("depth")))
    whole = named.filter("not _over").select("doc_id", "bytes", "depth", "shard")

    # buckets of one hash value above the limit: one large document, or rows alike in id and text
    over = stored(named.filter("_over").withColumn("_row", F.xxhash64(F.monotonically_increasing_id())), "over")
    largest = over.groupBy("_h").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    if not largest:
        return whole
    numbered = ranked(over, ["_h"], "_row", [], slots_for(largest), "_place")
    fits = F.greatest(F.lit(1), F.floor(F.lit(max_bytes) / F.greatest(F.col("bytes"), F.lit(1))))
    part = F.concat("shard", F.lit("."), F.floor(F.col("_place") / fits).cast("string"))
    return whole.unionByName(numbered.select("doc_id", "bytes", "depth", part.alias("shard")))
