"""Exact deduplication by progressive refinement, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storkline.llm.words import BLANKS
from storkline.session import stored

PREFIX_CHARS = 64


def normalised(text: Column) -> Column:
    """Every run of blanks replaced by one space; null becomes the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest_all: bool = False) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)``, one row per input row.

    Texts are equal when their normalised forms are. Groups are refined step by step: rows whose length
    occurs once are unique; of the others, rows whose length and prefix hash occur once; the full text is
    hashed only for rows that are left. ``text_sha256`` is null for a row settled earlier, unless
    ``digest_all`` asks for it everywhere.

    Of a group the row with the smallest id stays; null ids come last, and of rows that repeat that id one
    stays. Null and empty texts are equal. An empty table gives an empty result; other columns are
    ignored. Groups are reduced before they are shuffled, and rows of a hot group meet its one summary row
    in a join whose large partitions adaptive execution splits.
    """
    text = normalised(F.col(text_col))
    length, prefix = F.length("_text"), F.xxhash64(F.substring("_text", 1, PREFIX_CHARS))
    texts = docs.select(F.col(id_col).alias("doc_id"), text.alias("_text"))
    texts = texts.select("doc_id", "_text", length.alias("_length"), prefix.alias("_prefix"))

    keys = stored(texts.groupBy("_length", "_prefix").agg(F.count(F.lit(1)).alias("_n")), "prefix-counts")
    lengths = keys.groupBy("_length").agg(F.sum("_n").alias("_rows")).filter("_rows > 1").select("_length")
    repeated = keys.join(lengths, "_length", "left_semi").filter("_n > 1")
    repeated = stored(repeated.select(F.col("_length").alias("_l"), F.col("_prefix").alias("_p")), "prefixes")

    marked = texts.join(repeated, (F.col("_length") == F.col("_l")) & (F.col("_prefix") == F.col("_p")), "left")
    digest = F.sha2("_text", 256)
    rows = stored(marked.select(
        "doc_id", F.when(F.col("_l").isNotNull(), digest).alias("_full"),
        (digest if digest_all else F.when(F.col("_l").isNotNull(), digest)).alias("text_sha256"),
        F.monotonically_increasing_id().alias("_row"),
    ), "digests")

    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("_row").alias("row")))
    groups = rows.filter(F.col("_full").isNotNull()).groupBy(F.col("_full").alias("_sha"))
    groups = stored(groups.agg(first.alias("_first"), F.count(F.lit(1)).alias("_size")).filter("_size > 1"), "copies")
    found = rows.join(groups, F.col("_full") == F.col("_sha"), "left")
    alone = F.col("_sha").isNull()
    return found.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("_first.id")).alias("keep_id"),
        F.coalesce(F.col("_size"), F.lit(1)).alias("group_size"),
        (alone | (F.col("_row") == F.col("_first.row"))).alias("kept"),
        "text_sha256",
    )
