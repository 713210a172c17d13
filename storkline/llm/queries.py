"""Registered queries of the subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storkline.llm import (
    exact_dedup, hard_negatives, line_dedup, middle, mixing, packing, quality_classifier, quality_rules, sharding, simhash,
    substring_dedup, token_files, warc,
)
from storkline.session import work_path

SHARD_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.remove_repeated_chunks(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_chunks", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.score_documents(table(spark, sf_dir, "documents"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "warc")
    # a gzip member per record, as archives usually have
    warc.write_archive(table(spark, sf_dir, "pages"), path, compress=True)
    page, digest = warc.record_number("record_id").alias("page_id"), F.regexp_replace("payload_digest", "^sha1:", "")
    responses = warc.read_archive(spark, path).filter(F.col("record_type") == "response")
    revisits = warc.read_archive(spark, path, payload=False).filter(F.col("record_type") == "revisit")
    return responses.select(
        page, F.octet_length("payload").cast("long").alias("payload_bytes"), F.col("payload_sha1").alias("payload_digest"),
        "record_type", F.lit(None).cast("long").alias("refers_to"),
    ).unionAll(revisits.select(
        page, F.col("payload_length").alias("payload_bytes"), digest.alias("payload_digest"), "record_type",
        warc.record_number("refers_to").alias("refers_to"),
    ))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"), digest_all=True)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path()).drop("row", "ids")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.extendible_shards(table(spark, sf_dir, "documents"), SHARD_BYTES)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_classifier.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted")


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_path(spark, "token-files")
    token_files.write_ids(table(spark, sf_dir, "documents"), folder, tokenizer_path("byte_bpe_50k.json"))
    return token_files.read_ids(spark, folder).drop("ids")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label")
    label = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.mine_hard_negatives(table(spark, sf_dir, "embeddings"), label_col=label)


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = middle.fill_in_middle(table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_line_dedup, op2_quality_rules, op3_warc, op4_substring_dedup, op5_exact_dedup, op6_packing, op7_sharding,
        op8_mixing, op9_simhash, op10_quality_classifier, op11_token_files, op12_hard_negatives, op13_fill_in_middle,
    )
}
