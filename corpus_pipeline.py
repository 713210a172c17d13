"""A corpus from raw documents to packed sequences: classify, drop lines, drop near copies, mix, pack."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storkline.llm import line_dedup, mixing, near_copies as similar, packing, quality_classifier
from storkline.llm.queries import table, tokenizer_path
from storkline.session import work_path

# work columns begin with this, so that columns of the documents can have any name
OWN = "_corpus_"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents the classifier accepts."""
    scored = quality_classifier.score_quality(docs, table(spark, sf_dir, "labels"), prefix=OWN)
    return scored.filter(F.col(f"{OWN}predicted") == 1).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes repeated line chunks out of the texts; ``n_chars`` follows the text."""
    found = line_dedup.remove_repeated_chunks(docs, prefix=OWN)
    new = {"text": F.col(f"{OWN}kept_text")}
    if "n_chars" in docs.columns:
        length = F.length(f"{OWN}kept_text").cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(F.col(f"{OWN}n_removed") > 0, length).otherwise(F.col("n_chars"))
    return found.withColumns(new).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group: the one that names it, and one of rows that repeat its id."""
    marked = similar.mark_near_copies(docs, prefix=OWN)
    return marked.filter(f"{OWN}first").select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps each document as often as the mix takes it: not at all, once or twice."""
    chosen = mixing.mix_sources(docs, keep_columns=True, prefix=OWN)
    copies = F.sequence(F.lit(1), F.col(f"{OWN}copies"))
    return chosen.filter(F.col(f"{OWN}copies") > 0).withColumn(f"{OWN}copy", F.explode(copies)).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places all token pieces in sequences."""
    return packing.pack_documents(docs, tokenizer_path()).drop("ids")


STAGES = [("quality", quality), ("lines", lines), ("near_copies", near_copies), ("mix", mix), ("pack", pack)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_path(spark, f"corpus-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
