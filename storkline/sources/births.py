"""The deterministic ``births`` view over the ``lineitem`` table (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The view's definition, valid unchanged in Spark SQL and in other SQL engines.
BIRTHS_COLUMNS: dict[str, str] = {
    "birth_id": "l_orderkey * 1000000000000 + l_partkey * 1000000 + l_suppkey * 10 + l_linenumber",
    "year_fix": "CAST(1986 + l_orderkey % 36 AS INT)",
    "month": "CAST(1 + l_partkey % 12 AS INT)",
    "day": "CAST(1 + l_suppkey % 28 AS INT)",
    "weight_pounds": "CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE (30 + 30 * l_quantity + 500 * l_discount) / 100 END",
    "plurality": "CAST(CASE WHEN l_partkey % 61 = 0 THEN 0 WHEN l_partkey % 53 = 0 THEN NULL WHEN l_suppkey % 20 = 3 THEN 2 WHEN l_suppkey % 50 = 7 THEN 3 ELSE 1 END AS DOUBLE)",
    "is_male": "CASE WHEN l_linestatus = 'O' THEN 'true' ELSE 'false' END",
    "mother_married": "CASE WHEN l_returnflag = 'A' THEN 'TRUE' WHEN l_returnflag = 'N' THEN ' false ' ELSE NULL END",
    "apgar_1min": "CAST(l_linenumber AS DOUBLE)",
    "apgar_5min": "CASE WHEN l_orderkey % 36 < 9 THEN NULL ELSE CAST(8 + l_linenumber % 3 AS DOUBLE) END",
    "state": "CASE l_suppkey % 5 WHEN 0 THEN 'CA' WHEN 1 THEN 'TX' WHEN 2 THEN 'NY' WHEN 3 THEN 'FL' ELSE 'WA' END",
    "mother_residence_state": "CASE l_suppkey % 4 WHEN 0 THEN 'CA' WHEN 1 THEN 'TX' WHEN 2 THEN 'NY' ELSE 'OH' END",
    "mother_birth_state": "CASE WHEN l_partkey % 9 = 0 THEN NULL WHEN l_partkey % 2 = 0 THEN 'CA' ELSE 'MX' END",
    "mother_age": "CAST(8 + (l_suppkey * 3 + l_linenumber) % 56 AS DOUBLE)",
    "gestation_weeks": "CAST(CASE WHEN l_partkey % 33 = 0 THEN 99 WHEN l_partkey % 50 = 1 THEN NULL ELSE CASE WHEN l_quantity < 12 THEN 18 ELSE 28 END + (l_partkey * 7 + l_linenumber) % 20 END AS DOUBLE)",
    "lmp": "CASE WHEN l_suppkey % 7 = 0 THEN '99' WHEN l_suppkey % 7 = 1 THEN '9999' WHEN l_suppkey % 7 = 2 THEN NULL WHEN l_suppkey % 7 = 3 THEN '01992000' ELSE concat('0315', CAST(1985 + l_orderkey % 36 AS VARCHAR(4))) END",
    "weight_gain_pounds": "CASE WHEN l_partkey % 12 = 5 THEN NULL ELSE l_quantity + 100 * l_tax END",
    "cigarette_use": "CASE WHEN 1986 + l_orderkey % 36 < 2020 THEN NULL WHEN l_suppkey % 10 = 0 THEN 'true' ELSE 'false' END",
    "cigarettes_per_day": "CAST(CASE WHEN 1986 + l_orderkey % 36 < 2020 THEN NULL WHEN l_suppkey % 10 = 0 THEN 1 + l_partkey % 20 ELSE 0 END AS DOUBLE)",
    "alcohol_use": "CASE WHEN 1986 + l_orderkey % 36 < 2006 THEN NULL WHEN l_suppkey % 15 = 0 THEN 'true' ELSE 'false' END",
    "drinks_per_week": "CAST(CASE WHEN 1986 + l_orderkey % 36 < 2006 THEN NULL WHEN l_suppkey % 15 = 0 THEN 1 + l_partkey % 7 ELSE 0 END AS DOUBLE)",
    "born_alive_alive": "CAST(CASE WHEN l_partkey % 41 = 0 THEN NULL ELSE l_linenumber % 4 END AS DOUBLE)",
    "born_alive_dead": "CAST(CASE WHEN l_linenumber = 7 THEN 1 ELSE 0 END AS DOUBLE)",
    "born_dead": "CAST(l_suppkey % 3 AS DOUBLE)",
    "ever_born": "CAST(1 + l_linenumber % 4 AS DOUBLE)",
    "father_age": "CAST(CASE WHEN l_partkey % 4 = 0 THEN 99 ELSE 18 + l_partkey % 40 END AS DOUBLE)",
    "record_weight": "CAST(1 + l_orderkey % 2 AS INT)",
    "source_year": "CAST(CASE WHEN l_orderkey % 36 < 8 THEN 1986 WHEN l_orderkey % 36 < 16 THEN 1994 WHEN l_orderkey % 36 < 24 THEN 2002 WHEN l_orderkey % 36 < 32 THEN 2010 ELSE 2018 END AS INT)",
    "source_file": "concat('newborn_', CASE WHEN l_orderkey % 36 < 8 THEN '1986' WHEN l_orderkey % 36 < 16 THEN '1994' WHEN l_orderkey % 36 < 24 THEN '2002' WHEN l_orderkey % 36 < 32 THEN '2010' ELSE '2018' END)",
}


# the same number as ``birth_id``, which leaves the range of a long beyond an l_orderkey of nine million
WIDE_KEY = "CAST(CAST(l_orderkey AS DECIMAL(20,0)) * 1000000000000 + CAST(l_partkey AS DECIMAL(20,0)) * 1000000 + CAST(l_suppkey AS DECIMAL(20,0)) * 10 + l_linenumber AS DECIMAL(38,0))"


def births_from(lineitem: DataFrame, wide_key: bool = False) -> DataFrame:
    """The view over any frame with the columns of ``lineitem``, batch or streaming.

    ``wide_key`` gives ``birth_id`` as a decimal, for jobs that keep whole records and do not return the key.
    """
    columns = BIRTHS_COLUMNS | ({"birth_id": WIDE_KEY} if wide_key else {})
    return lineitem.selectExpr(*[f"{sql} AS {name}" for name, sql in columns.items()])


def births(spark: SparkSession, sf_dir: str) -> DataFrame:
    return births_from(spark.read.parquet(f"{sf_dir}/lineitem.parquet"))
