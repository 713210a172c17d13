"""Raw CSV files: one typed scan per file, columns by name, united by name."""

from __future__ import annotations

import logging
import re
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storkline import schema as S

log = logging.getLogger(__name__)

BAD_LINE = "_bad_line"
# a quote inside a quoted field is doubled
CSV_OPTIONS = {"header": True, "escape": '"'}


def _missing_path(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def read_header(spark: SparkSession, path: str) -> list[str]:
    """Column names of a headered CSV file (reads its first line only)."""
    try:
        return spark.read.options(**CSV_OPTIONS).csv(path).columns
    except AnalysisException as error:
        if _missing_path(error):
            raise FileNotFoundError(f"no raw data file at {path}") from error
        raise


PLACE = ["_file", "_block", "_line"]


def placed(rows: DataFrame) -> DataFrame:
    """A file scan with the place of each row: part file, block in it, line."""
    place = [F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()]
    return rows.select("*", *[c.alias(name) for c, name in zip(place, PLACE)])


def first_rows(rows: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows of a ``placed`` scan; a task keeps no more than ``n``."""
    return rows.orderBy(*PLACE).limit(n).drop(*PLACE)


def scan_rows(
    spark: SparkSession, path: str, skip_bad_lines: bool = True, multi_line: bool = False, nrows: int | None = None
) -> DataFrame:
    """All fields as text in the file's own column order, or the first ``nrows`` of them.

    A row with too few fields is padded with nulls. A row with more fields than the header is
    dropped: Spark hands over its raw text, in which the commas outside quotes are counted.

    Part files of one raw file must share a header: reading one that differs raises an error, as its columns
    would be swapped otherwise. A line break within quotes ends a record unless ``multi_line`` is set, which
    reads each part file in one task.
    """
    header = read_header(spark, path)
    parts = spark.read.text(path).inputFiles()
    fields = [T.StructField(c, T.StringType()) for c in header]
    fields.append(T.StructField(BAD_LINE, T.StringType()))
    rows = (
        spark.read.schema(T.StructType(fields))
        .options(**CSV_OPTIONS)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", BAD_LINE)
        # a pruned parse would not see surplus fields
        .option("columnPruning", False)
        # compare each part's header with the first one's
        .option("enforceSchema", len(parts) < 2)
        .option("multiLine", multi_line)
        .csv(path)
    )
    if nrows is not None:
        rows = placed(rows)
    if skip_bad_lines:
        unquoted = F.regexp_replace(BAD_LINE, r'"([^"]|"")*"', "")
        commas = F.length(unquoted) - F.length(F.replace(unquoted, F.lit(","), F.lit("")))
        # a plain count must still ask the reader for a field, which it needs beside the raw text
        asks_a_field = F.coalesce(F.length(header[0]), F.lit(0)) >= 0
        rows = rows.filter((F.col(BAD_LINE).isNull() | (commas < len(header))) & asks_a_field)
    if nrows is not None:
        rows = first_rows(rows, nrows)
    return rows.drop(BAD_LINE)


def typed(text: Column, target: T.DataType) -> Column:
    """Missing-value texts become null; a number that does not parse becomes null, not an error."""
    if isinstance(target, T.StringType):
        return F.when(~F.trim(text).isin(S.NA_TEXTS), text)
    # no missing-value text is a number other than NaN, and a cast ignores blanks around one
    number = text.try_cast("double")
    number = F.nullif(number, F.lit(float("nan")))
    if isinstance(target, T.IntegerType):
        return number.try_cast("int")
    return number


def era_of(path: str) -> int | None:
    """Era label inferred from the file name."""
    name = re.split(r"[/\\]", path.rstrip("/\\"))[-1]
    return next((year for known, year in S.ERA_FILES.items() if known in name), None)


def tag_source_year(df: DataFrame, era_year: int | None) -> DataFrame:
    """The era label as first column."""
    return df.select(F.lit(era_year).cast("int").alias("source_year"), "*")


def source_year_from_file(file_name: Column) -> Column:
    """The era label as a column, for frames that carry the file name of each row."""
    label = F.lit(None).cast("int")
    for known, year in reversed(S.ERA_FILES.items()):
        label = F.when(file_name.contains(known), F.lit(year)).otherwise(label)
    return label


def scan_csv(
    spark: SparkSession, path: str, era_year: int | None = None, nrows: int | None = None, multi_line: bool = False
) -> DataFrame:
    """One raw file with the known columns typed, others dropped, absent ones left absent."""
    rows = scan_rows(spark, path, multi_line=multi_line, nrows=nrows)
    absent = [c for c in S.RAW_COLUMNS if c not in rows.columns]
    if absent:
        log.warning("columns absent from %s: %s", path, absent)
    known = [c for c in S.RAW_COLUMNS if c not in absent]
    rows = rows.select(*[typed(F.col(c), S.RAW_TYPES[c]).alias(c) for c in known])
    return tag_source_year(rows, era_of(path) if era_year is None else era_year)


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """Rows of all frames, columns matched by name, absent ones filled with null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def load_all(
    spark: SparkSession, data_dir: str, files: list[str] | None = None,
    nrows_per_file: int | None = None, multi_line: bool = False,
) -> DataFrame:
    """All raw files, or the first rows of each, as one frame with ``source_file``; an absent file is skipped."""
    wanted = files or list(S.ERA_FILES)
    frames = []
    for name in wanted:
        try:
            frame = scan_csv(spark, f"{data_dir.rstrip('/')}/{name}", S.ERA_FILES.get(name), nrows_per_file, multi_line)
        except FileNotFoundError as error:
            log.warning("skipped: %s", error)
            continue
        frames.append(frame.withColumn("source_file", F.lit(name)))
    if not frames:
        raise ValueError(f"none of {wanted} found in {data_dir}")
    return union_by_name(frames)


def peek_raw(spark: SparkSession, path: str, n: int = 5) -> tuple[DataFrame, DataFrame]:
    """The first rows read without and with a header, to see whether a file has one."""
    plain, headed = (spark.read.option("header", header).csv(path) for header in (False, True))
    return first_rows(placed(plain), n), first_rows(placed(headed), n)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN becomes null in every floating column (NaN > 0 is true and NaN spoils aggregates)."""
    floats = [c for c, t in df.dtypes if t in ("double", "float")]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df
