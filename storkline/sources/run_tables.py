"""Run records and the model registry as small Parquet tables below one folder."""

from __future__ import annotations

import os
import time
import uuid
from dataclasses import dataclass, field
from urllib.parse import quote

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUNS = "run_id string, run_name string, start_ms bigint, params map<string,string>, metrics map<string,double>, tags map<string,string>"
REGISTRY = "name string, version int, run_id string, path string, metrics map<string,double>, tags map<string,string>"


@dataclass
class Run:
    run_id: str
    run_name: str
    start_ms: int
    params: dict[str, str] = field(default_factory=dict)
    metrics: dict[str, float] = field(default_factory=dict)
    tags: dict[str, str] = field(default_factory=dict)

    @classmethod
    def new(
        cls, name: str, metrics: dict, params: dict | None = None, tags: dict | None = None, start_ms: int | None = None
    ) -> Run:
        return cls(
            uuid.uuid4().hex, name, int(time.time() * 1000) if start_ms is None else start_ms,
            {k: str(v) for k, v in (params or {}).items()}, dict(metrics), dict(tags or {}),
        )

    def row(self) -> tuple:
        return (self.run_id, self.run_name, self.start_ms, self.params, self.metrics, self.tags)


def append_run(spark: SparkSession, folder: str, *runs: Run) -> None:
    table = spark.createDataFrame([r.row() for r in runs], RUNS)
    # a folder of its own: writers that share one clear away each other's unfinished files
    table.coalesce(1).write.parquet(f"{folder}/runs/{runs[0].run_id}")


def read_runs(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(RUNS).option("recursiveFileLookup", True).parquet(f"{folder}/runs")


def find_run(runs: DataFrame, name: str) -> DataFrame:
    """The newest run with a name, or no row."""
    return runs.filter(F.col("run_name") == name).orderBy(F.desc("start_ms"), "run_id").limit(1)


def read_registry(spark: SparkSession, folder: str) -> DataFrame:
    try:
        return spark.read.schema(REGISTRY).option("recursiveFileLookup", True).parquet(f"{folder}/registry")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], REGISTRY)
        raise


def claim(spark: SparkSession, path: str) -> bool:
    """Whether this call is the one that created the file; at most one of many callers is told so.

    Local files are created exclusively by the system. Elsewhere the store's own create without overwriting decides,
    which HDFS answers atomically.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(place.getParent())
    if store.getUri().getScheme() == "file":
        try:
            os.close(os.open(store.makeQualified(place).toUri().getPath(), os.O_CREAT | os.O_EXCL | os.O_WRONLY))
        except FileExistsError:
            return False
        return True
    try:
        store.create(place, False).close()
    except Py4JJavaError as error:
        if store.exists(place):
            return False
        raise error
    return True


def register_model(
    spark: SparkSession, folder: str, name: str, run_id: str, metrics: dict[str, float] | None = None,
    tags: dict[str, str] | None = None,
) -> tuple[int, str]:
    """Add the next version of a registered model for a recorded run; returns version and path.

    A version belongs to the writer that claims it, by a file below ``registry-claims``; others take the next one. A
    writer that is lost after its claim leaves a gap.
    """
    known = read_registry(spark, folder).filter(F.col("name") == name)
    version = (known.agg(F.max("version")).first()[0] or 0) + 1
    own = quote(name, safe="")
    while not claim(spark, f"{folder}/registry-claims/{own}/{version}"):
        version += 1
    path = f"{folder}/models/{run_id}"
    entry = (name, version, run_id, path, dict(metrics or {}), {"best_model": "true", **(tags or {})})
    spark.createDataFrame([entry], REGISTRY).coalesce(1).write.parquet(f"{folder}/registry/{own}-{version}")
    return version, path


def registered_path(spark: SparkSession, folder: str, name: str, version: int | None = None) -> str:
    """Model path of a version, the newest by default."""
    entries = read_registry(spark, folder).filter(F.col("name") == name)
    if version is not None:
        entries = entries.filter(F.col("version") == version)
    row = entries.orderBy(F.desc("version")).first()
    if row is None:
        raise ValueError(f"no registered model '{name}'" + (f" version {version}" if version else ""))
    return row.path
