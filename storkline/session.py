"""Session settings and the shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


# the JVM never compiles a method above 8000 bytes, so a wide projection fused into one would
# run interpreted; below the limit Spark splits it instead
COMPILED = {"spark.sql.codegen.hugeMethodLimit": 8000}


def build_session(app_name: str = "storkline", master: str | None = None, **conf) -> SparkSession:
    """Session with adaptive execution on; ``conf`` keys use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config(map=COMPILED)
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


@contextmanager
def set_for(spark: SparkSession, settings: dict) -> Iterator[None]:
    """Session settings that hold inside a ``with`` block."""
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, also set as the checkpoint folder.

    A local session without the setting (tests, bench) gets its own temporary folder. A cluster
    session must name one: a folder local to a machine would not survive the loss of an executor.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    folder = folder or context.getCheckpointDir()
    if folder is None:
        if not re.fullmatch(r"local(\[[^]]*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="storkline-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written as a table below the shared folder and read back.

    For rows that are read many times or whose random draws must repeat when a task does.
    """
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
