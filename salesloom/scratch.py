"""Shared scratch space for results that several jobs read."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Queries that begin in here delete their shuffle files when they end, not when the driver collects garbage."""
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREE_SHUFFLES)
        else:
            spark.conf.set(_FREE_SHUFFLES, before)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the session's checkpoint folder, or under its warehouse
    where no checkpoint folder is set: executors reach both."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{root.rstrip('/')}/salesloom/{uuid.uuid4().hex}/{name}"


def materialise(df: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` once and read it back: cuts lineage, survives executor loss,
    and gives later joins the real size of the data."""
    return _written(df, scratch_path(df.sparkSession, name), options or {})


def _written(df: DataFrame, path: str, options: dict[str, str]) -> DataFrame:
    with _shuffles_freed(df.sparkSession):  # nobody reads them once the result is written
        df.write.options(**{"compression": "zstd"} | options).mode("append").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def extended(table: DataFrame, df: DataFrame, options: dict[str, str] | None = None) -> DataFrame:
    """A materialised ``table`` with the rows of ``df``, which has its schema, written behind its own."""
    return _written(df, table.inputFiles()[0].rsplit("/", 1)[0], options or {})


def discard(df: DataFrame) -> None:
    """Delete the scratch files behind a materialised ``df`` that no later job reads."""
    spark = df.sparkSession
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        if "/salesloom/" in folder:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
