"""Processed rows as CSV (UTF-8 with byte-order mark) and Parquet, one folder per input file."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BYTE_ORDER_MARK = "﻿"
OUTPUT = "output"
INPUT = "input"
WRITERS = 4  # files that a task writes at the same time before it sorts the rest of its rows by input
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


@dataclass(frozen=True)
class Saved:
    csv_path: str
    parquet_path: str
    parquet_saved: bool
    parquet_error: str | None


def output_name(file_name: Column) -> Column:
    """``<stem>_processed`` of an input file name."""
    return F.concat(F.regexp_replace(file_name, "(?<=.)\\.[^.]*$", ""), F.lit("_processed"))


def input_key(file_path: Column) -> Column:
    """Short digest of an input's whole path; a letter first, so that it is read back as text."""
    return F.concat(F.lit("p"), F.substring(F.sha2(file_path, 256), 1, 8))


@contextmanager
def _unsorted(spark: SparkSession) -> Iterator[None]:
    """Tasks whose rows are of few inputs write them without a sort, which would spill whole rows."""
    before = spark.conf.get(_WRITERS)
    spark.conf.set(_WRITERS, str(WRITERS))
    try:
        yield
    finally:
        spark.conf.set(_WRITERS, before)


def save_processed(rows: DataFrame, output_dir: str) -> Saved:
    """Write rows under ``output_dir``/{csv,parquet}/output=<stem>_processed/input=<digest of the path>/.

    Inputs of equal names in different folders stay apart.  Rows stay in the tasks that hold them (no shuffle per file); output of other inputs stays.  The CSV header
    starts with a byte-order mark; extra columns travel as JSON.  A Parquet failure
    is reported, not raised.
    """
    named = rows.withColumns({OUTPUT: output_name(F.col("file_name")), INPUT: input_key(F.col("file_path"))})
    first = named.columns[0]
    flat = named.withColumn("extras", F.to_json("extras")) if "extras" in named.columns else named
    csv_path, parquet_path = f"{output_dir}/csv", f"{output_dir}/parquet"
    with _unsorted(rows.sparkSession):
        (
            flat.withColumnRenamed(first, BYTE_ORDER_MARK + first)
            .write.mode("overwrite")
            .option("header", True)
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(OUTPUT, INPUT)
            .csv(csv_path)
        )
    error = None
    try:
        writer = named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        with _unsorted(rows.sparkSession):
            writer.partitionBy(OUTPUT, INPUT).parquet(parquet_path)
    except Exception as problem:
        error = str(problem)
    return Saved(csv_path, parquet_path, error is None, error)
