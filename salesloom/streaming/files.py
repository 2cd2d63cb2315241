"""Arriving files and arriving rows, merged exactly once.

A replayed micro-batch overwrites its own partition (``batch=<id>``) and compares
keys with all other batches only, so a crash between the write and the commit
leaves neither gaps nor doubles, null keys included.
"""

from __future__ import annotations

from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from salesloom.config import Config
from salesloom.operators.conform import Rules
from salesloom.operators.incremental import keep_first, key_range, new_rows, within
from salesloom.plans.ingest import ingest
from salesloom.scratch import materialise
from salesloom.sources.hashing import file_hashes
from salesloom.sources.workbook import grid_of_workbooks

BATCH = "batch"
FILE_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)


def read_target(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The merged table so far; empty before the first batch."""
    full = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
    try:
        return spark.read.schema(full).parquet(path)
    except AnalysisException as problem:
        if "PATH_NOT_FOUND" not in str(problem):
            raise
        return spark.createDataFrame([], full)


def merge_batch(batch: DataFrame, batch_id: int, path: str, key: str, order: list[str],
                null_scope: list[str] | None = None) -> None:
    """Insert the batch's unseen keys as partition ``batch=<id>`` of ``path``.

    Of the other partitions only keys within the batch's own range are read.
    """
    target = read_target(batch.sparkSession, path, batch.schema)
    span = key_range(batch, key)
    others = within(target.filter(F.col(BATCH) != batch_id), key, span.low, span.high)
    fresh = new_rows(keep_first(batch, key, order, null_scope), others, key)
    fresh.sortWithinPartitions(key).write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")


def merge_stream(
    arriving: DataFrame, path: str, key: str, order: list[str], checkpoint: str
) -> StreamingQuery:
    """Insert-only merge of a stream of rows; processes what is there, then stops."""
    return (
        arriving.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(partial(merge_batch, path=path, key=key, order=order))
        .start()
    )


def workbook_stream(
    spark: SparkSession, folder: str, pattern: str = "*.xlsx", files_per_batch: int = 1000
) -> DataFrame:
    """New workbooks in ``folder`` as they arrive."""
    return (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
    )


def _ingest_batch(batch: DataFrame, batch_id: int, path, reports, sheet, config, rules, session_id):
    files = materialise(file_hashes(batch), "files")
    done = ingest(grid_of_workbooks(batch, sheet), files, config, rules, session_id)
    order = ["file_path", "sheet", "source_row_number"]
    merge_batch(done.rows, batch_id, path, "sale_id", order, ["file_path"])
    done.sheets.write.mode("overwrite").parquet(f"{reports}/{BATCH}={batch_id}")


def ingest_stream(
    files: DataFrame,
    path: str,
    reports: str,
    checkpoint: str,
    sheet: int | str | None = 0,
    config: Config | None = None,
    rules: Rules = Rules(),
    session_id: str | None = None,
) -> StreamingQuery:
    """Ingest arriving workbooks into ``path`` and their sheet reports into ``reports``."""
    handle = partial(
        _ingest_batch, path=path, reports=reports, sheet=sheet, config=config, rules=rules,
        session_id=session_id,
    )
    return (
        files.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(handle)
        .start()
    )
