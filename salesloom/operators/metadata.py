"""Per-file load metadata, joined to rows through the file."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compact_utc(now: dt.datetime | None = None) -> str:
    """UTC time stamp for ids, e.g. 20260416T031522Z."""
    return (now or dt.datetime.now(dt.timezone.utc)).strftime("%Y%m%dT%H%M%SZ")


def new_session_id(now: dt.datetime | None = None) -> str:
    """Id shared by all files of one session."""
    return f"session_{compact_utc(now)}_{uuid.uuid4().hex[:8]}"


def file_name(path: Column) -> Column:
    """Base name of a path or URI."""
    return F.regexp_replace(path, "^.*/", "")


def load_id(session_id: Column, path: Column, stamp: str) -> Column:
    """``load_<stamp>_<8 hex>``, one per file.

    The hex part is a digest of session and path, so a recomputed task yields the
    id it yielded before; a random one would not.
    """
    digest = F.sha2(F.concat_ws("\n", session_id, path), 256)
    return F.concat(F.lit(f"load_{stamp}_"), F.substring(digest, 1, 8))


def describe_files(
    files: DataFrame,
    session_id: str | None = None,
    loaded_at: dt.datetime | None = None,
) -> DataFrame:
    """Load metadata per file from ``files(file_path, file_hash)``.

    ``loaded_at`` is naive UTC and, like the session id, fixed once per call.
    """
    now = loaded_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    session = F.lit(session_id or new_session_id(now))
    return files.select(
        "file_path",
        load_id(session, F.col("file_path"), compact_utc(now)).alias("load_id"),
        session.alias("session_load_id"),
        file_name(F.col("file_path")).alias("file_name"),
        "file_hash",
        F.lit(now).cast("timestamp_ntz").alias("loaded_at"),
    )


def add_load_metadata(rows: DataFrame, described: DataFrame) -> DataFrame:
    """Stamp rows that carry ``file_path``, ``sheet`` and ``header_row``.

    For plain row tables; the ingestion job attaches the same columns through its
    chunk table instead, so a huge file never becomes one join key.
    """
    return (
        rows.join(described, "file_path")
        .withColumn("source_sheet", F.col("sheet"))
        .withColumn("header_row_detected", F.col("header_row").cast("long"))
    )
