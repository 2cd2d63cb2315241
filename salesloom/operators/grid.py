"""The grid model: every sheet of every file as rows of untyped cells.

``grid(file_path, sheet, row_idx, cells)`` where ``cells`` is an array of
``struct<v, kind>``; a null element is an empty cell.  Rows may be missing: a
missing ``row_idx`` means a blank row.  Nothing below assumes that a file is
small: per-file work is either bounded by the header scan or by the sheet width,
or it runs per chunk of ``CHUNK_ROWS`` rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

GRID_SCHEMA = (
    "file_path string, sheet string, row_idx bigint, cells array<struct<v:string,kind:string>>"
)
KEYS = ["file_path", "sheet"]
CHUNK_ROWS = 65536
WHOLE_ROW = -1


def cell(value: Column, kind: str = "str") -> Column:
    """Grid cell holding ``value``; null stays an empty cell."""
    return F.when(
        value.isNotNull(), F.struct(value.cast("string").alias("v"), F.lit(kind).alias("kind"))
    )


def has_value(cells: Column) -> Column:
    """False for rows whose cells are all empty."""
    return F.exists(cells, lambda c: c.isNotNull())


def drop_empty_rows(grid: DataFrame) -> DataFrame:
    return grid.filter(has_value(F.col("cells")))


def profile(grid: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """One pass over the cells: (file, sheet, chunk, pos) -> filled count, last filled row.

    ``pos`` -1 counts the rows of the chunk that hold any value.  The aggregation
    combines map-side, so what is shuffled is chunks x columns, not rows.
    """
    marker = F.array(F.struct(F.lit("").alias("v"), F.lit("").alias("kind")))
    return (
        drop_empty_rows(grid)
        .select(
            *KEYS,
            "row_idx",
            F.floor(F.col("row_idx") / chunk_rows).alias("chunk"),
            F.posexplode(F.concat(marker, "cells")).alias("place", "cell"),
        )
        .filter("cell IS NOT NULL")
        .groupBy(*KEYS, "chunk", (F.col("place") - 1).alias("pos"))
        .agg(F.count("*").alias("filled"), F.max("row_idx").alias("last_row"))
    )


def column_fill(profiled: DataFrame) -> DataFrame:
    """(file, sheet, pos): how often a column is filled and the last row that fills it."""
    return (
        profiled.filter(F.col("pos") != WHOLE_ROW)
        .groupBy(*KEYS, "pos")
        .agg(F.sum("filled").alias("filled"), F.max("last_row").alias("last_row"))
    )


def chunk_offsets(profiled: DataFrame) -> DataFrame:
    """(file, sheet, chunk): non-empty rows in the chunk and in all chunks before it."""
    earlier = W.partitionBy(*KEYS).orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    return profiled.filter(F.col("pos") == WHOLE_ROW).select(
        *KEYS,
        "chunk",
        F.col("filled").alias("rows"),
        F.coalesce(F.sum("filled").over(earlier), F.lit(0)).alias("rows_before"),
    )


def number_rows(
    grid: DataFrame, chunks: DataFrame, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """Rows below the header with ``source_row_number`` and ``physical_row_number``.

    ``chunks`` is :func:`chunk_offsets` joined with each file's ``header_row`` and
    ``filled_to_header`` (plus anything else a row needs from its file); files it
    lacks are dropped.  ``source_row_number`` runs consecutively from
    ``header_row + 2`` over non-empty rows.  Rows shuffle once, on
    (file, sheet, chunk), so one huge file spreads over many tasks; the join comes
    after the window and reuses its partitioning and order (hence the merge hint), so
    the rows that are sorted stay narrow.
    """
    in_chunk = W.partitionBy(*KEYS, "chunk").orderBy("row_idx")
    return (
        drop_empty_rows(grid)
        .withColumn("chunk", F.floor(F.col("row_idx") / chunk_rows))
        .withColumn("nth", F.row_number().over(in_chunk))
        .join(chunks.hint("merge"), [*KEYS, "chunk"])
        .filter(F.col("row_idx") > F.col("header_row"))
        .withColumn(
            "source_row_number",
            F.col("header_row") + 1 + F.col("rows_before") + F.col("nth") - F.col("filled_to_header"),
        )
        .withColumn("physical_row_number", F.col("row_idx") + 1)
        .drop("nth", "rows", "rows_before", "filled_to_header", "chunk")
    )
