"""Header detection and construction for many files in one job."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from salesloom.functions.text import is_numeric_like, label, normalize_text
from salesloom.operators.grid import KEYS, has_value

# How many rows are scanned for a header, and the score it must reach.
SCAN_ROWS = 15
MIN_SCORE = 3.0
# Weights of the score.
ALIAS_WEIGHT = 3.0
NUMERIC_PENALTY = 1.5
NEXT_ROW_BONUS = 0.5
WIDE_STEPS = (3, 5)

BLANK_HEADER = "unnamed_column"


def row_values(cells: Column) -> Column:
    """Normalised, non-empty texts of a row."""
    return F.filter(F.transform(cells, lambda c: normalize_text(c["v"])), lambda v: v != "")


def score_row(values: Column, next_values: Column, aliases: Iterable[str]) -> Column:
    """How much a row looks like a header, given the row right below it."""
    known = list(aliases)
    hits = F.size(F.filter(values, lambda v: v.isin(known)))
    numeric = F.size(F.filter(values, is_numeric_like))
    wide = sum(F.when(F.size(values) >= n, 1.0).otherwise(0.0) for n in WIDE_STEPS)
    below = F.when(F.exists(next_values, is_numeric_like), NEXT_ROW_BONUS).otherwise(0.0)
    return F.when(F.size(values) == 0, 0.0).otherwise(
        hits * F.lit(ALIAS_WEIGHT) + wide - numeric * F.lit(NUMERIC_PENALTY) + below
    )


def header_candidates(
    grid: DataFrame, aliases: Iterable[str], scan_rows: int = SCAN_ROWS
) -> DataFrame:
    """Score of each of the first ``scan_rows`` rows of every sheet.

    The row filter comes first and reaches the scan, so each window holds at most
    ``scan_rows + 1`` rows however long the file is.  ``filled_to_header`` counts
    non-empty rows up to and including the candidate.
    """
    known = list(aliases)
    in_order = W.partitionBy(*KEYS).orderBy("row_idx")
    here = F.col("row_idx")
    scanned = (
        grid.filter(here <= scan_rows)
        .withColumn("values", row_values(F.col("cells")))
        .withColumn("below", F.lead(F.struct("row_idx", "values")).over(in_order))
        .withColumn("above", F.lag(F.struct("row_idx", "cells")).over(in_order))
        .withColumn(
            "filled_to_header",
            F.sum(has_value(F.col("cells")).cast("long")).over(
                in_order.rowsBetween(W.unboundedPreceding, W.currentRow)
            ),
        )
        .filter(here < scan_rows)
    )
    empty = F.array().cast("array<string>")
    next_values = F.when(F.col("below.row_idx") == here + 1, F.col("below.values")).otherwise(empty)
    return scanned.select(
        *KEYS,
        "row_idx",
        "cells",
        F.when(F.col("above.row_idx") == here - 1, F.col("above.cells")).alias("category_cells"),
        "values",
        F.filter("values", lambda v: v.isin(known)).alias("alias_matches"),
        score_row(F.col("values"), next_values, known).alias("score"),
        "filled_to_header",
    )


def best_candidates(candidates: DataFrame) -> DataFrame:
    """Highest score per sheet; the earliest row wins a tie."""
    best = F.max_by(
        F.struct(
            F.col("row_idx").alias("header_row"),
            "score",
            "values",
            "alias_matches",
            F.col("cells").alias("header_cells"),
            "category_cells",
            "filled_to_header",
        ),
        F.struct("score", -F.col("row_idx")),
    )
    return candidates.groupBy(*KEYS).agg(best.alias("best")).select(*KEYS, "best.*")


def detect_headers(
    grid: DataFrame,
    aliases: Iterable[str],
    scan_rows: int = SCAN_ROWS,
    min_score: float = MIN_SCORE,
) -> DataFrame:
    """One row per sheet: its best header row, and whether that row is good enough."""
    best = best_candidates(header_candidates(grid, aliases, scan_rows))
    return best.withColumn("header_found", F.col("score") >= min_score)


def _width(fills: Column | None) -> Column:
    header = F.size("header_cells")
    if fills is None:
        return header
    filled = F.filter(fills, lambda f: f["last_row"] > F.col("header_row"))
    last = F.array_max(F.transform(filled, lambda f: f["pos"]))
    return F.greatest(header, F.coalesce(last + 1, F.lit(0)))


def header_labels(detected: DataFrame, fill: DataFrame | None = None) -> DataFrame:
    """One row per sheet and column position with its header text, level by level.

    ``raw_label`` is the field row, ``category_label`` the row above spread to the
    right over blanks, ``combined_label`` both, ``source_label`` the same made
    unique (``name__2`` ...).  With ``fill`` (:func:`grid.column_fill`) positions
    beyond the header row appear too, and ``filled`` tells whether any data row
    below the header holds a value there.  All windows are bounded by sheet width.
    """
    sheets = detected.filter("header_found")
    fills = None
    if fill is not None:
        per_sheet = fill.groupBy(*KEYS).agg(
            F.collect_list(F.struct("pos", "last_row")).alias("fills")
        )
        sheets = sheets.join(per_sheet, KEYS, "left")
        fills = F.coalesce(F.col("fills"), F.array().cast("array<struct<pos:int,last_row:bigint>>"))
        sheets = sheets.withColumn("fills", fills)
        fills = F.col("fills")

    label_at = lambda cells: label(F.get(F.col(cells), F.col("pos"))["v"])
    across = W.partitionBy(*KEYS).orderBy("pos")
    columns = (
        sheets.withColumn("width", _width(fills))
        .withColumn("pos", F.explode(F.sequence(F.lit(0), F.col("width") - 1)))
        .withColumn("raw_label", label_at("header_cells"))
        .withColumn(
            "category_label",
            F.coalesce(
                F.last(F.nullif(label_at("category_cells"), F.lit("")), ignorenulls=True).over(
                    across.rowsBetween(W.unboundedPreceding, W.currentRow)
                ),
                F.lit(""),
            ),
        )
        .withColumn(
            "combined_label",
            F.concat_ws(
                " ",
                F.nullif("category_label", F.lit("")),
                F.nullif("raw_label", F.lit("")),
            ),
        )
    )
    filled = (
        F.lit(True)
        if fills is None
        else F.exists(
            fills, lambda f: (f["pos"] == F.col("pos")) & (f["last_row"] > F.col("header_row"))
        )
    )
    return unique_labels(columns.withColumn("filled", filled)).select(
        *KEYS,
        "header_row",
        "pos",
        "raw_label",
        "category_label",
        "combined_label",
        "source_label",
        "filled",
    )


def unique_labels(columns: DataFrame) -> DataFrame:
    """Add ``source_label``: blanks named, the nth repeat in a sheet suffixed ``__n``."""
    base = F.when(F.col("combined_label") == "", BLANK_HEADER).otherwise(F.col("combined_label"))
    nth = F.row_number().over(W.partitionBy(*KEYS, "base_label").orderBy("pos"))
    return (
        columns.withColumn("base_label", base)
        .withColumn("nth", nth)
        .withColumn(
            "source_label",
            F.when(F.col("nth") == 1, F.col("base_label")).otherwise(
                F.concat("base_label", F.lit("__"), F.col("nth"))
            ),
        )
        .drop("nth")
    )
