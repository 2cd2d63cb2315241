"""Many files in one job: grid -> headers -> mapping -> checks -> typed rows + metadata."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.config import ROW_NUMBER, Config
from salesloom.operators import grid as G
from salesloom.operators.conform import Rules, conform
from salesloom.operators.headers import MIN_SCORE, SCAN_ROWS, detect_headers, header_labels
from salesloom.operators.mapping import layouts, map_labels
from salesloom.operators.metadata import describe_files
from salesloom.scratch import materialise

ACCEPTED = "accepted"
SHOWN_REJECTIONS = 20
FILE_COLUMNS = ("load_id", "session_load_id", "file_name", "file_hash", "loaded_at")


class RejectedFiles(ValueError):
    """Some sheets failed a check and the caller asked for all or nothing."""


@dataclass(frozen=True)
class Ingested:
    """``rows``: typed rows of accepted sheets; ``sheets``: one report row per sheet."""

    rows: DataFrame
    sheets: DataFrame

    def rejected(self) -> DataFrame:
        return self.sheets.filter(F.col("status") != ACCEPTED)

    def require_all(self) -> Ingested:
        """Fail unless every sheet was accepted; the message names the first few."""
        refused = self.rejected()
        first = refused.orderBy(*G.KEYS).limit(SHOWN_REJECTIONS)
        shown = first.select(
            "file_path", "status", "score", "missing_required", "duplicate_targets", "bad_columns"
        ).collect()
        if shown:
            reasons = "; ".join(str(row.asDict()) for row in shown)
            raise RejectedFiles(f"{refused.count()} sheets rejected: {reasons}")
        return self


def _status() -> F.Column:
    """First check a sheet fails, in the order the checks run."""
    return (
        F.when(F.col("read_error").isNotNull(), "unreadable")
        .when(~F.col("has_rows"), "empty")
        .when(~F.coalesce("header_found", F.lit(False)), "no header")
        .when(F.size("duplicate_targets") > 0, "duplicate targets")
        .when(~F.coalesce("is_valid", F.lit(False)), "missing required columns")
        .otherwise(ACCEPTED)
    )


def survey_sheets(
    grid: DataFrame,
    profiled: DataFrame,
    described: DataFrame,
    config: Config,
    scan_rows: int = SCAN_ROWS,
    min_score: float = MIN_SCORE,
) -> DataFrame:
    """One row per sheet: load metadata, header, layout, checks, status.

    Files without any cell appear once, with a null sheet.  Everything here is per
    sheet; the data rows were reduced to ``profiled`` before.
    """
    content = grid.filter(F.col("row_idx") >= 0)
    detected = detect_headers(content, config.alias_targets, scan_rows, min_score)
    labels = header_labels(detected, G.column_fill(profiled))
    shapes = layouts(map_labels(labels, config), config).drop("header_row")
    seen = profiled.select(*G.KEYS).distinct().withColumn("has_rows", F.lit(True))
    errors = grid.filter(F.col("row_idx") < 0).select(
        "file_path", F.get("cells", F.lit(0))["v"].alias("read_error")
    )
    return (
        described.join(seen, "file_path", "left")
        .join(detected, G.KEYS, "left")
        .join(shapes, G.KEYS, "left")
        .join(errors, "file_path", "left")
        .withColumn("has_rows", F.coalesce("has_rows", F.lit(False)))
        .withColumn(
            "category_row_used",
            F.exists(
                F.coalesce("category_cells", F.array().cast("array<struct<v:string,kind:string>>")),
                lambda c: F.coalesce(F.trim(c["v"]), F.lit("")) != "",
            ),
        )
        .withColumn("status", _status())
        .drop("header_cells", "category_cells", "has_rows")
    )


def typed_rows(
    grid: DataFrame,
    profiled: DataFrame,
    sheets: DataFrame,
    config: Config,
    rules: Rules = Rules(),
    chunk_rows: int = G.CHUNK_ROWS,
) -> DataFrame:
    """Typed rows of the accepted sheets, with ``errors`` per row.

    What a row needs from its file travels with the chunk table, so the only
    shuffle of data rows is the one on (file, sheet, chunk).
    """
    wanted = sheets.filter(F.col("status") == ACCEPTED).select(
        *G.KEYS, *FILE_COLUMNS, "header_row", "filled_to_header", "positions", "extras"
    )
    # Position arrays compress so well that their file size says little about a
    # broadcast's size in memory, hence the merge hint.
    chunks = G.chunk_offsets(profiled).join(wanted.hint("merge"), G.KEYS)
    numbered = (
        G.number_rows(grid, chunks, chunk_rows)
        .withColumn("source_sheet", F.col("sheet"))
        .withColumn("header_row_detected", F.col("header_row"))
    )
    keep = (*G.KEYS, *FILE_COLUMNS, "source_sheet", "header_row_detected", ROW_NUMBER,
            "physical_row_number")
    return conform(numbered, config, rules, keep)


def ingest(
    grid: DataFrame,
    files: DataFrame,
    config: Config | None = None,
    rules: Rules = Rules(),
    session_id: str | None = None,
    loaded_at: dt.datetime | None = None,
    scan_rows: int = SCAN_ROWS,
    min_score: float = MIN_SCORE,
    chunk_rows: int = G.CHUNK_ROWS,
    keep_grid: bool = True,
) -> Ingested:
    """Run the whole chain for every sheet of ``grid``.

    ``files(file_path, file_hash)`` lists the inputs, also those without any cell.
    Results that several steps read (grid, profile, sheet survey, typed rows) are
    written to scratch once; ``keep_grid=False`` re-reads a grid that is cheap to read
    again.  A sheet with one unacceptable value is rejected as a whole.
    """
    config = config or Config()
    if chunk_rows <= scan_rows:
        raise ValueError("chunk_rows must exceed scan_rows")
    grid = materialise(grid, "grid") if keep_grid else grid
    content = grid.filter(F.col("row_idx") >= 0)
    described = describe_files(files, session_id, loaded_at)
    profiled = materialise(G.profile(content, chunk_rows), "profile")
    sheets = materialise(
        survey_sheets(grid, profiled, described, config, scan_rows, min_score), "sheets"
    )
    typed = materialise(typed_rows(content, profiled, sheets, config, rules, chunk_rows), "typed")
    broken = (
        typed.filter(F.size("errors") > 0)
        .select(*G.KEYS, F.explode("errors").alias("bad_column"))
        .groupBy(*G.KEYS)
        .agg(F.array_sort(F.collect_set("bad_column")).alias("bad_columns"))
    )
    broken = materialise(broken, "broken")
    rows = typed.join(broken, G.KEYS, "left_anti").select(
        *G.KEYS, *config.schema, "extras", "physical_row_number"
    )
    report = sheets.join(broken, G.KEYS, "left").withColumn(
        "status",
        F.when(F.col("bad_columns").isNotNull(), "unreadable values").otherwise(F.col("status")),
    )
    return Ingested(rows, report)
