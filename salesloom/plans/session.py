"""One upload session: a folder of exports to processed output and loaded tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from salesloom.config import Config
from salesloom.operators.conform import Rules
from salesloom.plans.ingest import Ingested, ingest
from salesloom.plans.load import Tables, load_incremental, not_loaded, recover
from salesloom.scratch import materialise
from salesloom.sinks.processed import Saved, save_processed
from salesloom.sources.delimited import grid_of_records, read_records
from salesloom.sources.hashing import file_hashes, line_fingerprints
from salesloom.sources.workbook import binary_files, read_workbooks

PATTERNS = {"workbook": "*.xlsx", "delimited": "*.csv"}


@dataclass(frozen=True)
class Session:
    """What a session produced; ``saved`` and ``loaded`` are None when not asked for, all are when every
    file was known."""

    ingested: Ingested | None
    saved: Saved | None
    loaded: DataFrame | None


def _digests(spark: SparkSession, path: str | list[str], source: str, pattern: str, sep: str, hash_by: str) -> DataFrame:
    """(file_path, file_hash) of the files of a session."""
    if hash_by == "bytes":
        return file_hashes(binary_files(spark, path, pattern))
    if hash_by == "lines" and source == "delimited":
        return line_fingerprints(read_records(spark, path, pattern, sep))
    raise ValueError(f"Unknown digest: {hash_by}")


def _grid(spark: SparkSession, path: str | list[str], source: str, pattern: str, sheet: int | str | None, sep: str) -> DataFrame:
    if source == "workbook":
        return read_workbooks(spark, path, sheet, pattern)
    return grid_of_records(read_records(spark, path, pattern, sep), sep)


def run_session(
    spark: SparkSession,
    path: str | list[str],
    source: str = "workbook",
    pattern: str | None = None,
    sheet: int | str | None = 0,
    sep: str = ",",
    config: Config | None = None,
    rules: Rules = Rules(),
    session_id: str | None = None,
    output_dir: str | None = None,
    tables: Tables | None = None,
    strict_extras: bool = False,
    fail_on_rejected: bool = False,
    hash_by: str = "bytes",
    skip_known: bool = False,
) -> Session:
    """Read every export under ``path``, type it, optionally save and load it.

    ``source`` is "workbook" or "delimited".  Output is written before the load, so it
    exists even when the load fails.  ``fail_on_rejected`` stops before both when any
    sheet failed a check.  ``hash_by`` is the digest of every file of the session: "bytes"
    (SHA-256, read front to back) or, for delimited files, "lines" (computed in parallel).
    With ``skip_known`` files whose content ``tables`` has loaded under the same layout, as their audit tells,
    are left out before anything is parsed.
    """
    if source not in PATTERNS:
        raise ValueError(f"Unknown source: {source}")
    config, pattern = config or Config(), pattern or PATTERNS[source]
    files = materialise(_digests(spark, path, source, pattern, sep, hash_by), "files")
    if skip_known and tables is not None:
        recover(spark, tables)
        files = materialise(not_loaded(spark, files, config, tables), "files")
        path = [r.file_path for r in files.select("file_path").collect()]  # names of files only
        if not path:
            return Session(None, None, None)
    grid = _grid(spark, path, source, pattern, sheet, sep)
    done = ingest(grid, files, config, rules, session_id)
    if fail_on_rejected:
        done.require_all()
    saved = save_processed(done.rows, output_dir) if output_dir else None
    loaded = None
    if tables is not None:
        loaded = load_incremental(done.rows, config, tables, done.sheets, strict_extras)
    return Session(done, saved, loaded)
