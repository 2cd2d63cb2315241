"""Incremental, insert-only load into catalog tables, with an audit row per file.

A load has two phases. ``begin`` stages the rows, counts them against the target and writes the audit rows as
pending: from then on the load will happen. ``append`` adds the staged rows whose key the target lacks, and
``settle`` turns the pending rows into audit rows. Whatever step a load died in, ``recover`` finishes it with the
counts of its beginning, or leaves no trace of it if it died before they were written. A load id is loaded
once, so a load can be run again as a whole.

One load of a target runs at a time: a pending load is taken for a dead one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.config import Config, ConfigError
from salesloom.operators import incremental as I
from salesloom.operators import key_index
from salesloom.operators.conform import cast_declared
from salesloom.scratch import discard, materialise

PARTITION = "load_date"
RUN = "run"
FILE = ["load_id", "session_load_id", "file_name", "file_hash", "loaded_at"]
ROW = ["load_id", "source_sheet", "source_row_number"]
LOADED = "loaded"


@dataclass(frozen=True)
class Tables:
    """Names of the catalog tables a load touches."""

    target: str = "raw_sales"
    staging: str = "raw_sales_load"
    audit: str = "raw_loads"
    key: str = "sale_id"
    cluster: tuple[str, ...] = ("sale_id", "sale_date")
    indexed: bool = False  # keep a key index, and read only the target's files that may hold staged keys

    @property
    def index(self) -> str:
        return f"{self.target}_keys"

    @property
    def pending(self) -> str:
        return f"{self.audit}_pending"


def _check(rows: DataFrame, key: str) -> None:
    for column in (key, "file_hash"):
        if column not in rows.columns:
            raise ConfigError(f"Column '{column}' is required for a load")


def _refuse_nothing(rows: DataFrame) -> None:
    if rows.isEmpty():
        raise ValueError("Nothing to load: no rows")


def create_if_absent(spark: SparkSession, table: str, config: Config) -> None:
    """Target layout: Parquet, partitioned by day of ``loaded_at``."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in config.struct())
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}, {PARTITION} date) "
        f"USING parquet PARTITIONED BY ({PARTITION})"
    )


def _stored(df: DataFrame) -> DataFrame:
    return df.withColumn(PARTITION, F.to_date("loaded_at"))


def stage(rows: DataFrame, config: Config, tables: Tables) -> tuple[DataFrame, DataFrame]:
    """Replace the staging table with the first row per key of this load.

    Returns it, and (load_id, key, is_first): each file's first row per key, and whether that is the load's.
    """
    order = ["file_path", "sheet", "source_row_number", "load_id"]
    # Whole rows go through one window, whose map side leaves a row per key; only keys and places through the others.
    narrow = rows.select(*dict.fromkeys([tables.key, *order]))
    firsts = materialise(I.first_of_files(narrow, tables.key, "load_id", order).select("load_id", tables.key, "is_first"), "firsts")
    whole = rows.select(*dict.fromkeys([*order, *config.schema]))
    prepared = _stored(cast_declared(I.keep_first(whole, tables.key, order, ["load_id"]).select(*config.schema), config))
    prepared.write.mode("overwrite").format("parquet").saveAsTable(tables.staging)
    return rows.sparkSession.table(tables.staging), firsts


def known_keys(spark: SparkSession, staged: DataFrame, tables: Tables) -> DataFrame:
    """The target's rows that may hold a staged key."""
    target, span = spark.table(tables.target), I.key_range(staged, tables.key)
    if tables.indexed:
        files = key_index.files_to_read(spark, target.inputFiles(), tables.index, staged, tables.key)
        target = spark.read.schema(target.select(tables.key).schema).parquet(*files) if files else target.limit(0)
    return I.within(target, tables.key, span.low, span.high)


def append_clustered(fresh: DataFrame, tables: Tables) -> None:
    """Append sorted by key: range partitions keep files few and row groups prunable.

    The rows are written down first, as finding the ranges runs what they come from once more.
    """
    fresh = materialise(fresh, "fresh")
    (
        fresh.repartitionByRange(PARTITION, *tables.cluster)
        .sortWithinPartitions(PARTITION, *tables.cluster)
        .write.mode("append")
        .insertInto(tables.target)
    )
    discard(fresh)
    if tables.indexed:
        spark = fresh.sparkSession
        files = spark.table(tables.target).inputFiles()
        key_index.refresh(spark, files, tables.index, tables.key, lambda paths: spark.read.parquet(*paths))


# Columns of the load audit table.
AUDIT_SCHEMA = (
    "load_id string, session_load_id string, file_name string, file_hash string, "
    "loaded_at timestamp_ntz, source_sheet string, rows_in_file bigint, duplicate_rows bigint, "
    "rows_after_dedup bigint, rows_already_existing bigint, rows_inserted bigint, "
    "rows_inserted_derived bigint, rows_present_for_hash bigint, layout_version string, status string"
)


def _create_audit(spark: SparkSession, tables: Tables) -> None:
    spark.sql(f"CREATE TABLE IF NOT EXISTS {tables.audit} ({AUDIT_SCHEMA}) USING parquet")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.table(tables.audit).schema)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {tables.pending} ({columns}, {RUN} string) USING parquet PARTITIONED BY ({RUN})"
    )


def audit_entries(
    spark: SparkSession,
    tables: Tables,
    report: DataFrame | None,
    sheets: DataFrame | None = None,
    kept_out: DataFrame | None = None,
) -> DataFrame:
    """One audit row per loaded file, one per file ``kept_out``, and one per rejected sheet with its reason."""
    _create_audit(spark, tables)
    entries = spark.table(tables.audit).limit(0)
    columns = entries.columns
    for more in (report, kept_out):
        if more is not None:
            known = more.select(*[c for c in columns if c in more.columns])
            entries = entries.unionByName(known, allowMissingColumns=True)
    if sheets is not None:
        refused = sheets.filter(F.col("status") != "accepted").select(
            "load_id",
            "session_load_id",
            "file_name",
            "file_hash",
            "loaded_at",
            F.col("sheet").alias("source_sheet"),
            F.concat(F.lit("rejected: "), "status").alias("status"),
        )
        entries = entries.unionByName(refused, allowMissingColumns=True)
    return entries.select(*columns)


def _sheets():
    return F.array_join(F.array_sort(F.collect_set("source_sheet")), ",").alias("source_sheet")


def _run_of(rows: DataFrame) -> str:
    """The same for the same files: a load that begins again replaces what it had begun."""
    ids = rows.select("load_id").distinct()
    seen = ids.agg(F.bit_xor(F.xxhash64("load_id")), F.bit_xor(F.xxhash64(F.reverse("load_id"))), F.count("*")).first()
    return "_".join(f"{x & (2**64 - 1):x}" for x in seen)


def begin(
    rows: DataFrame,
    config: Config | None = None,
    tables: Tables = Tables(),
    sheets: DataFrame | None = None,
    kept_out: DataFrame | None = None,
) -> str:
    """Stage ``rows``, count them against the target, and write the load down as pending; returns its run.

    Only the staged key range of the target's key column is read, once for counts and insert.
    """
    config = config or Config()
    spark = rows.sparkSession
    create_if_absent(spark, tables.target, config)
    staged, firsts = stage(rows, config, tables)
    pairs = materialise(I.existing_pairs(staged, known_keys(spark, staged, tables), tables.key), "pairs")
    counts = I.file_counts(rows, firsts, pairs, tables.key, "load_id")
    report = counts.join(rows.groupBy(*FILE).agg(_sheets()), "load_id")
    report = report.withColumns({"layout_version": F.lit(config.version), "status": F.lit(LOADED)})
    run = _run_of(rows)
    entries = audit_entries(spark, tables, report, sheets, kept_out)
    names = ", ".join(f"`{c}`" for c in entries.columns)
    spark.sql(
        f"INSERT OVERWRITE TABLE {tables.pending} PARTITION ({RUN}='{run}') SELECT {names} FROM {{entries}}",
        entries=entries,
    )
    for table in (firsts, pairs):
        discard(table)
    return run


def append(spark: SparkSession, tables: Tables = Tables(), again: bool = False) -> None:
    """Add the staged rows that the target lacks; ``again`` where part of them may be there already.

    A row without a key is told by its place in its file, in the load's own days only.
    """
    staged, target = spark.table(tables.staging), spark.table(tables.target)
    known = known_keys(spark, staged, tables)
    if not again:
        fresh = I.new_rows(staged, known, tables.key)
    else:
        days = [r[0] for r in staged.select(PARTITION).distinct().collect()]  # one for each day of loading
        there = target.filter(F.col(PARTITION).isin(days) & F.col(tables.key).isNull()).select(*ROW).distinct()
        nameless = staged.filter(F.col(tables.key).isNull()).alias("s").join(
            there.alias("t"), F.expr(" AND ".join(f"s.{c} <=> t.{c}" for c in ROW)), "left_anti"
        )
        fresh = I.new_rows(staged.filter(F.col(tables.key).isNotNull()), known, tables.key).unionByName(nameless)
    append_clustered(fresh, tables)


def _present(spark: SparkSession, entries: DataFrame, tables: Tables) -> DataFrame:
    """(file_hash, present): rows of the target for the hashes of loaded files."""
    hashes = entries.filter(F.col("status") == LOADED).select("file_hash").distinct()
    target = spark.table(tables.target).select("file_hash").join(hashes, "file_hash", "left_semi")
    return target.groupBy("file_hash").agg(F.count("*").alias("present"))


def settle(spark: SparkSession, run: str, tables: Tables = Tables()) -> None:
    """Move the pending rows of ``run`` to the audit, with the rows now there for each file's hash."""
    entries = spark.table(tables.pending).filter(F.col(RUN) == run).drop(RUN)
    counted = entries.join(_present(spark, entries, tables), "file_hash", "left")
    if "rows_present_for_hash" in entries.columns:
        present = F.when(F.col("status") == LOADED, F.coalesce("present", F.lit(0)))
        counted = counted.withColumn("rows_present_for_hash", present)
    audit = spark.table(tables.audit)
    same = " AND ".join(f"s.{c} <=> t.{c}" for c in ("load_id", "source_sheet", "status"))
    fresh = counted.select(*audit.columns).alias("s").join(audit.alias("t"), F.expr(same), "left_anti")
    materialise(fresh, "entries").write.insertInto(tables.audit)
    spark.sql(f"ALTER TABLE {tables.pending} DROP IF EXISTS PARTITION ({RUN}='{run}')")


def recover(spark: SparkSession, tables: Tables = Tables()) -> list[str]:
    """Finish loads that were pending when their job died; returns their runs."""
    if not spark.catalog.tableExists(tables.pending):
        return []
    runs = [r[0] for r in spark.table(tables.pending).select(RUN).distinct().collect()]  # one at most
    for run in runs:
        append(spark, tables, again=True)
        settle(spark, run, tables)
    return runs


def not_loaded(spark: SparkSession, files: DataFrame, config: Config, tables: Tables) -> DataFrame:
    """``files(file_path, file_hash)`` whose content was not loaded under this layout yet."""
    if not spark.catalog.tableExists(tables.audit):
        return files
    done = spark.table(tables.audit).filter((F.col("status") == LOADED) & (F.col("layout_version") == config.version))
    return files.join(done.select("file_hash"), "file_hash", "left_anti").select(*files.columns)


def load_incremental(
    rows: DataFrame,
    config: Config | None = None,
    tables: Tables = Tables(),
    sheets: DataFrame | None = None,
    strict_extras: bool = False,
) -> DataFrame:
    """Dedup, stage, insert unseen keys, audit; returns one report row per file.

    A dead load of the target is finished first. Load ids that are audited as loaded are left out, so running
    the same load again changes nothing.

    With ``strict_extras`` a file with unknown columns is kept out as a whole and audited
    as rejected; when no file is left, that is audited before the load is refused.
    """
    config = config or Config()
    spark = rows.sparkSession
    _check(rows, tables.key)
    _refuse_nothing(rows)
    recover(spark, tables)
    _create_audit(spark, tables)
    arrived, kept_out = rows.select("load_id").distinct(), None
    done = spark.table(tables.audit).filter(F.col("status") == LOADED).select("load_id")
    rows = rows.join(done, "load_id", "left_anti").select(*rows.columns)
    audit = spark.table(tables.audit).join(arrived, "load_id", "left_semi")
    if rows.isEmpty():
        return audit
    if strict_extras:
        unknown = rows.filter(F.size("extras") > 0).groupBy(*FILE).agg(_sheets())
        kept_out = materialise(unknown.withColumn("status", F.lit("rejected: unknown columns")), "kept_out")
        rows = rows.join(kept_out.select("load_id"), "load_id", "left_anti").select(*rows.columns)
        if rows.isEmpty():
            audit_entries(spark, tables, None, sheets, kept_out).write.insertInto(tables.audit)
    _refuse_nothing(rows)
    run = begin(rows, config, tables, sheets, kept_out)
    append(spark, tables)
    settle(spark, run, tables)
    return spark.table(tables.audit).join(arrived, "load_id", "left_semi")
