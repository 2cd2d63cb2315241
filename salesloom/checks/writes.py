"""Queries over what the library writes: loads that die, indexes, marts kept up to date, saved output."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom import samples
from salesloom.checks.queries import CONFIG, LINE_ORDER, NOW, SESSION, STAGED, _staged, query
from salesloom.operators import incremental as I
from salesloom.operators import key_index
from salesloom.plans import history, load, mart_state, quality, star
from salesloom.samples import table
from salesloom.scratch import materialise, scratch_path
from salesloom.sinks.processed import save_processed
from salesloom.streaming import compaction

LOADS = [(1995, 1997), (1996, 1999), (1998, 2001)]  # years of shipping; they overlap


def _fresh(name: str) -> str:
    """A table name that no earlier run of the query has left."""
    return f"{name}_{uuid.uuid4().hex[:12]}"


def _drop(spark, *names: str) -> None:
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _shipped(lines: DataFrame, years: tuple[int, int]) -> DataFrame:
    return lines.filter(F.year("l_shipdate").between(*years))


def _load_rows(spark, folder, number: int) -> DataFrame:
    """A load as ingestion returns it: one file per return flag, keyed by order, keys missing on seventh lines."""
    lines = _shipped(table(spark, folder, "lineitem"), LOADS[number])
    name = F.concat(F.lit(f"{number}_"), "l_returnflag")
    values = {
        "sale_id": F.when(F.col("l_linenumber") != 7, F.col("l_orderkey").cast("string")),
        "sale_date": F.to_date("l_shipdate"),
        "total_amount_ars": F.col("l_extendedprice"),
        "load_id": F.concat(F.lit("load_"), name),
        "session_load_id": F.lit(f"{SESSION}_{number}"),
        "file_name": name,
        "file_hash": F.sha2(name, 256),
        "loaded_at": F.lit(NOW + dt.timedelta(days=number)).cast("timestamp_ntz"),
        "source_sheet": F.lit("0"),
        "source_row_number": F.xxhash64(*LINE_ORDER, "l_orderkey"),
    }
    typed = [values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in CONFIG.struct()]
    return lines.select(name.alias("file_path"), F.lit("0").alias("sheet"), *typed)


def _die_and_rerun(spark, rows: DataFrame, tables: load.Tables, number: int) -> None:
    """A load that dies after its beginning, half way through its append, or after that; then it is run again."""
    load.begin(rows, CONFIG, tables)
    if number == 1:
        half = I.new_rows(spark.table(tables.staging), spark.table(tables.target), tables.key)
        load.append_clustered(half.filter(F.col("file_name") != "1_N"), tables)
    elif number == 2:
        load.append(spark, tables)
    for _ in range(2):
        load.load_incremental(rows, CONFIG, tables)


def _loaded(spark, folder, run, **settings) -> load.Tables:
    name = _fresh("sales")
    tables = load.Tables(name, f"{name}_load", f"{name}_audit", **settings)
    for number in range(len(LOADS)):
        run(spark, materialise(_load_rows(spark, folder, number), "rows"), tables, number)
    return tables


def _gone(spark, tables: load.Tables) -> None:
    _drop(spark, tables.target, tables.staging, tables.audit, tables.pending, tables.index)


AUDITED = ["load_id", "rows_in_file", "duplicate_rows", "rows_after_dedup", "rows_already_existing", "rows_inserted",
           "rows_inserted_derived", "rows_present_for_hash", "status"]


@query
def two_phase_load(spark, folder):
    """The audit of three loads, each of which died at another step and was run again twice."""
    tables = _loaded(spark, folder, _die_and_rerun)
    result = materialise(spark.table(tables.audit).select(*AUDITED), "audit")
    _gone(spark, tables)
    return result


@query
def two_phase_target(spark, folder):
    """What those loads leave in the target: the rows of each load's files."""
    tables = _loaded(spark, folder, _die_and_rerun)
    counts = spark.table(tables.target).groupBy("load_id", "load_date").agg(
        F.count("*").alias("row_count"), F.count_distinct("sale_id").alias("key_count")
    )
    result = materialise(counts, "target")
    _gone(spark, tables)
    return result


@query
def indexed_load(spark, folder):
    """The same loads without an accident, into a target with a key index."""
    tables = _loaded(spark, folder, lambda s, rows, t, _: load.load_incremental(rows, CONFIG, t), indexed=True)
    result = materialise(spark.table(tables.audit).select(*AUDITED), "audit")
    _gone(spark, tables)
    return result


@query
def indexed_merge(spark, folder):
    """A merge that reads only those files of the target that may hold a staged key; the target has a file per order month."""
    path, name = scratch_path(spark, "target"), _fresh("keys")
    orders = table(spark, folder, "orders")
    early = orders.filter(F.col("o_orderdate") < dt.datetime(1999, 1, 1))
    target = early.select(
        F.col("o_orderkey").alias("sale_id"),
        F.col("o_orderstatus").alias("sale_status"),
        F.col("o_totalprice").alias("total"),
        F.sha2(F.col("o_orderpriority"), 256).alias("file_hash"),
        F.date_format("o_orderdate", "yyyy-MM").alias("month"),
    )
    target.repartition("month").write.partitionBy("month").parquet(path)
    whole = spark.read.parquet(path)
    read = spark.read.option("basePath", path).schema(whole.schema)
    key_index.refresh(spark, whole.inputFiles(), name, "sale_id", lambda files: read.parquet(*files))
    staged = materialise(_staged(spark, folder), "staged")
    files = key_index.files_to_read(spark, whole.inputFiles(), name, staged, "sale_id")
    near = read.parquet(*files) if files else whole.limit(0)
    merged = whole.select(*STAGED).unionByName(I.new_rows(staged, near, "sale_id"))
    _drop(spark, name)
    return merged


def _deduped_sales(spark, folder) -> DataFrame:
    return I.keep_first(samples.sales(spark, folder), "sale_id", ["sale_date", "shipped_at", "total_amount_ars"])


def _state(spark, folder, kpis) -> DataFrame:
    """``kpis`` of the partials of three loads by return of the order, one of them written twice, compacted between."""
    name = _fresh("mart_state")
    facts = materialise(star.fct_sales(_deduped_sales(spark, folder)).withColumn("_load", F.pmod(F.crc32("sale_id"), F.lit(3))), "facts")
    for number in (0, 1, 1, 2):
        mart_state.add_run(spark, name, facts.filter(F.col("_load") == number), f"run{number}")
        if number == 1:
            mart_state.compact(spark, name, least=2)
    result = materialise(kpis(spark.table(name)), "kpis")
    _drop(spark, name)
    return result


@query
def mart_state_monthly(spark, folder):
    return _state(spark, folder, mart_state.kpi_monthly)


@query
def mart_state_by_product(spark, folder):
    return _state(spark, folder, lambda state: mart_state.kpis(state, "product_key"))


@query
def dim_product_history(spark, folder):
    return history.product_history(samples.sales(spark, folder), ["sale_date", "sale_id"])


@query
def fct_history(spark, folder):
    """Every sale with what its product was called on the day; history is known from 1996 on.

    Sales and versions are written down, so that shuffles behind them are freed before the next ones."""
    read = ["sale_id", "sale_date", "quantity", *star.PRODUCT, *star.PRODUCT_DETAILS, *star.LOCATION, *star.STATUS]
    sold = materialise(samples.sales(spark, folder).select(*read), "sold")
    known = sold.filter(F.col("sale_date") >= dt.date(1996, 1, 1))
    versions = materialise(history.product_history(known, ["sale_date", "sale_id"]), "versions")
    facts = star.fct_sales(sold).select("sale_id", "sale_date", "product_key", "quantity")
    return history.as_of(facts, versions, "product_key", ["variant", "valid_from"])


@query
def fct_members(spark, folder):
    """Facts that meet their dimensions, those without a product meet the unknown one."""
    sold = samples.sales(spark, folder)
    named = F.col("status_description") != "O"
    sold = sold.withColumns({c: F.when(named, F.col(c)) for c in star.PRODUCT})
    facts = star.fct_sales(sold)
    products = star.with_unknown(star.dim_product(sold, ["sale_date", "sale_id"]), "product_key")
    places = star.with_unknown(star.dim_location(sold), "location_key")
    met = star.meet(star.meet(facts, products, "product_key", ["sale_id"]), places, "location_key", ["sale_id"])
    return met.groupBy("sku").agg(F.count("*").alias("fact_count"), F.sum("quantity").alias("units"))


@query
def dq_rules(spark, folder):
    """Rules as data, with ids of rows that break them."""
    rules = {
        "large": "l_quantity > 49",
        "free": "l_extendedprice <= 0",
        "late_return": "l_returnflag = 'R' AND l_shipdate >= '2000-01-01'",
    }
    lines = table(spark, folder, "lineitem").withColumn("id", F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey"))
    return quality.evaluate(lines, rules, "id")


@query
def saved_sessions(spark, folder):
    """Two sessions whose files have the same names in two folders, saved and read back."""
    path = scratch_path(spark, "saved")
    for number in (0, 1):
        rows = _load_rows(spark, folder, number).withColumns(
            {"file_path": F.concat(F.lit(f"inbox{number}/"), "file_name"), "file_name": F.concat(F.substring("file_name", 3, 1), F.lit(".csv"))}
        )
        saved = save_processed(rows, path)
    csv = spark.read.option("header", True).csv(saved.csv_path).groupBy("output", "input").agg(F.count("*").alias("csv_rows"))
    parquet = spark.read.parquet(saved.parquet_path).groupBy("output", "input").agg(
        F.count("*").alias("parquet_rows"), F.round(F.sum("total_amount_ars"), 2).alias("total")
    )
    return csv.join(parquet, ["output", "input"])


@query
def not_loaded(spark, folder):
    """Exports of which an audit, here of those with even numbers, has no content."""
    name = _fresh("ledger")
    tables = load.Tables(name, f"{name}_load", f"{name}_audit")
    files = samples.export_files(spark, folder)
    number = F.regexp_extract("file_path", r"_(\d+)\.", 1)
    known = files.filter(F.try_to_number(number, F.lit("9999999999")) % 2 == 0)
    done = known.withColumns({"load_id": F.col("file_path"), "status": F.lit(load.LOADED), "layout_version": F.lit(CONFIG.version)})
    load.audit_entries(spark, tables, done).write.insertInto(tables.audit)
    result = materialise(load.not_loaded(spark, files, CONFIG, tables).select("file_path"), "files")
    _gone(spark, tables)
    return result


WAVES = 4


@query
def stream_compacted(spark, folder):
    """Events in waves of two files, a micro-batch per file, compacted behind each wave: the first event per user stays.

    The last batch of a wave is compacted with the next one, so a reader always meets a base and batches behind it."""
    events = table(spark, folder, "events").select("user_id", "event_id", "event_type", "value")
    low, high = events.agg(F.min("event_id"), F.max("event_id")).first()
    wave = F.least(F.floor((F.col("event_id") - low) * WAVES / (high - low + 1)), F.lit(WAVES - 1)) if events.head(1) else F.lit(0)
    inbox, path, mark = (scratch_path(spark, n) for n in ("inbox", "merged", "progress"))
    for number in range(WAVES):
        # A user's events of one wave are in one file.
        events.where(wave == number).repartition(2, "user_id").write.mode("append").parquet(inbox)
        arriving = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(inbox)
        compaction.merge_stream(arriving, path, "user_id", ["event_id"], mark).awaitTermination()
        compaction.compact(spark, path, events.schema, "user_id", upto=2 * number, files=2)
        compaction.expire(spark, path)
    return compaction.read_compacted(spark, path, events.schema)
