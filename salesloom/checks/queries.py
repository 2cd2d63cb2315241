"""One function per operator: (spark, folder) -> DataFrame over the given tables."""

from __future__ import annotations

import datetime as dt
import hashlib
import io
import zipfile

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesloom import samples
from salesloom.config import Config
from salesloom.functions import dates, numbers, text
from salesloom.operators import conform as C
from salesloom.operators import grid as G
from salesloom.operators import headers as H
from salesloom.operators import incremental as I
from salesloom.operators import mapping as M
from salesloom.operators import metadata as MD
from salesloom.plans import marts, quality, star
from salesloom.plans.ingest import ingest, survey_sheets
from salesloom.samples import table
from salesloom.scratch import materialise, scratch_path
from salesloom.sources.delimited import read_delimited
from salesloom.sources.hashing import digest, file_hashes, line_fingerprints
from salesloom.sources.workbook import binary_files, grid_of_workbooks
from salesloom.streaming.files import merge_stream

CONFIG = Config()
RULES = C.Rules(run_year=2026)
NOW = dt.datetime(2026, 4, 16, 3, 15, 22)
SESSION = "session_20260416T031500Z_0badcafe"
QUERIES: dict = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def joined(column: str | Column) -> Column:
    """Array as text, so that results compare as plain values."""
    return F.array_join(column, "|")


# --- text ---------------------------------------------------------------------


@query
def normalize_text(spark, folder):
    docs = table(spark, folder, "documents")
    return docs.select("doc_id", text.normalize_text(F.col("text")).alias("normalized"))


@query
def strip_accents(spark, folder):
    docs = table(spark, folder, "documents")
    return docs.select("doc_id", text.strip_accents(F.col("text")).alias("plain"))


@query
def normalize_scalar_text(spark, folder):
    turns = table(spark, folder, "conversations")
    return turns.select(
        "conv_id", "turn", text.normalize_scalar_text(F.col("text")).alias("normalized")
    )


@query
def standardize_string(spark, folder):
    docs = table(spark, folder, "documents")
    padded = F.concat(F.lit(" \t "), "text", F.lit(" \n "))
    return docs.select("doc_id", text.standardize_string(padded).alias("standardized"))


@query
def effectively_empty(spark, folder):
    events = table(spark, folder, "events")
    value = (
        F.when(F.col("event_type") == "click", F.lit(" -- \n"))
        .when(F.col("event_type") == "error", F.lit(None).cast("string"))
        .otherwise(F.col("props"))
    )
    return events.select("event_id", text.is_effectively_empty(value).alias("is_empty"))


@query
def row_values(spark, folder):
    customers = table(spark, folder, "customer")
    cells = F.array(
        G.cell(F.col("c_name")),
        G.cell(F.lit("  ")),
        G.cell(F.lit(None).cast("string")),
        G.cell(F.concat("c_mktsegment", F.lit("ÓN\n(ARS)"))),
        G.cell(F.col("c_nationkey"), "num"),
    )
    return customers.select("c_custkey", joined(H.row_values(cells)).alias("row_values"))


@query
def numeric_like(spark, folder):
    lines = table(spark, folder, "lineitem")
    shown = F.array(
        F.format_number("l_extendedprice", 2),
        F.date_format("l_shipdate", "dd/MM/yyyy"),
        F.col("l_orderkey").cast("string"),
        F.concat(F.col("l_linenumber"), F.lit("%")),
    )
    counted = F.size(
        F.filter(shown, lambda v: text.is_numeric_like(text.normalize_text(v)))
    )
    return lines.groupBy("l_returnflag", "l_linenumber").agg(F.sum(counted).alias("numeric_cells"))


# --- numbers and dates ----------------------------------------------------------


@query
def parse_number_latam(spark, folder):
    lines = table(spark, folder, "lineitem")
    shown = samples.money_text(F.col("l_extendedprice"))
    return lines.select(
        "l_orderkey", "l_partkey", "l_suppkey", numbers.parse_float(shown).alias("price")
    )


@query
def parse_number_forms(spark, folder):
    lines = table(spark, folder, "lineitem")
    units = F.col("l_quantity").cast("long").cast("string")
    shown = (
        F.when(F.col("l_linenumber") == 1, F.concat(F.lit("ARS "), units))
        .when(F.col("l_linenumber") == 2, F.concat(units, F.lit(",5")))
        .when(F.col("l_linenumber") == 3, F.concat(F.lit("1,"), units, F.lit(",000")))
        .when(F.col("l_linenumber") == 4, F.concat(units, F.lit("e1")))
        .when(F.col("l_linenumber") == 5, F.concat(units, F.lit("d")))
        .when(F.col("l_linenumber") == 6, F.concat(F.lit("$-"), units, F.lit(" 00")))
        .otherwise(F.concat(F.lit("Ars "), units))
    )
    return lines.select(
        "l_orderkey", "l_partkey", "l_suppkey", numbers.parse_float(shown).alias("number")
    )


@query
def parse_int(spark, folder):
    lines = table(spark, folder, "lineitem")
    units = F.col("l_quantity").cast("long").cast("string")
    shown = (
        F.when(F.col("l_linenumber") == 1, units)
        .when(F.col("l_linenumber") == 2, F.concat(units, F.lit(",0")))
        .when(F.col("l_linenumber") == 3, F.concat(units, F.lit(",5")))
        .when(F.col("l_linenumber") == 4, F.lit("x"))
        .otherwise(F.concat(F.lit("$ "), units))
    )
    return lines.select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        numbers.parse_int(shown).alias("units"),
        numbers.int_error(shown).alias("is_error"),
    )


def _sold() -> Column:
    return F.col("o_orderdate") + F.make_dt_interval(
        hours=F.pmod("o_orderkey", F.lit(24)), mins=F.pmod("o_orderkey", F.lit(60))
    )


@query
def parse_date_es_long(spark, folder):
    orders = table(spark, folder, "orders")
    shown = samples.long_date_text(_sold())
    return orders.select("o_orderkey", dates.parse_datetime(shown, run_year=2026).alias("sold_at"))


@query
def parse_date_es_short(spark, folder):
    orders = table(spark, folder, "orders")
    shown = F.upper(samples.short_date_text(_sold()))
    year = F.year("o_orderdate")
    return orders.select(
        "o_orderkey",
        dates.parse_datetime(shown, reference_year=year, run_year=2026).alias("sold_at"),
    )


@query
def parse_date_fallback(spark, folder):
    orders = table(spark, folder, "orders")
    day = _sold()
    form = F.pmod("o_custkey", F.lit(6))
    shown = (
        F.when(form == 0, F.date_format(day, "yyyy-MM-dd HH:mm:ss"))
        .when(form == 1, F.date_format(day, "MM/dd/yyyy"))
        .when(form == 2, F.date_format(day, "dd/MM/yyyy"))
        .when(form == 3, F.date_format(day, "yyyyMMdd"))
        .when(form == 4, F.date_format(day, "d MMMM yyyy"))
        .otherwise(F.lit("sin fecha"))
    )
    return orders.select("o_orderkey", dates.parse_datetime(shown, run_year=2026).alias("sold_at"))


@query
def parse_date_only(spark, folder):
    orders = table(spark, folder, "orders")
    shown = samples.long_date_text(_sold())
    return orders.select("o_orderkey", dates.parse_date(shown, run_year=2026).alias("sold_on"))


@query
def date_errors(spark, folder):
    orders = table(spark, folder, "orders")
    day = (F.pmod("o_custkey", F.lit(31)) + 1).cast("string")
    shown = F.concat(day, F.lit(" de febrero de "), F.year("o_orderdate"))
    return orders.select(
        "o_orderkey",
        dates.date_error(shown, run_year=2026).alias("is_error"),
        dates.parse_date(shown, run_year=2026).alias("day"),
    )


@query
def month_lookup(spark, folder):
    orders = table(spark, folder, "orders")
    name = F.split(samples.long_date_text(F.col("o_orderdate")), " ")[2]
    return orders.groupBy(dates.month_number(name).alias("month")).agg(
        F.count("*").alias("order_count")
    )


# --- headers --------------------------------------------------------------------


@query
def header_score(spark, folder):
    grid = samples.export_grid(spark, folder)
    return H.header_candidates(grid, CONFIG.alias_targets).select(
        "file_path",
        "row_idx",
        "score",
        joined("values").alias("row_values"),
        F.size("alias_matches").alias("alias_matches"),
    )


@query
def alias_set(spark, folder):
    grid = samples.export_grid(spark, folder)
    found = H.header_candidates(grid, CONFIG.alias_targets)
    return (
        found.select(F.explode("alias_matches").alias("alias_norm"))
        .groupBy("alias_norm")
        .agg(F.count("*").alias("cell_count"))
    )


@query
def detect_header(spark, folder):
    grid = samples.export_grid(spark, folder)
    return H.detect_headers(grid, CONFIG.alias_targets).select(
        "file_path", "header_row", "score", "header_found"
    )


def _labels(spark, folder, with_fill: bool = False) -> DataFrame:
    grid = samples.export_grid(spark, folder)
    if with_fill:
        grid = materialise(grid, "grid")
    fill = G.column_fill(G.profile(grid)) if with_fill else None
    return H.header_labels(H.detect_headers(grid, CONFIG.alias_targets), fill)


@query
def category_ffill(spark, folder):
    return _labels(spark, folder).select(
        "file_path", "pos", "raw_label", "category_label", "combined_label"
    )


@query
def unique_headers(spark, folder):
    """Part types stand for header cells, parts of one size for a file."""
    parts = table(spark, folder, "part")
    named = F.when(F.col("p_type") == "PROMO", F.lit("")).otherwise(F.col("p_type"))
    columns = parts.select(
        F.concat(F.lit("talle_"), F.col("p_size"), F.lit("_"), F.floor(F.col("p_partkey") / 100)).alias(
            "file_path"
        ),
        F.lit("0").alias("sheet"),
        F.col("p_partkey").alias("pos"),
        named.alias("combined_label"),
    )
    return H.unique_labels(columns).select("file_path", "pos", "source_label")


@query
def drop_empty_rows(spark, folder):
    """Orders of status P become blank rows."""
    grid = samples.export_rows(spark, folder).select(
        "file_path",
        "id",
        F.array(
            G.cell(F.when(F.trim("status") != "P", F.col("status"))),
            G.cell(F.when(F.trim("status") != "P", F.col("total"))),
        ).alias("cells"),
    )
    return G.drop_empty_rows(grid).select("file_path", "id")


@query
def drop_empty_columns(spark, folder):
    return (
        _labels(spark, folder, with_fill=True)
        .filter("filled")
        .select("file_path", "pos", "source_label")
    )


@query
def source_row_number(spark, folder):
    grid = materialise(samples.export_grid(spark, folder), "grid")
    found = H.detect_headers(grid, CONFIG.alias_targets).filter("header_found")
    chunks = G.chunk_offsets(G.profile(grid)).join(
        found.select(*G.KEYS, "header_row", "filled_to_header"), G.KEYS
    )
    return G.number_rows(grid, chunks).select(
        "file_path", "row_idx", "source_row_number", "physical_row_number"
    )


# --- mapping and validation -------------------------------------------------------


def _mapped(spark, folder) -> DataFrame:
    return M.map_labels(_labels(spark, folder, with_fill=True), CONFIG)


@query
def map_columns(spark, folder):
    return _mapped(spark, folder).select("file_path", "pos", "source_label", "target", "mapped")


@query
def unmapped_report(spark, folder):
    return M.unmapped_columns(_mapped(spark, folder)).select("file_path", "pos", "source_label")


@query
def duplicate_targets(spark, folder):
    return M.duplicate_targets(_mapped(spark, folder)).select(
        "file_path", "target", joined("sources").alias("sources")
    )


@query
def alias_conflicts(spark, folder):
    """Part names as aliases, brands as targets."""
    parts = table(spark, folder, "part")
    return M.alias_conflicts(
        parts.select(F.col("p_name").alias("alias"), F.col("p_brand").alias("alias_target"))
    )


def _validated(spark, folder) -> DataFrame:
    return M.layouts(_mapped(spark, folder), CONFIG)


@query
def validate_missing(spark, folder):
    return _validated(spark, folder).select(
        "file_path",
        joined("missing_required").alias("missing_required"),
        F.size("missing_schema").alias("missing_schema"),
        "is_valid",
    )


@query
def validate_extra(spark, folder):
    return _validated(spark, folder).select(
        "file_path", joined("extra_columns").alias("extra_columns"), "mapped_count"
    )


@query
def survey_files(spark, folder):
    """Status of every export file; reads profile and headers, no data rows."""
    grid = materialise(samples.export_grid(spark, folder), "grid")
    described = MD.describe_files(samples.export_files(spark, folder), SESSION, NOW)
    sheets = survey_sheets(grid, G.profile(grid), described, CONFIG)
    return sheets.select("file_path", "status", "header_row", "category_row_used", "mapped_count")


# --- typing ---------------------------------------------------------------------


SIMPLE = Config(
    aliases={},
    required=[],
    schema={"sale_id": "string", "sale_date": "date", "quantity": "integer",
            "total": "float", "shipped_at": "timestamp", "is_open": "boolean"},
)


def _simple_rows(spark, folder) -> DataFrame:
    rows = samples.export_rows(spark, folder)
    return rows.select(
        "id",
        F.array(
            G.cell(F.col("id"), "num"),
            G.cell(F.col("date")),
            G.cell(F.col("quantity"), "num"),
            G.cell(F.when(F.col("quantity") == 3, F.lit("s/d")).otherwise(F.col("total"))),
            G.cell(F.col("shipped")),
            G.cell(F.when(F.trim("status") == "O", "True").otherwise("False"), "bool"),
        ).alias("cells"),
        F.array(*[F.lit(i) for i in range(6)]).alias("positions"),
        F.array().cast("array<struct<name:string,pos:int>>").alias("extras"),
    )


@query
def conform_schema(spark, folder):
    typed = C.conform(_simple_rows(spark, folder), SIMPLE, RULES, keep=("id",))
    return typed.select("id", *SIMPLE.schema, F.size("errors").alias("error_count"))


@query
def conversion_report(spark, folder):
    typed = C.conform(_simple_rows(spark, folder), SIMPLE, RULES, keep=("id",))
    status = typed.withColumn("bucket", F.pmod("id", F.lit(10)))
    return C.conversion_report(status, ["quantity", "total", "sale_date"], ["bucket"])


@query
def cast_declared(spark, folder):
    orders = table(spark, folder, "orders")
    shown = orders.select(
        F.col("o_orderkey").alias("sale_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("sale_date"),
        F.concat("o_custkey", F.when(F.col("o_orderstatus") == "P", "x").otherwise("")).alias(
            "quantity"
        ),
        F.col("o_totalprice").cast("string").alias("total_amount_ars"),
    )
    return C.cast_declared(shown, CONFIG)


# --- metadata and hashes ------------------------------------------------------------


@query
def file_hash(spark, folder):
    docs = table(spark, folder, "documents")
    return docs.select(
        "doc_id",
        digest(F.col("text")).alias("sha256"),
        digest(F.col("text"), "md5").alias("md5"),
        digest(F.col("text"), "sha1").alias("sha1"),
    )


@query
def file_hash_binary(spark, folder):
    """Digests of the table files themselves."""
    files = binary_files(spark, folder, "*.parquet")
    return file_hashes(files).select(MD.file_name(F.col("file_path")).alias("file_name"), "file_hash")


@query
def file_hash_any(spark, folder):
    """An algorithm Spark has no function for."""
    files = binary_files(spark, folder, "*.parquet")
    return file_hashes(files, "blake2b").select(
        MD.file_name(F.col("file_path")).alias("file_name"), "file_hash"
    )


@query
def load_metadata(spark, folder):
    described = MD.describe_files(samples.export_files(spark, folder), SESSION, NOW)
    rows = samples.export_rows(spark, folder).select(
        "file_path",
        "id",
        F.lit("0").alias("sheet"),
        F.create_map(*[F.lit(x) for kv in samples.HEADER_ROW.items() for x in kv])[
            F.col("layout")
        ].alias("header_row"),
    )
    return MD.add_load_metadata(rows, described).select(
        "id", "load_id", "session_load_id", "file_name", "file_hash", "loaded_at", "source_sheet",
        "header_row_detected",
    )


# --- dedup, merge, audit ------------------------------------------------------------


LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_linenumber"]


@query
def dedup_keep_first(spark, folder):
    return I.keep_first(table(spark, folder, "lineitem"), "l_orderkey", LINE_ORDER)


@query
def dedup_keep_last(spark, folder):
    return I.keep_last(table(spark, folder, "lineitem"), "l_orderkey", LINE_ORDER)


@query
def dedup_null_keys(spark, folder):
    """Returned lines lose their key; one survives per line status."""
    lines = table(spark, folder, "lineitem")
    key = F.when(F.col("l_returnflag") != "R", F.col("l_orderkey"))
    keyed = lines.withColumn("sale_key", key)
    return I.keep_first(
        keyed, "sale_key", ["l_orderkey", *LINE_ORDER], null_scope=["l_linestatus"]
    ).select("sale_key", "l_orderkey", *LINE_ORDER)


def _target(spark, folder) -> DataFrame:
    orders = table(spark, folder, "orders")
    return orders.filter(F.col("o_orderdate") < dt.datetime(1999, 1, 1)).select(
        F.col("o_orderkey").alias("sale_id"),
        F.col("o_orderstatus").alias("sale_status"),
        F.col("o_totalprice").alias("total"),
        F.sha2(F.col("o_orderpriority"), 256).alias("file_hash"),
    )


def _arrived(spark, folder) -> DataFrame:
    """Lines shipped from 1998 on, keyed by order: repeats, known keys and new ones."""
    lines = table(spark, folder, "lineitem")
    return lines.filter(F.col("l_shipdate") >= dt.datetime(1998, 1, 1)).select(
        F.col("l_orderkey").alias("sale_id"),
        F.col("l_linestatus").alias("sale_status"),
        F.col("l_extendedprice").alias("total"),
        F.sha2(F.col("l_returnflag"), 256).alias("file_hash"),
        *LINE_ORDER,
    )


STAGED = ["sale_id", "sale_status", "total", "file_hash"]


def _staged(spark, folder) -> DataFrame:
    return I.keep_first(_arrived(spark, folder), "sale_id", LINE_ORDER).select(*STAGED)


@query
def count_existing(spark, folder):
    """The target here repeats keys: every line of the early orders."""
    lines = table(spark, folder, "lineitem")
    early = lines.filter(F.col("l_shipdate") < dt.datetime(1999, 1, 1))
    target = early.select(F.col("l_orderkey").alias("sale_id"))
    return I.count_existing(_staged(spark, folder), target, "sale_id")


@query
def count_by_hash(spark, folder):
    wanted = hashlib.sha256(b"2-HIGH").hexdigest()
    return I.count_by_hash(_target(spark, folder), wanted)


@query
def insert_only_merge(spark, folder):
    return I.insert_only_merge(_target(spark, folder), _staged(spark, folder), "sale_id")


@query
def load_counts(spark, folder):
    staged, target = _staged(spark, folder), _target(spark, folder)
    pairs = I.existing_pairs(staged, target, "sale_id")
    return I.load_counts(_arrived(spark, folder), staged, pairs, "sale_id", "file_hash")


@query
def load_audit(spark, folder):
    """One entry per load, here one load per order month."""
    orders = table(spark, folder, "orders").withColumns(samples.file_of_order())
    stamped = orders.select(
        F.concat(F.lit("load_"), F.date_format("o_orderdate", "yyyyMM")).alias("load_id"),
        F.lit(SESSION).alias("session_load_id"),
        F.date_format("o_orderdate", "yyyy-MM").alias("file_name"),
        F.sha2(F.date_format("o_orderdate", "yyyy-MM"), 256).alias("file_hash"),
        F.lit(NOW).cast("timestamp_ntz").alias("loaded_at"),
        F.lit("0").alias("source_sheet"),
        "o_orderkey",
    )
    counted = stamped.groupBy("load_id").agg(F.count("*").alias("row_count"))
    return star.dim_load(stamped).join(counted, "load_id").withColumn("status", F.lit("loaded"))


# --- star schema and marts ------------------------------------------------------------


@query
def stg_sales(spark, folder):
    raw = samples.sales(spark, folder).withColumn(
        "product_title", F.concat(F.lit("  "), F.replace("product_title", F.lit(" "), F.lit("\t ")))
    )
    blanked = raw.withColumn(
        "variant", F.when(F.col("variant") == "5-LOW", F.lit("   ")).otherwise(F.col("variant"))
    )
    return star.stg_sales(blanked).select(
        "sale_id", "sale_date", "product_title", "variant", "buyer_city", "buyer_state",
        "buyer_country", "quantity", "total_amount_ars",
    )


@query
def dim_date(spark, folder):
    orders = table(spark, folder, "orders")
    return star.dim_date(orders.select(F.to_date("o_orderdate").alias("sale_date")))


@query
def dim_product(spark, folder):
    return star.dim_product(samples.sales(spark, folder), ["sale_date", "sale_id"])


@query
def dim_location(spark, folder):
    return star.dim_location(samples.sales(spark, folder))


@query
def dim_status(spark, folder):
    return star.dim_status(samples.sales(spark, folder))


@query
def fct_sales(spark, folder):
    return star.fct_sales(samples.sales(spark, folder))


@query
def fct_lookup(spark, folder):
    """Facts of the late years against the products sold in the early ones."""
    sold = samples.sales(spark, folder)
    early = sold.filter(F.col("sale_date") < dt.date(1995, 2, 1))
    products = star.dim_product(early, ["sale_date", "sale_id"])
    facts = star.fct_sales(sold).select("sale_id", "product_key", "quantity")
    checked = star.checked_key(facts, products, "product_key")
    return (
        star.lookup(checked, products, "product_key", ["sku"], spread_by=["sale_id"])
        .groupBy("sku")
        .agg(F.count("*").alias("fact_count"), F.sum("quantity").alias("units"))
    )


@query
def kpi_summary(spark, folder):
    return marts.kpi_summary(samples.sales(spark, folder))


@query
def kpi_by_product(spark, folder):
    return marts.kpi_by(samples.sales(spark, folder), "sku", "product_title")


@query
def kpi_by_location(spark, folder):
    return marts.kpi_by(samples.sales(spark, folder), *star.LOCATION)


@query
def kpi_by_status(spark, folder):
    return marts.kpi_by(samples.sales(spark, folder), *star.STATUS)


@query
def kpi_monthly(spark, folder):
    return marts.kpi_monthly(samples.sales(spark, folder))


@query
def kpi_location_rollup(spark, folder):
    return marts.kpi_location_rollup(samples.sales(spark, folder), *star.LOCATION)


@query
def filter_sales(spark, folder):
    chosen = marts.filter_sales(
        samples.sales(spark, folder),
        dt.date(1997, 1, 1),
        dt.date(1998, 6, 30),
        sale_status=["F", "O"],
        buyer_country=["AMERICA", "ASIA"],
    )
    return chosen.select("sale_id", "sale_date", "sale_status", "buyer_country", "total_amount_ars")


@query
def preview_rows(spark, folder):
    return marts.preview(table(spark, folder, "orders"), "o_orderdate", "o_orderkey")


# --- data quality ------------------------------------------------------------------------


@query
def dq_duplicates(spark, folder):
    return quality.duplicate_summary(table(spark, folder, "lineitem"), "l_orderkey")


@query
def dq_duplicate_keys(spark, folder):
    return quality.duplicate_keys(table(spark, folder, "lineitem"), "l_orderkey")


@query
def dq_nulls(spark, folder):
    orders = table(spark, folder, "orders")
    gaps = orders.select(
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderkey")).alias("sale_id"),
        F.col("o_orderdate").alias("sale_date"),
        F.nullif("o_orderstatus", F.lit("P")).alias("sale_status"),
    )
    return quality.check_rules(gaps, quality.null_rules(gaps.columns))


@query
def dq_consistency(spark, folder):
    sold = samples.sales(spark, folder).withColumn(
        "delivered_at", F.col("shipped_at") + F.make_dt_interval(days=F.lit(26) - F.col("quantity").cast("int"))
    )
    return quality.check_rules(sold, quality.sales_rules())


# --- end to end -----------------------------------------------------------------------------


def _ingested(spark, folder):
    grid = samples.export_grid(spark, folder)
    files = samples.export_files(spark, folder)
    return ingest(grid, files, CONFIG, RULES, SESSION, NOW)


@query
def ingest_end_to_end(spark, folder):
    """All export files, the hot one included, to typed rows with load metadata."""
    return _ingested(spark, folder).rows.select(
        "file_name", "sale_id", "sale_date", "sale_status", "quantity", "total_amount_ars", "sku",
        "shipped_at", "load_id", "session_load_id", "loaded_at", "header_row_detected",
        "source_row_number", F.to_json("extras").alias("extras"),
    )


@query
def ingest_monthly_sales(spark, folder):
    """Exports to the monthly mart: typed, first row per sale, aggregated."""
    rows = _ingested(spark, folder).rows
    return marts.kpi_monthly(I.keep_first(rows, "sale_id", ["file_path", "source_row_number"]))


@query
def delimited_scan(spark, folder):
    """Customers written as delimited text and read back as a grid."""
    customers = table(spark, folder, "customer")
    quoted = F.concat(F.lit('"'), "c_name", F.lit('; ""'), "c_mktsegment", F.lit('"""'))
    line = F.concat_ws(";", F.col("c_custkey").cast("string"), quoted, F.lit(""),
                       samples.money_text(F.col("c_acctbal")))
    path = scratch_path(spark, "csv")
    customers.select(line.alias("value")).write.text(path)
    grid = read_delimited(spark, path, sep=";", pattern="*")
    at = lambda i: F.get("cells", F.lit(i))["v"]
    return grid.select(
        numbers.parse_int(at(0)).alias("c_custkey"),
        at(1).alias("label"),
        at(2).isNull().alias("third_is_empty"),
        numbers.parse_float(at(3)).alias("c_acctbal"),
    )


@query
def delimited_row_order(spark, folder):
    """Row numbers of a text export follow the file, however Spark splits it."""
    orders = table(spark, folder, "orders")
    path = scratch_path(spark, "csv")
    orders.select(F.col("o_orderkey").cast("string").alias("value")).write.text(path)
    grid = read_delimited(spark, path, pattern="*")
    per_file = grid.groupBy("file_path").agg(
        F.count("*").alias("rows"), F.min("row_idx").alias("low"), F.max("row_idx").alias("high"),
        F.count_distinct("row_idx").alias("places"),
    )
    dense = (F.col("low") == 0) & (F.col("high") == F.col("rows") - 1) & (
        F.col("places") == F.col("rows")
    )
    return per_file.agg(
        F.sum("rows").alias("row_count"), F.count_if(~dense).alias("files_out_of_order")
    )


@query
def line_fingerprint(spark, folder):
    """Parallel content digest: equal texts, equal digests."""
    docs = table(spark, folder, "documents")
    lines = docs.select(
        F.col("doc_id").cast("string").alias("file_path"),
        F.posexplode(F.split("text", "\n")).alias("row_idx", "record"),
    )
    prints = line_fingerprints(lines)
    return prints.groupBy("file_hash").agg(F.count("*").alias("copies")).groupBy("copies").agg(
        F.count("*").alias("digest_count")
    )


def _build_workbook(rows: pd.Series) -> pd.Series:
    """Workbook bytes around prepared sheet XML, one per row."""

    def packed(body: str) -> bytes:
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr(
                "xl/workbook.xml",
                '<workbook xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/'
                'relationships"><sheets><sheet name="Ventas" r:id="rId1"/></sheets></workbook>',
            )
            archive.writestr(
                "xl/_rels/workbook.xml.rels",
                '<Relationships><Relationship Id="rId1" Target="worksheets/sheet1.xml"/>'
                "</Relationships>",
            )
            archive.writestr(
                "xl/worksheets/sheet1.xml",
                f"<worksheet><sheetData>{body}</sheetData></worksheet>",
            )
        return buffer.getvalue()

    return rows.map(packed)


@query
def workbook_scan(spark, folder):
    """Customers packed into workbooks of 100 rows each, and scanned back."""
    customers = table(spark, folder, "customer")
    row = F.concat(
        F.lit('<row><c t="inlineStr"><is><t>'), F.col("c_name"), F.lit("</t></is></c><c><v>"),
        F.col("c_acctbal"), F.lit('</v></c><c t="b"><v>'), F.pmod("c_custkey", F.lit(2)),
        F.lit('</v></c><c t="inlineStr"><is><t>NA</t></is></c></row>'),
    )
    books = (
        customers.withColumn("book", F.floor(F.col("c_custkey") / 100))
        .groupBy("book")
        .agg(F.array_sort(F.collect_list(F.struct("c_custkey", row.alias("row")))).alias("rows"))
        .select(
            F.concat(F.lit("clientes_"), F.col("book").cast("string"), F.lit(".xlsx")).alias("path"),
            F.pandas_udf(_build_workbook, T.BinaryType())(
                F.array_join(F.transform("rows", lambda r: r["row"]), "")
            ).alias("content"),
        )
    )
    at = lambda i: F.get("cells", F.lit(i))
    return grid_of_workbooks(books, "Ventas").select(
        "file_path",
        "sheet",
        "row_idx",
        at(0)["v"].alias("name"),
        at(0)["kind"].alias("name_kind"),
        numbers.parse_float(at(1)["v"], at(1)["kind"]).alias("balance"),
        at(2)["v"].alias("flag"),
        F.size("cells").alias("width"),
    )


@query
def stream_ingest(spark, folder):
    """Events as a file stream, merged insert-only: the first event per user stays."""
    schema = table(spark, folder, "events").schema
    arriving = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(folder)
        .select("user_id", "event_id", "event_type", "value")
    )
    path = scratch_path(spark, "merged")
    mark = scratch_path(spark, "progress")
    merge_stream(arriving, path, "user_id", ["event_id"], mark).awaitTermination()
    return spark.read.parquet(path).select("user_id", "event_id", "event_type", "value")
