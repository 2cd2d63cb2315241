"""Sales exports rendered from order tables, for checks and measurements.

Every order becomes one row of an export file: 256 consecutive order numbers share
a file, and all urgent orders (a fifth of the data) share one more, so one source is
far larger than the rest.  Files follow one of eight layouts that drift the way real
exports do.  Everything is a DataFrame expression; sizes grow with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.functions.dates import SPANISH_MONTHS
from salesloom.operators.grid import cell

ROWS_PER_FILE = 256
URGENT = "1-URGENT"
HOT_FILE = "urgente.xlsx"
NAMES = [m for m in SPANISH_MONTHS if m != "setiembre"]

FLAT = ["# de venta", "Fecha de venta", "Estado de la venta", "Unidades", "Total (ARS)", "SKU",
        "Fecha en camino"]
TWO_LEVEL = ["# de venta", "Fecha de venta", "Estado", "Unidades", "Total (ARS)", "SKU",
             "Fecha en camino"]
CATEGORIES = ["Ventas", None, None, None, None, "Publicaciones", "Envíos"]
# Layout number -> rows above the data as (row_idx, labels).
LEADS: dict[int, list[tuple[int, list]]] = {
    0: [(1, ["Reporte de ventas"]), (3, CATEGORIES), (4, TWO_LEVEL)],
    1: [(0, FLAT)],
    2: [(0, ["Reporte", "10/2026"]), (2, FLAT[::-1])],
    3: [(0, FLAT + ["Columna nueva"])],
    4: [(0, FLAT[:4] + FLAT[5:])],
    5: [(0, FLAT)],
    6: [(0, FLAT + ["Cantidad"])],
    7: [(0, ["uno", "dos", "tres", "cuatro", "cinco", "seis", "siete"])],
    8: [(0, ["Reporte de urgentes"]), (2, FLAT)],
}
HOT_LAYOUT = 8
HEADER_ROW = {layout: rows[-1][0] for layout, rows in LEADS.items()}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def money_text(value: Column) -> Column:
    """"$ 44.473,56"."""
    return F.concat(F.lit("$ "), F.translate(F.format_number(value, 2), ",.", ".,"))


def _month_name(day: Column) -> Column:
    return F.get(F.array(*[F.lit(m) for m in NAMES]), F.month(day) - 1)


def long_date_text(day: Column) -> Column:
    """"12 de abril de 2026 17:10 hs."."""
    return F.concat_ws(
        " de ", F.dayofmonth(day).cast("string"), _month_name(day),
        F.concat(F.year(day), F.lit(" "), F.date_format(day, "HH:mm"), F.lit(" hs.")),
    )


def short_date_text(day: Column) -> Column:
    """"3 de mayo | 09:05"."""
    return F.concat(
        F.dayofmonth(day), F.lit(" de "), _month_name(day), F.lit(" | "),
        F.date_format(day, "HH:mm"),
    )


def file_of_order() -> dict[str, Column]:
    """File, layout and position of an order's row."""
    key = F.col("o_orderkey")
    number = F.floor(key / ROWS_PER_FILE)
    hot = F.col("o_orderpriority") == URGENT
    layout = F.when(hot, HOT_LAYOUT).otherwise(F.pmod(number, F.lit(8))).cast("int")
    position = F.when(hot, key).otherwise(F.pmod(key, F.lit(ROWS_PER_FILE)))
    name = F.when(hot, HOT_FILE).otherwise(
        F.concat(F.lit("ventas_"), number.cast("string"), F.lit(".xlsx"))
    )
    return {"file_path": name, "layout": layout, "position": position}


def export_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with the texts an export shows and the file they belong to."""
    orders = table(spark, folder, "orders").withColumns(file_of_order())
    sold = F.col("o_orderdate") + F.make_dt_interval(
        hours=F.pmod("o_orderkey", F.lit(24)), mins=F.pmod("o_orderkey", F.lit(60))
    )
    shipped = sold + F.make_dt_interval(days=F.pmod("o_custkey", F.lit(20)).cast("int"))
    return orders.select(
        "file_path",
        "layout",
        "position",
        F.col("o_orderkey").alias("id"),
        long_date_text(sold).alias("date"),
        F.concat(F.lit("  "), "o_orderstatus", F.lit(" ")).alias("status"),
        (F.pmod("o_custkey", F.lit(9)) + 1).alias("quantity"),
        money_text(F.col("o_totalprice")).alias("total"),
        F.concat(F.lit("SKU-"), "o_custkey").alias("sku"),
        short_date_text(shipped).alias("shipped"),
    )


def _lead_rows() -> Column:
    """Map layout -> array of (row_idx, cells) above its data."""

    def lead(index: int, labels: list) -> Column:
        cells = F.array(*[cell(F.lit(x).cast("string")) for x in labels])
        return F.struct(F.lit(index).cast("bigint").alias("row_idx"), cells.alias("cells"))

    pairs = []
    for layout, rows in LEADS.items():
        pairs += [F.lit(layout), F.array(*[lead(i, labels) for i, labels in rows])]
    return F.create_map(*pairs)


def _data_cells() -> Column:
    """Cells of a data row in the layout of its file."""
    one = {
        "id": cell(F.col("id"), "num"),
        "date": cell(F.col("date")),
        "status": cell(F.col("status")),
        "quantity": cell(F.col("quantity"), "num"),
        "total": cell(F.col("total")),
        "sku": cell(F.col("sku")),
        "shipped": cell(F.col("shipped")),
    }
    flat = list(one.values())
    none = F.lit(None).cast("struct<v:string,kind:string>")
    layout = F.col("layout")
    return (
        F.when(layout == 2, F.array(*flat[::-1]))
        .when(layout == 3, F.array(*flat, cell(F.concat(F.lit("n"), "id"))))
        .when(layout == 4, F.array(*flat[:4], *flat[5:]))
        .when(layout == 5, F.array(*flat[:3], none, *flat[4:]))
        .when(layout == 6, F.array(*flat, one["quantity"]))
        .otherwise(F.array(*flat))
    )


def export_grid(spark: SparkSession, folder: str) -> DataFrame:
    """The exports as a grid (``salesloom.operators.grid``); skipped positions are blank rows."""
    rows = export_rows(spark, folder)
    header_row = F.create_map(*[F.lit(x) for pair in HEADER_ROW.items() for x in pair])
    data = rows.select(
        "file_path",
        F.lit("0").alias("sheet"),
        (F.col("position") + 1 + header_row[F.col("layout")]).alias("row_idx"),
        _data_cells().alias("cells"),
    )
    files = rows.select("file_path", "layout").distinct()
    leads = files.select(
        "file_path", F.explode(_lead_rows()[F.col("layout")]).alias("lead")
    ).select("file_path", F.lit("0").alias("sheet"), "lead.row_idx", "lead.cells")
    return data.unionByName(leads)


def export_files(spark: SparkSession, folder: str) -> DataFrame:
    """(file_path, file_hash) of the exports; the hash is a digest of the name."""
    files = table(spark, folder, "orders").select(file_of_order()["file_path"].alias("file_path"))
    return files.distinct().withColumn("file_hash", F.sha2("file_path", 256))


def sales(spark: SparkSession, folder: str) -> DataFrame:
    """Loaded sales at line grain: lineitem with its order, product and buyer location."""
    lines, orders = table(spark, folder, "lineitem"), table(spark, folder, "orders")
    part, customer = table(spark, folder, "part"), table(spark, folder, "customer")
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    # Lines shuffle twice, to their part while they are narrow and to their order, which has met its buyer by then.
    bought = (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
    )
    joined = lines.join(part, lines.l_partkey == part.p_partkey).join(bought, lines.l_orderkey == bought.o_orderkey)
    return joined.select(
        F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey").alias("sale_id"),
        F.to_date("o_orderdate").alias("sale_date"),
        F.col("o_orderstatus").alias("sale_status"),
        F.col("l_linestatus").alias("status_description"),
        F.col("l_quantity").cast("long").alias("quantity"),
        F.concat(F.lit("SKU-"), "l_partkey").alias("sku"),
        F.col("p_brand").alias("publication_id"),
        F.col("p_name").alias("product_title"),
        F.col("o_orderpriority").alias("variant"),
        F.col("l_extendedprice").alias("total_amount_ars"),
        F.col("l_shipdate").alias("shipped_at"),
        F.col("c_mktsegment").alias("buyer_city"),
        F.col("n_name").alias("buyer_state"),
        F.col("r_name").alias("buyer_country"),
    )
