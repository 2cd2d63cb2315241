"""Business metrics over ``fct_sales`` (or anything with its measure columns)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _metrics() -> list[Column]:
    """Total, number of sales, units and average ticket.

    Every measure combines map-side; the distinct count shuffles on (group, sale),
    so one large group spreads over the cluster.
    """
    total = F.round(F.sum("total_amount_ars"), 2)
    sales = F.count_distinct("sale_id")
    return [
        total.alias("total_sales"),
        sales.alias("sale_count"),
        F.sum("quantity").alias("units_sold"),
        F.try_divide(total, sales).alias("average_ticket"),
    ]


def kpi_summary(sales: DataFrame) -> DataFrame:
    return sales.agg(*_metrics())


def kpi_by(sales: DataFrame, *columns: str | Column) -> DataFrame:
    return sales.groupBy(*columns).agg(*_metrics())


def kpi_monthly(sales: DataFrame) -> DataFrame:
    month = F.to_date(F.date_trunc("month", F.col("sale_date"))).alias("month")
    return kpi_by(sales, month)


def kpi_location_rollup(sales: DataFrame, *levels: str) -> DataFrame:
    """Sales by location with subtotals; ``level`` counts the columns rolled away."""
    ranked = sales.rollup(*levels).agg(
        F.round(F.sum("total_amount_ars"), 2).alias("total_sales"),
        F.count("*").alias("row_count"),
        F.grouping_id().alias("grouping_id"),
    )
    return ranked.withColumn(
        "level", F.bit_count("grouping_id").cast("int")
    ).drop("grouping_id")


def filter_sales(
    sales: DataFrame,
    date_from=None,
    date_to=None,
    **allowed: list,
) -> DataFrame:
    """Dashboard filter by date range and lists of allowed values; all of it reaches the scan."""
    if date_from is not None:
        sales = sales.filter(F.col("sale_date") >= F.lit(date_from))
    if date_to is not None:
        sales = sales.filter(F.col("sale_date") <= F.lit(date_to))
    for column, values in allowed.items():
        sales = sales.filter(F.col(column).isin(list(values)))
    return sales


def preview(sales: DataFrame, *order: str, rows: int = 5) -> DataFrame:
    """First rows for a look, in a fixed order when one is given."""
    return (sales.orderBy(*order) if order else sales).limit(rows)
