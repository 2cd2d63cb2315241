"""Materialised models over the raw sales table: staging, star schema, marts, quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.config import Config
from salesloom.plans import marts, quality, star

MONTH = "sale_month"
NEWEST = ["loaded_at", "sale_date", "sale_id"]


def build_models(
    spark: SparkSession, raw_table: str, prefix: str = "", config: Config | None = None
) -> dict[str, DataFrame]:
    """Rebuild every model from ``raw_table``; returns the tables by name.

    Staging and facts are written once and read back by what follows, so each later
    model scans only the columns it needs.  Facts are range-partitioned on
    (month, sale) and partitioned by month: date filters prune whole folders.  Each
    dimension has the member ``UNKNOWN`` for facts without a key.
    """
    config = config or Config()

    def save(name: str, df: DataFrame, partition: str | None = None) -> DataFrame:
        writer = df.write.mode("overwrite").format("parquet")
        if partition:
            writer = writer.partitionBy(partition)
        writer.saveAsTable(prefix + name)
        return spark.table(prefix + name)

    staged = save("stg_sales", star.stg_sales(spark.table(raw_table).select(*config.schema)))
    facts = (
        star.fct_sales(staged)
        .withColumn(MONTH, F.date_format("sale_date", "yyyy-MM"))
        .repartitionByRange(MONTH, "sale_id")
    )
    products = star.dim_product(staged, NEWEST)
    models = {
        "stg_sales": staged,
        "dim_date": save("dim_date", star.with_unknown(star.dim_date(staged), "date_key")),
        "dim_product": save("dim_product", star.with_unknown(products, "product_key")),
        "dim_location": save("dim_location", star.with_unknown(star.dim_location(staged), "location_key")),
        "dim_status": save("dim_status", star.with_unknown(star.dim_status(staged), "status_key")),
        "dim_load": save("dim_load", star.dim_load(staged)),
        "fct_sales": save("fct_sales", facts, MONTH),
    }
    sold = models["fct_sales"]
    # Aggregated by key first: the dimension joins a row per member, not per sale.
    by_product = marts.kpi_by(sold, "product_key")
    by_location = marts.kpi_by(sold, "location_key")
    rules = quality.null_rules(config.required) | quality.sales_rules()
    models |= {
        "mart_summary": save("mart_summary", marts.kpi_summary(sold)),
        "mart_monthly": save("mart_monthly", marts.kpi_monthly(sold)),
        "mart_product": save(
            "mart_product",
            star.lookup(
                by_product, models["dim_product"], "product_key",
                [*star.PRODUCT, *star.PRODUCT_DETAILS],
            ),
        ),
        "mart_location": save(
            "mart_location",
            star.lookup(by_location, models["dim_location"], "location_key", list(star.LOCATION)),
        ),
        "dq_summary": save("dq_summary", quality.check_rules(staged, rules)),
    }
    return models
