"""Staging model and star schema over loaded sales.

Dimension keys are digests of the natural key, so facts compute their foreign keys
from their own columns: building ``fct_sales`` needs no join, whatever the size of
the dimensions.  ``lookup`` is there for keys that must be checked against one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.functions.text import strip
from salesloom.operators.incremental import keep_last

UNKNOWN = -1
_PART = "_part"
PRODUCT = ("sku", "publication_id")
PRODUCT_DETAILS = ("product_title", "variant")
LOCATION = ("buyer_country", "buyer_state", "buyer_city")
STATUS = ("sale_status", "status_description")
LOAD = ("load_id", "session_load_id", "file_name", "file_hash", "loaded_at", "source_sheet")
MEASURES = (
    "quantity",
    "unit_price_ars",
    "product_revenue_ars",
    "total_amount_ars",
    "shipping_cost_ars",
    "sale_fee_ars",
    "taxes_ars",
    "discounts_ars",
    "refund_amount_ars",
)


def surrogate_key(*parts: str) -> Column:
    """Stable 60-bit key of a natural key; ``UNKNOWN`` when every part is null."""
    text = F.concat_ws("\x1f", *[F.coalesce(F.col(p).cast("string"), F.lit("\x00")) for p in parts])
    key = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")
    absent = F.coalesce(*[F.col(p).cast("string") for p in parts]).isNull()
    return F.when(absent, F.lit(UNKNOWN).cast("long")).otherwise(key)


def date_key(day: Column) -> Column:
    """yyyymmdd of a date; ``UNKNOWN`` for null."""
    return F.coalesce(
        F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day), F.lit(UNKNOWN)
    )


def stg_sales(raw: DataFrame) -> DataFrame:
    """Cleaned sales: texts trimmed, single-spaced, blank to null; names in title case."""
    titled = {"buyer_city", "buyer_state", "buyer_country"}

    def clean(name: str, kind: str) -> Column:
        if kind != "string":
            return F.col(name)
        text = F.regexp_replace(strip(F.col(name)), "\\s+", " ")
        text = F.nullif(text, F.lit(""))
        return F.initcap(text) if name in titled else text

    return raw.select(*[clean(n, k).alias(n) for n, k in raw.dtypes])


def dim_date(sales: DataFrame, day: str = "sale_date") -> DataFrame:
    """Every day from the first to the last sale with its calendar parts.

    Only the two bounds are aggregated; the days come from ``sequence``.
    """
    bounds = sales.agg(F.min(day).alias("low"), F.max(day).alias("high"))
    days = bounds.filter("low IS NOT NULL").select(
        F.explode(F.sequence(F.to_date("low"), F.to_date("high"))).alias("day")
    )
    return days.select(
        date_key(F.col("day")).alias("date_key"),
        "day",
        F.year("day").alias("year"),
        F.quarter("day").alias("quarter"),
        F.month("day").alias("month"),
        F.dayofmonth("day").alias("day_of_month"),
        (F.weekday("day") + 1).alias("iso_weekday"),
        F.weekofyear("day").alias("iso_week"),
        F.weekday("day").isin(5, 6).alias("is_weekend"),
    )


def dim_product(sales: DataFrame, order: list[str]) -> DataFrame:
    """Latest title and variant per product, by ``order`` descending."""
    known = sales.filter(F.coalesce(*PRODUCT).isNotNull())
    keyed = known.withColumn("product_key", surrogate_key(*PRODUCT))
    narrow = keyed.select("product_key", *PRODUCT, *PRODUCT_DETAILS, *order)
    return keep_last(narrow, "product_key", order).select("product_key", *PRODUCT, *PRODUCT_DETAILS)


def _distinct_dim(sales: DataFrame, key: str, columns: tuple[str, ...]) -> DataFrame:
    distinct = sales.select(*columns).distinct().withColumn(key, surrogate_key(*columns))
    return distinct.filter(F.col(key) != UNKNOWN).select(key, *columns)


def dim_location(sales: DataFrame) -> DataFrame:
    return _distinct_dim(sales, "location_key", LOCATION)


def dim_status(sales: DataFrame) -> DataFrame:
    return _distinct_dim(sales, "status_key", STATUS)


def dim_load(sales: DataFrame) -> DataFrame:
    return sales.select(*LOAD).distinct()


def fct_sales(sales: DataFrame) -> DataFrame:
    """One row per sale: foreign keys and measures, all from the row itself."""
    measures = [m for m in MEASURES if m in sales.columns]
    keys = [
        date_key(F.col("sale_date")).cast("int").alias("date_key"),
        surrogate_key(*PRODUCT).alias("product_key"),
        surrogate_key(*LOCATION).alias("location_key"),
        surrogate_key(*STATUS).alias("status_key"),
    ]
    load = ["load_id"] if "load_id" in sales.columns else []
    return sales.select("sale_id", "sale_date", *keys, *load, *measures)


def _met(facts: DataFrame, dimension: DataFrame, key: str, how: str, spread_by: list[str] | None) -> DataFrame:
    """``facts`` joined with ``dimension``, those without a key (``UNKNOWN`` or null) spread over as many parts as a
    shuffle has.

    Such facts share one key, however many they are, and compress so well that Spark does not see the skew. The part
    of a fact comes from its own columns, ``spread_by`` or all that can be hashed; the unknown member is in each part.
    """
    parts = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    told = spread_by or [f.name for f in facts.schema if "map<" not in f.dataType.simpleString()]
    unknown = F.lit(str(UNKNOWN)).try_cast(facts.schema[key].dataType)
    keyless = F.col(key).isNull() | F.col(key).eqNullSafe(unknown)
    own = F.when(keyless, F.pmod(F.xxhash64(*told), F.lit(parts)).cast("int")).otherwise(0)
    every = F.when(F.col(key) == unknown, F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(F.array(F.lit(0)))
    members = dimension.withColumn(_PART, F.explode(every))
    return facts.withColumn(_PART, own).join(members, [key, _PART], how).drop(_PART)


def lookup(
    facts: DataFrame, dimension: DataFrame, key: str, columns: list[str], spread_by: list[str] | None = None
) -> DataFrame:
    """Facts with dimension columns attached; facts without a member keep nulls.

    No broadcast is forced: Spark picks one from the dimension's real size. Facts without a key are spread by
    ``spread_by``, columns that tell facts apart, all by default; Spark splits other skewed keys.
    """
    return _met(facts, dimension.select(key, *columns), key, "left", spread_by)


def meet(facts: DataFrame, dimension: DataFrame, key: str, spread_by: list[str] | None = None) -> DataFrame:
    """Facts with all columns of their member, facts without one left out; spread as by :func:`lookup`."""
    return _met(facts, dimension, key, "inner", spread_by)


def checked_key(facts: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Facts whose ``key`` is set to ``UNKNOWN`` where the dimension lacks it."""
    members = dimension.select(key, F.lit(True).alias("_member"))
    return (
        facts.join(members, key, "left")
        .withColumn(key, F.when(F.col("_member"), F.col(key)).otherwise(F.lit(UNKNOWN)))
        .select(*facts.columns)
    )


def lookup_checked(facts: DataFrame, dimension: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """:func:`checked_key` and :func:`lookup` in one join."""
    members = dimension.select(key, *columns, F.lit(True).alias("_member"))
    met = facts.join(members, key, "left")
    member = F.when(F.col("_member"), F.col(key)).otherwise(F.lit(UNKNOWN))
    return met.withColumn(key, member).select(*facts.columns, *columns)


def with_unknown(dimension: DataFrame, key: str) -> DataFrame:
    """The dimension and its member ``UNKNOWN``, whose other columns are null: facts without a key meet it."""
    spark = dimension.sparkSession
    member = spark.createDataFrame([(UNKNOWN,)], f"`{key}` {dimension.schema[key].dataType.simpleString()}")
    return dimension.filter(F.col(key) != UNKNOWN).unionByName(member, allowMissingColumns=True)
