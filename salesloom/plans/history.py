"""Type-2 product dimension: what a product was called when it was sold.

A version holds from the day a product first shows its attributes until the day it shows others; of several
sales on a day the last by ``order`` counts. Facts meet the versions through (product, year): a version is
listed under each year it reaches into, so the join is an equi-join whose hot keys Spark can split, and a fact
is compared with the versions of its own year only, 366 at most. A version is shuffled once for each of its years;
by months the lists were three times as long as the versions, and longer than the facts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from salesloom.plans.star import PRODUCT, PRODUCT_DETAILS, surrogate_key

_YEAR = "_year"


def history(
    sales: DataFrame, keys: tuple[str, ...], details: tuple[str, ...], order: list[str], day: str = "sale_date"
) -> DataFrame:
    """(keys, details, valid_from, valid_to): ``valid_to`` is the day the next version begins, null for the last.

    Sales are cut to one row per key and day by partial maxima before the window: it holds a row
    per day of a product, however often that sells.
    """
    shown = F.max_by(F.struct(*details), F.struct(*order)).alias("_shown")
    days = sales.filter(F.col(day).isNotNull()).groupBy(*keys, F.col(day).alias("valid_from")).agg(shown)
    own = W.partitionBy(*keys).orderBy("valid_from")
    days = days.withColumn("_before", F.lag("_shown").over(own)).withColumn("_n", F.row_number().over(own))
    versions = days.filter((F.col("_n") == 1) | ~F.col("_shown").eqNullSafe(F.col("_before")))
    return versions.withColumn("valid_to", F.lead("valid_from").over(own)).select(
        *keys, *[F.col("_shown")[d].alias(d) for d in details], "valid_from", "valid_to"
    )


def product_history(sales: DataFrame, order: list[str]) -> DataFrame:
    """Versions of every product with their surrogate key."""
    known = sales.filter(F.coalesce(*PRODUCT).isNotNull())
    return history(known, PRODUCT, PRODUCT_DETAILS, order).withColumn("product_key", surrogate_key(*PRODUCT))


def as_of(
    facts: DataFrame, versions: DataFrame, key: str, columns: list[str], day: str = "sale_date", last_day=None
) -> DataFrame:
    """``facts`` with the ``columns`` of the version valid on ``day``; null before the first version, for
    unknown keys and without a day.

    An open version reaches to ``last_day``, by default the facts' last.
    """
    end = F.lit(last_day) if last_day is not None else F.lit(facts.agg(F.max(day)).first()[0])
    upto = F.coalesce(F.date_sub("valid_to", 1), F.greatest(end.cast("date"), F.col("valid_from")))
    years = F.sequence(F.year("valid_from"), F.year(upto))
    listed = versions.select(
        F.col(key).alias("_key"), F.explode(years).alias(_YEAR), "valid_from", "valid_to", *columns
    )
    rows = facts.withColumn(_YEAR, F.year(day))
    valid = (F.col("valid_from") <= F.col(day)) & (F.col("valid_to").isNull() | (F.col(day) < F.col("valid_to")))
    met = rows.join(listed, (rows[key] == listed["_key"]) & (rows[_YEAR] == listed[_YEAR]) & valid, "left")
    return met.select(*[rows[c] for c in facts.columns], *[listed[c] for c in columns])
