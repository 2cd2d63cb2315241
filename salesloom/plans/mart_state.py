"""Marts kept up to date by loads: partial aggregates per month that merge.

Each load writes the partial sums of its own rows only, under (run, month); months it has no rows of are not
touched, and writing a run again replaces what it had written. A mart is the sum over the runs of a month.
``compact`` merges a month's runs into one that names what it covers: a reader leaves covered runs out, so it
does not matter where a compaction dies.

Sales ids are unique over all loads (the load inserts a key once), so sales are counted, not compared.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.scratch import materialise

MONTH = "sale_month"
RUN = "run"
KEYS = ("product_key", "location_key", "status_key")
SHARES = 16  # tasks that a month is dealt to, at most
_SHARE = "_share"
_SUMS = ("total", "sales", "units")


def _summed(rows: DataFrame, sales: Column) -> DataFrame:
    """Sums per month and dimension keys, each month in up to ``SHARES`` tasks: the one shuffle serves the sums and
    bounds a month's files."""
    share = F.pmod(F.xxhash64(*KEYS), F.lit(SHARES))
    dealt = rows.withColumn(_SHARE, share).repartition(MONTH, _SHARE)
    sums = [F.sum("total").alias("total"), sales.alias("sales"), F.sum("units").alias("units")]
    return dealt.groupBy(MONTH, _SHARE, *KEYS).agg(*sums).drop(_SHARE)


def partials(facts: DataFrame) -> DataFrame:
    """Sums of ``facts`` per month and dimension keys, dealt by month."""
    month = F.coalesce(F.date_format("sale_date", "yyyy-MM"), F.lit("none"))
    rows = facts.select(
        month.alias(MONTH),
        *KEYS,
        F.col("total_amount_ars").alias("total"),
        F.col("sale_id").isNotNull().alias("sales"),
        F.col("quantity").alias("units"),
    )
    return _summed(rows, F.count_if("sales"))


def _write(spark: SparkSession, table: str, parts: DataFrame, run: str) -> None:
    """Replace the partials of ``run``, dealt by month; those of other runs stay."""
    keys = ", ".join(f"{k} bigint" for k in KEYS)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({keys}, total double, sales bigint, units bigint, covers array<string>, "
        f"{RUN} string, {MONTH} string) USING parquet PARTITIONED BY ({RUN}, {MONTH})"
    )
    columns = ", ".join([*KEYS, *_SUMS, "covers", MONTH])
    # The given part of the partition is what an overwrite replaces.
    spark.sql(
        f"INSERT OVERWRITE TABLE {table} PARTITION ({RUN}='{run}', {MONTH}) SELECT {columns} FROM {{parts}}",
        parts=parts,
    )


def add_run(spark: SparkSession, table: str, facts: DataFrame, run: str) -> None:
    """Add the facts of one load; again with the same ``run`` it changes nothing."""
    _write(spark, table, partials(facts).withColumn("covers", F.lit(None).cast("array<string>")), run)


def live(state: DataFrame) -> DataFrame:
    """Partials that no compacted run covers.

    What is covered are names of partitions, so they are broadcast and the partials stay where they are.
    """
    covered = state.select(MONTH, F.explode("covers").alias(RUN)).distinct()
    return state.join(F.broadcast(covered), [MONTH, RUN], "left_anti")


def compact(spark: SparkSession, table: str, least: int = 8) -> list[str]:
    """Merge the runs of each month that has ``least`` or more; returns these months."""
    state = live(spark.table(table))
    runs = state.select(MONTH, RUN).distinct().groupBy(MONTH).agg(F.collect_set(RUN).alias("covers"))  # names only
    many = materialise(runs.filter(F.size("covers") >= least), "runs")
    months = [r[0] for r in many.select(MONTH).collect()]
    if not months:
        return []
    chosen = state.drop("covers").join(F.broadcast(many.select(MONTH)), MONTH)
    merged = materialise(_summed(chosen, F.sum("sales")), "merged")
    groups: dict[tuple[str, ...], list[str]] = {}
    for month, covers in many.collect():  # names only
        groups.setdefault(tuple(sorted(covers)), []).append(month)
    for covers in groups:
        name = "base_" + hashlib.md5(",".join(covers).encode()).hexdigest()
        own = many.filter(F.array_sort("covers") == F.array(*map(F.lit, covers)))
        _write(spark, table, merged.join(F.broadcast(own), MONTH), name)
    for covers, own in groups.items():
        for month in own:
            for run in covers:
                spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({RUN}='{run}', {MONTH}='{month}')")
    return months


def kpis(state: DataFrame, *by: str | Column) -> DataFrame:
    """The business metrics of ``marts`` from the partials."""
    total = F.round(F.sum("total"), 2)
    sales = F.sum("sales")
    return live(state).groupBy(*by).agg(
        total.alias("total_sales"),
        sales.alias("sale_count"),
        F.sum("units").alias("units_sold"),
        F.try_divide(total, sales).alias("average_ticket"),
    )


def kpi_monthly(state: DataFrame) -> DataFrame:
    month = F.try_to_timestamp(F.concat(MONTH, F.lit("-01")), F.lit("yyyy-MM-dd")).cast("date")
    return kpis(state, month.alias("month"))
