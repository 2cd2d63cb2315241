"""Data-quality checks: one row per rule with failed and total counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def check_rules(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """``rules`` maps a name to the condition a bad row meets; one pass for all rules."""
    counted = df.agg(
        F.count("*").alias("total"),
        *[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in rules.items()],
    )
    return counted.unpivot(["total"], list(rules), "rule", "failed").select(
        "rule", "failed", "total"
    )


SAMPLES = 4  # ids of bad rows that a rule keeps


def evaluate(df: DataFrame, rules: dict[str, str], id: str, samples: int = SAMPLES) -> DataFrame:
    """``rules`` as data, a name and the SQL condition that a bad row meets; one row per rule.

    All rules are counted in one aggregation, which also keeps up to ``samples`` ids of bad rows: ids fall
    into that many classes by their MD5, and each class keeps the id of the least MD5. So a sample does not
    depend on how the rows are spread, and holds no more than that whatever fails. Null ids are counted only.
    """
    code = F.md5(F.col(id).cast("string"))
    # Through the first byte of the MD5, as even as the samples divide 256.
    own = F.conv(F.substring(code, 1, 2), 16, 10).cast("int") % samples
    marked = F.concat(code, F.lit(" "), F.col(id).cast("string"))
    aggregates = [F.count("*").alias("total")]
    for i, condition in enumerate(rules.values()):
        bad = F.coalesce(F.expr(condition), F.lit(False))
        least = [F.substring_index(F.min(F.when(bad & (own == k), marked)), " ", -1) for k in range(samples)]
        found = F.array_join(F.array_sort(F.array_compact(F.array(*least))), "|")
        aggregates.append(F.struct(F.count_if(bad).alias("failed"), found.alias("sample")).alias(f"rule_{i}"))
    counted = df.agg(*aggregates)
    rows = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"rule_{i}").alias("found")) for i, n in enumerate(rules)])
    return counted.select("total", F.inline(rows)).select("rule", "found.failed", "total", "found.sample")


def null_rules(columns: list[str]) -> dict[str, Column]:
    """A required value is missing."""
    return {f"{c}_null": F.col(c).isNull() for c in columns}


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once; counts combine map-side."""
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count("*").alias("occurrences"))
        .filter("occurrences > 1")
    )


def duplicate_summary(df: DataFrame, key: str) -> DataFrame:
    """One row: how many keys repeat and how many rows are surplus."""
    return duplicate_keys(df, key).agg(
        F.count("*").alias("duplicated_keys"),
        F.coalesce(F.sum(F.col("occurrences") - 1), F.lit(0)).alias("surplus_rows"),
    )


def sales_rules() -> dict[str, Column]:
    """Consistency of one sale."""
    return {
        "quantity_not_positive": F.col("quantity") <= 0,
        "total_negative": F.col("total_amount_ars") < 0,
        "shipped_before_sale": F.to_date("shipped_at") < F.col("sale_date"),
        "delivered_before_shipped": F.col("delivered_at") < F.col("shipped_at"),
    }
