"""From source headers to target columns, and the checks on the result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.config import ROW_NUMBER, Config
from salesloom.functions.text import normalize_text
from salesloom.operators.grid import KEYS


def alias_conflicts(aliases: DataFrame) -> DataFrame:
    """Normalised aliases claimed by more than one target, from (alias, alias_target) rows."""
    return (
        aliases.select(normalize_text(F.col("alias")).alias("alias_norm"), "alias_target")
        .groupBy("alias_norm")
        .agg(
            F.count_distinct("alias_target").alias("target_count"),
            F.min("alias_target").alias("first_target"),
            F.max("alias_target").alias("last_target"),
        )
        .filter("target_count > 1")
    )


def map_labels(labels: DataFrame, config: Config) -> DataFrame:
    """Add ``target`` (alias target, else the label itself) and ``mapped``.

    Columns no data row fills are dropped first.  The alias table is
    configuration: its size does not depend on the data, so it is broadcast.
    """
    aliases = F.broadcast(config.alias_table(labels.sparkSession))
    return (
        labels.filter("filled")
        .filter(F.col("source_label") != ROW_NUMBER)
        .withColumn("alias_norm", normalize_text(F.col("source_label")))
        .join(aliases, "alias_norm", "left")
        .withColumn("target", F.coalesce("alias_target", "source_label"))
        .withColumn("mapped", F.col("alias_target").isNotNull())
        .drop("alias_target")
    )


def unmapped_columns(mapped: DataFrame) -> DataFrame:
    """Columns no alias matched; they travel on under their source name."""
    return mapped.filter(~F.col("mapped")).select(*KEYS, "pos", "source_label")


def duplicate_targets(mapped: DataFrame) -> DataFrame:
    """Targets fed by several columns of one sheet (bounded by the sheet width)."""
    ordered = F.array_sort(F.collect_list(F.struct("pos", "source_label")))
    return (
        mapped.groupBy(*KEYS, "target")
        .agg(ordered.alias("sources"))
        .filter(F.size("sources") > 1)
        .select(*KEYS, "target", F.transform("sources", lambda s: s["source_label"]).alias("sources"))
    )


def layouts(mapped: DataFrame, config: Config) -> DataFrame:
    """One row per sheet: where each target column sits, and the schema checks.

    ``positions`` lines up with ``config.file_columns`` (null = absent) so that
    rows need one array lookup per column.
    """
    listed = F.array_sort(F.collect_list(F.struct("pos", "source_label", "target", "mapped")))
    sheets = mapped.groupBy(*KEYS, "header_row").agg(listed.alias("columns"))
    names = F.transform("columns", lambda c: c["target"])
    literal = lambda items: F.array(*[F.lit(x) for x in items]).cast("array<string>")
    repeated = F.when(F.size(names) == F.size(F.array_distinct(names)), literal([])).otherwise(
        F.array_distinct(
            F.filter(names, lambda n: F.size(F.filter(names, lambda m: m == n)) > 1)
        )
    )
    position = lambda name: F.get(
        F.filter("columns", lambda c: c["target"] == name), F.lit(0)
    )["pos"]
    schema = literal(config.schema)
    return (
        sheets.withColumn("present_columns", F.concat(names, F.array(F.lit(ROW_NUMBER))))
        .withColumn("positions", F.transform(literal(config.file_columns), position))
        .withColumn(
            "extras",
            F.transform(
                F.filter("columns", lambda c: ~F.array_contains(schema, c["target"])),
                lambda c: F.struct(c["target"].alias("name"), c["pos"].alias("pos")),
            ),
        )
        .withColumn("duplicate_targets", repeated)
        .withColumn(
            "unmapped_columns",
            F.transform(
                F.filter("columns", lambda c: ~c["mapped"]), lambda c: c["source_label"]
            ),
        )
        .withColumn("mapped_count", F.size(F.filter("columns", lambda c: c["mapped"])))
        .drop("columns")
        .transform(validate, config)
    )


def validate(sheets: DataFrame, config: Config) -> DataFrame:
    """Compare ``present_columns`` with the required list and the schema."""
    literal = lambda items: F.array(*[F.lit(x) for x in items]).cast("array<string>")
    required, schema = literal(config.required), literal(config.schema)
    present = F.col("present_columns")
    return (
        sheets.withColumn("missing_required", F.array_sort(F.array_except(required, present)))
        .withColumn("missing_schema", F.array_sort(F.array_except(schema, present)))
        .withColumn("extra_columns", F.array_sort(F.array_except(present, schema)))
        .withColumn("is_valid", F.size("missing_required") == 0)
    )
