"""Deduplication and insert-only merge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def keep_one(
    df: DataFrame, key: str, order: list[Column], null_scope: list[str] | None = None
) -> DataFrame:
    """First row per key in the given order.

    Null keys count as equal; with ``null_scope`` they do so only within those
    columns (one survivor per file).  ``row_number = 1`` lets Spark cut every key to
    one row per map task before the shuffle, so a key that holds a third of the
    data costs its reducer one row per task.
    """
    scope = [F.when(F.col(key).isNull(), F.col(c)) for c in null_scope or []]
    window = W.partitionBy(key, *scope).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def keep_first(df: DataFrame, key: str, order: list[str], null_scope=None) -> DataFrame:
    """First arrival per key, ascending by ``order``."""
    return keep_one(df, key, [F.col(c).asc() for c in order], null_scope)


def keep_last(df: DataFrame, key: str, order: list[str], null_scope=None) -> DataFrame:
    """Latest arrival per key, descending by ``order``."""
    return keep_one(df, key, [F.col(c).desc() for c in order], null_scope)


def first_of_files(df: DataFrame, key: str, file: str, order: list[str]) -> DataFrame:
    """Each file's first row per key by ``order``, with ``is_first``: whether it is the first of all files.

    Null keys of different files never compete. The second window holds a row per file and key.
    """
    own = W.partitionBy(key, file).orderBy(*order)
    across = W.partitionBy(key, F.when(F.col(key).isNull(), F.col(file))).orderBy(*order)
    firsts = df.withColumn("_rank", F.row_number().over(own)).filter("_rank = 1")
    return firsts.withColumn("is_first", F.row_number().over(across) == 1).drop("_rank")


def _staged_keys(target: DataFrame, staged: DataFrame, key: str) -> DataFrame:
    """Keys of the target's rows that are staged too; Spark broadcasts the staged side when it is small."""
    return target.select(key).join(staged.select(key).distinct(), key, "left_semi")


def new_rows(staged: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Staged rows whose key the target lacks; null keys never match, so they stay.

    Only the target's key column is read, and cut to the staged keys before it is made
    distinct: with a small staged side the target is not shuffled.
    """
    known = _staged_keys(target, staged, key).distinct()
    return staged.join(known, key, "left_anti").select(*staged.columns)


def insert_only_merge(target: DataFrame, staged: DataFrame, key: str) -> DataFrame:
    """The target after the load: old rows untouched, unseen keys appended."""
    return target.unionByName(new_rows(staged, target, key), allowMissingColumns=True)


def existing_pairs(staged: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """(key, pairs): staged keys the target holds, and in how many rows.

    The target is cut to the staged keys and counted per key before the join, so the
    join itself is one row per key on the target side.
    """
    per_key = _staged_keys(target, staged, key).groupBy(key).agg(F.count("*").alias("pairs"))
    return staged.select(key).join(per_key, key)


def count_existing(staged: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Pairs of (staged row, target row) with equal keys, as one row ``row_count``."""
    return existing_pairs(staged, target, key).agg(
        F.coalesce(F.sum("pairs"), F.lit(0)).alias("row_count")
    )


def load_counts(rows: DataFrame, staged: DataFrame, pairs: DataFrame, key: str, by: str) -> DataFrame:
    """Per file (``by``): rows arrived, left after dedup, already known, inserted.

    ``pairs`` is :func:`existing_pairs`.  ``rows_inserted`` counts the staged rows
    without a match; ``rows_inserted_derived`` is staged minus matching pairs, which
    differs where the target repeats a key.
    """
    arrived = rows.groupBy(by).agg(F.count("*").alias("rows_in_file"))
    known = (
        staged.select(by, key)
        .join(pairs, key, "left")
        .groupBy(by)
        .agg(
            F.count("*").alias("rows_after_dedup"),
            F.coalesce(F.sum("pairs"), F.lit(0)).alias("rows_already_existing"),
            F.count_if(F.col("pairs").isNull()).alias("rows_inserted"),
        )
    )
    zero = {c: F.coalesce(c, F.lit(0)) for c in known.columns if c != by}
    return (
        arrived.join(known, by, "left")
        .withColumns(zero)
        .withColumn("duplicate_rows", F.col("rows_in_file") - F.col("rows_after_dedup"))
        .withColumn(
            "rows_inserted_derived", F.col("rows_after_dedup") - F.col("rows_already_existing")
        )
    )


def file_counts(rows: DataFrame, firsts: DataFrame, pairs: DataFrame, key: str, by: str) -> DataFrame:
    """Per file (``by``), as if the files were loaded one after the other: rows arrived, repeats in the file,
    left after those, already known (to the target, or from an earlier file of the load), inserted.

    ``firsts`` is :func:`first_of_files`, ``pairs`` is :func:`existing_pairs`; the derived count differs
    where the target repeats a key.
    """
    arrived = rows.groupBy(by).agg(F.count("*").alias("rows_in_file"))
    met = F.coalesce("pairs", F.when(F.col("is_first"), F.lit(0)).otherwise(F.lit(1)))
    known = (
        firsts.select(by, key, "is_first")
        .join(pairs, key, "left")
        .groupBy(by)
        .agg(
            F.count("*").alias("rows_after_dedup"),
            F.sum(met).cast("long").alias("rows_already_existing"),
            F.count_if(F.col("is_first") & F.col("pairs").isNull()).alias("rows_inserted"),
        )
    )
    return (
        arrived.join(known, by)
        .withColumn("duplicate_rows", F.col("rows_in_file") - F.col("rows_after_dedup"))
        .withColumn("rows_inserted_derived", F.col("rows_after_dedup") - F.col("rows_already_existing"))
    )


def count_by_hash(target: DataFrame, file_hash: str) -> DataFrame:
    """Target rows that came from the file with this hash, as one row ``row_count``."""
    return target.filter(F.col("file_hash") == F.lit(file_hash)).agg(
        F.count("*").alias("row_count")
    )


def key_range(df: DataFrame, key: str):
    """Smallest and largest key, for pruning a scan of a table sorted by it."""
    return df.agg(F.min(key).alias("low"), F.max(key).alias("high")).first()


def within(df: DataFrame, key: str, low, high) -> DataFrame:
    """Rows that could match keys in [low, high]; the range reaches the Parquet scan."""
    if low is None:
        return df.limit(0)
    return df.filter(F.col(key).between(F.lit(low), F.lit(high)))
