"""Documents to training tokens: quality, lines, near duplicates, benchmark passages, encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from salesloom.llm import bpe, decontaminate, line_dedup, ngram_join, quality
from salesloom.llm.frames import read
from salesloom.llm.queries import codec
from salesloom.scratch import materialise

ORACLE_SQL = None  # fitted rules, components and encoding have no SQL


def _row_key():
    return F.xxhash64("doc_id", "text")


def keep_quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.keep_quality(docs, read(spark, folder, "labels"))


def drop_lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without the boilerplate lines of their source."""
    kept = line_dedup.drop_boilerplate(docs, "source").select(*docs.columns)
    return kept.withColumn("n_chars", F.length("text").cast("long"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of each group of near duplicates the document of the smallest id; texts without words all stay."""
    found = ngram_join.near_duplicates(docs, words=5, percent=80)
    first = found.where("group is not null").groupBy("group").agg(F.min(F.struct("doc_id", "row_key"))["row_key"].alias("_row"))
    stay = materialise(first.select("_row").unionAll(found.where("group is null").select(F.col("row_key").alias("_row"))).distinct(), "stay")
    rows = docs.withColumn("_row", _row_key()).join(stay, "_row", "left_semi")
    # Repeated rows share a key.
    copy = F.row_number().over(Window.partitionBy("_row").orderBy("_row"))
    wordless = F.coalesce(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(True))
    return rows.withColumn("_copy", copy).where((F.col("_copy") == 1) | wordless).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    rows = docs.withColumn("_row", _row_key())
    found = decontaminate.find_contamination(rows, read(spark, folder, "benchmark"), id="_row")
    return rows.join(materialise(found.select("_row").distinct(), "contaminated"), "_row", "left_anti").select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token counts and digests of the ids and of the bytes they decode to."""
    return bpe.round_trip(docs.select("doc_id", "text"), codec())


STAGES = [
    ("quality", keep_quality),
    ("lines", drop_lines),
    ("near_duplicates", one_of_each_group),
    ("decontamination", drop_contaminated),
    ("byte_bpe", encode),
]


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, folder), name)
    return docs
