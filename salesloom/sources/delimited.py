"""Delimited text scan without a header, split across tasks.

Spark's text source splits files by byte range.  A line's place in its file is its
split's start plus its place in the split; the few rows of per-split totals are
all that is ordered per file, so one huge file is read by many tasks.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import WindowSpec
from pyspark.sql import functions as F

from salesloom.scratch import materialise
from salesloom.sources.cells import NULL_TEXTS

SHEET = "0"
SPLIT = ["file_path", "split_start"]


def _plain_path(uri: Column) -> Column:
    """Path as other sources spell it, without percent escapes."""
    return F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def text_lines(spark: SparkSession, path: str | list[str], pattern: str = "*.csv") -> DataFrame:
    """(file_path, split_start, line_id, line): ``line_id`` rises within a split."""
    lines = (
        spark.read.option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .text(path)
    )
    return lines.select(
        _plain_path(F.col("_metadata.file_path")).alias("file_path"),
        F.col("_metadata.file_block_start").alias("split_start"),
        F.monotonically_increasing_id().alias("line_id"),
        F.col("value").alias("line"),
    )


def split_fields(line: Column, sep: str = ",") -> Column:
    """Fields of one record: quoted fields may hold separators, ``""`` in them is a quote;
    a quote inside a plain field is text."""
    s = re.escape(sep)
    quoted = '"(?:[^"]++|"")*+"'
    fields = F.regexp_extract_all(
        F.concat(F.lit(sep), line), F.lit(f'{s}((?:{quoted})?+[^{s}]*+)'), F.lit(1)
    )
    unquoted = lambda f: F.when(
        F.startswith(f, F.lit('"')),
        F.replace(
            F.regexp_replace(f, '(?s)^"((?:[^"]++|"")*+)"', "$1"), F.lit('""'), F.lit('"')
        ),
    ).otherwise(f)
    return F.transform(fields, unquoted)


def _cells(fields: Column) -> Column:
    empty = F.lit(None).cast("struct<v:string,kind:string>")
    return F.transform(
        fields,
        lambda f: F.when(f.isin(*NULL_TEXTS), empty).otherwise(
            F.struct(f.alias("v"), F.lit("str").alias("kind"))
        ),
    )


def _before(column: str):
    return F.coalesce(
        F.sum(column).over(
            W.partitionBy("file_path").orderBy("split_start").rowsBetween(W.unboundedPreceding, -1)
        ),
        F.lit(0),
    )


def _with_split(lines: DataFrame, splits: DataFrame) -> DataFrame:
    """``lines`` with the columns of their split, of which every line has one.

    An outer join, so that only the splits can be broadcast: by the size of their scratch files, which compress
    a hundredfold, the lines may seem small enough.  What is made of the splits' numbers must not be null without
    them, or a filter on it turns the join into an inner one.
    """
    return lines.na.drop(subset=SPLIT).join(splits, SPLIT, "left")


def number_lines(lines: DataFrame) -> DataFrame:
    """Records that are one line each: (file_path, row_idx, record)."""
    splits = (
        lines.groupBy(*SPLIT)
        .agg(F.min("line_id").alias("first_id"), F.count("*").alias("lines"))
        .select(*SPLIT, (_before("lines") - F.col("first_id")).alias("shift"))
    )
    return _with_split(lines, splits).select(
        "file_path",
        (F.col("line_id") + F.coalesce("shift", F.lit(0))).alias("row_idx"),
        F.col("line").alias("record"),
    )


def open_quotes(line: Column, sep: str = ",") -> tuple[Column, Column]:
    """Whether a quoted field is open after the line: if none was before it, and if one was.

    A quote opens a field only as its first character, so one inside a plain field is text.
    """
    s = re.escape(sep)
    inside = '(?:[^"]++|"")*+'
    field = f'(?:"{inside}"[^{s}]*+|(?!")[^{s}]*+)'
    fresh = line.rlike(f'^(?:{field}{s})*+"{inside}\\z')
    within = line.rlike(f'^{inside}(?:\\z|"[^{s}]*+(?:{s}{field})*+{s}"{inside}\\z)')
    return fresh.cast("int"), within.cast("int")


def _settled(rows: DataFrame, zero: str, one: str, window: WindowSpec) -> DataFrame:
    """``rows`` with the state before and after each, for either state before the first: ``before_0``, ``after_0``,
    ``before_1``, ``after_1``.  ``zero`` and ``one`` name the state after a row that begins in state 0 or 1.

    A row keeps the state, turns it, or fixes it; so the last fixed state and the turns since decide.
    """
    prior = window.rowsBetween(W.unboundedPreceding, -1)
    turn = (F.col(zero) > F.col(one)).cast("int")
    rows = rows.withColumn("turns", F.sum(turn).over(window))
    rows = rows.withColumn("fixed", F.when(F.col(zero) == F.col(one), (F.col(zero) + F.col("turns")) % 2))
    last = lambda over: F.last("fixed", ignorenulls=True).over(over)
    rows = rows.withColumns({"fixed_through": last(window), "fixed_before": last(prior)})
    states = {}
    for s in (0, 1):
        states[f"before_{s}"] = (F.coalesce("fixed_before", F.lit(s)) + F.col("turns") - turn) % 2
        states[f"after_{s}"] = (F.coalesce("fixed_through", F.lit(s)) + F.col("turns")) % 2
    return rows.withColumns(states).drop("turns", "fixed", "fixed_through", "fixed_before")


def number_records(lines: DataFrame, sep: str = ",") -> DataFrame:
    """Records whose quoted fields may run over several lines.

    A line starts a record when no quoted field is open before it.  Each split
    counts its record starts for both possible states at its first line; a pass
    over the splits' totals then settles the state.  Only lines of multi-line records are
    grouped again.
    """
    in_split = W.partitionBy(*SPLIT).orderBy("line_id")
    zero, one = open_quotes(F.col("line"), sep)
    marked = _settled(lines.withColumns({"zero": zero, "one": one}), "zero", "one", in_split)
    starts = {f"starts_{s}": F.sum((F.col(f"before_{s}") == 0).cast("long")).over(in_split) for s in (0, 1)}
    marked = marked.withColumns(starts)
    ends = marked.groupBy(*SPLIT).agg(
        F.max_by("after_0", "line_id").alias("end_0"),
        F.max_by("after_1", "line_id").alias("end_1"),
        F.max("starts_0").alias("total_0"),
        F.max("starts_1").alias("total_1"),
    )
    by_state = lambda c: F.when(F.col("state") == 0, F.col(f"{c}_0")).otherwise(F.col(f"{c}_1"))
    splits = (
        _settled(ends, "end_0", "end_1", W.partitionBy("file_path").orderBy("split_start"))
        .withColumn("state", F.col("before_0"))
        .withColumn("starts", by_state("total"))
        .withColumn("before", _before("starts"))
        .select(*SPLIT, "state", "before")
    )
    placed = _with_split(marked, splits).select(
        *SPLIT,
        "line_id",
        "line",
        (F.coalesce("before", F.lit(0)) + by_state("starts") - 1).alias("row_idx"),
        (by_state("before") == 0).alias("opens"),
        (by_state("after") == 0).alias("closes"),
    )
    whole = F.col("opens") & F.col("closes")
    single = placed.filter(whole).select("file_path", "row_idx", F.col("line").alias("record"))
    pieces = F.array_sort(F.collect_list(F.struct("split_start", "line_id", "line")))
    joined = (
        placed.filter(~whole)
        .groupBy("file_path", "row_idx")
        .agg(pieces.alias("pieces"))
        .select(
            "file_path",
            "row_idx",
            F.array_join(F.transform("pieces", lambda p: p["line"]), "\n").alias("record"),
        )
    )
    return single.unionByName(joined)


def read_records(
    spark: SparkSession, path: str | list[str], pattern: str = "*.csv", sep: str = ","
) -> DataFrame:
    """(file_path, row_idx, record) of every text file under ``path``.

    Lines are written to scratch once, so that both passes see the same splits.
    The multi-line path runs only when some line leaves a quoted field open.
    """
    lines = materialise(text_lines(spark, path, pattern), "lines")
    multi = not lines.filter(open_quotes(F.col("line"), sep)[0] == 1).isEmpty()
    return number_records(lines, sep) if multi else number_lines(lines)


def grid_of_records(records: DataFrame, sep: str = ",") -> DataFrame:
    """Grid of numbered records; a byte-order mark before the first one is dropped."""
    first = F.regexp_replace(F.col("record"), "^\ufeff", "")
    record = F.when(F.col("row_idx") == 0, first).otherwise(F.col("record"))
    return records.select(
        "file_path",
        F.lit(SHEET).alias("sheet"),
        "row_idx",
        _cells(split_fields(record, sep)).alias("cells"),
    )


def read_delimited(
    spark: SparkSession, path: str | list[str], sep: str = ",", pattern: str = "*.csv"
) -> DataFrame:
    """Grid of every delimited file under ``path``."""
    return grid_of_records(read_records(spark, path, pattern, sep), sep)
