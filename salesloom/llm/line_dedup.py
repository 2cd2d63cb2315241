"""Line dedup: drop lines that a large share of a site's pages carry.

Method: site-relative frequency. Pages are grouped by host; the pages of the host that contain a line are
divided by the host's pages, and lines above ``ratio`` are boilerplate and dropped.

Pages of a host with the same body count once, above and below the line, so copies of a page don't make
its lines boilerplate. The share alone decides: a line must be on two such pages, or it would be a share of
itself, whatever the host's size, and goes from every page, also from one that has little else.

Scale: lines travel as 64-bit hashes. Counting is on (host, line, body) and then on (host, line), each
with partial sums, so neither a hot host nor a common line meets in one task. Only pages that lose lines
get a list, which is joined to them by a key of their own.

Defined cases: a line is compared without blanks at its ends; blank lines are kept and never counted; null
texts stay null and count as the empty page; a null host is a host; repeated rows get the same lines; extra columns pass through, except
those named like the result's own (``n_lines``, ``n_dropped``), which are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.llm.frames import without

_HASH = "_line"


def _lines(text: str) -> Column:
    return F.split(text, "\n")


def _hashes(text: str) -> Column:
    """Hashes of the non-blank lines."""
    # F.trim itself would take the line's index as the characters to trim.
    return F.transform(F.filter(F.transform(_lines(text), lambda x: F.trim(x)), lambda x: x != ""), lambda x: F.xxhash64(x))


def boilerplate(pages: DataFrame, ratio: float) -> DataFrame:
    """(host, line) of ``pages(_host, _body, text)`` above the ratio."""
    hosts = pages.groupBy("_host").agg(F.count_distinct("_body").alias("pages"))
    lines = pages.select("_host", "_body", F.explode(F.array_distinct(_hashes("text"))).alias(_HASH))
    counts = lines.groupBy("_host", _HASH).agg(F.count_distinct("_body").alias("found")).where("found > 1")
    return counts.join(hosts, counts["_host"].eqNullSafe(hosts["_host"])).where(F.col("found") > ratio * F.col("pages")).select(counts["_host"], _HASH)


def drop_boilerplate(docs: DataFrame, host: str | Column = "source", ratio: float = 0.05) -> DataFrame:
    """``docs`` with ``text`` without its boilerplate lines, ``n_lines`` (non-blank) and ``n_dropped``."""
    docs = without(docs, "n_lines", "n_dropped", "_host", "_body", "_key", "_drop", _HASH)
    host = F.col(host) if isinstance(host, str) else host
    pages = docs.withColumns({"_host": host, "_body": F.xxhash64(F.coalesce("text", F.lit("")))})
    found = boilerplate(pages.select("_host", "_body", "text"), ratio)
    lines = pages.select(F.xxhash64("_host", "_body").alias("_key"), "_host", F.explode(F.array_distinct(_hashes("text"))).alias(_HASH))
    hits = lines.join(found, (lines[_HASH] == found[_HASH]) & lines["_host"].eqNullSafe(found["_host"])).select("_key", lines[_HASH])
    drop = hits.groupBy("_key").agg(F.collect_set(_HASH).alias("_drop"))
    marked = pages.withColumn("_key", F.xxhash64("_host", "_body")).join(drop, "_key", "left")
    count = F.coalesce(F.size(F.filter(_lines("text"), lambda x: F.trim(x) != "")), F.lit(0)).cast("long")
    dropped = F.when(F.col("_drop").isNull(), F.lit(0)).otherwise(F.size(F.filter(_hashes("text"), lambda x: F.array_contains("_drop", x)))).cast("long")
    marked = marked.withColumn("n_lines", count).withColumn("n_dropped", dropped)
    kept = F.filter(_lines("text"), lambda x: (F.trim(x) == "") | ~F.array_contains("_drop", F.xxhash64(F.trim(x))))
    text = F.when(F.col("n_dropped") == 0, F.col("text")).otherwise(F.array_join(kept, "\n"))
    return marked.withColumn("text", text).select(*[f"`{c}`" for c in docs.columns], "n_lines", "n_dropped")
