"""Document fingerprints by winnowing, in column expressions.

Method: hashes of all runs of ``k`` words; of every ``window`` consecutive ones the smallest is chosen, the
rightmost of equal ones, and its position is kept. Any run of ``k + window - 1`` words that two texts share
therefore gives them a common fingerprint, and no shared run under ``k`` words can.

A chosen hash and its position are one number: 32 bits of hash above the position counted from the far end,
so that the smallest number is the smallest hash and among equal hashes the rightmost.

Scale: fingerprints are row-wise; texts are shuffled once, to meet their neighbours by key. Order by id is
taken from ids alone: range-partitioned, numbered within partitions, with the partitions' first rows (one
each) joining the ends.

Defined cases: null and empty texts have no words and an empty fingerprint; a text of fewer than ``k`` words has
one gram, all its words; two empty fingerprints are alike (1.0), an empty and another one not (0.0). Rows
of the same id and text are one document in the order of ids; rows of the same id are ordered by a hash of
their texts; null ids come last. Extra columns are left out of the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from salesloom.scratch import materialise

_BITS = 31  # of the position
_LAST = 2**_BITS - 1


def _bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _packed(grams: Column) -> Column:
    return F.transform(grams, lambda g, i: F.shiftleft(F.shiftrightunsigned(g, 32), _BITS).bitwiseOR(F.lit(_LAST) - i.cast("long")))


def _grams(hashes: Column, k: int) -> Column:
    runs = F.transform(F.sequence(F.lit(0), F.size(hashes) - k), lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(k)]))
    whole = F.array(F.xxhash64(hashes))
    return F.when(F.size(hashes) >= k, runs).when(F.size(hashes) > 0, whole).otherwise(F.array().cast("array<bigint>"))


def _pairwise(values: Column, step: int) -> Column:
    """Each value or, if smaller, the one ``step`` places on."""
    return F.transform(values, lambda v, i: F.least(v, F.get(values, i + step)))


def _minima(packed: Column, window: int) -> Column:
    """Minimum of the ``window`` values from each place on, from minima over 1, 2, 4, ... of them."""

    def widened(values: Column, width: int) -> Column:
        if width == window:
            return values
        step = min(width, window - width)
        return _bound(_pairwise(values, step), lambda wider: widened(wider, width + step))

    return widened(packed, 1)


def _chosen(packed: Column, window: int) -> Column:
    whole = F.slice(_minima(packed, window), F.lit(1), F.greatest(F.size(packed) - (window - 1), F.lit(1)))
    return F.when(F.size(packed) > 0, F.array_distinct(whole)).otherwise(packed)


def winnow(text: str | Column, k: int = 5, window: int = 16) -> Column:
    """Fingerprint of a text: chosen hashes with positions, as an array of longs."""
    text = F.col(text) if isinstance(text, str) else text
    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return _bound(_bound(hashes, lambda h: _packed(_grams(h, k))), lambda p: _chosen(p, window))


def shown(fingerprint: str) -> Column:
    """Text form: hash in hexadecimal, ``@``, position of the gram's first word."""
    mark = lambda x: F.concat(F.lower(F.lpad(F.hex(F.shiftright(x, _BITS)), 8, "0")), F.lit("@"), (F.lit(_LAST) - x.bitwiseAND(F.lit(_LAST))).cast("string"))
    return F.array_join(F.transform(fingerprint, mark), " ")


def likeness(a: str, b: str) -> Column:
    """Share of common hashes among all of two fingerprints."""
    left, right = (F.transform(x, lambda v: F.shiftright(v, _BITS)) for x in (a, b))
    both = F.size(F.array_union(left, right))
    return F.when(both == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(left, right)) / both)


def following(ids: DataFrame) -> DataFrame:
    """For distinct ``ids(_id, _key, _n)``: the next row in descending order (``next_id``, ``next_key``), after
    the last the first, and for that row this one's (``_n``)."""
    parts = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = ids.repartitionByRange(parts, F.desc_nulls_last("_id"), F.asc("_key")).sortWithinPartitions(F.desc_nulls_last("_id"), F.asc("_key"))
    ordered = materialise(ordered.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("seq")), "ordered")
    row = F.struct("_id", "_key")
    inside = ordered.withColumn("next", F.lead(row).over(Window.partitionBy("part").orderBy("seq")))
    firsts = ordered.groupBy("part").agg(F.min_by(row, "seq").alias("first"))  # a row per partition
    chain = Window.orderBy("part")
    firsts = firsts.withColumn("after", F.lead("first").over(chain)).withColumn("start", F.min_by("first", "part").over(Window.orderBy(F.lit(1))))
    ends = firsts.select("part", F.coalesce("after", "start").alias("end"))
    return inside.join(ends, "part").select("_id", "_key", "_n", F.coalesce("next", "end").alias("next"))


def compare_with_edited(docs: DataFrame, k: int = 5, window: int = 16, id: str = "doc_id") -> DataFrame:
    """Fingerprints of each text and of its edited text: the last third of its characters replaced by as many
    first ones of the next document's, in descending order of ids."""
    texts = docs.select(F.struct(F.col(id).alias("id")).alias("_id"), F.xxhash64(F.col(id), F.col("text")).alias("_key"), F.coalesce("text", F.lit("")).alias("text"))
    after = following(texts.select(F.col("_id.id").alias("_id"), "_key", F.length("text").alias("_n")).distinct())
    after = after.select(F.struct(F.col("_id").alias("id")).alias("_id"), "_key", F.col("next._key").alias("next_key"), F.floor(F.col("_n") / 3).cast("int").alias("cut"))
    after = materialise(after, "after")
    before = after.select(F.col("next_key").alias("_key"), F.col("_key").alias("last_key"), F.col("_id").alias("last_id"), F.col("cut").alias("last_cut"))
    # Both roles of a text, as the next of one and itself, read one shuffle: the join is on the same columns.
    linked = texts.withColumn("own", winnow("text", k, window)).join(after.join(before, "_key"), ["_key", "_id"])
    heads = linked.select(F.col("last_key").alias("_key"), F.col("last_id").alias("_id"), F.expr("substring(text, 1, last_cut)").alias("head"), F.col("own").alias("next_own"))
    heads = heads.dropDuplicates(["_key", "_id"])
    edited = F.concat(F.expr("substring(text, 1, length(text) - cut)"), F.col("head"))
    pairs = linked.join(heads, ["_key", "_id"]).select("_id.id", "text", "own", "next_own", edited.alias("edited"))
    pairs = pairs.withColumn("edited_own", winnow("edited", k, window))
    return pairs.select(
        F.col("id").alias(id),
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        shown("own").alias("fingerprint"),
        shown("edited_own").alias("edited_fingerprint"),
        likeness("own", "edited_own").alias("near_edited"),
        likeness("own", "next_own").alias("near_next"),
    )
