"""Quality classifier: a sparse rule ensemble over text statistics.

Method: trees are grown on the statistics of labelled texts; every path from a root to a node is a rule, a
conjunction of comparisons; a logistic regression with an L1 penalty gives most rules no weight; what is left
is compiled into one Spark column, so scoring is a projection over the statistics.

The model is fitted on at most ``sample`` labelled rows, those with the smallest hash of their id; that
bound is a parameter, and everything else covers all rows. Statistics come from whole texts in one pass.

Defined cases: null and empty texts have statistics of zero and a score like any other text; labels that are
not 0 or 1 are left out; an id labelled several times counts each time; without labels of both kinds the
score is the share of ones (0.5 without any); extra columns pass through, except those named like the
result's own, which are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesloom.llm.frames import without
from salesloom.llm.words import Batch, split_words, text_batches, word_hashes
from salesloom.scratch import materialise

STATISTICS = (
    "log_words",
    "word_length",
    "distinct_words",
    "top_word",
    "upper_share",
    "digit_share",
    "symbol_share",
    "stop_share",
    "blank_share",
    "lines_per_word",
    "repeated_neighbours",
    "long_words",
    "symbol_words",
)
_KIND = np.zeros(256, np.uint8)  # 1 upper case, 2 digit, 3 other printable ASCII, 4 full stop or comma, 5 blank
_KIND[33:127] = 3
_KIND[65:91] = 1
_KIND[97:123] = 0
_KIND[48:58] = 2
_KIND[[44, 46]] = 4
_KIND[[9, 10, 11, 12, 13, 32]] = 5


def text_statistics(piece: Batch) -> np.ndarray:
    """A row of ``STATISTICS`` for each text."""
    words, rows = split_words(piece), piece.rows
    hashes, counts = word_hashes(words), words.counts
    row = words.row
    size = np.diff(piece.offsets)
    byte_row = np.repeat(np.arange(rows), size)
    kinds = _KIND[piece.data]

    def per_byte(mask: np.ndarray) -> np.ndarray:
        return np.bincount(byte_row[mask], minlength=rows)

    distinct, top = np.zeros(rows), np.zeros(rows)
    for r in np.flatnonzero(counts):
        own = np.sort(hashes[words.ptr[r] : words.ptr[r + 1]])
        new = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1], [True])))
        distinct[r] = len(new) - 1
        top[r] = np.diff(new).max()
    same = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
    lengths = words.end - words.start
    ends_odd = (kinds[words.end - 1] == 3) if len(words.end) else np.empty(0, bool)
    n, b = np.maximum(counts, 1), np.maximum(size, 1)
    return np.column_stack(
        [
            np.log1p(counts),
            np.bincount(row, lengths, rows) / n,
            distinct / n,
            top / n,
            per_byte(kinds == 1) / b,
            per_byte(kinds == 2) / b,
            per_byte(kinds == 3) / b,
            per_byte(kinds == 4) / b,
            per_byte(kinds == 5) / b,
            per_byte(piece.data == 10) / n,
            np.bincount(row[1:][same], minlength=rows) / n,
            np.bincount(row[lengths > 20], minlength=rows) / n,
            np.bincount(row[ends_odd], minlength=rows) / n,
        ]
    )


def with_statistics(docs: DataFrame) -> DataFrame:
    """``docs`` without ``text`` and with the statistics of it."""
    docs = without(docs, *STATISTICS)
    kept = [c for c in docs.columns if c != "text"]

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [text_statistics(piece) for piece in text_batches(batch.column("text"))]
            if made:
                table = np.concatenate(made)
                columns = [batch.column(c) for c in kept] + [pa.array(table[:, k].copy()) for k in range(len(STATISTICS))]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, *STATISTICS])

    fields = [f for f in docs.schema.fields if f.name != "text"]
    return docs.mapInArrow(run, T.StructType([*fields, *[T.StructField(c, T.DoubleType()) for c in STATISTICS]]))


class Condition(NamedTuple):
    statistic: int
    above: bool
    threshold: float


class Rules(NamedTuple):
    """Weighted conjunctions; the weight of the empty one is the intercept."""

    terms: tuple[tuple[tuple[Condition, ...], float], ...]

    def score(self) -> Column:
        total = reduce(lambda a, b: a + b, [F.lit(w) if not r else F.when(_holds(r), F.lit(w)).otherwise(F.lit(0.0)) for r, w in self.terms], F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def _holds(rule: tuple[Condition, ...]) -> Column:
    tests = [F.col(STATISTICS[c.statistic]) > c.threshold if c.above else F.col(STATISTICS[c.statistic]) <= c.threshold for c in rule]
    return reduce(lambda a, b: a & b, tests)


def _paths(node, path: tuple[Condition, ...] = ()) -> Iterator[tuple[Condition, ...]]:
    """Rules of a tree: the path to every node below the root, one condition per statistic and side."""
    if path:
        tight: dict[tuple[int, bool], float] = {}
        for c in path:
            key = (c.statistic, c.above)
            have = tight.get(key)
            tight[key] = c.threshold if have is None else (max(have, c.threshold) if c.above else min(have, c.threshold))
        yield tuple(Condition(s, a, t) for (s, a), t in sorted(tight.items()))
    if node.numDescendants() > 0:
        split = node.split()
        at, threshold = split.featureIndex(), split.threshold()
        yield from _paths(node.leftChild(), (*path, Condition(at, False, threshold)))
        yield from _paths(node.rightChild(), (*path, Condition(at, True, threshold)))


def fit_rules(labelled: DataFrame, trees: int = 8, depth: int = 3, penalty: float = 0.0005) -> Rules:
    """Rules from rows with the statistics and a ``label`` of 0 or 1; the rows are few (a bounded sample)."""
    labelled = materialise(labelled.select(F.col("label").cast("double").alias("label"), *STATISTICS).orderBy("label", *STATISTICS), "labelled")
    share = labelled.agg(F.avg("label"), F.count("*")).first()
    if share[0] in (None, 0.0, 1.0):
        odds = {None: 0.0, 0.0: -math.inf, 1.0: math.inf}[share[0]]
        return Rules((((), odds),))
    vectors = VectorAssembler(inputCols=list(STATISTICS), outputCol="features").transform(labelled)
    grown = GBTClassifier(maxIter=trees, maxDepth=depth, seed=1, maxBins=64).fit(vectors)
    rules = sorted({rule for tree in grown.trees for rule in _paths(tree._call_java("rootNode"))})
    if not rules:
        return Rules((((), math.log(share[0] / (1 - share[0]))),))
    held = F.array(*[_holds(r).cast("double") for r in rules])
    table = materialise(labelled.select("label", held.alias("held")), "rules")
    fitted = LogisticRegression(featuresCol="vector", elasticNetParam=1.0, regParam=penalty, standardization=False, maxIter=60).fit(
        table.select("label", array_to_vector("held").alias("vector"))
    )
    weights = [(rule, float(w)) for rule, w in zip(rules, fitted.coefficients.toArray(), strict=True) if w]
    return Rules((((), float(fitted.intercept)), *weights))


def training_row(id: str, folds: int = 4, held_out: int = 2) -> Column:
    return F.crc32(F.col(id).cast("string").cast("binary")) % folds != held_out


def learn(docs: DataFrame, labels: DataFrame, sample: int = 20_000, id: str = "doc_id") -> Rules:
    """Rules learned from ``labels(id, quality)`` of rows that are not held out."""
    chosen = labels.select(F.col(id).alias("_id"), F.col("quality").alias("label")).where("label in (0, 1)").where(training_row("_id"))
    chosen = chosen.orderBy(F.xxhash64("_id"), "label").limit(sample)  # what is broadcast: an id and a label each
    labelled = docs.select(F.col(id).alias("_id"), "text").join(F.broadcast(chosen), "_id").select("label", "text")
    # Ids repeated in the documents would multiply the rows, so the sample is bounded again.
    return fit_rules(with_statistics(labelled).orderBy(F.xxhash64(*STATISTICS), "label").limit(sample))


def _aside(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with its own columns that are named like a statistic renamed, and their names."""
    taken = {s.lower() for s in STATISTICS}
    own = {f"_own_{i}": c for i, c in enumerate(docs.columns) if c.lower() in taken}
    return docs.withColumnsRenamed({c: n for n, c in own.items()}), own


def score_quality(docs: DataFrame, labels: DataFrame, sample: int = 20_000, id: str = "doc_id", threshold: float = 0.7) -> DataFrame:
    """``docs`` without ``text``, with ``held_out`` (a null id is), ``score`` (that the label is 1) and ``predicted``."""
    rules = learn(docs, labels, sample, id)
    docs, own = _aside(without(docs, "held_out", "score", "predicted"))
    kept = [f"`{c}`" for c in docs.columns if c != "text"]
    scored = with_statistics(docs).withColumn("held_out", F.coalesce(~training_row(id), F.lit(True))).withColumn("score", rules.score())
    return scored.select(*kept, "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted")).withColumnsRenamed(own)


def keep_quality(docs: DataFrame, labels: DataFrame, sample: int = 20_000, id: str = "doc_id", threshold: float = 0.7) -> DataFrame:
    """The documents with a score of at least ``threshold``, with their own columns."""
    rules = learn(docs, labels, sample, id)
    docs, own = _aside(docs)
    return with_statistics(docs.withColumn("_text", F.col("text"))).where(rules.score() >= threshold).select(
        *[(F.col("_text").alias("text") if c == "text" else F.col(f"`{c}`")) for c in docs.columns]
    ).withColumnsRenamed(own)
