"""Language ID by rank-order profiles.

Method: a profile is a language's most frequent n-grams (1 to 3 letters, word ends included) in order of
frequency. A text's own most frequent n-grams are ranked the same way, and its distance from a language is the
sum of how far each is out of place there; an n-gram missing from the profile counts as the profile's length.
The nearest language wins (ties: the first by name). The score is one minus the distance as a share of the
largest possible.

Profiles are counted over all training rows: each task adds up n-grams per language before they are shuffled,
and ranking keeps ``size`` rows per language on the map side already. The profiles, languages x size rows, are
what is sent to the tasks; a language is a label, so their number does not grow with the text.

Letters are compared in lower case. N-grams hold the low 16 bits of each character, which tells apart all of
the basic plane.

Defined cases: a text that is null or has no letter is ``und`` with score 0, so is every text if there are no
training rows; a null id is held out; extra columns pass through, except those named like the result's own,
which are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from salesloom.llm.frames import without

_LETTERS: dict[str, np.ndarray] = {}
_CHARS = 400_000  # characters handled at once


def _letters() -> np.ndarray:
    if "table" not in _LETTERS:
        _LETTERS["table"] = np.fromiter(map(str.isalpha, map(chr, range(0x110000))), bool, 0x110000)
    return _LETTERS["table"]


def _pieces(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    low, size = 0, 0
    for i, text in enumerate(texts):
        if i > low and (size + len(text or "") > _CHARS or i - low >= 60_000):
            yield low, i
            low, size = i, 0
        size += len(text or "")
    if low < len(texts):
        yield low, len(texts)


def text_grams(texts: list[str | None], owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (owner, n-gram) of texts as one ascending number each, the owner above 48 bits of n-gram, and
    their counts. Blanks stand for word ends; an n-gram has none inside and is not one."""
    lowered = [(t or "").lower() for t in texts]
    codes = np.frombuffer((" " + " ".join(lowered) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    who = np.repeat(owner, [len(t) + 1 for t in lowered]).astype(np.uint64)
    letter = _letters()[codes]
    small = np.where(letter, codes & np.uint32(0xFFFF), np.uint32(32)).astype(np.uint64)
    # Position i + 1 of codes belongs to who[i]; the blank before a text is the end of the one before it.
    a, b = small[1:-1], small[2:]
    mine = letter[1:-1]
    who = who[: len(a)]
    made = [(who << np.uint64(48) | a)[mine]]
    before, after = letter[:-2], letter[2:]
    pair = mine & after
    made.append((who << np.uint64(48) | a << np.uint64(16) | b)[pair])
    made.append((who << np.uint64(48) | np.uint64(32) << np.uint64(16) | a)[mine & ~before])
    made.append((who << np.uint64(48) | a << np.uint64(16) | np.uint64(32))[mine & ~after])
    first = small[:-2]
    made.append((who << np.uint64(48) | first << np.uint64(32) | a << np.uint64(16) | b)[mine])
    grams = np.sort(np.concatenate(made))
    new = np.flatnonzero(np.concatenate(([True], grams[1:] != grams[:-1]))) if len(grams) else np.empty(0, np.int64)
    return grams[new], np.diff(np.append(new, len(grams)))


_COUNTS = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])
_MASK = np.uint64(2**48 - 1)


def _count(batches) -> Iterator[pa.RecordBatch]:
    """Counts of n-grams per language, added up over the task."""
    names: dict[str, int] = {}
    keys, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def added():
        every = np.concatenate([keys, *[k for k, _ in held]])
        order = np.argsort(every, kind="stable")
        every = every[order]
        new = np.flatnonzero(np.concatenate(([True], every[1:] != every[:-1])))
        return every[new], np.add.reduceat(np.concatenate([counts, *[c for _, c in held]])[order], new)

    for batch in batches:
        texts, langs = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
        for low, high in _pieces(texts):
            owner = np.array([names.setdefault(x, len(names)) for x in langs[low:high]])
            held.append(text_grams(texts[low:high], owner))
            if len(held) >= 20:
                keys, counts = added()
                held = []
    if held:
        keys, counts = added()
    if len(keys):
        by = list(names)
        langs = pa.DictionaryArray.from_arrays(pa.array((keys >> np.uint64(48)).astype(np.int32)), pa.array(by, pa.string())).cast(pa.string())
        yield pa.RecordBatch.from_arrays([langs, pa.array((keys & _MASK).astype(np.int64)), pa.array(counts)], schema=_COUNTS)


def fit_profiles(docs: DataFrame, size: int = 300) -> dict[str, np.ndarray]:
    """N-grams by falling frequency of each ``lang`` of ``docs(text, lang)``."""
    counts = docs.where("lang is not null and text is not null").select("text", "lang").mapInArrow(_count, "lang string, gram long, n long")
    total = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    profiles: dict[str, list[int]] = {}
    for row in total.withColumn("rank", rank).where(F.col("rank") <= size).orderBy("lang", "rank").collect():
        profiles.setdefault(row.lang, []).append(row.gram)
    return {lang: np.array(grams, np.uint64) for lang, grams in profiles.items()}


class Profiles:
    """Ranks of all profiles' n-grams, side by side."""

    def __init__(self, profiles: dict[str, np.ndarray], size: int):
        self.langs, self.size = sorted(profiles), size
        self.grams = np.unique(np.concatenate([profiles[x] for x in self.langs])) if profiles else np.empty(0, np.uint64)
        self.ranks = np.full((len(self.grams) + 1, len(self.langs)), -1, np.int32)
        for k, lang in enumerate(self.langs):
            self.ranks[np.searchsorted(self.grams, profiles[lang]), k] = np.arange(len(profiles[lang]))

    def nearest(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        rows = len(texts)
        keys, counts = text_grams(texts, np.arange(rows))
        if not len(keys) or not self.langs:
            return ["und"] * rows, np.zeros(rows)
        owner, grams = (keys >> np.uint64(48)).astype(np.int64), keys & _MASK
        # Most frequent first within each text; equal counts stay in the order of n-grams.
        falling = (owner.astype(np.uint64) << np.uint64(32)) | (np.uint64(2**32 - 1) - counts.astype(np.uint64))
        order = np.argsort(falling, kind="stable")
        owner, grams = owner[order], grams[order]
        ptr = np.searchsorted(owner, np.arange(rows + 1))
        rank = np.arange(len(owner)) - ptr[owner]
        kept = rank < self.size
        owner, grams, rank = owner[kept], grams[kept], rank[kept]
        at = np.searchsorted(self.grams, grams)
        at[at == len(self.grams)] = 0
        at = np.where(self.grams[at] == grams, at, len(self.grams))
        place = self.ranks[at]
        away = np.where(place < 0, self.size, np.abs(place - rank[:, None]))
        total = np.stack([np.bincount(owner, away[:, k], rows) for k in range(len(self.langs))], axis=1)
        found = np.bincount(owner, minlength=rows)
        best = total.argmin(axis=1)
        score = 1 - total[np.arange(rows), best] / np.maximum(found * self.size, 1)
        return [self.langs[k] if n else "und" for k, n in zip(best, found, strict=True)], np.where(found > 0, score, 0.0)


def training_row(id: str, folds: int = 4, held_out: int = 2) -> Column:
    return F.coalesce(F.crc32(F.col(id).cast("string").cast("binary")) % folds != held_out, F.lit(False))


def identify_languages(docs: DataFrame, size: int = 300, id: str = "doc_id") -> DataFrame:
    """``docs`` without ``text``, with ``held_out``, ``lang_pred`` and ``score``; learns from the text and ``lang`` of rows
    that are not held out."""
    profiles = Profiles(fit_profiles(docs.where(training_row(id)), size), size)
    docs = without(docs, "held_out", "lang_pred", "score")
    kept = [c for c in docs.columns if c != "text"]

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            langs, scores = [], []
            for low, high in _pieces(texts):
                found, score = profiles.nearest(texts[low:high])
                langs += found
                scores.append(score)
            if texts:
                made = [pa.array(langs, pa.string()), pa.array(np.concatenate(scores))]
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *made], names=[*kept, "lang_pred", "score"])

    fields = [f for f in docs.schema.fields if f.name != "text"]
    schema = T.StructType([*fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return docs.mapInArrow(run, schema).select(*[f"`{c}`" for c in kept], (~training_row(id)).alias("held_out"), "lang_pred", "score")
