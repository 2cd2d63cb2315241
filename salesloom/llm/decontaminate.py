"""Benchmark decontamination: passages of documents within a small edit distance of a benchmark item.

Method: windows as long as an item are embedded by CGK random walks: step j of a walk copies the symbol it
stands on and moves on or not by a bit drawn from (walk, j, symbol), so that two sequences a few edits apart
fall back into step and their embeddings have a small Hamming distance. Bit-sampling LSH on the embeddings,
repeated until a pair at the limit collides with probability ``recall``, gives the candidates; each is
verified by its exact edit distance to the best matching passage. Symbols are words, A-Z lower-cased.

Windows are taken where they can match at all: a passage within k edits of an item of n words shares at
least n - 2 - 3 k of its three-word runs on neighbouring diagonals, which loses none and spares the walk on
almost every position. The limit is k = floor(n * (1 - similarity)).

Scale: the corpus is read once and never shuffled; items travel with the tasks in blocks of at most ``block_words``
words, a pass over the corpus for each block.

Defined cases: null and empty texts match nothing; items without text or with fewer than ``min_words`` words
are not searched (``left_out`` returns the short ones); a document that holds an item several times gives its best match (the first of equal ones);
repeated rows and repeated items give a row each; extra columns of the documents are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.llm.words import U64, gram_hashes, gram_starts, mixed, split_words, text_batches, word_hashes

_RUN = 3
_MATCHES = "_id long, item_id long, start_word long, end_word long, distance int, n_words int"
_NAMES = [f.split()[0] for f in _MATCHES.split(", ")]


def passage_distance(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Least edit distance of ``item`` to a passage of ``text``, and that passage's start and end."""

    def last_row(a, b, first):
        at = np.arange(len(b) + 1)
        row = first
        for symbol in a:
            new = np.empty_like(row)
            new[0] = row[0] + 1
            new[1:] = np.minimum(row[1:] + 1, row[:-1] + (b != symbol))
            row = np.minimum.accumulate(new - at) + at
        return row

    ends = last_row(item, text, np.zeros(len(text) + 1, np.int64))
    end = int(ends.argmin())
    starts = last_row(item[::-1], text[:end][::-1], np.arange(end + 1))
    return int(ends[end]), end - int(starts.argmin()), end


class Items:
    """Benchmark items as word hashes, their three-word runs, and the LSH keys of their embeddings."""

    def __init__(self, items: list[tuple[int, str]], similarity: float, min_words: int, recall: float, sampled: int = 4, per_walk: int = 8):
        texts = pa.array([t for _, t in items], pa.string())
        self.ids, self.words = [], []
        for piece in text_batches(texts):
            words = split_words(piece, fold=True)
            hashes = word_hashes(words)
            for r in np.flatnonzero(words.counts >= min_words):
                self.ids.append(items[piece.first + r][0])
                self.words.append(hashes[words.ptr[r] : words.ptr[r + 1]])
        self.length = np.array([len(w) for w in self.words], np.int64)
        self.limit = np.floor(self.length * (1 - similarity) + 1e-9).astype(np.int64)
        self.need = np.maximum(self.length - _RUN + 1 - _RUN * self.limit, 1)
        runs = [gram_hashes(w, _RUN) for w in self.words] or [np.empty(0, U64)]
        grams = np.concatenate(runs)
        order = np.argsort(grams, kind="stable")
        self.grams = grams[order]
        self.item = np.repeat(np.arange(len(self.words)), [len(r) for r in runs[: len(self.words)]])[order]
        self.offset = np.concatenate([np.arange(len(r)) for r in runs])[order]
        self.seen = np.zeros(1 << 20, bool)
        self.seen[(self.grams >> U64(44)).astype(np.int64)] = True
        # Embeddings at the limit differ in up to half of their places.
        repetitions = math.ceil(math.log(1 - recall) / math.log(1 - 0.5**sampled))
        self.walks = -(-repetitions // per_walk)
        self.sampled, self.per_walk = sampled, per_walk
        self.padded = np.zeros((len(self.words), int(self.length.max(initial=1))), U64)
        for k, w in enumerate(self.words):
            self.padded[k, : len(w)] = w
        self.keys = [self.embedded_keys(walk, self.padded, self.length, np.arange(len(self.words))) for walk in range(self.walks)]

    def embedded_keys(self, walk: int, symbols: np.ndarray, sizes: np.ndarray, item: np.ndarray) -> np.ndarray:
        """LSH keys of each row of symbols, embedded and sampled for its item's length."""
        steps = 3 * self.length[item]
        at = np.zeros(len(symbols), np.int64)
        rows = np.arange(len(symbols))
        draw = np.stack([mixed((item_steps := self.length.astype(U64)) * U64(1000) + U64(s), 300 + walk) for s in range(self.per_walk * self.sampled)], axis=1)
        places = (draw % (3 * item_steps[:, None])).astype(np.int64)[item]
        keys = np.zeros((len(symbols), self.per_walk), U64)
        for j in range(int(steps.max(initial=0))):
            inside = at < sizes
            symbol = np.where(inside, symbols[rows, np.minimum(at, symbols.shape[1] - 1)], U64(0))
            hit = places == j
            if hit.any():
                r, s = np.nonzero(hit)
                np.add.at(keys, (r, s // self.sampled), mixed(symbol[r] + U64(j), 400) + s.astype(U64))
            at += (mixed(symbol + U64(j), 500 + walk) & U64(1)).astype(np.int64)
        return keys

    def windows(self, hashes: np.ndarray, row: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, item, diagonal) where enough runs of an item lie on neighbouring diagonals."""
        grams = gram_hashes(hashes, _RUN)[starts]
        maybe = np.flatnonzero(self.seen[(grams >> U64(44)).astype(np.int64)])
        low = np.searchsorted(self.grams, grams[maybe])
        count = np.searchsorted(self.grams, grams[maybe], "right") - low
        maybe, low, count = maybe[count > 0], low[count > 0], count[count > 0]
        entry = np.repeat(low - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum()) if len(count) else np.empty(0, np.int64)
        place = np.repeat(starts[maybe], count)
        item, diagonal = self.item[entry], place - self.offset[entry]
        row = row[place]
        width = 2 * self.limit[item] + 1
        order = np.lexsort((diagonal, item, row))
        row, item, diagonal, width = row[order], item[order], diagonal[order], width[order]
        if not len(row):
            return row, item, diagonal
        # How many runs follow within the band that starts on a run's diagonal.
        group = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (item[1:] != item[:-1]), [True])))
        keep = np.zeros(len(row), bool)
        for a, z in zip(group[:-1], group[1:], strict=True):
            need = self.need[item[a]]
            if z - a >= need:
                own = diagonal[a:z]
                reach = np.searchsorted(own, own + width[a]) - np.arange(z - a)
                for k in np.flatnonzero(reach >= need):
                    keep[a + k : a + k + reach[k]] = True
        new = np.concatenate(([True], (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (diagonal[1:] != diagonal[:-1])))
        keep &= new
        return row[keep], item[keep], diagonal[keep]

    def candidates(self, hashes: np.ndarray, ptr: np.ndarray, row, item, diagonal) -> np.ndarray:
        """Which windows share an LSH key with their item."""
        found = np.zeros(len(row), bool)
        start = np.maximum(diagonal, ptr[row])
        size = np.minimum(diagonal + self.length[item], ptr[row + 1]) - start
        for low in range(0, len(row), 20_000):
            part = slice(low, low + 20_000)
            width = int(size[part].max(initial=1))
            index = np.minimum(start[part][:, None] + np.arange(width), len(hashes) - 1)
            symbols = hashes[index]
            for walk in range(self.walks):
                left = np.flatnonzero(~found[part])
                keys = self.embedded_keys(walk, symbols[left], size[part][left], item[part][left])
                found[low + left] = (keys == self.keys[walk][item[part][left]]).any(axis=1)
        return found


def _matches(batches, items: Items) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("_id")
        for piece in text_batches(batch.column("text")):
            words = split_words(piece, fold=True)
            hashes = word_hashes(words)
            row, item, diagonal = items.windows(hashes, words.row, gram_starts(words, _RUN))
            if not len(row):
                continue
            hit = items.candidates(hashes, words.ptr, row, item, diagonal)
            best: dict[tuple[int, int], tuple[int, int, int]] = {}
            for r, k, d in zip(row[hit], item[hit], diagonal[hit], strict=True):
                limit = items.limit[k]
                low, high = max(d - limit, words.ptr[r]), min(d + items.length[k] + limit, words.ptr[r + 1])
                distance, start, end = passage_distance(items.words[k], hashes[low:high])
                if distance <= limit:
                    match = (distance, int(low + start - words.ptr[r]), int(low + end - words.ptr[r]))
                    best[r, k] = min(best.get((r, k), match), match)
            if best:
                rows, kinds = zip(*best, strict=True)
                distance, start, end = zip(*best.values(), strict=True)
                columns = [
                    ids.slice(piece.first, piece.rows).take(pa.array(rows, pa.int64())),
                    pa.array([items.ids[k] for k in kinds], pa.int64()),
                    pa.array(start, pa.int64()),
                    pa.array(end, pa.int64()),
                    pa.array(distance, pa.int32()),
                    pa.array([int(items.length[k]) for k in kinds], pa.int32()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=_NAMES)


def find_contamination(
    docs: DataFrame, items: DataFrame, similarity: float = 0.8, min_words: int = 8, recall: float = 0.99, block_words: int = 2_000_000, id: str = "doc_id"
) -> DataFrame:
    """A row per document and benchmark item found in it: the passage's first word and the one after its last, its
    edit distance in words and the item's length. ``items(item_id, text)``."""
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null")
    words = items.agg(F.sum(F.size(F.split("text", r"[\x20\x09-\x0D]+")))).first()[0] or 0
    blocks = max(1, -(-words // block_words))
    texts = docs.select(F.col(id).cast("long").alias("_id"), "text")
    found = []
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block).orderBy("item_id", "text").collect()  # about block_words words
        index = Items([(r.item_id, r.text) for r in own], similarity, min_words, recall)
        found.append(texts.mapInArrow(lambda b, i=index: _matches(b, i), _MATCHES))
    return reduce(DataFrame.unionAll, found).withColumnRenamed("_id", id)


def left_out(items: DataFrame, min_words: int = 8) -> DataFrame:
    """The items with text that ``find_contamination`` doesn't search, as they have fewer than ``min_words`` words."""
    words = F.size(F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda x: x != ""))
    return items.where((words > 0) & (words < min_words))
