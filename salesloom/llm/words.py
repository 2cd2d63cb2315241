"""Words and their hashes over whole Arrow batches of texts, without a Python loop per word.

A word is a maximal run of bytes outside space, tab, line feed, vertical tab, form feed and
carriage return. Texts are UTF-8, so a word never splits a character. Null texts have no words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BLANK = [9, 10, 11, 12, 13, 32]


def _mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: every input bit reaches every output bit."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    return _mixed(x + U64((0x9E3779B97F4A7C15 * (2 * seed + 1)) % 2**64))


def _odd(seed: int) -> int:
    return int(mixed(np.arange(1, dtype=U64), 1000 + seed)[0]) | 1


@dataclass
class Batch:
    """Texts of consecutive rows: bytes ``data``, row ``i`` at ``offsets[i]:offsets[i + 1]``."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1


def text_batches(texts: pa.Array, size: int = 1 << 18) -> Iterator[Batch]:
    """Whole rows in pieces of about ``size`` bytes; a longer text is a piece of its own."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    _, places, content = texts.buffers()
    offsets = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(content, np.uint8) if content is not None else np.empty(0, np.uint8)
    low = 0
    while low < len(texts):
        high = int(np.searchsorted(offsets, offsets[low] + size, "right")) - 1
        high = min(max(high, low + 1), len(texts))
        yield Batch(low, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
        low = high


_SOLID = np.ones(256, bool)
_SOLID[_BLANK] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


@dataclass
class Words:
    """Word ``i`` is ``data[start[i]:end[i]]``; row ``r`` holds words ``ptr[r]:ptr[r + 1]``."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    ptr: np.ndarray

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.ptr) - 1), np.diff(self.ptr))

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.ptr)


def split_words(batch: Batch, fold: bool = False) -> Words:
    data = lower_ascii(batch.data) if fold else batch.data
    solid = _SOLID[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[batch.offsets] = True
    before = np.zeros(len(data), bool)
    before[1:] = solid[:-1]
    start = np.flatnonzero(solid & (edge[:-1] | ~before))
    after = np.zeros(len(data), bool)
    after[:-1] = solid[1:]
    end = np.flatnonzero(solid & (edge[1:] | ~after)) + 1
    return Words(data, batch.offsets, start, end, np.searchsorted(start, batch.offsets))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2^64."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        n = max(n, (1 << 18) + 1)
        both = []
        for b in (base, pow(base, -1, 2**64)):
            steps = np.full(n, b, U64)
            steps[0] = 1
            both.append(np.cumprod(steps, dtype=U64))
        _POWERS[base] = have = (both[0], both[1])
    return have


def _spans(values: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hash modulo 2^64 of each span, from one prefix sum."""
    up, down = _powers(base, len(values) + 1)
    sums = np.zeros(len(values) + 1, U64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return (sums[end] - sums[start]) * down[start]


def word_hashes(words: Words, seed: int = 0) -> np.ndarray:
    """64-bit hash of each word's bytes."""
    table = mixed(np.arange(256, dtype=U64), 2 * seed + 1)
    return mixed(_spans(table[words.data], words.start, words.end, _odd(2 * seed)), seed)


def gram_hashes(hashes: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Hash of each run of ``n`` consecutive hashes; runs over row ends are for the caller to leave out."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.empty(0, U64)
    base = _odd(2 * seed + 1)
    if n <= 8:
        total = np.zeros(count, U64)
        for k in range(n):
            total = total * U64(base) + hashes[k : k + count]
    else:
        at = np.arange(count)
        total = _spans(hashes, at, at + n, base)
    return mixed(total, seed + 7)


def gram_starts(words: Words, n: int) -> np.ndarray:
    """Word positions at which ``n`` consecutive words of one row begin."""
    counts = np.maximum(words.counts - n + 1, 0)
    first = np.repeat(words.ptr[:-1] - np.concatenate(([0], np.cumsum(counts)[:-1])), counts)
    return first + np.arange(counts.sum())


def joined_words(words: Words, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the kept words of each row joined by one space, and the rows' offsets in them."""
    size = len(words.data)
    change = np.zeros(size + 1, np.int8)
    chosen = np.flatnonzero(kept)
    change[words.start[chosen]] = 1
    change[words.end[chosen]] -= 1
    mask = np.zeros(size + 1, bool)
    mask[:size] = np.cumsum(change[:size], dtype=np.int8).astype(bool)
    row = words.row[chosen]
    followed = chosen[:-1][row[:-1] == row[1:]] if len(chosen) else chosen
    mask[words.end[followed]] = True
    data = np.append(np.where(_SOLID[words.data], words.data, np.uint8(32)), np.uint8(32))[mask]
    places = np.concatenate(([0], np.cumsum(mask)))[words.offsets]
    return data, places
