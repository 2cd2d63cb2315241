"""Count-min sketch over 64-bit keys: which keys may occur at least twice.

Each partition sends its own sketch, the cells it hit in ascending order (about a byte a key) and
whether it hit them twice; blocks of cells are merged by adding, saturating at two. A merged cell
never underestimates: a key below two in any row occurs once. The merged sketch has ``rows`` bit
maps of ``2**bits`` bits (64 MB for 2 x 2**28), whatever the data; that bounds what is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from salesloom.llm.frames import gaps, out, rows_of, ungaps
from salesloom.llm.words import U64, mixed

SKETCHES = "block int, keys long, cells binary, twice binary"

_SHARD_BITS = 6  # a row is merged in that many blocks, as a power of two
_FLUSH = 4_000_000  # keys a task holds before it sends them
_BLOCKS = pa.schema([("block", pa.int32()), ("keys", pa.int64()), ("cells", pa.binary()), ("twice", pa.binary())])
_HOT = pa.schema([("block", pa.int32()), ("keys", pa.int64()), ("hot", pa.binary())])


def _cell(hashes: np.ndarray, row: int, bits: int) -> np.ndarray:
    return (mixed(hashes, 20 + row) >> U64(64 - bits)).astype(np.uint32)


def _shard_bits(bits: int) -> int:
    """Blocks hold whole bytes."""
    return max(min(_SHARD_BITS, bits - 3), 0)


def sketch_partition(arrays: Iterable[np.ndarray], bits: int, rows: int) -> Iterator[pa.RecordBatch]:
    """The sketch of a partition whose keys come as arrays."""
    shard_bits = _shard_bits(bits)
    edges = np.arange(2**shard_bits + 1, dtype=np.uint64) << U64(bits - shard_bits)

    def flush(held: list[np.ndarray]):
        keys = np.concatenate(held)
        for row in range(rows):
            cells = np.sort(_cell(keys, row, bits))
            new = np.flatnonzero(np.concatenate(([True], cells[1:] != cells[:-1])))
            twice = np.diff(np.append(new, len(cells))) > 1
            cells = cells[new]
            cuts = np.searchsorted(cells, edges)
            for k in np.flatnonzero(np.diff(cuts)):
                low, high = cuts[k], cuts[k + 1]
                yield out(
                    _BLOCKS,
                    block=[row * 2**shard_bits + int(k)],
                    keys=[int(high - low)],
                    cells=[gaps(cells[low:high] - np.uint32(edges[k]))],
                    twice=[np.packbits(twice[low:high]).tobytes()],
                )

    held, count = [], 0
    for keys in arrays:
        if len(keys):
            held.append(keys)
            count += len(keys)
        if count >= _FLUSH:
            yield from flush(held)
            held, count = [], 0
    if held:
        yield from flush(held)


def _merge(batches, bits: int) -> Iterator[pa.RecordBatch]:
    """Add the partitions' cells of each block; rows arrive ordered by block."""
    size = 2 ** (bits - _shard_bits(bits))
    block, keys, counts = None, 0, None

    def done():
        return out(_HOT, block=[block], keys=[keys], hot=[np.packbits(counts >= 2).tobytes()])

    for row in rows_of(batches):
        if row["block"] != block:
            if block is not None:
                yield done()
            block, keys, counts = row["block"], 0, np.zeros(size, np.uint8)
        own = ungaps(row["cells"], np.uint32)
        twice = np.unpackbits(np.frombuffer(row["twice"], np.uint8), count=len(own))
        counts[own] = np.minimum(counts[own] + 1 + twice, 2)
        keys += row["keys"]
    if block is not None:
        yield done()


def merged(partial: DataFrame, bits: int, rows: int) -> tuple[list[np.ndarray], int]:
    """Bit maps of the cells hit at least twice, one per row, and about how many keys there are."""
    shards = 2 ** _shard_bits(bits)
    blocks = (
        partial.repartition(rows * shards, "block")
        .sortWithinPartitions("block")
        .mapInArrow(lambda b: _merge(b, bits), "block int, keys long, hot binary")
    )
    width = 2**bits // shards // 8
    maps = [np.zeros(2**bits // 8, np.uint8) for _ in range(rows)]
    keys = 0
    for batch in blocks.toArrow().to_batches():  # at most rows * 2**bits bits
        for block, count, hot in zip(*batch.columns, strict=True):
            row, at = divmod(block.as_py(), shards)
            maps[row][at * width : (at + 1) * width] = np.frombuffer(hot.as_buffer(), np.uint8)
            keys += count.as_py()
    return maps, keys // rows


def repeated(keys: np.ndarray, maps: list[np.ndarray], bits: int) -> np.ndarray:
    """Whether the sketch has seen each key at least twice; true for every key that was."""
    said = np.ones(len(keys), bool)
    for row, hot in enumerate(maps):
        cell = _cell(keys, row, bits)
        said &= (hot[cell >> np.uint32(3)] >> (7 - (cell & np.uint32(7))).astype(np.uint8)) & 1 == 1
    return said
