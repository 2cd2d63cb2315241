"""Which files of a table may hold a key: per-file Bloom filters and key ranges, kept in a table beside it.

Each file's keys are cut into buckets by hash; a row of the index holds one file's keys of one bucket as packed
bits with their least and largest key. A merge deals its staged keys into the same buckets, so each task tests a
share of the staged keys against the matching share of every file. An answer "no" is certain; files that the index
does not know are always read. So an index that is behind, or has a file twice, costs time, never rows.

The index takes ``bits_per_key`` bits a key and is read by column. Null keys are in no file: they never match.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 256
BITS_PER_KEY = 24
PROBES = 12
_TURN = np.uint64(0x9E3779B97F4A7C15)


def same_path(path: str) -> str:
    """One spelling of a local file's URI."""
    return re.sub("^file:/+", "file:/", path)


def _hashed(key: str) -> tuple[Column, Column]:
    code = F.xxhash64(F.col(key).cast("string"))
    return code.alias("code"), F.pmod(code, F.lit(BUCKETS)).cast("int").alias("bucket")


def _places(codes: np.ndarray, size: int) -> np.ndarray:
    """The bits of each key in a filter of ``size`` bits, one column per probe."""
    codes = codes.astype(np.int64).view(np.uint64)[:, None]
    step = (codes * _TURN) | np.uint64(1)
    mixed = codes + step * np.arange(1, PROBES + 1, dtype=np.uint64)
    mixed ^= mixed >> np.uint64(29)
    return ((mixed * _TURN) >> np.uint64(33)) % np.uint64(size)


def _filter_of(table: pa.Table, key: str) -> pa.Table:
    codes = np.unique(table.column("code").to_numpy())
    size = max(64, len(codes) * BITS_PER_KEY)
    bits = np.zeros(size, bool)
    bits[_places(codes, size).ravel()] = True
    ends = pc.min_max(table.column(key).combine_chunks())
    columns = [table.column("file")[:1], table.column("bucket")[:1]]
    columns += [pa.array([ends[e].as_py()], table.schema.field(key).type) for e in ("min", "max")]
    columns += [pa.array([size], pa.int64()), pa.array([np.packbits(bits).tobytes()], pa.binary())]
    return pa.table(columns, names=["file", "bucket", "low", "high", "size", "bits"])


def index_rows(rows: DataFrame, key: str) -> DataFrame:
    """Index rows of ``rows(<key>, file)``: one for each file and bucket that holds a key.

    A group is one file's share of one bucket, so it is bounded by the size of a file.
    """
    kind = rows.schema[key].dataType.simpleString()
    hashed = rows.filter(F.col(key).isNotNull()).select(key, "file", *_hashed(key))
    return hashed.groupBy("file", "bucket").applyInArrow(
        lambda table: _filter_of(table, key),
        f"file string, bucket int, low {kind}, high {kind}, size long, bits binary",
    )


def refresh(spark: SparkSession, files: list[str], index: str, key: str, read) -> None:
    """Add to the ``index`` table the ``files`` that it lacks; ``read(paths)`` gives their rows."""
    if spark.catalog.tableExists(index):
        known = spark.table(index).select("file").distinct()
        paths = spark.createDataFrame([(p, same_path(p)) for p in files], "path string, file string")
        files = [r.path for r in paths.join(known, "file", "left_anti").collect()]  # names of files only
    if files:
        one = F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:/").alias("file")
        index_rows(read(files).select(key, one), key).write.mode("append").format("parquet").saveAsTable(index)


def _tested(batches, key: str) -> Iterator[pa.RecordBatch]:
    """Files that may hold a staged key; a bucket's staged keys come first, then the files' filters."""
    bucket, keys, codes, held = None, [], np.empty(0, np.int64), []
    for batch in batches:
        hits = []
        columns = {n: batch.column(n) for n in batch.schema.names}
        for i, own in enumerate(columns["bucket"].to_pylist()):
            if own != bucket:
                bucket, keys, codes, held = own, None, np.empty(0, np.int64), []
            if not columns["file"][i].is_valid:
                held.append((columns[key][i].as_py(), columns["code"][i].as_py()))
                continue
            if keys is None:
                held.sort()
                keys, codes = [k for k, _ in held], np.array([c for _, c in held], np.int64)
            low = bisect.bisect_left(keys, columns["low"][i].as_py())
            high = bisect.bisect_right(keys, columns["high"][i].as_py())
            if low < high:
                bits = np.frombuffer(columns["bits"][i].as_buffer(), np.uint8)
                places = _places(codes[low:high], columns["size"][i].as_py())
                told = (bits[places >> np.uint64(3)] >> (7 - (places & np.uint64(7))).astype(np.uint8)) & 1
                if told.all(axis=1).any():
                    hits.append(columns["file"][i].as_py())
        yield pa.RecordBatch.from_arrays([pa.array(hits, pa.string())], names=["file"])


def files_with(index: DataFrame, staged: DataFrame, key: str) -> DataFrame:
    """(file) of the indexed files that may hold a key of ``staged``."""
    keys = staged.select(key).filter(F.col(key).isNotNull()).distinct().select(key, *_hashed(key))
    both = keys.unionByName(index, allowMissingColumns=True)
    dealt = both.repartition(BUCKETS, "bucket").sortWithinPartitions("bucket", F.asc_nulls_first("file"))
    return dealt.mapInArrow(lambda batches: _tested(batches, key), "file string").distinct()


def files_to_read(spark: SparkSession, files: list[str], index: str, staged: DataFrame, key: str) -> list[str]:
    """Those of ``files`` that may hold a key of ``staged``, or that the index does not know."""
    if not files or not spark.catalog.tableExists(index):
        return files
    table = spark.table(index)
    paths = spark.createDataFrame([(p, same_path(p)) for p in files], "path string, file string")
    known = paths.join(table.select("file").distinct(), "file", "left_anti")
    held = paths.join(files_with(table, staged, key), "file", "left_semi")
    return [r.path for r in known.unionByName(held).select("path").collect()]  # names of files only
