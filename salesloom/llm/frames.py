"""Small helpers shared by the operators: table access, column order, packed arrays."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns that an operator is about to add under these names."""
    taken = {n.lower() for n in names}
    return df.select(*[f"`{c}`" for c in df.columns if c.lower() not in taken])


def planes(values: np.ndarray) -> bytes:
    """Integers byte plane by byte plane: the mostly empty high bytes compress to nothing."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes()


def unplanes(content: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    flat = np.frombuffer(content, np.uint8).reshape(size, -1)
    return np.ascontiguousarray(flat.T).view(kind).reshape(-1)


def gaps(ascending: np.ndarray) -> bytes:
    return planes(np.diff(ascending, prepend=ascending.dtype.type(0)))


def ungaps(content: bytes, kind: type) -> np.ndarray:
    return np.cumsum(unplanes(content, kind), dtype=kind)


def packed(values: np.ndarray) -> bytes:
    """``planes`` without the high ones that hold zeros only, behind the number of those left."""
    each = values.view(np.uint8).reshape(len(values), values.itemsize).T
    used = max((k + 1 for k in range(len(each)) if each[k].any()), default=0)
    return bytes([used]) + np.ascontiguousarray(each[:used]).tobytes() + (b"" if used else len(values).to_bytes(8, "little"))


def unpacked(content: bytes, kind: type) -> np.ndarray:
    used = content[0]
    if not used:
        return np.zeros(int.from_bytes(content[1:9], "little"), kind)
    flat = np.frombuffer(content, np.uint8, offset=1).reshape(used, -1)
    whole = np.zeros((flat.shape[1], np.dtype(kind).itemsize), np.uint8)
    whole[:, :used] = flat.T
    return whole.view(kind).reshape(-1)


def packed_gaps(ascending: np.ndarray) -> bytes:
    return packed(np.diff(ascending, prepend=ascending.dtype.type(0)))


def unpacked_gaps(content: bytes, kind: type) -> np.ndarray:
    return np.cumsum(unpacked(content, kind), dtype=kind)


def rows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    """Rows of batches whose rows are few and hold whole arrays."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(k)[i].as_py() for k, name in enumerate(batch.schema.names)}


def out(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)
