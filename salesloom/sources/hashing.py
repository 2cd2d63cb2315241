"""Content digests of files, computed by Spark."""

from __future__ import annotations

import codecs
import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WHOLE_BYTES = 1 << 24  # of a file that is hashed as one value
SHA2_BITS = {"sha224": 224, "sha256": 256, "sha384": 384, "sha512": 512}


def digest(content: Column, algorithm: str = "sha256") -> Column:
    """Hex digest by one of Spark's own hash functions."""
    name = algorithm.lower().replace("-", "")
    if name in SHA2_BITS:
        return F.sha2(content, SHA2_BITS[name])
    if name == "md5":
        return F.md5(content)
    if name == "sha1":
        return F.sha1(content)
    raise ValueError(f"Not a built-in hash: {algorithm}")


def _content(column: pa.Array) -> memoryview:
    """The values of a binary column without nulls, one behind the other."""
    kind = "q" if pa.types.is_large_binary(column.type) else "i"
    offsets = memoryview(column.buffers()[1]).cast("B").cast(kind)
    return memoryview(column.buffers()[2])[offsets[column.offset] : offsets[column.offset + len(column)]]


def _row(path: str, state) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([path], pa.string()), pa.array([state.hexdigest()], pa.string())], ["file_path", "file_hash"]
    )


def _hash_lines(batches: Iterable[pa.RecordBatch], algorithm: str, known: dict) -> Iterator[pa.RecordBatch]:
    """Digests of files from their lines in order, each with a line feed behind it.  ``known`` has, by URI, a file's
    path, its length and whether it begins with a byte-order mark, which Spark's reader leaves out."""
    at, state, seen = None, None, 0

    def ended():
        path, length, marked = known[at]
        size = seen + len(codecs.BOM_UTF8) * marked
        if size == length:
            state.update(b"\n")
        elif size != length + 1:  # the last line has no line feed in the file
            raise ValueError(f"{path} has {length} bytes, {size} were read")
        return _row(path, state)

    for batch in batches:
        uris, low = batch.column("uri"), 0
        while low < batch.num_rows:
            uri = uris[low].as_py()
            high = batch.num_rows
            if uris[high - 1].as_py() != uri:  # a file's lines are one behind the other
                high = next(i for i in range(low, high) if uris[i].as_py() != uri)
            if uri != at:
                if at is not None:
                    yield ended()
                at, seen = uri, 0
                state = hashlib.new(algorithm, codecs.BOM_UTF8 if known[uri][2] else b"")
            piece = _content(batch.column("line").slice(low, high - low))
            if seen:
                state.update(b"\n")
            state.update(piece[:-1])  # the last line feed waits until it is known that the file has it
            seen += len(piece)
            low = high
    if at is not None:
        yield ended()


def _long_files(spark: SparkSession, files: list, algorithm: str) -> DataFrame:
    """(file_path, file_hash) of ``files(path, length)``, each read front to back in one task that holds some lines.

    Spark's line reader takes the files for compressed ones, by a codec that passes bytes on: it neither splits nor
    unpacks them.  A codec is told by what follows a point; names without one are split, their lines sorted.
    """
    hadoop, known, suffixes = spark._jvm.org.apache.hadoop, {}, {}
    for path, length in files:
        place = hadoop.fs.Path(path)
        stream = place.getFileSystem(spark._jsc.hadoopConfiguration()).open(place)
        marked = all(stream.read() == byte for byte in codecs.BOM_UTF8)
        stream.close()
        known[place.toUri().toString()] = (path, length, marked)
        point, ending = place.getName().rpartition(".")[1:]
        suffixes.setdefault(point and point + ending, []).append(path)

    def lines(suffix, paths):
        read = spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true")
        if suffix:
            whole = hadoop.io.compress.PassthroughCodec
            read = read.option("io.compression.codecs", whole.CLASSNAME).option(whole.OPT_EXTENSION, suffix)
        rows = read.text([re.sub(r"([\\{}\[\]*?])", r"\\\1", p) for p in paths]).select(
            F.col("_metadata.file_path").alias("uri"),
            F.col("_metadata.file_block_start").alias("split_start"),
            F.concat(F.col("value").cast("binary"), F.lit(b"\n")).alias("line"),
        )
        if not suffix:
            place = ["uri", "split_start", "line_id"]
            rows = rows.withColumn("line_id", F.monotonically_increasing_id())
            rows = rows.repartition("uri").sortWithinPartitions(*place)
        return rows.select("uri", "line")

    hashed = lambda batches: _hash_lines(batches, algorithm, known)
    every = [lines(*x).mapInArrow(hashed, "file_path string, file_hash string") for x in suffixes.items()]
    return reduce(DataFrame.unionByName, every)


def file_hashes(files: DataFrame, algorithm: str = "sha256", whole: int = WHOLE_BYTES) -> DataFrame:
    """(file_path, file_hash) of a ``binaryFile`` DataFrame, for any hashlib algorithm.

    Files of up to ``whole`` bytes are hashed as one value; longer ones are read again by lines, so that a task holds
    a piece of them.  What lies between two line feeds is held at once.
    """
    whole = max(whole, len(codecs.BOM_UTF8))  # a mark alone is no line
    long = files.where(F.col("length") > whole).select("path", "length").collect()
    short = files.where(F.col("length") <= whole) if long else files
    path = F.col("path").alias("file_path")
    try:
        hashes = short.select(path, digest(F.col("content"), algorithm).alias("file_hash"))
        algorithm = algorithm.lower().replace("-", "")
    except ValueError:
        hashlib.new(algorithm)  # unknown names fail here, on the driver

        def hashed(batches):
            for batch in batches:
                digests = [
                    hashlib.new(algorithm, c.as_buffer()).hexdigest() for c in batch.column("content")
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("path"), pa.array(digests, pa.string())], ["file_path", "file_hash"]
                )

        hashes = short.select("path", "content").mapInArrow(hashed, "file_path string, file_hash string")
    return hashes.unionByName(_long_files(files.sparkSession, long, algorithm)) if long else hashes


def line_fingerprints(lines: DataFrame) -> DataFrame:
    """(file_path, file_hash) from numbered records, for text files of any size.

    A byte digest has to read a file front to back in one task; this one combines
    per-record hashes of (position, text), so a file of any size is hashed in
    parallel.  Equal files give equal values; the value is not the byte digest.
    """
    each = F.xxhash64("row_idx", "record")
    other = F.xxhash64("record", "row_idx")
    return lines.groupBy("file_path").agg(
        F.sha2(
            F.concat_ws(
                ":", F.count("*"), F.bit_xor(each), F.bit_xor(other), F.sum(F.length("record"))
            ),
            256,
        ).alias("file_hash")
    )
