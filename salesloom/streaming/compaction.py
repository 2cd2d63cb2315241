"""Compaction of a stream's target while the stream goes on.

Each micro-batch of a merging stream leaves a folder ``batch=<id>``: many small files, each sorted by key by itself.
``compact`` merges the batches up to one of them into key-ranged, key-sorted files under ``base=<n>`` and then
switches the target to them by one manifest file, ``_manifests/<n>.json``, made under another name and renamed.
Readers (``read_compacted``) take the newest manifest's base and the batches after those it covers, so a crash
leaves the old state or the new one, never parts of both, and no reader sees a row twice.

What a base covers is deleted later (``expire``), by the manifest before the newest one, so that a reader who
has listed the files of the state before can finish. A batch that the stream replays after its compaction is
recognised by its number: it is covered, so it's neither read nor merged again.

One compaction of a target runs at a time; the stream may write its batches meanwhile.
"""

from __future__ import annotations

import json
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from salesloom.operators.incremental import keep_first, key_range, new_rows, within

BATCH = "batch"
MANIFESTS = "_manifests"
NOTHING = {"number": 0, "base": None, "covers": -1}


def _files(spark: SparkSession, path: str):
    """The target's file system and its path there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _child(spark: SparkSession, path: str, *names: str):
    return spark._jvm.org.apache.hadoop.fs.Path("/".join([path.rstrip("/"), *names]))


def _listed(spark: SparkSession, path: str) -> list[str]:
    """Names directly under ``path``; none where it is absent."""
    system, place = _files(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(place)) if system.exists(place) else []


def _numbers(names: list[str], prefix: str, suffix: str = "") -> list[int]:
    bare = [n[len(prefix) : len(n) - len(suffix)] for n in names if n.startswith(prefix) and n.endswith(suffix)]
    return sorted(int(n) for n in bare if n.isdigit())


def manifests(spark: SparkSession, path: str) -> list[dict]:
    """All manifests of a target, oldest first: number, base folder, last batch covered."""
    folder = f"{path.rstrip('/')}/{MANIFESTS}"
    numbers = _numbers(_listed(spark, folder), "", ".json")
    if not numbers:
        return []
    lines = spark.read.text([f"{folder}/{n}.json" for n in numbers], wholetext=True).collect()
    return sorted((json.loads(r[0]) for r in lines), key=lambda m: m["number"])


def current(spark: SparkSession, path: str) -> dict:
    return (manifests(spark, path) or [NOTHING])[-1]


def _live(spark: SparkSession, path: str, state: dict, but: int | None = None, upto: int | None = None) -> list[str]:
    """Folders that make up the target now, but for batch ``but`` and those after ``upto``."""
    batches = [n for n in _numbers(_listed(spark, path), f"{BATCH}=") if n > state["covers"] and n != but]
    folders = [f"{BATCH}={n}" for n in batches if upto is None or n <= upto]
    return [f"{path.rstrip('/')}/{n}" for n in ([state["base"]] if state["base"] else []) + folders]


def _rows(spark: SparkSession, folders: list[str], schema: T.StructType) -> DataFrame:
    """Rows of the folders; a schema is given, so that no file is opened to infer one."""
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def read_compacted(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The merged table so far; empty before the first batch."""
    return _rows(spark, _live(spark, path, current(spark, path)), schema)


def merge_batch(batch: DataFrame, batch_id: int, path: str, key: str, order: list[str]) -> None:
    """Insert the batch's unseen keys as ``batch=<id>``, compared with the base and the other batches.

    A replayed batch overwrites its folder; one that a base covers already changes nothing.
    """
    spark = batch.sparkSession
    state = current(spark, path)
    if batch_id <= state["covers"]:
        return
    target = _rows(spark, _live(spark, path, state, but=batch_id), batch.schema)
    span = key_range(batch, key)
    fresh = new_rows(keep_first(batch, key, order), within(target, key, span.low, span.high), key)
    fresh.sortWithinPartitions(key).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{BATCH}={batch_id}")


def merge_stream(arriving: DataFrame, path: str, key: str, order: list[str], checkpoint: str) -> StreamingQuery:
    """Insert-only merge of a stream of rows into a target that may be compacted at any time."""
    return (
        arriving.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(partial(merge_batch, path=path, key=key, order=order))
        .start()
    )


def compact(spark: SparkSession, path: str, schema: T.StructType, key: str, upto: int, files: int) -> dict:
    """Merge the base and the batches up to ``upto`` into ``files`` key-ranged files; returns the manifest now valid.

    ``upto`` is a batch the stream has committed: the one it works on may still be replayed with other rows.
    Without a batch to merge nothing is written. The rows are dealt by ranges of the key, which Spark samples, with
    a hash behind it, so that rows of a null key (each of them stays) don't end in one file.
    """
    state = current(spark, path)
    due = [n for n in _numbers(_listed(spark, path), f"{BATCH}=") if state["covers"] < n <= upto]
    if not due:
        return state
    number = state["number"] + 1
    base = f"base={number}"
    rows = _rows(spark, _live(spark, path, state, upto=upto), schema)
    spread = F.xxhash64(*[f"`{c}`" for c in rows.columns])
    dealt = rows.repartitionByRange(files, F.col(key), spread).sortWithinPartitions(key)
    # Left by a compaction that died before its switch, the folder is no reader's yet.
    dealt.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{base}")
    made = {"number": number, "base": base, "covers": due[-1]}
    _switch(spark, path, made)
    return made


def _switch(spark: SparkSession, path: str, manifest: dict) -> None:
    """Publish a manifest whole: written aside, then renamed."""
    system, _ = _files(spark, path)
    aside = _child(spark, path, MANIFESTS, f"_{manifest['number']}.tmp")
    stream = system.create(aside, True)
    try:
        stream.write(bytearray(json.dumps(manifest).encode()))
    finally:
        stream.close()
    if not system.rename(aside, _child(spark, path, MANIFESTS, f"{manifest['number']}.json")):
        raise RuntimeError(f"Another compaction of {path} has made manifest {manifest['number']}")


def expire(spark: SparkSession, path: str) -> list[str]:
    """Delete what the manifest before the newest had replaced already; returns the folders' names."""
    known = manifests(spark, path)
    if len(known) < 2:
        return []
    before, newest = known[-2:]
    names = _listed(spark, path)
    old = [f"{BATCH}={n}" for n in _numbers(names, f"{BATCH}=") if n <= before["covers"]]
    old += [f"base={n}" for n in _numbers(names, "base=") if f"base={n}" not in (before["base"], newest["base"]) and n < newest["number"]]
    system, _ = _files(spark, path)
    for name in old:
        system.delete(_child(spark, path, name), True)
    return old
