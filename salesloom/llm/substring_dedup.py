"""Substring dedup: remove every word that lies in a run of words found elsewhere too.

Method: count-min prefilter. Pass one counts the hashes of all windows of ``window`` consecutive
words in partition sketches, which are merged by adding cells (saturating at two). A merged cell
never underestimates, so a window below two in any row is unique. Pass two groups exactly only the
windows estimated repeated; what turns out unique after all is sent back to its document. Pass
three removes the words under the repeated windows.

Scale: a partition sends its sketch as sorted cell gaps (about a byte a window), its estimated
repeats once per distinct window (a passage in a third of all documents is one entry per partition,
not one per document), and the merged sketch has a fixed size, ``rows * 2**bits`` bits (64 MB by
default), which is the bound of what is broadcast. The result is exact whatever the size; with more
windows than cells more of them reach pass two, so ``bits`` (up to 32) goes up with the corpus.
Windows are compared by 96-bit digests of their words.

Defined cases: null and empty texts have no words; a text shorter than the window keeps all its
words; repeated rows are separate documents (each repeats the other); a null id is an id; extra
columns pass through, except those named like the result's own, which are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesloom.llm import countmin
from salesloom.llm.frames import gaps, out, planes, rows_of, ungaps, unplanes, without
from salesloom.llm.words import U64, Words, gram_hashes, gram_starts, joined_words, split_words, text_batches, word_hashes

_FLUSH = 4_000_000  # windows a task holds before it sends them
_SHARD_WINDOWS = 2_000_000  # windows grouped exactly in one go

_FOUND = pa.schema(
    [("shard", pa.int32()), ("task", pa.int64()), ("first", pa.binary()), ("second", pa.binary()), ("row", pa.binary()), ("place", pa.binary())]
)
_SINGLE = pa.schema([("task", pa.int64()), ("keys", pa.binary()), ("row", pa.binary()), ("place", pa.binary())])
_NONE = np.uint32(2**32 - 1)


def window_hashes(words: Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word of each window of a batch, and the window's two hashes (64 and 32 bits)."""
    at = gram_starts(words, window)
    first = gram_hashes(word_hashes(words), window)
    second = gram_hashes(word_hashes(words, 1), window, 1)
    return at, first[at], (second[at] >> U64(32)).astype(np.uint32)


def window_keys(batches, window: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for piece in text_batches(batch.column("text")):
            words = split_words(piece)
            yield gram_hashes(word_hashes(words), window)[gram_starts(words, window)]


def find_partition(batches, window: int, bits: int, maps, shards: int) -> Iterator[pa.RecordBatch]:
    """The partition's windows estimated repeated, each distinct one once; one that occurs once
    here says where. A last row per flush names the documents."""
    maps = maps.value
    task = TaskContext.get().partitionId() << 24

    def flush(held, keys):
        first, second, row, place = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.argsort(first)
        same = first[order][1:] == first[order][:-1]
        if (same & (second[order][1:] != second[order][:-1])).any():
            order = np.lexsort((second, first))
        first, second = first[order], second[order]
        new = np.flatnonzero(np.concatenate(([True], (first[1:] != first[:-1]) | (second[1:] != second[:-1]))))
        several = np.diff(np.append(new, len(first))) > 1
        first, second, row, place = first[new], second[new], row[order][new], place[order][new]
        row[several], place[several] = _NONE, 0
        shard = ((first >> U64(32)) * U64(shards)) >> U64(32)
        cuts = np.searchsorted(shard, np.arange(shards + 1, dtype=U64))
        for k in np.flatnonzero(np.diff(cuts)):
            x = slice(cuts[k], cuts[k + 1])
            yield out(
                _FOUND, shard=[int(k)], task=[task], first=[gaps(first[x])], second=[planes(second[x])], row=[planes(row[x])], place=[planes(place[x])]
            )
        names = np.concatenate(keys)
        yield out(_FOUND, shard=[task % shards], task=[task], first=[None], second=[None], row=[planes(names)], place=[None])

    held, keys, count, rows = [], [], 0, 0
    for batch in batches:
        names = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in ("_id", "_key")], axis=1)
        for piece in text_batches(batch.column("text")):
            words = split_words(piece)
            at, first, second = window_hashes(words, window)
            hit = np.flatnonzero(countmin.repeated(first, maps, bits))
            if not len(hit):
                continue
            row = words.row[at[hit]]
            held.append((first[hit], second[hit], (row + rows).astype(np.uint32), (at[hit] - words.ptr[row]).astype(np.uint32)))
            keys.append(names[piece.first : piece.first + piece.rows].reshape(-1))
            count += len(hit)
            rows += piece.rows
            if count >= _FLUSH:
                yield from flush(held, keys)
                held, keys, count, rows = [], [], 0, 0
                task += 1
    if held:
        yield from flush(held, keys)


def group_shard(table: pa.Table) -> pa.Table:
    """Group one shard's windows exactly; keep those that occur once in all, for their documents."""
    made, found = [], []
    for row in rows_of(table.to_batches()):
        if row["first"] is None:
            made.append(out(_SINGLE, task=[row["task"]], keys=[row["row"]], row=[None], place=[None]))
        else:
            found.append(row)
    if found:
        first = np.concatenate([ungaps(x["first"], np.uint64) for x in found])
        second = np.concatenate([unplanes(x["second"], np.uint32) for x in found])
        row = np.concatenate([unplanes(x["row"], np.uint32) for x in found])
        place = np.concatenate([unplanes(x["place"], np.uint32) for x in found])
        task = np.repeat(np.arange(len(found)), [len(x["second"]) // 4 for x in found])
        order = np.argsort(first)
        same = first[order][1:] == first[order][:-1]
        if (same & (second[order][1:] != second[order][:-1])).any():
            order = np.lexsort((second, first))
        first, second = first[order], second[order]
        new = np.concatenate(([True], (first[1:] != first[:-1]) | (second[1:] != second[:-1]), [True]))
        alone = order[new[:-1] & new[1:]]
        alone = np.sort(alone[row[alone] != _NONE])
        cuts = np.searchsorted(task[alone], np.arange(len(found) + 1))
        for k, x in enumerate(found):
            own = alone[cuts[k] : cuts[k + 1]]
            if len(own):
                made.append(out(_SINGLE, task=[x["task"]], keys=[None], row=[planes(row[own])], place=[planes(place[own])]))
    return pa.Table.from_batches(made, _SINGLE)


_PLACES = pa.schema([("_id", pa.int64()), ("_key", pa.int64()), ("_single", pa.list_(pa.int32()))])


def name_documents(table: pa.Table) -> pa.Table:
    """From a task's row numbers back to documents: the unique windows of each."""
    names, rows, places = None, [], []
    for x in rows_of(table.to_batches()):
        if x["keys"] is not None:
            names = unplanes(x["keys"], np.int64).reshape(-1, 2)
        else:
            rows.append(unplanes(x["row"], np.uint32))
            places.append(unplanes(x["place"], np.uint32))
    if not rows:
        return _PLACES.empty_table()
    row, place = np.concatenate(rows), np.concatenate(places)
    order = np.argsort(row, kind="stable")
    row, place = row[order], place[order].astype(np.int32)
    new = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
    lists = pa.ListArray.from_arrays(pa.array(np.append(new, len(row)), pa.int32()), pa.array(place))
    own = names[row[new]]
    return pa.table([pa.array(own[:, 0].copy()), pa.array(own[:, 1].copy()), lists], schema=_PLACES)


def cut_partition(batches, window: int, bits: int, maps, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Remove the words under windows estimated repeated and not known to be unique."""
    maps = maps.value
    for batch in batches:
        single = batch.column("_single")
        texts, counts, removed = [], [], []
        for piece in text_batches(batch.column("text")):
            words = split_words(piece)
            at = gram_starts(words, window)
            at = at[countmin.repeated(gram_hashes(word_hashes(words), window)[at], maps, bits)]
            begins = np.zeros(len(words.start) + 1, bool)
            begins[at] = True
            own = single.slice(piece.first, piece.rows)
            lengths = own.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            begins[own.flatten().to_numpy() + np.repeat(words.ptr[:-1], lengths)] = False
            change = np.zeros(len(words.start) + 1, np.int32)
            starts = np.flatnonzero(begins)
            change[starts] = 1
            change[starts + window] -= 1
            covered = np.cumsum(change[:-1]) > 0
            data, places = joined_words(words, ~covered)
            texts.append(pa.LargeStringArray.from_buffers(piece.rows, pa.py_buffer(places.astype(np.int64)), pa.py_buffer(data)))
            counts.append(words.counts)
            removed.append(np.bincount(words.row[covered], minlength=piece.rows))
        if not texts:
            continue
        own = {"text": pa.concat_arrays(texts).cast(pa.string()), "n_words": pa.array(np.concatenate(counts)), "n_removed": pa.array(np.concatenate(removed))}
        yield pa.RecordBatch.from_arrays([own[n] if n in own else batch.column(n) for n in schema.names], names=schema.names)


def dedup_substrings(docs: DataFrame, window: int = 35, id: str = "doc_id", bits: int = 28, rows: int = 2) -> DataFrame:
    """``docs`` with ``text`` reduced to the words kept (joined by one space; empty for null), and
    ``n_words`` and ``n_removed``. ``id`` is an integer column."""
    spark = docs.sparkSession
    docs = without(docs, "n_words", "n_removed", "_id", "_key", "_single")
    partial = docs.select("text").mapInArrow(lambda b: countmin.sketch_partition(window_keys(b, window), bits, rows), countmin.SKETCHES)
    maps, windows = countmin.merged(partial, bits, rows)
    maps = spark.sparkContext.broadcast(maps)
    shards = max(1, -(-windows // _SHARD_WINDOWS))
    keyed = docs.withColumns({"_id": F.coalesce(F.col(id).cast("long"), F.lit(-1)), "_key": F.xxhash64("text")})
    found = keyed.select("_id", "_key", "text").mapInArrow(
        lambda b: find_partition(b, window, bits, maps, shards),
        "shard int, task long, first binary, second binary, row binary, place binary",
    )
    single = found.groupBy("shard").applyInArrow(group_shard, "task long, keys binary, row binary, place binary")
    places = single.groupBy("task").applyInArrow(name_documents, "_id long, _key long, _single array<int>")
    fields = [f for f in docs.schema.fields if f.name != "text"]
    schema = T.StructType([*fields, T.StructField("text", T.StringType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())])
    names = pa.schema([(f.name, pa.null()) for f in schema.fields])
    return keyed.join(places, ["_id", "_key"], "left").mapInArrow(lambda b: cut_partition(b, window, bits, maps, names), schema)
