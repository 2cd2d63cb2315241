"""Conversation prefix trie: every distinct beginning of the conversations, with what shares it.

Method. A turn's id is the MD5 of its role and text with its size in bytes. Conversations lie in rows of ``WIDTH``
positional turn-id columns, and one SQL ROLLUP over these columns aggregates all prefixes together; grouping_id tells
a prefix's length. Longer conversations continue in further rows, grouped by the node that the row before ends at
besides its own ROLLUP. A node is known by its depth and two 64-bit hashes: of each (position, turn), xor-ed over the prefix.

Subtree sums need no walk over the tree. The smallest member of a node is the smallest of all deeper nodes of its
that it passes, so each conversation owns the nodes of the end of its path. A second ROLLUP sums over a
node's members what they own (bytes, childless nodes); only the smallest member owns nodes above, whose bytes are known.

Scale: turns travel as ids, never as texts. Prefixes are aggregated in the tasks before they are shuffled, so
a first turn that a third of all conversations share is one row of each task. A conversation's turns are numbered by a window that holds
one row at a time. The ids that end at a node are joined in pieces of up to 65,536, and a node's pieces stream through
one hash, as a SHA-256 of one text must; they hold decimal ids only.

Defined cases: a null role or text is empty; null turns come first; turns of equal number come by the MD5 of
role and text, whatever order they are stored in; turns without a conversation id belong to none and are left out;
``%`` keeps the sign of negative ids; no rows give no nodes; extra columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from salesloom.scratch import materialise

WIDTH = 8
_PIECE_BITS = 16
_KEY = ["n1", "n2", "depth"]


def numbered(turns: DataFrame, order: list) -> DataFrame:
    """``turns(conv_id, turn_id, ..)`` with ``pos``, from 1 in each conversation."""
    return turns.withColumn("pos", F.row_number().over(Window.partitionBy("conv_id").orderBy(*order)).cast("long"))


def turn_table(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn_id, pos): turn ids are structs of an MD5 and the text's bytes."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.struct(digest.alias("id"), F.octet_length(text).cast("long").alias("bytes")).alias("turn_id"),
    )
    return numbered(turns, [F.asc_nulls_first("turn"), F.col("turn_id.id")]).drop("turn")


def rebuilt(turns: DataFrame, base: Column, head: Column) -> tuple[DataFrame, DataFrame]:
    """Conversations of the first ``head`` turns of conversation ``base`` and their own turns after their first ``head``
    (both expressions over ``conv_id``): (conv_id) of all, and (conv_id, turn_id, pos) of what they hold."""
    ids = materialise(turns.select("conv_id").distinct(), "conversations")
    own = turns.where(F.col("pos") > head).select("conv_id", F.lit(1).alias("part"), "pos", "turn_id")
    heirs = ids.select(F.col("conv_id").alias("heir"), base.alias("conv_id"), head.alias("head"))
    begun = turns.join(heirs, "conv_id").where("pos <= head")
    parts = own.unionAll(begun.select(F.col("heir").alias("conv_id"), F.lit(0).alias("part"), "pos", "turn_id"))
    return ids, numbered(parts, ["part", "pos"]).drop("part")


def _hashes(pos: Column, turn: Column) -> tuple[Column, Column]:
    return F.xxhash64(pos, turn["id"], turn["bytes"]), F.xxhash64(turn["bytes"], turn["id"], pos, F.lit(13))


def blocks(ids: DataFrame, turns: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row for each ``width`` turns of a conversation, and one for each without turns: the depth, node and bytes that it
    continues, its turns as columns, and the bytes of the whole conversation (``total``)."""
    before = Window.partitionBy("conv_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    a, b = _hashes(F.col("pos"), F.col("turn_id"))
    so_far = {"k1": F.bit_xor("h1").over(before), "k2": F.bit_xor("h2").over(before), "begun": F.sum("turn_id.bytes").over(before)}
    rows = turns.withColumns({"h1": a, "h2": b}).withColumns({n: F.coalesce(c, F.lit(0)) for n, c in so_far.items()})
    slot = (F.col("pos") - 1) % width
    first = {n: F.max(F.when(slot == 0, F.col(n))) for n in ("k1", "k2", "begun")}
    columns = [F.max(F.when(slot == i, F.col("turn_id"))).alias(f"t{i + 1}") for i in range(width)]
    found = rows.groupBy("conv_id", (F.col("pos") - 1 - slot).alias("start")).agg(*[c.alias(n) for n, c in first.items()], *columns, F.sum("turn_id.bytes").alias("held"))
    whole = found.groupBy("conv_id").agg(F.sum("held").alias("total"))
    zero = F.lit(0).cast("long")
    none = ids.join(whole, "conv_id", "left_anti").withColumns({n: zero for n in ("start", "k1", "k2", "begun", "total")})
    return found.drop("held").join(whole, "conv_id").unionByName(none, allowMissingColumns=True)


def rolled_up(rows: DataFrame, sums: str, width: int = WIDTH) -> DataFrame:
    """``sums`` (SQL) of all prefixes: their node (n1, n2, depth), its parent's hashes, the bytes of its last text and of the prefix."""
    turns = [f"t{i + 1}" for i in range(width)]
    grouped = rows.sparkSession.sql(
        f"SELECT start, k1, k2, begun, {', '.join(turns)}, {width} - bit_count(grouping_id()) AS own, {sums} "
        f"FROM {{rows}} GROUP BY start, k1, k2, begun, ROLLUP({', '.join(turns)})",
        rows=rows,
    )
    # A rolled-up column is null, and so is one beyond the conversation's end.
    reached = F.when(F.col("own") == 0, F.col("start") == 0)
    for i, t in enumerate(turns, 1):
        reached = reached.when(F.col("own") == i, F.col(t).isNotNull())
    here, above = [F.col("k1"), F.col("k2")], [F.col("k1"), F.col("k2")]
    size, last = F.col("begun"), F.lit(0).cast("long")
    for i, t in enumerate(turns, 1):
        parts = _hashes(F.col("start") + i, F.col(t))
        here = [h.bitwiseXOR(F.when(F.col("own") >= i, p).otherwise(0)) for h, p in zip(here, parts, strict=True)]
        above = [h.bitwiseXOR(F.when(F.col("own") > i, p).otherwise(0)) for h, p in zip(above, parts, strict=True)]
        size = size + F.when(F.col("own") >= i, F.col(t)["bytes"]).otherwise(0)
        last = F.when(F.col("own") == i, F.col(t)["bytes"]).otherwise(last)
    taken = [c for c in grouped.columns if c not in {"start", "k1", "k2", "begun", "own", *turns}]
    return grouped.where(reached).select(
        *[h.alias(n) for h, n in zip([*here, *above], ("n1", "n2", "p1", "p2"), strict=True)],
        (F.col("start") + F.col("own")).cast("long").alias("depth"),
        last.alias("bytes"),
        size.alias("size"),
        *taken,
    )


def _joined(batches) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's pieces, which come in order, with commas between them."""
    key, held, done = None, None, []

    def close():
        return [(*key, held.hexdigest())] if key else []

    for batch in batches:
        for *node, piece in zip(*(batch.column(n).to_pylist() for n in (*_KEY, "piece")), strict=True):
            if tuple(node) == key:
                held.update(b",")
            else:
                done += close()
                key, held = tuple(node), hashlib.sha256()
            held.update(piece.encode())
        yield _ends(done)
        done = []
    yield _ends(close())


def _ends(rows: list) -> pa.RecordBatch:
    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * 4, [pa.int64()] * 3 + [pa.string()], strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=[*_KEY, "ends_sha256"])


def ends_digest(ends: DataFrame) -> DataFrame:
    """(n1, n2, depth, ends_sha256) of ``ends(n1, n2, depth, conv_id)``: the hash of a node's ids, ascending, comma-joined."""
    part = F.shiftright("conv_id", _PIECE_BITS)
    pieces = ends.groupBy(*_KEY, part.alias("part")).agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("piece"))
    pieces = pieces.repartition(*_KEY).sortWithinPartitions(*_KEY, "part")
    return pieces.mapInArrow(_joined, "n1 long, n2 long, depth long, ends_sha256 string")


def prefix_trie(ids: DataFrame, turns: DataFrame, width: int = WIDTH) -> DataFrame:
    """A row per node of the trie of ``turns(conv_id, turn_id, pos)``, whose conversations are ``ids(conv_id)``."""
    rows = materialise(blocks(ids, turns, width), "blocks")
    nodes = rolled_up(rows, "count(*) AS n_convs, min(conv_id) AS conv_id, sum(total) AS bytes_of_all", width)
    nodes = materialise(nodes, "nodes")
    children = nodes.where("depth > 0").groupBy(F.col("p1").alias("n1"), F.col("p2").alias("n2"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, _KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = materialise(nodes, "children")
    # What a conversation owns: the bytes and childless nodes from its first own node on, and the bytes above that.
    owned = nodes.groupBy("conv_id").agg(F.sum("bytes").alias("owned"), F.sum((F.col("n_children") == 0).cast("long")).alias("leaves"), F.min(F.col("size") - F.col("bytes")).alias("above"))
    owned = materialise(owned, "owned")
    sums = rolled_up(rows.join(owned, "conv_id"), "sum(owned) AS owned_of_all, sum(leaves) AS n_leaves", width)
    sums = sums.select(*_KEY, "owned_of_all", "n_leaves")

    lengths = turns.groupBy("conv_id").agg(F.max("pos").alias("depth"), *[F.bit_xor(h).alias(n) for h, n in zip(_hashes(F.col("pos"), F.col("turn_id")), ("n1", "n2"), strict=True)])
    ends = ids.join(lengths, "conv_id", "left").select("conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in _KEY])
    parents = nodes.select(F.col("n1").alias("p1"), F.col("n2").alias("p2"), F.col("depth").alias("_depth"), F.col("conv_id").alias("parent_conv_id"))
    found = nodes.withColumn("_depth", F.col("depth") - 1).join(parents, ["p1", "p2", "_depth"], "left")
    found = found.join(sums, _KEY).join(ends_digest(ends), _KEY, "left").join(owned.select("conv_id", "above"), "conv_id")
    over = F.col("size") - F.col("bytes")  # bytes before the node's last turn
    shared = (F.col("bytes_of_all") - F.col("n_convs") * over) - (F.col("owned_of_all") + F.col("above") - over)
    return found.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        shared.alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def rebuilt_trie(conversations: DataFrame, every: int = 5, heads: int = 9, width: int = WIDTH) -> DataFrame:
    """The trie of ``conversations(conv_id, turn, role, text)`` after each took its first turns, up to ``heads`` - 1
    by its id's checksum, from the conversation of the id that ``every`` divides."""
    turns = materialise(turn_table(conversations), "turns")
    key = F.col("conv_id")
    ids, parts = rebuilt(turns, key - key % every, F.crc32(key.cast("string").cast("binary")) % heads)
    return prefix_trie(ids, materialise(parts, "rebuilt"), width)
