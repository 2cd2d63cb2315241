"""Merkle dataset manifest: one root over all rows, and a proof of each row against it.

Method: bitmap-rank indexing. Each group keeps a compressed bitmap of its ids, the non-empty 64-bit words of it,
merged from every task's partial words. A popcount directory says how many rows come before each word: ids are cut
into a few levels of 12 bits, and each level sums within its parent only. A row's leaf coordinate is its
word's entry plus the set bits below its own: rows are never sorted. The coordinate keys arrays of 1,024 slots; an
array is reduced by ten levels in one task, the nodes that come out are the slots of the next arrays, and paths are
joined from the top down.

Ids that repeat, and null ids, are one bit for several rows. The rows of such words alone are put in order by id
(null first), leaf and row, in sorted ranges that split a repeated id too.

Scale: a directory's window holds at most 4,096 words, an array 1,024 slots, whatever the size of a group. The rows
travel as digests (text is read once). The tree over the groups' roots is built the same way.

Defined cases: a null field is ``-``, any other its UTF-8 byte count, a colon and the value; null groups come first;
equal ids of a group ascend by leaf, so equal rows may change places without effect; a group of one row has its leaf
as its root; no rows give no rows; other columns, whatever they are called, take no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from salesloom.scratch import materialise

SLOT_BITS = 10
_LEVEL_BITS = 12  # of a directory level
_NO_ID = -(1 << 60)  # word of null ids, before that of any id
_STEP = 33  # bytes of a path for one level: where the sibling stands, and its digest
_ALONE, _LEFT, _RIGHT = b"A", b"L", b"R"


def leaf_digest(fields: list[Column]) -> Column:
    """SHA-256 of the fields' texts in their order."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def ordered(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` with ``place``, from 0 in ascending order of ``keys``; rows that are equal in them come in any order."""
    counter = F.monotonically_increasing_id()
    sorted_ranges = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ranges = materialise(sorted_ranges.select("*", F.shiftright(counter, 33).alias("_range"), counter.bitwiseAND(F.lit((1 << 33) - 1)).alias("_at")), "ranges")
    # One row for each range.
    sizes = ranges.groupBy("_range").count()
    starts = sizes.select("_range", (F.sum("count").over(Window.orderBy("_range")) - F.col("count")).alias("_start"))
    return ranges.join(starts, "_range").withColumn("place", F.col("_start") + F.col("_at")).drop("_range", "_at", "_start")


def directory(leaves: DataFrame) -> DataFrame:
    """(group, word, bits, n, total, base): the non-empty words of each group's bitmap, the rows in them, in the group and before them."""
    words = leaves.groupBy("group", "word").agg(F.expr("bit_or(shiftleft(1L, low))").alias("bits"), F.count("*").alias("n"))
    words = materialise(words, "words")
    found = words.withColumns({"part": F.col("word"), "base": F.lit(0).cast("long")})
    level = words.select("group", F.col("word").alias("part"), "n")
    for last in (False, False, False, False, True):
        parent = F.shiftright("part", _LEVEL_BITS)
        inside = Window.partitionBy("group") if last else Window.partitionBy("group", parent)
        before = level.select("group", "part", (F.sum("n").over(inside.orderBy("part")) - F.col("n")).alias("before"))
        found = found.join(before, ["group", "part"]).withColumns({"base": F.col("base") + F.col("before"), "part": parent}).drop("before")
        level = level.groupBy("group", parent.alias("part")).agg(F.sum("n").alias("n"))
    total = words.groupBy("group").agg(F.sum("n").alias("total"))
    return materialise(found.drop("part").join(total, "group"), "directory")


def coordinates(leaves: DataFrame) -> DataFrame:
    """``leaves(group, word, low, id, leaf, row, ..)`` with ``index``, from 0 in each group, and the group's ``total``."""
    words = directory(leaves)
    tied = F.col("n") > F.bit_count("bits")
    rank = F.col("base") + F.expr("bit_count(bits & ~shiftleft(-1L, low))")
    single = leaves.join(words.where(~tied), ["group", "word"]).withColumn("index", rank)
    result = single.drop("word", "low", "row", "bits", "n", "base")
    if words.where(tied).isEmpty():
        return result
    placed = ordered(leaves.join(words.where(tied), ["group", "word"]), "group", "id", "leaf", "row")
    first = placed.groupBy("group", "word").agg(F.min("place").alias("first"))
    placed = placed.join(first, ["group", "word"]).withColumn("index", F.col("base") + F.col("place") - F.col("first"))
    return result.unionByName(placed.select(*result.columns))


def _digest(text: bytes) -> bytes:
    return hashlib.sha256(text).hexdigest().encode()


def _reduced(table: pa.Table, bits: int) -> pa.Table:
    """The nodes of one slot array with their paths in it and the node that they become."""
    index, digests, total = (table.column(c).to_pylist() for c in ("index", "digest", "total"))
    size, first = len(index), min(index)
    order = [0] * size
    for row, place in enumerate(index):
        order[place - first] = row
    nodes = [digests[row].hex().encode() for row in order]
    paths = [[] for _ in order]
    many, spans = total[0], [range(k, k + 1) for k in range(size)]
    for _ in range(bits):
        if many == 1:
            break
        for k, span in enumerate(spans):
            other = k ^ 1
            side = _ALONE if other >= len(nodes) else _RIGHT if other > k else _LEFT
            step = side + (bytes(32) if side == _ALONE else bytes.fromhex(nodes[other].decode()))
            for leaf in span:
                paths[leaf].append(step)
        nodes = [_digest(b"".join(nodes[k : k + 2])) for k in range(0, len(nodes), 2)]
        spans = [range(spans[k].start, spans[min(k + 1, len(spans) - 1)].stop) for k in range(0, len(spans), 2)]
        many = (many + 1) // 2
    path = [b""] * size
    for place, row in enumerate(order):
        path[row] = b"".join(paths[place])
    up = bytes.fromhex(nodes[0].decode())
    return table.append_column("path", pa.array(path, pa.binary())).append_column("up", pa.array([up] * size, pa.binary()))


def climb(nodes: DataFrame, bits: int = SLOT_BITS) -> DataFrame:
    """``nodes(group, index, digest, total, ..)`` with the ``path`` of each to its group's ``root``."""
    done = nodes.where("total = 1").withColumns({"path": F.lit(b""), "root": F.col("digest")})
    several = nodes.where("total > 1")
    if several.isEmpty():
        return done
    kind = f"{', '.join(f'`{n}` {k}' for n, k in nodes.dtypes)}, path binary, up binary"
    array = F.shiftright("index", bits)
    members = several.groupBy("group", array).applyInArrow(lambda table: _reduced(table, bits), kind)
    members = materialise(members, "members")
    heads = members.where(F.col("index") % (1 << bits) == 0)
    size = F.shiftright(F.col("total") + ((1 << bits) - 1), bits)
    above = climb(heads.select("group", array.alias("index"), F.col("up").alias("digest"), size.alias("total")), bits)
    above = above.select("group", F.col("index").alias("_array"), F.col("path").alias("_path"), "root")
    joined = members.withColumn("_array", array).join(above, ["group", "_array"])
    return done.unionByName(joined.withColumn("path", F.concat("path", "_path")).select(*done.columns))


_PROVED = "id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _proved(batches) -> Iterator[pa.RecordBatch]:
    """Digests as text, the hash of each row's siblings, and the root that its claim folds to."""
    for batch in batches:
        columns = {n: batch.column(n).to_pylist() for n in ("digest", "claim", "subroot", "root", "path")}
        proofs, folded = [], []
        for claim, path in zip(columns["claim"], columns["path"], strict=True):
            node, siblings = claim.hex().encode(), []
            for at in range(0, len(path), _STEP):
                side, other = path[at : at + 1], path[at + 1 : at + _STEP].hex().encode()
                if side == _ALONE:
                    node = _digest(node)
                else:
                    siblings.append(other)
                    node = _digest(other + node if side == _LEFT else node + other)
            proofs.append(hashlib.sha256(b"".join(siblings)).hexdigest())
            folded.append(node.decode())
        leaf, subroot, root = ([x.hex() for x in columns[n]] for n in ("digest", "subroot", "root"))
        same = [a == b for a, b in zip(folded, root, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), *map(pa.array, (leaf, subroot, root, proofs, folded)), pa.array(same, pa.bool_())],
            names=[f.split()[0] for f in _PROVED.split(", ")],
        )


def prove(docs: DataFrame, fields: list[Column], claimed: list[Column] | None = None, id: str = "doc_id", group: str = "lang", bits: int = SLOT_BITS) -> DataFrame:
    """A row per document: its id, ``leaf``, its group's ``subroot``, the ``root``, the hash of its siblings up to it
    (``proof_sha256``), the root that its ``claimed`` fields fold to with them, and whether that is the root."""
    key = F.col(id).cast("long")
    name = F.col(group).cast("string")
    leaf = F.unhex(leaf_digest(fields))
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("="), name), F.lit("")).alias("group"),  # null before any name
        F.coalesce(F.shiftright(key, 6), F.lit(_NO_ID)).alias("word"),
        F.coalesce(key.bitwiseAND(F.lit(63)), F.lit(0)).cast("int").alias("low"),
        F.monotonically_increasing_id().alias("row"),
        key.alias("id"),
        leaf.alias("leaf"),
        (F.unhex(leaf_digest(claimed)) if claimed else leaf).alias("claim"),
    )
    placed = coordinates(materialise(leaves, "leaves")).withColumnRenamed("leaf", "digest")
    rows = climb(materialise(placed, "placed"), bits).withColumnRenamed("root", "subroot")
    rows = materialise(rows.select("group", "index", "id", "digest", "claim", "path", "subroot"), "rows")
    tops = ordered(rows.where("index = 0").select("group", F.col("subroot").alias("digest")), "group")
    tops = materialise(tops.select(F.lit("").alias("group"), F.col("place").alias("index"), "digest", F.col("group").alias("name")), "tops")
    tops = climb(tops.withColumn("total", F.lit(tops.count())), bits)
    tops = materialise(tops.select(F.col("name").alias("group"), F.col("path").alias("_path"), "root"), "roots")
    rows = rows.join(tops, "group").withColumn("path", F.concat("path", "_path"))
    rows = rows.select("id", "digest", "claim", "subroot", "root", "path").mapInArrow(_proved, _PROVED)
    return rows.withColumnRenamed("id", id)


def prove_against_edits(docs: DataFrame, bits: int = SLOT_BITS) -> DataFrame:
    """``prove`` of ``docs(doc_id, source, lang, n_chars, text)`` with one added to ``n_chars`` of some documents,
    those whose id's checksum 7 divides: their proofs fail."""
    edited = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
    size = F.col("n_chars").cast("decimal(20,0)")
    names = ["doc_id", "source", "lang", "n_chars", "text"]
    fields = [F.col(n) for n in names]
    claimed = [F.when(edited, size + 1).otherwise(size) if n == "n_chars" else F.col(n) for n in names]
    return prove(docs.select(*names), fields, claimed, bits=bits)
