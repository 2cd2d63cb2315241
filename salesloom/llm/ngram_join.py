"""N-gram Jaccard join: groups of documents whose word n-gram sets are similar.

Method: vertical partitioning. The global order of n-grams is the order of their hashes; it is cut
into fragments, and each document's set into the segments that fall into them.

1. Candidates. Two sets that differ in at most D n-grams agree on all but D segments. There are more
   than D fragments (D from the similarity and the size class), so two linked sets share a number of
   whole segments, and only equal segments meet, the rarest first. A passage or line that many documents
   share makes up too few segments to let them meet. Which segments occur more than once is told by a
   count-min sketch before anything is shuffled.
2. Counting. The overlap of a pair is counted fragment by fragment, in separate tasks, and summed.
3. No pairs within groups. Equal sets are one node, and groups that meet in the same node are merged until most nodes
   are in one. The nodes of a group are compared with its middle only, the n-grams that most of them have. Let d be a
   node's distance from the middle (n-grams in one but not both) and its slack size * (100 - p) / (100 + p) - d. Two
   nodes that share no difference from the middle are d + d apart, so they are linked exactly if their slacks sum to
   zero or more; sharing differences only brings them closer. So every node whose slack allows it is linked to the node
   of the largest slack, and a node whose slack doesn't can only be linked to one with which it shares differences, as
   many as its slack lacks. Few nodes share so many with another component; those that do are compared through
   their rarest such differences, a bounded number of them with the other holders. A difference of which more nodes may
   be the closer half of a link makes them a group of the next round, at most half as large, as a difference is one that most
   members haven't; it compares the differences from the middle instead of the sets: two nodes' differ in as many n-grams.

A segment may be empty. Empty segments count as shared only for documents with so many of them that
no other shared segment is guaranteed; there are more fragments than needed, so those are rare.

Sets and nodes are identified by 64-bit hashes of n-grams and sets.

Defined cases: A-Z are lower-cased; a text of fewer than n words has one n-gram, all its words; null and
empty texts have none and are linked with nothing; repeated rows are one node; the smallest id ignores
null ids; extra columns are left out of the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from salesloom.llm import countmin
from salesloom.llm.components import components
from salesloom.llm.words import U64, Batch, gram_hashes, gram_starts, mixed, split_words, text_batches, word_hashes
from salesloom.scratch import discard, materialise

_COUNTED = 4  # fragments in which overlaps are counted
_TOGETHER = 32  # nodes of a group whose sets meet in one task, fragment by fragment
_LEADS = 16  # nodes with a shared difference that are compared with its other holders one by one; more form a group
_BIN = 256  # members for which a group's grams get another bin
_FLUSH = 1_000_000  # grams that a task adds up before it sends their sums


def shingle_sets(piece: Batch, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of each row in ascending order, and where each row's begin."""
    words = split_words(piece, fold=True)
    hashes, counts = word_hashes(words), words.counts
    sizes = np.where(counts >= n, counts - n + 1, (counts > 0).astype(np.int64))
    ptr = np.concatenate(([0], np.cumsum(sizes)))
    grams = np.empty(ptr[-1], U64)
    full = np.repeat(counts >= n, sizes)
    grams[full] = gram_hashes(hashes, n)[gram_starts(words, n)]
    for short in range(1, n):
        rows = np.flatnonzero(counts == short)
        if len(rows):
            grams[ptr[rows]] = gram_hashes(hashes, short, 60 + short)[words.ptr[rows]]
    for low, high in zip(ptr[:-1], ptr[1:], strict=True):
        if high - low > 1:
            grams[low:high].sort()
    row = np.repeat(np.arange(len(sizes)), sizes)
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (row[1:] != row[:-1])
    return grams[new], np.concatenate(([0], np.cumsum(np.bincount(row[new], minlength=len(sizes)))))


def size_classes(percent: int, largest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Upper sizes of the classes, the most n-grams in which two linked sets of a class differ, and
    the class's number of fragments."""
    upper = [1]
    while upper[-1] < largest:
        upper.append(max(upper[-1] + 1, upper[-1] * 3 // 2))
    upper.append(max(upper[-1] + 1, upper[-1] * 3 // 2))
    differ = [2 * u * (100 - percent) // (100 + percent) for u in upper]
    fragments = []
    for u, d in zip(upper, differ, strict=True):
        tries = np.arange(d + 1, 2 * d + 4)
        empty = tries * np.exp(-0.7 * u / tries)  # segments expected to be empty
        fragments.append(int(tries[np.argmax((tries - d - empty) / tries)]))
    return np.array(upper), np.array(differ), np.array(fragments)


def segment_keys(grams: np.ndarray, ptr: np.ndarray, percent: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For a set's own size class and the next: (row, key) of every segment through which a row can
    meet another, and how many of them it shares with any set it is linked to."""
    sizes = np.diff(ptr)
    upper, differ, fragments = size_classes(percent, int(sizes.max(initial=1)))
    own = np.searchsorted(upper, sizes)
    made = []
    # A set may also link to larger ones of the next class.
    for step, member in ((0, sizes > 0), (1, (sizes > 0) & (100 * sizes >= percent * (upper[own] + 1)))):
        need = np.zeros(len(sizes), np.int64)
        rows = np.flatnonzero(member)
        if not len(rows):
            made.append((np.empty(0, np.int64), np.empty(0, U64), need))
            continue
        kind = own[rows] + step
        count = fragments[kind]
        base = np.concatenate(([0], np.cumsum(count)))
        values = grams[np.repeat(member, sizes)]
        at = np.repeat(np.arange(len(rows)), sizes[rows])
        slot = base[at] + (((values >> U64(32)) * count[at].astype(U64)) >> U64(32)).astype(np.int64)
        new = np.flatnonzero(np.concatenate(([True], slot[1:] != slot[:-1])))
        total = np.zeros(base[-1], U64)
        total[slot[new]] = np.add.reduceat(mixed(values, 3), new)
        filled = np.zeros(base[-1], bool)
        filled[slot[new]] = True
        holder = np.repeat(np.arange(len(rows)), count)
        empty = count - np.bincount(holder[filled], minlength=len(rows))
        partner = np.minimum(upper[kind], 100 * sizes[rows] // percent)
        surely = count - (sizes[rows] + partner) * (100 - percent) // (100 + percent) - empty
        used = filled | (surely < 1)[holder]
        place = (np.arange(base[-1]) - base[holder]).astype(U64) | (kind[holder].astype(U64) << U64(40))
        need[rows] = np.maximum(surely, 1)
        made.append((rows[holder[used]], mixed(total[used] + mixed(place[used], 4), 5), need))
    return made


def _keys(batches, n: int, percent: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for piece in text_batches(batch.column("text")):
            for _, keys, _ in segment_keys(*shingle_sets(piece, n), percent):
                yield keys


_SETS = "_id long, _row long, n_shingles long, node long, keys array<long>, need long, next_keys array<long>, next_need long"


def _described(batches, n: int, percent: int, maps, bits: int) -> Iterator[pa.RecordBatch]:
    """Each document's set size, its node, and the segments that may occur elsewhere."""
    maps = maps.value
    names = [f.split()[0] for f in _SETS.split(", ")]
    for batch in batches:
        for piece in text_batches(batch.column("text")):
            grams, ptr = shingle_sets(piece, n)
            sums = np.concatenate((np.zeros(1, U64), np.cumsum(mixed(grams, 6), dtype=U64)))
            node = mixed(sums[ptr[1:]] - sums[ptr[:-1]] + np.diff(ptr).astype(U64), 8)
            columns = [batch.column(c).slice(piece.first, piece.rows) for c in ("_id", "_row")]
            columns += [pa.array(np.diff(ptr)), pa.array(node.view(np.int64))]
            for rows, keys, need in segment_keys(grams, ptr, percent):
                hit = np.flatnonzero(countmin.repeated(keys, maps, bits))
                # The sketch never says too few: a row with fewer than it needs is linked with nothing.
                enough = np.bincount(rows[hit], minlength=piece.rows) >= need
                hit = hit[enough[rows[hit]]]
                places = np.concatenate(([0], np.cumsum(np.bincount(rows[hit], minlength=piece.rows))))
                columns.append(pa.ListArray.from_arrays(pa.array(places, pa.int32()), pa.array(keys[hit].view(np.int64))))
                columns.append(pa.array(need))
            yield pa.RecordBatch.from_arrays(columns, names=names)


def _segments(batches, n: int) -> Iterator[pa.RecordBatch]:
    """Each row's set, cut into the fragments in which overlaps are counted."""
    for batch in batches:
        for piece in text_batches(batch.column("text")):
            grams, ptr = shingle_sets(piece, n)
            row = np.repeat(np.arange(piece.rows), np.diff(ptr))
            slot = row * _COUNTED + (((grams >> U64(32)) * U64(_COUNTED)) >> U64(32)).astype(np.int64)
            places = np.concatenate(([0], np.cumsum(np.bincount(slot, minlength=piece.rows * _COUNTED))))
            own = batch.column("_node").slice(piece.first, piece.rows).to_numpy()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(own, _COUNTED)),
                    pa.array(np.tile(np.arange(_COUNTED, dtype=np.int32), piece.rows)),
                    pa.ListArray.from_arrays(pa.array(places, pa.int32()), pa.array(grams.view(np.int64))),
                ],
                names=["node", "fragment", "grams"],
            )


def _both(batches) -> Iterator[np.ndarray]:
    """Each row's key two times, so that a sketch marks it."""
    for batch in batches:
        yield np.repeat(batch.column("_row").to_numpy().view(U64), 2)


def _among(batches, maps, bits: int) -> Iterator[pa.RecordBatch]:
    """Rows that the sketch marks."""
    for batch in batches:
        marked = countmin.repeated(batch.column("_row").to_numpy().view(U64), maps.value, bits)
        yield batch.filter(pa.array(marked))


def _meetings(nodes: DataFrame) -> DataFrame:
    """(group, node): nodes in one group share a segment, and any two linked nodes are in one.

    A node shares ``need`` segments with whatever it is linked to. So it drops out if fewer of its
    segments occur elsewhere, and otherwise all but need - 1 of them suffice: the rarest."""
    own = nodes.select("node", F.lit(0).alias("step"), "need", F.explode("keys").alias("group"))
    larger = nodes.select("node", F.lit(1).alias("step"), F.col("next_need").alias("need"), F.explode("next_keys").alias("group"))
    groups = own.unionAll(larger)
    members = groups.groupBy("group").agg(F.count("*").alias("members")).where("members > 1")
    mine = Window.partitionBy("node", "step")
    groups = groups.join(members, "group").withColumn("shared", F.count("*").over(mine))
    groups = groups.withColumn("rank", F.row_number().over(mine.orderBy("members", "group")))
    return groups.where("shared >= need and rank <= shared - need + 1").select("group", "node")


def _rooted(df: DataFrame, roots: DataFrame | None) -> DataFrame:
    """``df`` with the component of its ``node``; before any link each node is its own."""
    if roots is None:
        return df.withColumn("root", F.col("node"))
    return df.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _open(groups: DataFrame, roots: DataFrame | None) -> DataFrame:
    """The rows of the groups that lie in several components, with their number of ``members``; of
    groups with the same members one."""
    ends = _rooted(groups.select("group", "node"), roots).groupBy("group").agg(
        F.count("*").alias("members"),
        F.min("root").alias("a"),
        F.max("root").alias("z"),
        F.bit_xor("node").alias("x"),
        F.bit_xor(F.xxhash64("node")).alias("y"),
    )
    same = ends.where("a < z").groupBy("members", "x", "y").agg(F.min("group").alias("group"))
    return groups.join(same.select("group", "members"), "group")


def _first(groups: DataFrame) -> DataFrame:
    """(group, first): the member of each group that meets most others."""
    members = groups.groupBy("group").agg(F.count("*").alias("members"))
    met = groups.join(members, "group").groupBy("node").agg(F.sum("members").alias("met"))
    return groups.join(met, "node").groupBy("group").agg(F.max(F.struct("met", "node"))["node"].alias("first"))


def _merged(groups: DataFrame) -> DataFrame:
    """Groups joined into one if their first member is the same, again and again while that makes rows fewer by a
    quarter: most nodes come to be in one group."""
    rows = groups.count()
    while True:
        merged = groups.join(_first(groups), "group").select(F.col("first").alias("group"), "node").distinct()
        merged = materialise(merged, "merged")
        before, rows = rows, merged.count()
        discard(groups)
        groups = merged
        if 4 * rows >= 3 * before:
            return groups


_UNLIKE = "group long, node long, fragment int, differ int, grams array<long>"


def _from_middle(rows: pa.Table) -> pa.RecordBatch:
    """What each row's grams and the middle of its group and fragment, all of whose rows are here, don't share."""
    group, fragment = (rows.column(c).to_numpy() for c in ("group", "fragment"))
    lists = rows.column("grams").combine_chunks()
    values, sizes = lists.flatten().to_numpy(), lists.value_lengths().to_numpy()
    place = np.concatenate(([0], np.cumsum((group[1:] != group[:-1]) | (fragment[1:] != fragment[:-1]))))
    members = np.bincount(place)
    holder = np.repeat(np.arange(len(group)), sizes)
    order = np.lexsort((values, place[holder]))
    where, what = place[holder][order], values[order]
    first = np.flatnonzero(np.concatenate((np.ones(min(len(what), 1), bool), (where[1:] != where[:-1]) | (what[1:] != what[:-1]))))
    times = np.diff(np.append(first, len(what)))
    run = np.empty(len(what), np.int64)
    run[order] = np.repeat(np.arange(len(first)), times)
    # Each gram of the middle once for every row of its group and fragment: no more than twice what the rows hold.
    middle = np.flatnonzero(2 * times > members[where[first]])
    copies = members[where[first[middle]]]
    begin = (np.cumsum(members) - members)[where[first[middle]]]
    row = np.repeat(begin - np.concatenate(([0], np.cumsum(copies)[:-1])), copies) + np.arange(copies.sum()) if len(middle) else middle
    pairs = np.sort(np.concatenate((holder * len(first) + run, row * len(first) + np.repeat(middle, copies))))
    new = np.concatenate((np.ones(1, bool), pairs[1:] != pairs[:-1], np.ones(1, bool)))
    pairs = pairs[new[:-1] & new[1:]] if len(pairs) else pairs
    row = pairs // max(len(first), 1)
    differ = np.bincount(row, minlength=len(group))
    # With fewer than four members no two share a difference.
    told = (members[place] > 3)[row]
    ends = np.concatenate(([0], np.cumsum(np.bincount(row[told], minlength=len(group)))))
    grams = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(what[first[pairs[told] % max(len(first), 1)]], pa.int64()))
    columns = [rows.column(c).combine_chunks() for c in ("group", "node", "fragment")] + [pa.array(differ, pa.int32()), grams]
    return pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in _UNLIKE.split(", ")])


def _from_middles(batches) -> Iterator[pa.RecordBatch]:
    """``_from_middle`` of rows that come ordered by group and fragment."""
    rest = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = pa.concat_tables([rest, rows]) if rest else rows
        group, fragment = (rows.column(c).to_numpy() for c in ("group", "fragment"))
        ends = np.flatnonzero((group[1:] != group[:-1]) | (fragment[1:] != fragment[:-1])) + 1
        cut = int(ends[-1]) if len(ends) else 0
        if cut:
            yield _from_middle(rows.slice(0, cut))
        rest = rows.slice(cut)
    if rest:
        yield _from_middle(rest)


_COUNTS = "group long, fragment int, bin int, members long, grams array<long>, times array<long>"
_COUNTS_SCHEMA = pa.schema([("group", pa.int64()), ("fragment", pa.int32()), ("bin", pa.int32()), ("members", pa.int64()), ("grams", pa.list_(pa.int64())), ("times", pa.list_(pa.int64()))])


def _listed(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), pa.array(values, pa.int64()))


def _added(group, fragment, part, members, grams, times) -> pa.RecordBatch:
    """Counts of equal (group, fragment, bin, gram) added up, one row for each group, fragment and bin."""
    order = np.lexsort((grams, part, fragment, group))
    columns = [c[order] for c in (group, fragment, part, members, grams, times)]
    edge = np.zeros(len(order), bool)
    edge[:1] = True
    for c in columns[:3]:
        edge[1:] |= c[1:] != c[:-1]
    new = edge.copy()
    new[1:] |= columns[4][1:] != columns[4][:-1]
    first, rows = np.flatnonzero(new), np.flatnonzero(edge)
    total = np.add.reduceat(columns[5], first) if len(first) else columns[5]
    sizes = np.diff(np.append(np.searchsorted(first, rows), len(first)))
    lists = [_listed(columns[4][first], sizes), _listed(total, sizes)]
    return pa.RecordBatch.from_arrays([*[pa.array(c[rows]) for c in columns[:4]], *lists], schema=_COUNTS_SCHEMA)


def _counted(batches) -> Iterator[pa.RecordBatch]:
    """A task's own counts of the grams of each group, a bin of grams for every ``_BIN`` members."""
    held, size = [], 0

    def flush():
        return _added(*[np.concatenate(c) for c in zip(*held, strict=True)])

    for batch in batches:
        lists = batch.column("grams")
        grams, sizes = lists.flatten().to_numpy(), lists.value_lengths().to_numpy()
        group, fragment, members = (np.repeat(batch.column(c).to_numpy(), sizes) for c in ("group", "fragment", "members"))
        bins = -(-members // _BIN)
        part = (mixed(grams.view(U64), 9) % bins.astype(U64)).astype(np.int32)
        held.append((group, fragment, part, members, grams, np.ones(len(grams), np.int64)))
        size += len(grams)
        if size >= _FLUSH:
            yield flush()
            held, size = [], 0
    if size:
        yield flush()


def _majority(table: pa.Table) -> pa.Table:
    """The grams of a bin that most members have."""
    values, times = (table.column(c).combine_chunks().flatten().to_numpy() for c in ("grams", "times"))
    members = table.column("members")[0].as_py()
    grams, at = np.unique(values, return_inverse=True)
    middle = grams[2 * np.bincount(at, times, len(grams)).astype(np.int64) > members]
    return pa.table({"group": table.column("group")[:1], "fragment": table.column("fragment")[:1], "middle": pa.array([middle], pa.list_(pa.int64()))})


def _unlike(groups: DataFrame, sets: DataFrame) -> DataFrame:
    """(group, node, fragment, differ, grams): how many grams of a fragment a node and its group's middle don't
    share, and which, for groups of four or more.

    The rows of up to ``_TOGETHER`` nodes meet as they are. Of more nodes each task adds up the grams that it
    has, and these sums meet, in a bin for every ``_BIN`` members."""
    few = groups.where(F.col("members") <= _TOGETHER).join(sets, ["parent", "node"])
    few = few.select("group", "node", "fragment", "grams").repartition("group", "fragment").sortWithinPartitions("group", "fragment")
    many = groups.where(F.col("members") > _TOGETHER).join(sets, ["parent", "node"])
    sums = many.select("group", "fragment", "members", "grams").mapInArrow(_counted, _COUNTS)
    middle = sums.groupBy("group", "fragment", "bin").applyInArrow(_majority, "group long, fragment int, middle array<long>")
    middle = middle.groupBy("group", "fragment").agg(F.flatten(F.collect_list("middle")).alias("middle"))
    middles = F.coalesce("middle", F.array().cast("array<bigint>"))
    grams = F.concat(F.array_except("grams", middles), F.array_except(middles, "grams"))
    many = many.join(middle, ["group", "fragment"], "left").select("group", "node", "fragment", grams.alias("grams"))
    many = many.select("group", "node", "fragment", F.size("grams").alias("differ"), "grams")
    return few.mapInArrow(_from_middles, _UNLIKE).unionAll(many)


def _shared_keys(lists: pa.Array, groups: np.ndarray) -> np.ndarray:
    """Keys of (group, gram) for lists of grams."""
    return mixed(mixed(groups.view(U64), 11).repeat(lists.value_lengths().to_numpy()) + lists.flatten().to_numpy().view(U64), 12)


def _differences(batches) -> Iterator[np.ndarray]:
    for batch in batches:
        yield _shared_keys(batch.column("grams"), batch.column("group").to_numpy())


_HELD = "group long, node long, grams array<long>"


def _not_alone(batches, maps, bits: int) -> Iterator[pa.RecordBatch]:
    """Of each row the differences, as keys, that the sketch has seen twice in the group."""
    for batch in batches:
        lists = batch.column("grams")
        sizes = lists.value_lengths().to_numpy()
        keys = _shared_keys(lists, batch.column("group").to_numpy())
        held = countmin.repeated(keys, maps.value, bits)
        kept = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[held], minlength=len(sizes))
        columns = [batch.column("group"), batch.column("node"), _listed(keys[held].view(np.int64), kept)]
        yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in _HELD.split(", ")])


def _meetings_by_difference(asked: DataFrame, unlike: DataFrame, roots: DataFrame, percent: int, bits: int) -> DataFrame:
    """(parent, gram, node, root, own, rest, leads): nodes with the same ``gram`` share a difference from the parent group's
    middle, and any two linked nodes of a parent that are not in one component yet have such a gram, for which one of them
    ``leads``. For the rarest of them, two nodes share no more differences than the ``rest`` of either: those of the gram
    and of all less rare ones.

    ``asked(group, node, distance, own, most)``: a node's slack and the largest of its group. Two such nodes are linked
    only if they share as many differences as make up for what their slacks lack. Let a be the one of larger slack: it
    needs that many with any other of no larger slack than its own (``index``), and the other that many with one
    of the largest slack (``probe``). Only differences that another component of the group has too count: a sketch
    leaves out most others before they are counted. Differences that the same nodes hold are one ``gram`` of their number
    as weight: an edit that a node shares makes several. A node that has fewer than it needs is out; else the rarest that
    the two share has, in the order of rarity, a rest of index or more in a and of probe or more in the other, and in both
    as much as they need; a holder without that for any leading node is out."""
    spark = asked.sparkSession
    cost = 100 + percent
    lack = {"probe": F.ceil(-(F.col("own") + F.col("most")) / (2 * cost)), "index": F.ceil(-F.col("own") / cost)}
    asked = asked.withColumns({n: F.greatest(F.lit(1), c) for n, c in lack.items()}).where("probe <= distance")
    asked = materialise(asked.select("group", "node", "own", "probe", "index"), "asked")
    rows = materialise(unlike.join(asked.select("group", "node"), ["group", "node"]).select("group", "node", "fragment", "grams"), "differences")
    partial = rows.select("group", "grams").mapInArrow(lambda b: countmin.sketch_partition(_differences(b), bits, 1), countmin.SKETCHES)
    maps = spark.sparkContext.broadcast(countmin.merged(partial, bits, 1)[0])
    held = materialise(rows.mapInArrow(lambda b: _not_alone(b, maps, bits), _HELD), "held")
    maps.destroy()
    discard(rows)
    enough = held.groupBy("group", "node").agg(F.sum(F.size("grams")).alias("held")).join(asked, ["group", "node"]).where("held >= probe")
    listed = held.join(_rooted(enough, roots), ["group", "node"]).select("group", "node", "root", "own", "probe", "index", F.explode("grams").alias("gram"))
    listed = materialise(listed, "listed")
    discard(held)

    def across(rows: DataFrame, *more: Column) -> DataFrame:
        ends = rows.groupBy("gram").agg(F.count("*").alias("holders"), F.min("root").alias("a"), F.max("root").alias("z"), *more)
        return ends.where("a < z").drop("a", "z")

    who = across(listed, F.bit_xor(F.xxhash64("group", "node")).alias("x"), F.bit_xor(F.xxhash64("node", "group")).alias("y"))
    who = who.groupBy("holders", "x", "y").agg(F.min("gram").alias("gram"), F.count("*").alias("weight")).drop("x", "y")
    behind = Window.partitionBy("group", "node").orderBy(F.desc("holders"), F.desc("gram")).rowsBetween(Window.unboundedPreceding, 0)
    found = listed.join(materialise(who, "held_alike"), "gram").withColumn("rest", F.sum("weight").over(behind)).where("rest >= probe")
    found = found.select("group", "node", "root", "own", "gram", "rest", F.expr("rest >= index").alias("leads"))
    found = materialise(found, "found")
    discard(listed)

    def enough(other: str, rest: str) -> Column:
        return F.col("own") + F.col(other) + 2 * cost * F.least("rest", rest) >= 0

    for _ in range(2):  # the bounds are closer when fewer holders are left
        first = [F.max(F.when(F.col("leads"), F.col(c))).alias(n) for c, n in (("own", "lead"), ("rest", "behind"))]
        ends = across(found, *first, F.max("rest").alias("most")).where("lead is not null")
        met = found.join(ends, "gram").withColumn("leads", F.col("leads") & enough("own", "most"))
        met = met.where(F.col("leads") | (F.col("own") <= F.col("lead")) & enough("lead", "behind")).select(*found.columns)
        before, found = found, materialise(met, "met")
        discard(before)
    return found.withColumnRenamed("group", "parent")


def _candidates(met: DataFrame, percent: int) -> DataFrame:
    """(parent, u, v, slacks): a leading node of ``met`` with any other of another component and no larger slack, where
    the differences they may still share are as many as their slacks lack."""
    lead = met.where("leads").select("gram", F.col("node").alias("u"), F.col("root").alias("_root"), F.col("own").alias("_own"), F.col("rest").alias("_rest"))
    enough = F.col("own") + F.col("_own") + 2 * (100 + percent) * F.least("rest", "_rest") >= 0
    pairs = met.join(lead, "gram").where(F.expr("root != _root and own <= _own") & enough)
    return pairs.select("parent", "u", F.col("node").alias("v"), (F.col("own") + F.col("_own")).alias("slacks"))


def _pair_links(met: DataFrame, unlike: DataFrame, percent: int) -> DataFrame:
    """(u, v): the linked pairs of ``met``, of a leading node with any other of another component and no larger slack.

    The differences that two nodes share are counted fragment by fragment and summed."""
    pairs = _candidates(met, percent).distinct()
    one, other = (unlike.select(F.col("group").alias("parent"), "fragment", F.col("node").alias(n), F.col("grams").alias(f"_{n}")) for n in "uv")
    shared = pairs.join(one, ["parent", "u"]).join(other, ["parent", "fragment", "v"])
    shared = shared.groupBy("parent", "u", "v", "slacks").agg(F.sum(F.size(F.array_intersect("_u", "_v"))).alias("shared"))
    return shared.where(F.col("slacks") + 2 * (100 + percent) * F.col("shared") >= 0).select("u", "v")


def _further(roots: DataFrame | None, links: DataFrame) -> DataFrame:
    """(node, root) after more ``links(u, v)``: only links between components are followed."""
    if roots is None:
        return components(links)
    ends = links.join(roots.select(F.col("node").alias("u"), F.col("root").alias("_u")), "u", "left")
    ends = ends.join(roots.select(F.col("node").alias("v"), F.col("root").alias("_v")), "v", "left")
    between = ends.select(F.coalesce("_u", "u").alias("u"), F.coalesce("_v", "v").alias("v")).where("u != v").distinct()
    between = materialise(between, "between")
    if between.isEmpty():
        return roots
    deeper = components(between)
    # A node that had no link before is a component of its own until now.
    nodes = roots.unionAll(deeper.select("node", F.col("node").alias("root")).join(roots.select("node"), "node", "left_anti"))
    nodes = nodes.join(deeper.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left")
    return materialise(nodes.select("node", F.coalesce("top", "root").alias("root")), "roots")


def linked_roots(nodes: DataFrame, groups: DataFrame, segments: DataFrame, percent: int, bits: int) -> DataFrame | None:
    """(node, root) of the components of all linked pairs of ``nodes(node, size)``; None without any.

    ``groups(group, node)``: any two linked nodes share a group. ``segments``: the sets."""
    roots = None
    shared = materialise(_open(groups, None).select("group", "node"), "shared")
    discard(groups)
    groups = _merged(shared).withColumn("parent", F.lit(0).cast("long"))
    # Later rounds compare what a node and the middle of the ``parent`` group don't share: as far apart as the sets.
    sets = segments.withColumn("parent", F.lit(0).cast("long"))
    while True:
        before, groups = groups, materialise(_open(groups, roots), "groups")
        discard(before)
        if groups.isEmpty():
            return roots
        unlike = materialise(_unlike(groups, sets), "unlike")
        discard(sets)
        sets = unlike.select(F.col("group").alias("parent"), "node", "fragment", "grams")
        # Twice what a link may cost is shared out by size; what the distance leaves of it is the slack.
        slack = unlike.groupBy("group", "node").agg(F.sum("differ").alias("distance")).join(nodes, "node")
        slack = slack.withColumn("own", F.col("size") * (100 - percent) - F.col("distance") * (100 + percent))
        best = slack.groupBy("group").agg(F.max(F.struct("own", "node")).alias("best"))
        slack = slack.join(best, "group").select("group", "node", "distance", "own", F.col("best.own").alias("most"), F.col("best.node").alias("best"))
        slack = materialise(slack, "slack")
        linked = slack.where("own + most >= 0 and node != best").select(F.col("node").alias("u"), F.col("best").alias("v"))
        linked = materialise(linked.distinct(), "linked")
        roots = _further(roots, linked)
        # Who is too far from the middle for that can be linked only by shared differences from it.
        still = _open(groups.select("group", "node"), roots).where("members > 3").select("group").distinct()
        met = _meetings_by_difference(slack.join(still, "group"), unlike, roots, percent, bits)
        leads = materialise(met.groupBy("gram").agg(F.count_if("leads").alias("count")), "leads")
        more = materialise(_pair_links(met.join(leads.where(F.col("count") <= _LEADS), "gram"), unlike, percent).distinct(), "linked")
        roots = _further(roots, more)
        moved = met.join(leads.where(F.col("count") > _LEADS), "gram").select(F.col("gram").alias("group"), "node", "parent")
        moved = materialise(moved, "shared")
        for table in (met, leads):
            discard(table)
        for table in (slack, groups):
            discard(table)
        groups = moved


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id: str = "doc_id", bits: int = 27, rows: int = 2) -> DataFrame:
    """One row per document: the id, ``n_shingles``, ``component_id`` (smallest id reachable), ``group``
    (the component as a hash, null for empty texts) and ``row_key`` (hash of id and text)."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id).alias("_id"), F.xxhash64(F.col(id), F.col("text")).alias("_row"), "text")
    partial = texts.select("text").mapInArrow(lambda b: countmin.sketch_partition(_keys(b, words, percent), bits, rows), countmin.SKETCHES)
    maps = spark.sparkContext.broadcast(countmin.merged(partial, bits, rows)[0])
    described = materialise(texts.mapInArrow(lambda b: _described(b, words, percent, maps, bits), _SETS), "described")
    maps.destroy()
    nodes = described.where("n_shingles > 0 and size(keys) + size(next_keys) > 0").groupBy("node")
    nodes = nodes.agg(F.min("_row").alias("_row"), *[F.first(c).alias(c) for c in ("n_shingles", "keys", "need", "next_keys", "next_need")])
    nodes = materialise(nodes.withColumnRenamed("n_shingles", "size"), "nodes")
    groups = materialise(_meetings(nodes), "meetings")
    needed = materialise(nodes.join(groups.select("node").distinct(), "node", "left_semi").select("_row", F.col("node").alias("_node")), "needed")
    # Only texts of needed rows, told by a bit map of fixed size, are shuffled; the join then cuts them to those exactly.
    partial = needed.select("_row").mapInArrow(lambda b: countmin.sketch_partition(_both(b), bits, 1), countmin.SKETCHES)
    maps = spark.sparkContext.broadcast(countmin.merged(partial, bits, 1)[0])
    few = texts.select("_row", "text").mapInArrow(lambda b: _among(b, maps, bits), "_row long, text string")
    segments = few.dropDuplicates(["_row"]).join(needed, "_row").mapInArrow(lambda b: _segments(b, words), "node long, fragment int, grams array<long>")
    segments = materialise(segments, "segments")
    maps.destroy()
    roots = linked_roots(nodes.select("node", "size"), groups, segments, percent, bits)
    placed = _rooted(described.select("_id", "_row", "n_shingles", "node"), roots)
    placed = placed.withColumn("group", F.when(F.col("n_shingles") > 0, F.col("root")))
    least = placed.where("n_shingles > 0").groupBy("group").agg(F.min("_id").alias("least"))
    return placed.join(least, "group", "left").select(
        F.col("_id").alias(id),
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("least")).otherwise(F.col("_id")).alias("component_id"),
        "group",
        F.col("_row").alias("row_key"),
    )
