"""Exact top-k search by inner product: a KD-tree per shard of the vectors.

Method. Rows are dealt into shards of bounded size by a hash of the row, so copies of a vector don't meet in one.
A shard's tree splits at the median of the widest dimension down to small leaves and keeps the tight bounding box
of every node. A box bounds the product of a query with all vectors in it (per dimension the larger of the products
with its two ends). The search visits nodes from the largest bound on, scans leaves, and ends at the first bound
below the kth score so far: nothing left can enter the result. Equal bounds are visited, as ties go to smaller ids.

First each query searches the shard that its own row is in; its kth score there is propagated to the search of all
other shards, which begin with it. Queries travel in blocks; a task holds one shard and streams the blocks past it.
The shards' answers, at most k rows each, meet per query.

Scores are exact: vectors are whole numbers, and products that doubles might round are made of Python's integers
(beyond 64 bits a score is the nearest 64-bit value).

Defined cases: vectors that are null or hold null or non-finite components take no part; vectors of another length
than the query's are no candidates of it; rows that repeat an id are rows of their own, as queries and as candidates;
a null id is no query and loses ties; no rows give no rows; extra columns are left out.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from salesloom.llm.frames import rows_of
from salesloom.scratch import materialise

SHARD_ROWS = 65536
_LEAST_ROWS = 4096  # of a shard, where there are few
_LEAF = 64
_BLOCK = 512  # queries that are searched together
_EXACT = 2.0**53
_FOUND = "query_row long, query_id long, row long, vec_id long, score long"
_FOUND_SCHEMA = pa.schema([(f.split()[0], pa.int64()) for f in _FOUND.split(", ")])


def quantised(vector: str | Column, scale: float) -> Column:
    """Whole numbers of a vector, null unless every component is finite."""
    vector = F.col(vector) if isinstance(vector, str) else vector
    vector = vector.cast("array<double>")
    whole = F.transform(vector, lambda x: F.floor(x * F.lit(float(scale))).cast("double"))
    # A comparison with null is null, and NaN is above all numbers.
    fine = F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return F.when(fine, whole)


class Tree:
    """A shard's vectors in leaf order, the nodes' boxes, and each node's rows or children."""

    def __init__(self, vectors: np.ndarray, rows: np.ndarray, ids: np.ndarray):
        self.low, self.high, self.span, self.children = [], [], [], []
        self.order = np.arange(len(rows))
        self._grow(vectors, 0, len(rows))
        self.vectors, self.rows, self.ids = vectors[self.order], rows[self.order], ids[self.order]
        self.low, self.high = (np.array(x).reshape(len(self.span), vectors.shape[1]) for x in (self.low, self.high))
        self.largest = float(np.abs(vectors).max(initial=0))

    def _grow(self, vectors: np.ndarray, begin: int, end: int) -> int:
        """A node over ``order[begin:end]``; medians split by place, so equal vectors split too."""
        own = vectors[self.order[begin:end]]
        node = len(self.span)
        self.low.append(own.min(axis=0))
        self.high.append(own.max(axis=0))
        self.span.append((begin, end))
        self.children.append(None)
        if end - begin > _LEAF and own.shape[1]:
            middle = (end - begin) // 2
            widest = int(np.argmax(self.high[node] - self.low[node]))
            self.order[begin:end] = self.order[begin:end][np.argpartition(own[:, widest], middle)]
            self.children[node] = (self._grow(vectors, begin, begin + middle), self._grow(vectors, begin + middle, end))
        return node

    def products(self, queries: np.ndarray, others: np.ndarray) -> np.ndarray:
        """Exact inner products as whole numbers, in 64 bits."""
        most = float(np.abs(queries).max(initial=0)) * self.largest * max(queries.shape[-1], 1)
        if most < _EXACT:
            return (others @ queries.T).T.astype(np.int64)
        whole = np.frompyfunc(int, 1, 1)
        exact = np.dot(whole(others), whole(queries).T).T if others.size else np.zeros((len(queries), len(others)), object)
        return np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """For each query and node, a number that no product with the node's vectors exceeds."""
        sums = np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T
        most = float(np.abs(queries).max(initial=0)) * self.largest * max(queries.shape[-1], 1)
        return sums if most < _EXACT else sums + most * 1e-12  # beyond what doubles hold exactly, with room for their rounding

    def search(self, query: np.ndarray, bounds: np.ndarray, own: int, k: int, least: int | None):
        """The rows of the k best scores, of none below ``least``, and the scores."""
        best: list[tuple[int, int, int]] = []  # the worst first: score, minus id, place
        todo = [(-bounds[0], 0)]
        while todo:
            bound, node = heapq.heappop(todo)
            kth = best[0][0] if len(best) == k else least
            if kth is not None and -bound < kth:
                break
            if self.children[node]:
                for child in self.children[node]:
                    heapq.heappush(todo, (-bounds[child], child))
                continue
            begin, end = self.span[node]
            scores = self.products(query[None], self.vectors[begin:end])[0]
            for at in range(end - begin) if kth is None else np.flatnonzero(scores >= kth):
                place = begin + int(at)
                if self.rows[place] != own:
                    entry = (int(scores[at]), -int(self.ids[place]), place)
                    if len(best) < k:
                        heapq.heappush(best, entry)
                    elif entry > best[0]:
                        heapq.heapreplace(best, entry)
        return [e[2] for e in best], [e[0] for e in best]


_NO_ID = 2**63 - 1  # a null id loses ties
_PACKED = "dim int, shard long, kind int, part long, rows binary, ids binary, vectors binary, least binary, known binary"
_PACKED_SCHEMA = pa.schema([("dim", pa.int32()), ("shard", pa.int64()), ("kind", pa.int32()), ("part", pa.int64()), *[(n, pa.binary()) for n in ("rows", "ids", "vectors", "least", "known")]])


def _packed(batches, kind: int, part: str, most: int | None) -> Iterator[pa.RecordBatch]:
    """Rows that come ordered by dim and ``part`` in packs of one dim and part, of up to ``most`` rows."""

    def pack(dim, value, held):
        rows, ids, vectors, least, known = zip(*held, strict=True)
        arrays = (np.array(rows, np.int64), np.array(ids, np.int64), np.array(vectors, np.float64), np.array(least, np.int64), np.array(known, bool))
        columns = {"dim": dim, "shard": value, "kind": kind, "part": rows[0]} | dict(zip(("rows", "ids", "vectors", "least", "known"), (a.tobytes() for a in arrays), strict=True))
        return pa.RecordBatch.from_pylist([columns], _PACKED_SCHEMA)

    key, held = None, []
    for batch in batches:
        columns = {n: batch.column(n) for n in batch.schema.names}
        values = columns["vector"].flatten().to_numpy(zero_copy_only=False)
        ends = np.concatenate(([0], np.cumsum(columns["vector"].value_lengths().to_numpy())))
        dims, parts, rows, ids = (columns[n].to_pylist() for n in ("dim", part, "row", "vec_id"))
        least = columns["least"].to_pylist() if "least" in columns else [None] * len(rows)
        for i, now in enumerate(zip(dims, parts, strict=True)):
            if held and (now != key or len(held) == most):
                yield pack(*key, held)
                held = []
            key = now
            held.append((rows[i], _NO_ID if ids[i] is None else ids[i], values[ends[i] : ends[i + 1]], least[i] or 0, least[i] is not None))
    if held:
        yield pack(*key, held)


def _unpacked(row: dict) -> list[np.ndarray]:
    kinds = {"rows": np.int64, "ids": np.int64, "vectors": np.float64, "least": np.int64, "known": bool}
    found = [np.frombuffer(row[n], k) for n, k in kinds.items()]
    found[2] = found[2].reshape(len(found[0]), row["dim"])
    return found


def _searched(batches, k: int) -> Iterator[pa.RecordBatch]:
    """Answers of shards, each followed by the blocks of queries that search it."""
    tree, key = None, None
    for row in rows_of(batches):
        rows, ids, vectors, least, known = _unpacked(row)
        if row["kind"] == 0:
            tree, key = Tree(vectors, rows, ids), (row["dim"], row["shard"])
            continue
        if key != (row["dim"], row["shard"]):
            raise RuntimeError("a block of queries came without its shard")
        answers = []
        bounds = tree.bounds(vectors)
        for i, query in enumerate(vectors):
            places, scores = tree.search(query, bounds[i], rows[i], k, int(least[i]) if known[i] else None)
            answers += [(rows[i], ids[i], tree.rows[p], tree.ids[p], s) for p, s in zip(places, scores, strict=True)]
        columns = [np.array(c, np.int64) for c in (zip(*answers, strict=True) if answers else [[]] * 5)]
        arrays = [pa.array(c) for c in columns]
        arrays[3] = pa.array(columns[3], mask=columns[3] == _NO_ID)
        yield pa.RecordBatch.from_arrays(arrays, schema=_FOUND_SCHEMA)


def _search(shards: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Answers to blocks of ``queries``, each with the ``shard`` that it searches."""
    both = shards.unionByName(queries)
    dealt = both.repartition("dim", "shard").sortWithinPartitions("dim", "shard", "kind", "part")
    return dealt.mapInArrow(lambda b: _searched(b, k), _FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, queried: Column, k: int = 10, id: str = "vec_id", vector: str = "embedding", scale: float = 1024, shard_rows: int = SHARD_ROWS, least_rows: int = _LEAST_ROWS) -> DataFrame:
    """For each row that is ``queried`` the ``k`` other rows of the largest inner product: ``query_id``, ``rank`` from 1, the
    other's ``vec_id`` and ``score``, of vectors whose components are first multiplied by ``scale`` and rounded down."""
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col(id).cast("long").alias("vec_id"),
        quantised(vector, scale).alias("vector"),
        F.coalesce(queried, F.lit(False)).alias("asks"),
        F.monotonically_increasing_id().alias("row"),
    ).where("vector is not null")
    rows = materialise(rows.withColumn("dim", F.size("vector")), "vectors")
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sizes = rows.groupBy("dim").count()
    # A shard has no more rows than ``shard_rows`` by its hash's mean; with few rows there are as many shards as tasks.
    many = F.greatest(F.ceil(F.col("count") / shard_rows), F.least(F.ceil(F.col("count") / least_rows), F.lit(spread)))
    sizes = materialise(sizes.select("dim", many.cast("long").alias("shards")), "sizes")
    rows = materialise(rows.join(sizes, "dim").withColumn("shard", F.pmod(F.xxhash64("row"), "shards")), "dealt")
    dealt = rows.select("dim", "shard", "row", "vec_id", "vector").repartition("dim", "shard").sortWithinPartitions("dim", "shard", "row")
    shards = materialise(dealt.mapInArrow(lambda b: _packed(b, 0, "shard", None), _PACKED), "shards")

    asking = rows.where("asks and vec_id is not null").select("dim", "shard", "row", "vec_id", "vector")
    blocks = asking.repartition("dim", "shard").sortWithinPartitions("dim", "shard", "row").mapInArrow(lambda b: _packed(b, 1, "shard", _BLOCK), _PACKED)
    home = materialise(_search(shards, blocks, k), "home")
    # The kth score at home bounds the search elsewhere.
    kth = _best(home, k).where(F.col("rank") == k).select(F.col("query_row").alias("row"), F.col("score").alias("least"))
    known = asking.join(kth, "row", "left").select("dim", "shard", "row", "vec_id", "vector", "least")
    blocks = known.repartition("dim", "shard").sortWithinPartitions("dim", "shard", "row").mapInArrow(lambda b: _packed(b, 1, "shard", _BLOCK), _PACKED)
    blocks = materialise(blocks, "blocks").withColumnRenamed("shard", "_home").join(sizes, "dim")
    others = blocks.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1))).where("shard != _home")
    away = _search(shards, others.drop("_home", "shards"), k)
    return _best(home.unionByName(away), k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
