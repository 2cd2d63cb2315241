"""LM scoring by a hierarchical Pitman-Yor model.

Method: Chinese-restaurant seating sampled by Gibbs. Every context has a restaurant, whose customers are the
tokens that follow it; each of its tables sends one customer to the parent that all contexts share, the
restaurant of all words, whose own base is uniform over the training vocabulary and one unknown word. A sweep
seats all customers anew, given everyone else's tables; the probabilities predicted by the states after the
burn-in are averaged, and a text's score is the log10 of the product over its tokens.

A context is the word before, or the text's beginning. A step seats all customers of a word in a restaurant at
once, by the conditional distribution of their tables: up to 1,024 customers exactly, more of them by the limit law
of the same sums. Within a sweep the totals of other words and restaurants are those of the sweep before.

Scale: the state is spread by the hash of (word before, word), so the pairs of a frequent word are on all shards.
Pairs are counted per task before they are shuffled. After a sweep each shard sends one sum for each of its
contexts and words to their nodes, and the nodes return the totals; five numbers pass the driver. Texts are written
down by flush (of 6 MB). A flush's distinct words and then its distinct pairs are looked up, without their
rows, and the answers, as counts without their empty high bytes, meet its texts again. Shards and nodes are as many as the
bytes of the training texts ask for; each pair of them, and of a flush and a shard, is one row of one batch, so they are
large. Words and pairs are told apart by 64 bits of hash.

Defined cases: A-Z are lower-cased; null and empty texts have the end token only; without training rows every
token is unknown; a null id is held out; repeated rows are separate documents; extra columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce
from math import lgamma, log

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.llm.frames import out, packed, packed_gaps, rows_of, unpacked, unpacked_gaps
from salesloom.llm.words import U64, Batch, mixed, split_words, text_batches, word_hashes
from salesloom.scratch import discard, extended, materialise

_FLUSH = 1_000_000  # tokens that are counted together
_FLUSH_BYTES = 6 << 20  # of texts that are scored together
_SHARD_BYTES = 1 << 23  # of training text
_NODE_BYTES = 1 << 27
_EXACT = 1024  # customers of a dish whose seatings are summed exactly
_BEGIN = U64(0x626567)  # the contexts and words that no text has
_END = U64(0x656E64)
_PAIR, _CONTEXT, _WORD, _HOME = 0, 1, 2, 3


def token_keys(piece: Batch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word before, word and row of every token, ends included, row by row."""
    words = split_words(piece, fold=True)
    hashes = word_hashes(words)
    ptr = words.ptr + np.arange(len(words.ptr))
    own, before = np.full(ptr[-1], _END, U64), np.full(ptr[-1], _BEGIN, U64)
    at = np.arange(len(hashes)) + words.row
    own[at] = hashes
    before[at + 1] = hashes
    return before, own, np.repeat(np.arange(len(words.counts)), words.counts + 1)


def pair_keys(before: np.ndarray, own: np.ndarray) -> np.ndarray:
    return mixed(mixed(before, 70) + own, 71)


def _shard(keys: np.ndarray, shards: int) -> np.ndarray:
    """Ascending with the key."""
    return ((keys >> U64(32)) * U64(shards)) >> U64(32)


def _cuts(keys: np.ndarray, shards: int) -> Iterator[tuple[int, slice]]:
    """Each shard's slice of ascending keys."""
    cuts = np.searchsorted(_shard(keys, shards), np.arange(shards + 1, dtype=U64))
    for k in np.flatnonzero(np.diff(cuts)):
        yield int(k), slice(cuts[k], cuts[k + 1])


def _distinct(keys: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, np.int64)


def _raw(content: bytes) -> np.ndarray:
    return np.frombuffer(content, U64)


_COUNTS = pa.schema([("shard", pa.int32()), ("before", pa.binary()), ("words", pa.binary()), ("counts", pa.binary())])


def _count(batches, shards: int) -> Iterator[pa.RecordBatch]:
    def flush(held):
        before, own = (np.concatenate(x) for x in zip(*held, strict=True))
        keys = pair_keys(before, own)
        order = np.argsort(keys)
        keys = keys[order]
        new = _distinct(keys)
        counts = np.diff(np.append(new, len(keys))).astype(np.uint32)
        keys, first = keys[new], order[new]
        cuts = list(_cuts(keys, shards))
        hashes = {n: [x[first[at]].tobytes() for _, at in cuts] for n, x in (("before", before), ("words", own))}
        return out(_COUNTS, **hashes, shard=[k for k, _ in cuts], counts=[packed(counts[at]) for _, at in cuts])

    held, size = [], 0
    for batch in batches:
        for piece in text_batches(batch.column("text")):
            held.append(token_keys(piece)[:2])
            size += len(held[-1][0])
            if size >= _FLUSH:
                yield flush(held)
                held, size = [], 0
    if held:
        yield flush(held)


# A shard of the state: its contexts and words in ascending order, its pairs as gaps between ascending indexes into
# them, their customers and tables, the tables of the samples kept so far summed, each of its words' tables in the
# parent, and how many counts are 1 and 2.  Draws are made in the order of the pairs' keys.
_FIXED = ["shard", "contexts", "vocabulary", "before", "words", "customers", "ones", "twos"]
_STATE = "shard int, contexts binary, vocabulary binary, before binary, words binary, customers binary, ones long, twos long, tables binary, summed binary, top binary"
_KINDS = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
_STATE_SCHEMA = pa.schema([(n, _KINDS[k]) for n, k in (f.split() for f in _STATE.split(", "))])


def _state(fixed: dict, tables, summed, top) -> pa.Table:
    columns = {n: [fixed[n]] for n in _FIXED}
    return pa.Table.from_batches([out(_STATE_SCHEMA, **columns, tables=[packed(tables)], summed=[packed(summed)], top=[packed(top)])])


def _folded(context: np.ndarray, word: np.ndarray) -> dict[str, bytes]:
    """Pairs by ascending context and word: the gaps between their contexts, and between the words of a context."""
    gap = np.diff(word, prepend=word[:1])
    first = np.flatnonzero(np.diff(context, prepend=context[:1] + np.uint32(1)))
    gap[first] = word[first]
    return {"before": packed_gaps(context), "words": packed(gap)}


def _unfolded(row: dict) -> tuple[np.ndarray, np.ndarray]:
    context, gap = unpacked_gaps(row["before"], np.uint32), unpacked(row["words"], np.uint32)
    first = np.flatnonzero(np.diff(context, prepend=context[:1] + np.uint32(1)))
    sums = np.cumsum(gap, dtype=np.int64)
    return context, sums - np.repeat(sums[first] - gap[first], np.diff(np.append(first, len(gap))))


def _named_pairs(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A shard's pairs, their indexes and their keys."""
    context, word = _unfolded(row)
    return context, word, pair_keys(*(unpacked_gaps(row[n], np.uint64)[at] for n, at in (("contexts", context), ("vocabulary", word))))


def _opened(table: pa.Table) -> pa.Table:
    """A shard's first state: one table for each word in each restaurant."""
    parts = list(rows_of(table.to_batches()))
    before, own = (np.concatenate([_raw(p[c]) for p in parts]) for c in ("before", "words"))
    counts = np.concatenate([unpacked(p["counts"], np.uint32) for p in parts]).astype(np.int64)
    keys = pair_keys(before, own)
    order = np.argsort(keys)
    new = _distinct(keys[order])
    customers, first = np.add.reduceat(counts[order], new), order[new]
    contexts, context = np.unique(before[first], return_inverse=True)
    vocabulary, word = np.unique(own[first], return_inverse=True)
    order = np.argsort(context * len(vocabulary) + word)
    fixed = {"shard": parts[0]["shard"], "contexts": packed_gaps(contexts), "vocabulary": packed_gaps(vocabulary), "customers": packed(customers[order])}
    fixed |= _folded(context[order].astype(np.uint32), word[order].astype(np.uint32))
    fixed |= {"ones": int((customers == 1).sum()), "twos": int((customers == 2).sum())}
    return _state(fixed, np.ones(len(first), np.int64), np.zeros(len(first), np.int64), np.ones(len(vocabulary), np.int64))


def _sums(at: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    return np.bincount(at, values, size).astype(np.int64)


_SENT = "kind int, node int, shard int, keys binary, customers binary, tables binary, top binary"
_SENT_SCHEMA = pa.schema([("kind", pa.int32()), ("node", pa.int32()), ("shard", pa.int32()), *[(n, pa.binary()) for n in ("keys", "customers", "tables", "top")]])


def _send(batches, nodes: int) -> Iterator[pa.RecordBatch]:
    """A shard's sums of each of its contexts and words, by node."""
    for row in rows_of(batches):
        customers, tables, top = (unpacked(row[c], np.int64) for c in ("customers", "tables", "top"))
        for kind, names, at in zip((_CONTEXT, _WORD), ("contexts", "vocabulary"), _unfolded(row), strict=True):
            keys = unpacked_gaps(row[names], np.uint64)
            sums = {n: _sums(at, x, len(keys)) for n, x in (("customers", customers), ("tables", tables))}
            sums["top"] = top if kind == _WORD else np.zeros(len(keys), np.int64)
            cuts = list(_cuts(keys, nodes))
            values = {n: [packed(x[own]) for _, own in cuts] for n, x in sums.items()}
            gaps = [packed_gaps(keys[own]) for _, own in cuts]
            yield out(_SENT_SCHEMA, **values, kind=[kind] * len(cuts), node=[k for k, _ in cuts], shard=[row["shard"]] * len(cuts), keys=gaps)


# What a node returns to each shard (tables, top, in the order of the keys sent), and its whole table as shard -1.
_NODES = _SENT + ", totals array<double>"
_NODES_SCHEMA = _SENT_SCHEMA.append(pa.field("totals", pa.list_(pa.float64())))


def _total(table: pa.Table, t: Totals | None, discount: float, strength: float, seed: int) -> pa.Table:
    parts = list(rows_of(table.to_batches()))
    kind, node = parts[0]["kind"], parts[0]["node"]
    each = [unpacked_gaps(p["keys"], np.uint64) for p in parts]
    keys, at = np.unique(np.concatenate(each), return_inverse=True)
    customers, tables = (_sums(at, np.concatenate([unpacked(p[c], np.int64) for p in parts]), len(keys)) for c in ("customers", "tables"))
    top = np.zeros(len(keys), np.int64)
    top[at] = np.concatenate([unpacked(p["top"], np.int64) for p in parts])
    if kind == _WORD and t is not None:
        rng = np.random.default_rng([seed, node])
        top = seat(rng, tables, t.top_tables - top, np.full(len(keys), 1 / (t.words + 1)), discount, strength)
    totals = [customers.sum(), tables.sum(), top.sum(), len(keys), (tables == 1).sum(), (tables == 2).sum()]
    mine = np.split(at, np.cumsum([len(own) for own in each])[:-1])
    back = len(parts) * [None]
    columns = {"kind": [kind] * (1 + len(parts)), "node": [node] * (1 + len(parts)), "shard": [-1, *[p["shard"] for p in parts]]}
    columns |= {"keys": [packed_gaps(keys), *back], "customers": [packed(customers), *back], "totals": [list(map(float, totals)), *back]}
    columns |= {n: [packed(x), *[packed(x[own]) for own in mine]] for n, x in (("tables", tables), ("top", top))}
    return pa.Table.from_batches([out(_NODES_SCHEMA, **columns)])


@lru_cache(maxsize=4)
def _log_seatings(discount: float, size: int) -> np.ndarray:
    """[customers, tables]: log of the summed weights of all ways to seat them (generalised Stirling numbers)."""
    made = np.full((size + 1, size + 1), -np.inf)
    made[0, 0] = 0.0
    for c in range(size):
        joined = made[c, 1:].copy()
        joined[:c] += np.log(c - discount * np.arange(1, c + 1))
        made[c + 1, 1:] = np.logaddexp(made[c, :-1], joined)
    return made


@lru_cache(maxsize=4)
def _log_scaled(discount: float) -> np.ndarray:
    """By tables: log of the chance that so many independent tables have ``_EXACT`` customers together."""
    t = np.arange(1, _EXACT + 1)
    return _log_seatings(discount, _EXACT)[_EXACT, 1:] + np.cumsum(np.log(t)) + t * np.log(discount)


def _ways(customers: np.ndarray, t: int, discount: float) -> np.ndarray:
    """Log weight of all seatings at ``t`` tables, up to a constant of each dish.

    Table sizes are Sibuya variables, whose sums follow a stable law: the chance that t tables have c customers
    is a function of t / c**discount over c, which is read off at ``_EXACT`` for more of them.
    """
    found = _log_seatings(discount, _EXACT)[np.minimum(customers, _EXACT), min(t, _EXACT)]
    far = np.flatnonzero(customers > _EXACT)
    if len(far):
        chances = _log_scaled(discount)
        at = t * (_EXACT / customers[far]) ** discount
        chance = np.interp(at, np.arange(1, _EXACT + 1), chances, right=-np.inf) + np.log(np.minimum(at, 1))
        found[far] = chance - lgamma(t + 1) - t * log(discount)
    return found


def seat(rng, customers: np.ndarray, others: np.ndarray, base: np.ndarray, discount: float, strength: float) -> np.ndarray:
    """A Gibbs step: tables of each dish given its customers, ``others`` tables of other dishes and probability
    ``base`` of the dish at a new table, drawn from the conditional distribution with all seatings summed.

    Numbers of tables are tried in ascending order, until their weights are under e**-40 of the largest.
    """
    tables = np.minimum(customers, 1)
    active = np.flatnonzero(customers > 1)
    own, rest, log_base = customers[active], others[active], np.log(base[active])
    weight, highest, best = np.zeros(len(active)), np.full(len(active), -np.inf), np.full(len(active), -np.inf)
    t = 1
    while len(active):
        weight += log_base + np.log(strength + discount * (rest + (t - 1)))
        whole = weight + _ways(own, t, discount)
        highest = np.maximum(highest, whole)
        drawn = whole + rng.gumbel(size=len(active))
        better = drawn > best
        tables[active[better]] = t
        best = np.maximum(best, drawn)
        t += 1
        on = (own >= t) & (whole > highest - 40)
        active, own, rest, log_base, weight, highest, best = (x[on] for x in (active, own, rest, log_base, weight, highest, best))
    return tables


class Totals:
    """The model's totals after a sweep."""

    def __init__(self, values: list[float]):
        self.customers, self.top_customers, self.top_tables, self.words, self.top_ones, self.top_twos = values


def _discount(ones: float, twos: float) -> float:
    """From how many counts are one and two."""
    return float(np.clip(ones / (ones + 2 * twos) if ones else 0.5, 0.05, 0.95))


def base_probability(customers, tables, t: Totals, discount: float, strength: float):
    """Of words with that many customers and tables in the parent restaurant."""
    room = strength + t.top_customers
    return (customers - discount * tables) / room + (strength + discount * t.top_tables) / room / (t.words + 1)


def _sweep(state: pa.Table, nodes: pa.Table, t: Totals, discounts, strength: float, seed: int, keep: bool) -> pa.Table:
    low, top_discount = discounts
    row = next(rows_of(state.to_batches()))
    told = sorted(rows_of(nodes.to_batches()), key=lambda p: p["node"])
    others, sent, top = (np.concatenate([unpacked(p[c], np.int64) for p in told if p["kind"] == kind]) for kind, c in ((_CONTEXT, "tables"), (_WORD, "tables"), (_WORD, "top")))
    context, word, keys = _named_pairs(row)
    customers, tables, summed = (unpacked(row[c], np.int64) for c in ("customers", "tables", "summed"))
    rest = sent[word] - tables  # of the word's customers in the parent, those from other contexts
    base = base_probability(rest, top[word] * (rest / sent[word]), t, top_discount, strength)
    rng = np.random.default_rng([seed, row["shard"]])
    order = np.argsort(keys)
    tables[order] = seat(rng, customers[order], (others[context] - tables)[order], base[order], low, strength)
    return _state(row, tables, summed + tables if keep else summed, top)


class Model:
    """Sampled states: the shards' table, the nodes' own tables and the totals of each kept sample."""

    def __init__(self, state: DataFrame | None, nodes: list[DataFrame], totals: list[Totals], discounts, strength: float, shards: int, spread: int):
        self.state, self.nodes, self.totals, self.discounts, self.strength = state, nodes, totals, discounts, strength
        self.shards, self.spread = shards, spread

    @property
    def tokens(self) -> int:
        return int(self.totals[0].customers) if self.totals else 0


def fit(texts: DataFrame, burn_in: int = 2, samples: int = 3, strength: float = 1.0, seed: int = 8) -> Model:
    """The model of ``texts(text)``."""
    size = texts.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    shards, spread = max(16, size // _SHARD_BYTES), max(8, size // _NODE_BYTES)
    counts = texts.select("text").mapInArrow(lambda b: _count(b, shards), "shard int, before binary, words binary, counts binary")
    state = materialise(counts.groupBy("shard").applyInArrow(_opened, _STATE), "state")
    ones, twos = state.agg(F.sum("ones"), F.sum("twos")).first()
    if ones is None:
        return Model(None, [], [], (0.5, 0.5), strength, shards, spread)

    def exchange(state, totals, discount, sweep):
        sent = state.mapInArrow(lambda b: _send(b, spread), _SENT)
        nodes = materialise(sent.groupBy("kind", "node").applyInArrow(lambda x: _total(x, totals, discount, strength, seed * 100 + sweep), _NODES), "nodes")
        words = nodes.where((F.col("shard") < 0) & (F.col("kind") == _WORD))
        return nodes, Totals(list(words.agg(*[F.sum(F.get("totals", F.lit(i))) for i in range(6)]).first()))

    def sweeping(totals, number, keep):
        return lambda a, b: _sweep(a, b, totals, discounts, strength, number, keep)

    nodes, totals = exchange(state, None, 0.5, 99)
    discounts, kept = (_discount(ones, twos), _discount(totals.top_ones, totals.top_twos)), []
    for sweep in range(burn_in + samples):
        keep = sweep >= burn_in
        told = nodes.where("shard >= 0").groupBy("shard")
        moved = state.groupBy("shard").cogroup(told).applyInArrow(sweeping(totals, seed * 100 + sweep, keep), _STATE)
        moved = materialise(moved, "state")
        discard(state)
        discard(nodes)
        state = moved
        nodes, totals = exchange(state, totals, discounts[1], sweep)
        if keep:  # without what was returned to shards; keys and customers are the same in all samples
            same = [] if kept else ["keys", "customers"]
            kept.append((materialise(nodes.where("shard < 0").select("kind", "node", *same, "tables", "top"), "kept"), totals))
    discard(nodes)
    return Model(state, [n for n, _ in kept], [t for _, t in kept], discounts, strength, shards, spread)


_ASKED = pa.schema([("kind", pa.int32()), ("shard", pa.int32()), ("flush", pa.int64()), *[(n, pa.binary()) for n in ("keys", "names", "rows", "texts")]])
_ASKED_SQL = "kind int, shard int, flush long, keys binary, names binary, rows binary, texts binary"
_TOLD = pa.schema([("flush", pa.int64()), ("kind", pa.int32()), ("shard", pa.int32()), ("values", pa.list_(pa.binary()))])
_TOLD_SQL = "flush long, kind int, shard int, values array<binary>"


def _flushes(batches) -> Iterator[pa.RecordBatch]:
    """Documents by flush: their ids, the bytes of each and their texts, packed, as rows are held by the dozen."""
    number = TaskContext.get().partitionId() << 24

    def flush(held):
        names, sizes, texts = (np.concatenate(x) for x in zip(*held, strict=True))
        return out(_ASKED, kind=[_HOME], shard=[-1], flush=[number], keys=[None], names=[packed(names)], rows=[packed(sizes)], texts=[pa.compress(texts.tobytes(), "zstd", asbytes=True)])

    held, size = [], 0
    for batch in batches:
        if "flush" in batch.schema.names:
            yield batch
            continue
        ids = batch.column("_id")
        known = ids.is_valid().to_numpy(zero_copy_only=False).astype(np.int64)
        ids = ids.fill_null(0).to_numpy()
        for piece in text_batches(batch.column("text")):
            mine = slice(piece.first, piece.first + piece.rows)
            held.append((np.stack([ids[mine], known[mine]], axis=1).reshape(-1), np.diff(piece.offsets), piece.data))
            size += len(piece.data) + piece.rows
            if size >= _FLUSH_BYTES:
                yield flush(held)
                held, size = [], 0
                number += 1
    if held:
        yield flush(held)


def _tokens_of(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word before, word and row of every token of a flush."""
    offsets = np.concatenate(([0], np.cumsum(unpacked(row["rows"], np.int64))))
    texts = pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.decompress(row["texts"], int(offsets[-1]), "zstd")])
    held = []
    for piece in text_batches(texts):
        before, own, rows = token_keys(piece)
        held.append((before, own, (rows + piece.first).astype(np.uint32)))
    return tuple(np.concatenate(x) for x in zip(*held, strict=True))


def _ask(batches, shards: int, spread: int, kinds: tuple[int, ...] = (_PAIR, _WORD)) -> Iterator[pa.RecordBatch]:
    """Each flush's distinct pairs and words by shard. Every word is a context, but for the end; the beginning is asked
    for as a word."""
    for row in rows_of(_flushes(batches)):
        before, own, _ = _tokens_of(row)
        asked = []
        for kind in kinds:
            keys = np.sort(pair_keys(before, own) if kind == _PAIR else np.concatenate((before, own)))
            keys = keys[_distinct(keys)]
            asked += [(kind, k, packed_gaps(keys[at])) for k, at in _cuts(keys, shards if kind == _PAIR else spread)]
        kind, at, keys = zip(*asked, strict=True)
        none = dict.fromkeys(("names", "rows", "texts"), [None] * len(asked))
        yield out(_ASKED, **none, kind=kind, shard=at, flush=[row["flush"]] * len(asked), keys=keys)


def _width(kind: int, samples: int) -> int:
    """Numbers that answer a key of that kind."""
    return {_PAIR: 2, _WORD: 2 + 3 * samples}[kind]


def _found(asked: pa.Table, have: list[tuple[np.ndarray, list[np.ndarray]]]) -> pa.Table:
    """For the keys of each row asked the values of all tables ``have``, each by its own ascending keys; of an unknown key
    all are 0."""
    have = [(keys, [np.append(v, 0) for v in values]) for keys, values in have]
    made, told = [], {n: asked.column(n) for n in ("flush", "kind", "shard")}
    for row in rows_of(asked.select(["keys"]).to_batches()):
        own, values = unpacked_gaps(row["keys"], np.uint64), []
        for keys, columns in have:
            at = np.searchsorted(keys, own)
            at[at < len(keys)] = np.where(keys[at[at < len(keys)]] == own[at < len(keys)], at[at < len(keys)], len(keys))
            values += [packed(v[at]) for v in columns]
        made.append(values)
    return pa.table(told | {"values": pa.array(made, pa.list_(pa.binary()))}).cast(_TOLD)


def _answer_pairs(asked: pa.Table, have: pa.Table) -> pa.Table:
    """Of each pair asked for its customers and summed tables."""
    keys, values = np.empty(0, U64), [np.empty(0, np.int64)] * _width(_PAIR, 0)
    for row in rows_of(have.to_batches()) if asked.num_rows else ():
        keys = _named_pairs(row)[2]
        order = np.argsort(keys)
        keys, values = keys[order], [unpacked(row[c], np.int64)[order] for c in ("customers", "summed")]
    return _found(asked, [(keys, values)])


def _answer_words(asked: pa.Table, have: pa.Table, samples: int) -> pa.Table:
    """Of each word asked for its customers and, in each sample, its tables as a context; then the same as a word, there
    also its tables in the parent."""
    told = []
    parts = sorted(rows_of(have.to_batches()), key=lambda p: p["sample"]) if asked.num_rows else []
    for kind, each in ((_CONTEXT, ("tables",)), (_WORD, ("tables", "top"))):
        own = [p for p in parts if p["kind"] == kind]
        keys, values = np.empty(0, U64), [np.empty(0, np.int64)] * (1 + len(each) * samples)
        if own:
            keys = unpacked_gaps(own[0]["keys"], np.uint64)
            values = [unpacked(own[0]["customers"], np.int64), *[unpacked(p[c], np.int64) for p in own for c in each]]
        told.append((keys, values))
    return _found(asked, told)


# A row is a flush, or a flush's share of a shard. Spark reads up to 4,096 of them at once, but of one row group.
_LONG_ROWS = {"parquet.block.size": str(1 << 23), "parquet.block.size.row.check.min": "1", "parquet.page.size.row.check.min": "1"}
_SCORES = pa.schema([("_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])


def _named(asked: pa.Table, told: pa.Table, model: tuple) -> pa.Table:
    """A flush's documents with their sums: a pair's discounted customers, the weight of a new table in its context and the
    word's probability in the parent, by the counts told."""
    totals, (low, top_discount), strength = model
    home = next(rows_of(asked.to_batches()))
    names = unpacked(home["names"], np.int64).reshape(-1, 2)
    before, own, rows = _tokens_of(home)
    tokens = np.bincount(rows, minlength=len(names))
    keys = pair_keys(before, own)
    order = np.argsort(keys)
    new = _distinct(keys[order])
    counts, first, rows = np.diff(np.append(new, len(keys))), order[new], rows[order]
    context, word = np.split(np.unique(np.concatenate((before[first], own[first])), return_inverse=True)[1], 2)
    parts = sorted(rows_of(told.to_batches()), key=lambda p: p["shard"])
    (customers, summed), (room, *more) = (
        [np.concatenate([unpacked(p["values"][i], np.int64) for p in parts if p["kind"] == k]) for i in range(_width(k, len(totals)))]
        for k in (_PAIR, _WORD)
    )
    tables, (seen, *parent) = more[: len(totals)], more[len(totals) :]
    held = customers - low * summed / max(len(totals), 1)
    fresh = [(strength + low * x) / (strength + room) for x in tables]
    ground = [base_probability(x, top, t, top_discount, strength) for x, top, t in zip(parent[::2], parent[1::2], totals, strict=True)]
    n, v = (totals[0].customers, totals[0].words) if totals else (0, 0)
    base = np.log10((seen + 1) / (n + v + 1))[word]
    chance = held / (strength + room[context])
    chance = chance + sum(f[context] * g[word] for f, g in zip(fresh, ground, strict=True)) / len(totals) if totals else np.ones(len(held))
    sums = [np.bincount(rows, np.repeat(x, counts), len(names)) for x in ((seen > 0)[word].astype(float), base, np.log10(chance))]
    columns = [pa.array(names[:, 0].copy(), mask=names[:, 1] == 0), pa.array(tokens)]
    return pa.table([*columns, pa.array(np.rint(sums[0]).astype(np.int64)), pa.array(sums[1]), pa.array(sums[2])], schema=_SCORES)


def score(docs: DataFrame, model: Model, id: str = "doc_id", last: bool = False) -> DataFrame:
    """A row per document: id, ``n_tokens``, ``n_known``, ``base_score`` (add-one unigram) and ``score``.

    What the model answers is written down here: the result does not read the model's tables again. After the ``last``
    texts they are deleted as soon as they are read, so those of words are asked first."""
    spark, samples = docs.sparkSession, len(model.totals)
    shards, spread, frozen = model.shards, model.spread, (model.totals, model.discounts, model.strength)
    asked = docs.select(F.col(id).cast("long").alias("_id"), "text").mapInArrow(_flushes, _ASKED_SQL)
    asked = materialise(asked, "asked", _LONG_ROWS)

    def keys(kind):
        rows = asked.mapInArrow(lambda b: _ask(b, shards, spread, (kind,)), _ASKED_SQL)
        return rows.select("kind", "shard", "flush", "keys").groupBy("shard")

    state = model.state if model.state is not None else spark.createDataFrame([], _STATE)
    nodes = [n.withColumn("sample", F.lit(s)) for s, n in enumerate(model.nodes)]
    nodes = nodes or [spark.createDataFrame([], f"sample int, {_SENT}")]
    nodes = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), nodes).groupBy(F.col("node").alias("shard"))
    told = materialise(keys(_WORD).cogroup(nodes).applyInArrow(lambda a, b: _answer_words(a, b, samples), _TOLD_SQL), "told", _LONG_ROWS)
    for table in model.nodes if last else []:
        discard(table)
    state = state.select("shard", "contexts", "vocabulary", "before", "words", "customers", "summed").groupBy("shard")
    told = extended(told, keys(_PAIR).cogroup(state).applyInArrow(_answer_pairs, _TOLD_SQL), _LONG_ROWS)
    if last and model.state is not None:
        discard(model.state)
    named = asked.groupBy("flush").cogroup(told.groupBy("flush")).applyInArrow(lambda a, b: _named(a, b, frozen), "_id long, n_tokens long, n_known long, base_score double, score double")
    return named.withColumnRenamed("_id", id)


def training_row(id: str, folds: int = 7, held_out: int = 2) -> Column:
    return F.coalesce(F.crc32(F.col(id).cast("string").cast("binary")) % folds != held_out, F.lit(False))


def score_documents(docs: DataFrame, id: str = "doc_id", **settings) -> DataFrame:
    """All documents scored by the model of those that are not held out."""
    model = fit(docs.where(training_row(id)).select("text"), **settings)
    scored = score(docs, model, id, last=True)
    return scored.select(id, (~training_row(id)).alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")
