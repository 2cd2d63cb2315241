"""The prefix trie against a walk over all prefixes in plain Python."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from salesloom.llm import prefix_trie

TURNS = "conv_id long, turn long, role string, text string"


def trie(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            convs.setdefault(c, []).append((turn is not None, turn or 0, digest, role, text))
    convs = {c: [x[3:] for x in sorted(t)] for c, t in convs.items()}
    made = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        made[c] = convs.get(c - (abs(c) % 5) * (1 if c >= 0 else -1), [])[:h] + own[h:]
    members = {}
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children, want = {}, []
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    for p, own in members.items():
        below = [q for q in members if q[: len(p)] == p]
        ends = sorted(c for c in own if len(made[c]) == len(p))
        want.append(
            (
                min(own),
                len(p),
                min(members[p[:-1]]) if p else None,
                len(own),
                len(children.get(p, [])),
                sum(q not in children for q in below),
                sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in below if q),
                hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
            )
        )
    return sorted(want, key=str)


@pytest.mark.parametrize("width, piece", [(2, 1), (3, 16), (8, 16)])
def test_trie(spark, monkeypatch, width, piece):
    monkeypatch.setattr(prefix_trie, "_PIECE_BITS", piece)
    random.seed(width)
    words = ["a", "bé", "", None, "long " * 300]
    rows = []
    for c in [*range(-7, 60), 10**6]:
        first = random.choice([0, 1])
        size = random.choice([0, 1, 2, 3, 5, 9, 20])
        rows += [(c, first + i if i or random.random() < 0.9 else None, random.choice(["user", "bot", None]), random.choice(words)) for i in range(size)]
        if c % 3 == 0:
            rows += [(c, 40 + i, "user", "same") for i in range(12)]
    rows += [(70 + i, t, "user", f"t{t}") for i in range(25) for t in range(10)]  # one conversation many times
    rows += [(None, 1, "user", "nobody's"), (70, 3, "user", "a tie"), *rows[5:9]]
    random.shuffle(rows)
    df = spark.createDataFrame(rows, TURNS).withColumn("depth", F.lit("x")).withColumn("turn_id", F.lit(1)).repartition(3)
    got = prefix_trie.rebuilt_trie(df, width=width)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert {k for _, k in got.dtypes[:-1]} == {"bigint"}
    assert sorted(map(tuple, got.collect()), key=str) == trie(rows)


def test_trie_of_nothing(spark):
    assert prefix_trie.rebuilt_trie(spark.createDataFrame([], TURNS)).count() == 0


def test_conversation_without_turns_of_its_own(spark):
    rows = [(6, 1, "user", "a")]  # its head is of conversation 5, which is absent
    got = list(map(tuple, prefix_trie.rebuilt_trie(spark.createDataFrame(rows, TURNS)).collect()))
    assert got == trie(rows)
