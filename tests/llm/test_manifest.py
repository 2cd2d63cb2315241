"""The manifest against a tree built in plain Python."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from salesloom.llm import manifest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    fields = (doc_id, source, lang, n_chars, text)
    return sha("".join("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def tree(leaves):
    """The root and every leaf's steps (other first, sibling or None)."""
    steps, level, places = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for k, place in enumerate(places):
            run = level[place // 2 * 2 : place // 2 * 2 + 2]
            steps[k].append((place % 2 == 1, run[1 - place % 2] if len(run) == 2 else None))
            places[k] = place // 2
        level = [sha("".join(level[k : k + 2])) for k in range(0, len(level), 2)]
    return level[0], steps


def proved(docs):
    groups = {}
    for row in docs:
        groups.setdefault(row[2], []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        trees[g] = tree([leaf(*r) for r in groups[g]])
    root, tops = tree([trees[g][0] for g in names])
    want = []
    for g, top in zip(names, tops, strict=True):
        for row, steps in zip(groups[g], trees[g][1], strict=True):
            doc_id, text, lang, source, n_chars = row
            edited = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0 and n_chars is not None
            node = leaf(doc_id, text, lang, source, n_chars + 1) if edited else leaf(*row)
            for first, other in steps + top:
                node = sha(node) if other is None else sha(other + node if first else node + other)
            proof = sha("".join(o for _, o in steps + top if o))
            want.append((doc_id, leaf(*row), trees[g][0], root, proof, node, node == root))
    return want


@pytest.mark.parametrize("bits, rows", [(1, 40), (2, 150), (10, 1500)])
def test_manifest(spark, bits, rows):
    random.seed(rows)
    langs = [None, "", "en", "en", "en", "é", "z", *[f"l{i}" for i in range(9)]]
    ids = random.sample(range(-3000, 3000), rows) + [2**62, -(2**62), 63, 64, -64]
    docs = [(i, random.choice([None, "", "tä xt", "x" * 9000]), random.choice(langs), random.choice([None, "s"]), random.choice([None, i])) for i in ids]
    docs += [(None, "a", "en", None, 1), (None, "b", "en", None, 1), (None, "a", None, None, None), *docs[:7], (docs[0][0], "other", "en", "s", 3)]
    docs += [(77, "same", "en", "s", 4)] * 30
    df = spark.createDataFrame(docs, DOCS).withColumn("word", F.lit("x")).withColumn("leaf", F.lit(1)).repartition(5)
    got = manifest.prove_against_edits(df, bits)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    found = list(map(tuple, got.collect()))
    assert sorted(found, key=str) == sorted(proved(docs), key=str)
    assert {r[6] for r in found} == {True, False}


def test_manifest_without_ties_or_rows(spark):
    docs = [(i * 64, str(i), "en", "s", i) for i in range(300)]
    df = spark.createDataFrame(docs, DOCS)
    assert sorted(map(tuple, manifest.prove_against_edits(df, 3).collect())) == sorted(proved(docs))
    assert manifest.prove_against_edits(df.limit(0)).count() == 0
    assert list(map(tuple, manifest.prove_against_edits(df.limit(1)).collect())) == proved(docs[:1])
