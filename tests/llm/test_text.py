"""Operators on single texts against plain Python."""

import base64
import collections
import hashlib
import math
import pathlib
import random
import re
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
import xxhash

from salesloom.llm import bpe, decontaminate, fingerprints, language, language_model, quality
from salesloom.llm.frames import packed, packed_gaps, unpacked, unpacked_gaps
from salesloom.llm.words import gram_hashes, gram_starts, split_words, text_batches, word_hashes

DOCS = "doc_id long, text string"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_words_and_grams():
    random.seed(1)
    texts = [None, "", " \n"] + ["".join(random.choice("ab é\n\tZ") for _ in range(random.randint(0, 40))) for _ in range(200)]
    for size in (10, 1 << 18):
        for piece in text_batches(pa.array(texts, pa.string()), size):
            words = split_words(piece)
            hashes = word_hashes(words)
            seen = {}
            for r in range(piece.rows):
                own = range(words.ptr[r], words.ptr[r + 1])
                got = [bytes(words.data[words.start[i] : words.end[i]]).decode() for i in own]
                assert got == words_of(texts[piece.first + r])
                for i, word in zip(own, got, strict=True):
                    assert seen.setdefault(word, hashes[i]) == hashes[i]
            assert len(set(seen.values())) == len(seen)
            grams, row = gram_hashes(hashes, 12), words.row
            assert [i for i in range(len(grams)) if row[i] == row[i + 11]] == gram_starts(words, 12).tolist()


@pytest.mark.parametrize("leaf", [1, 3, 50])
def test_bpe_equals_tiktoken(leaf):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    plain = tiktoken.Encoding("plain", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    codec = bpe.Codec(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN, leaf)
    random.seed(leaf)
    parts = ["a", "b", "the", "ing", " ", "  ", "\n", "\t", "'s", "'re", "'", "é", "日本", "9", "12", ".", "!!", " ", "\x1c", "́", "🙂", "\r\n"]
    for _ in range(300):
        own = random.sample(parts, random.choice([1, 2, 5, 22]))
        text = "".join(random.choice(own) for _ in range(random.randint(0, 120)))
        assert codec.encode(text) == plain.encode_ordinary(text)
        assert codec.decode(codec.encode(text)) == text.encode()
    run = "".join(random.choice("abcdefgh") for _ in range(3000))
    assert codec.encode(run) == plain.encode_ordinary(run)


def test_bpe_frames(spark):
    codec = bpe.Codec(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    df = spark.createDataFrame([(1, "ab ab", "x"), (None, None, "y")], DOCS + ", tokens string")
    back = bpe.decode_tokens(bpe.encode_texts(df, codec), codec).orderBy("doc_id").collect()
    assert [bytes(r.decoded) for r in back] == [b"", b"ab ab"]
    empty = hashlib.sha256(b"").hexdigest()
    assert [(r.n_tokens, r.ids_sha256) for r in bpe.round_trip(df, codec).where("doc_id is null").collect()] == [(0, empty)]
    assert bpe.round_trip(df.limit(0), codec).count() == 0


def signed(x):
    return x - 2**64 if x >= 2**63 else x


def folded(values, seed=42):
    for v in values:
        seed = xxhash.xxh64_intdigest((v & (2**64 - 1)).to_bytes(8, "little"), seed)
    return seed


def winnowed(text, k=5, window=16):
    h = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words_of(text)]
    grams = [folded(h[i : i + k]) >> 32 for i in range(len(h) - k + 1)] if len(h) >= k else [folded(h) >> 32] if h else []
    chosen = []
    for s in range(max(1, len(grams) - window + 1) if grams else 0):
        own = grams[s : s + window]
        at = s + max(i for i, g in enumerate(own) if g == min(own))
        if (grams[at], at) not in chosen:
            chosen.append((grams[at], at))
    return chosen


def likeness(a, b):
    a, b = {x for x, _ in a}, {x for x, _ in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprints(spark):
    random.seed(2)
    docs = [(i * 7 - 50, " ".join(random.choice("a bb é ccc 日本".split()) for _ in range(random.choice([0, 1, 5, 21, 60])))) for i in range(30)]
    docs += [(None, "x y"), (1000, None), (1000, "same id"), docs[0]]

    def key(doc):
        seed = folded([doc[0]]) if doc[0] is not None else 42
        return signed(xxhash.xxh64_intdigest(doc[1].encode(), seed) if doc[1] is not None else seed)

    order = sorted(set(docs), key=lambda d: (d[0] is None, -(d[0] or 0), key(d)))
    after = {d: order[(i + 1) % len(order)][1] or "" for i, d in enumerate(order)}
    want = []
    for d in docs:
        text, cut = d[1] or "", len(d[1] or "") // 3
        edited = text[: len(text) - cut] + after[d][:cut]
        own, other = winnowed(text), winnowed(edited)
        shown = [" ".join(f"{g:08x}@{p}" for g, p in x) for x in (own, other)]
        want.append((d[0], len(text), hashlib.sha256(edited.encode()).hexdigest(), *shown, likeness(own, other), likeness(own, winnowed(after[d]))))
    df = spark.createDataFrame(docs, DOCS).repartition(3)
    assert sorted(map(tuple, fingerprints.compare_with_edited(df).collect()), key=str) == sorted(want, key=str)
    assert fingerprints.compare_with_edited(df.limit(0)).count() == 0


def test_language_grams_and_prediction(spark):
    texts = ["Abc é9 日", None, "", "x-y  zz", "\n"]
    keys, counts = language.text_grams(texts, np.arange(len(texts)))
    want = {}
    for i, text in enumerate(texts):
        for word in "".join(c if c.isalpha() else " " for c in (text or "").lower()).split():
            padded = f" {word} "
            for n in (1, 2, 3):
                for at in range(len(padded) - n + 1):
                    gram = padded[at : at + n]
                    if gram.strip():
                        code = sum((ord(c) & 0xFFFF) << (16 * (n - 1 - k)) for k, c in enumerate(gram))
                        want[i << 48 | code] = want.get(i << 48 | code, 0) + 1
    assert dict(zip(keys.tolist(), counts.tolist(), strict=True)) == want
    rows = [(i, "the cat and the hat", "en") for i in range(20)] + [(100 + i, "die katze und der hut", "de") for i in range(20)]
    rows += [(None, "the hat", None), (500, None, "en"), (501, "12 !", "de")]
    df = spark.createDataFrame(rows, DOCS + ", lang string")
    got = {(r.doc_id, r.lang): (r.lang_pred, r.score) for r in language.identify_languages(df).collect()}
    assert all(p == lang for (i, lang), (p, _) in got.items() if i is not None and i < 500)
    assert got[500, "en"] == got[501, "de"] == ("und", 0.0) and got[None, None][0] == "en"
    assert language.identify_languages(df.limit(0)).count() == 0


def test_language_model_counts(spark):
    random.seed(3)
    docs = [(i, " ".join(random.choice("A b cc É q".split()) for _ in range(random.randint(0, 20)))) for i in range(60)] + [(None, "a"), (61, None)]
    held = lambda d: d is None or zlib.crc32(str(d).encode()) % 7 == 2
    tokens = lambda t: [w.translate({i: i + 32 for i in range(65, 91)}) for w in words_of(t)] + ["</s>"]
    c = collections.Counter(x for d, t in docs if not held(d) for x in tokens(t))
    n, v = sum(c.values()), len(c)
    got = {r.doc_id: r for r in language_model.score_documents(spark.createDataFrame(docs, DOCS).repartition(3)).collect()}
    assert len(got) == len(docs)
    for d, t in docs:
        r, own = got[d], tokens(t)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(d), len(own), sum(c[x] > 0 for x in own), n)
        assert math.isclose(r.base_score, sum(math.log10((c[x] + 1) / (n + v + 1)) for x in own), abs_tol=1e-9)
        assert r.score < 0
    assert language_model.score_documents(spark.createDataFrame([], DOCS)).count() == 0


def test_language_model_contexts_are_words(spark):
    held = [i for i in range(1000) if zlib.crc32(str(i).encode()) % 7 == 2]
    docs = [(i, ("xab p " if i % 2 else "yab q ") * 5) for i in range(1000, 1200)]  # words before that end alike
    docs += [(held[0], "xab p"), (held[1], "xab q"), (held[2], "yab q"), (held[3], "new p")]
    got = {r.doc_id: r.score for r in language_model.score_documents(spark.createDataFrame(docs, DOCS).repartition(3)).collect()}
    assert got[held[0]] > got[held[1]] + 1 and got[held[2]] > got[held[1]] + 1 and got[held[3]] < 0


def test_language_model_keeps_only_what_its_result_reads(spark):
    def left():
        root = pathlib.Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
        return {p for p in root.glob("salesloom/*/*") if any(p.glob("*.parquet"))}

    before = left()
    scored = language_model.score_documents(spark.createDataFrame([(i, f"a b {i % 3}") for i in range(40)], DOCS))
    assert sorted(p.name for p in left() - before) == ["asked", "told"]
    assert scored.count() == 40


def test_language_model_asks_for_a_hot_word_once(spark):
    sizes = []
    for n in (100, 100_000):
        df = spark.createDataFrame([(1, "the " * n)], "_id long, text string").coalesce(1)
        asked = df.mapInArrow(lambda b: language_model._ask(b, 16, 8), language_model._ASKED_SQL).where(f"kind != {language_model._HOME}")
        sizes.append((asked.count(), asked.selectExpr("sum(octet_length(keys))").first()[0], asked.where("rows is not null").count()))
    assert sizes[0] == sizes[1] and sizes[0][2] == 0


def test_language_model_sends_a_flush_as_one_batch(spark):
    docs = [(i, " ".join(f"w{(i * 7919 + k) % 5000}" for k in range(400_000))) for i in range(6)]  # 2.3 MB each
    df = spark.createDataFrame(docs, "_id long, text string").coalesce(1)
    for sending, keys, least in ((lambda b: language_model._ask(b, 64, 8), 64 + 8, 2), (lambda b: language_model._count(b, 64), 64, 2)):

        def batches(b, sending=sending):
            sizes = [x.num_rows for x in sending(b)]
            yield pa.RecordBatch.from_pydict({"n": pa.array([len(sizes)]), "rows": pa.array([sum(sizes)])})

        got = df.mapInArrow(batches, "n long, rows long").first()
        assert got.n == least and got.rows <= got.n * keys
    text = spark.createDataFrame(docs, DOCS)
    scores = [{r.doc_id: r.score for r in language_model.score_documents(text.repartition(n)).collect()} for n in (1, 4)]
    assert len(scores[0]) == 6 and all(math.isclose(scores[0][i], scores[1][i], rel_tol=1e-9) for i in scores[0])


@pytest.mark.parametrize("n", [0, 1, 500])
def test_pairs_are_folded_by_context(n):
    rng = np.random.default_rng(n)
    pairs = np.unique(rng.integers(0, 60, (n, 2)).astype(np.uint32), axis=0)
    row = language_model._folded(pairs[:, 0], pairs[:, 1])
    assert (np.stack(language_model._unfolded(row), axis=1) == pairs).all()
    assert n < 500 or len(row["before"]) < 1.1 * len(pairs)


@pytest.mark.parametrize("values", [[], [0, 0], [0, 255, 3], [1, 1 << 40, 0], [-1, 5], [2**63 - 1]])
def test_packed_integers(values):
    values = np.array(values, np.int64)
    assert (unpacked(packed(values), np.int64) == values).all()
    ascending = np.sort(values.astype(np.uint64))
    assert (unpacked_gaps(packed_gaps(ascending), np.uint64) == ascending).all()
    assert len(unpacked(packed(values), np.int64)) == len(values)


def test_seating_bounds():
    rng = np.random.default_rng(1)
    customers = np.array([0, 1, 2, 50, 100_000])
    tables = language_model.seat(rng, customers, np.full(5, 10.0), np.full(5, 1e-3), 0.5, 1.0)
    assert (tables <= customers).all() and (tables >= np.minimum(customers, 1)).all()


def seatings(customers, others, base, discount, strength):
    """Probability of each number of tables, from every way to seat the customers one after the other."""
    found = {}

    def sit(tables, left, weight):
        if not left:
            found[len(tables)] = found.get(len(tables), 0) + weight
            return
        sit([*tables, 1], left - 1, weight * (strength + discount * (others + len(tables))) * base)
        for i, size in enumerate(tables):
            sit([*tables[:i], size + 1, *tables[i + 1 :]], left - 1, weight * (size - discount))

    sit([], customers, 1.0)
    return {t: w / sum(found.values()) for t, w in found.items()}


@pytest.mark.parametrize("customers,others,base,discount,strength", [(2, 0, 0.3, 0.5, 1.0), (5, 3, 0.4, 0.7, 1.0), (7, 40, 0.2, 0.2, 2.0)])
def test_seating_is_the_exact_conditional(customers, others, base, discount, strength):
    n = 40_000
    drawn = language_model.seat(np.random.default_rng(4), np.full(n, customers), np.full(n, others), np.full(n, base), discount, strength)
    want = seatings(customers, others, base, discount, strength)
    for tables, chance in want.items():
        assert abs((drawn == tables).mean() - chance) < 4 * (chance / n) ** 0.5 + 1e-4


@pytest.mark.parametrize("customers,others,base,discount", [(1500, 20, 0.1, 0.6), (2500, 2000, 0.01, 0.6), (2500, 5, 0.001, 0.8), (2500, 3000, 0.1, 0.7)])
def test_seating_of_many_customers(customers, others, base, discount):
    """Beyond 1,024 customers, against the distribution with all seatings summed exactly."""
    n = 10_000
    drawn = language_model.seat(np.random.default_rng(5), np.full(n, customers), np.full(n, others), np.full(n, base), discount, 1.0)
    t = np.arange(1, customers + 1)
    weight = language_model._log_seatings(discount, customers)[customers, 1:] + t * math.log(base) + np.cumsum(np.log(1 + discount * (others + t - 1)))
    want = np.exp(weight - weight.max())
    want /= want.sum()
    mean = (want * t).sum()
    spread = (want * (t - mean) ** 2).sum() ** 0.5
    assert abs(drawn.mean() - mean) < 0.02 * mean + 4 * spread / n**0.5
    assert abs(np.bincount(drawn, minlength=customers + 1)[1:] / n - want).sum() < 0.15


def test_contamination(spark):
    random.seed(4)
    vocabulary = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(random.choices(vocabulary, k=random.randint(8, 50)))) for i in range(20)] + [(90, None), (91, "too short")]
    docs, planted = [(999, None)], set()
    for i in range(120):
        words = random.choices(vocabulary, k=random.randint(0, 80))
        if i % 3 == 0:
            item, text = items[i % 20]
            own = text.split()
            for _ in range(random.randint(0, int(0.2 * len(own)))):
                at = random.randrange(len(own))
                random.choice([lambda a=at, o=own: o.__setitem__(a, "Q"), lambda a=at, o=own: o.insert(a, "Q"), lambda a=at, o=own: o.pop(a)])()
            at = random.randint(0, len(words))
            words[at:at] = own
            planted.add((i, item))
        docs.append((i, " ".join(words)))
    tables = spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.find_contamination(*tables).collect()}
    assert planted <= got and len(got - planted) <= 1
    assert {(r.doc_id, r.item_id) for r in decontaminate.find_contamination(*tables, block_words=200).collect()} == got


def test_items_left_out(spark):
    items = [(1, " a b\tc d e f g "), (2, "a b c d e f g h"), (3, None), (4, " "), (5, "a")]
    df = spark.createDataFrame(items, "item_id long, text string")
    assert sorted(r.item_id for r in decontaminate.left_out(df).collect()) == [1, 5]


def test_quality(spark):
    random.seed(5)
    good = lambda: " ".join(random.choices("the of and house tree water river".split(), k=60))
    docs = [(i, good() if i % 4 else "BUY!! " * 40) for i in range(200)] + [(None, None), (300, "")]
    df = spark.createDataFrame(docs, DOCS).repartition(2)
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(200)] + [(1, 7), (None, 1)], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.score_quality(df, labels).collect()}
    assert len(got) == len(docs) and all(got[i].predicted == int(i % 4 > 0) for i in range(200))
    assert got[None].held_out and 0 <= got[300].score <= 1
    assert {r.score for r in quality.score_quality(df, labels.limit(0)).collect()} == {0.5}
