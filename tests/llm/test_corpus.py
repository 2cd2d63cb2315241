"""Operators over a corpus against brute force."""

import collections
import random

import pytest
from pyspark.sql import functions as F

from llm.test_text import DOCS, words_of
from salesloom.llm import line_dedup, ngram_join, quality, substring_dedup, url_filter
from salesloom.llm.components import components


@pytest.mark.parametrize("bits", [6, 20])
def test_substrings(spark, bits):
    random.seed(3)
    docs = [(i if i % 17 else None, None if i % 29 == 0 else " ".join(random.choice("abc é d".split()) for _ in range(random.randint(0, 30)))) for i in range(120)]
    docs += docs[:9] + [(7, "z " * 50)]
    runs = [[tuple(w[i : i + 4]) for i in range(len(w) - 3)] for w in (words_of(t) for _, t in docs)]
    count = collections.Counter(r for own in runs for r in own)
    want = []
    for (d, t), own in zip(docs, runs, strict=True):
        words = words_of(t)
        gone = {k for i, r in enumerate(own) if count[r] > 1 for k in range(i, i + 4)}
        want.append((d, " ".join(w for k, w in enumerate(words) if k not in gone), len(words), len(gone)))
    df = spark.createDataFrame(docs, DOCS).withColumn("n_words", F.lit("other")).withColumn("extra", F.lit(1)).repartition(3)
    got = [(r.doc_id, r.text, r.n_words, r.n_removed) for r in substring_dedup.dedup_substrings(df, 4, bits=bits).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert substring_dedup.dedup_substrings(df.limit(0), 4, bits=bits).count() == 0


def grouped(docs, n, percent):
    sets = []
    for _, text in docs:
        w = words_of((text or "").translate({i: i + 32 for i in range(65, 91)}))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    parent = list(range(len(docs)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[top(i)] = min(least.get(top(i), d), d)
    return sorted(((d, len(s), least.get(top(i)) if s else d) for i, ((d, _), s) in enumerate(zip(docs, sets, strict=True))), key=str)


@pytest.mark.parametrize("n, percent, together, leads", [(3, 90, 32, 16), (5, 80, 32, 2), (2, 75, 2, 1)])
def test_near_duplicates(spark, monkeypatch, n, percent, together, leads):
    monkeypatch.setattr(ngram_join, "_TOGETHER", together)
    monkeypatch.setattr(ngram_join, "_LEADS", leads)
    monkeypatch.setattr(ngram_join, "_BIN", 3)
    monkeypatch.setattr(ngram_join, "_FLUSH", 50)
    random.seed(n)
    vocabulary, docs = [f"w{i}" for i in range(200)] + ["É", "A"], []
    for _ in range(8):
        base = random.choices(vocabulary, k=random.choice([1, 2, 6, 12, 40, 120]))
        for _ in range(random.randint(1, 12)):
            own = list(base)
            for _ in range(random.choice([0, 1, 1, 2, 5])):
                own[random.randrange(len(own))] = random.choice(vocabulary)
            docs.append((3 * len(docs) if random.random() < 0.95 else None, " ".join(own)))
    docs += [(5000, None), (5001, ""), *docs[:3]]
    df = spark.createDataFrame(docs, DOCS).withColumn("group", F.lit(1)).repartition(3)
    got = ngram_join.near_duplicates(df, n, percent, bits=16).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == grouped(docs, n, percent)


@pytest.mark.parametrize("leads", [16, 1])
def test_a_large_group_at_the_edge(spark, monkeypatch, leads):
    """200 copies of one text, each a few words away: some pairs are linked, some only through others."""
    monkeypatch.setattr(ngram_join, "_LEADS", leads)
    random.seed(11)
    base, docs = [f"w{i}" for i in range(120)], []
    for i in range(200):
        own = list(base)
        for _ in range(random.choice([1, 3, 4, 5])):
            own[random.randrange(len(own))] = random.choice(["x", "y", f"z{i}"])
        docs.append((i, " ".join(own)))
    got = ngram_join.near_duplicates(spark.createDataFrame(docs, DOCS).repartition(5), 5, 80, bits=16)
    got = sorted(map(tuple, got.select("doc_id", "n_shingles", "component_id").collect()), key=str)
    assert got == grouped(docs, 5, 80) and 2 < len({c for _, _, c in got}) < 150


def test_few_candidates_in_a_large_group(spark, monkeypatch):
    """Pairs whose rarest shared difference leaves too few others for a link are not compared."""
    seen, candidates = [], ngram_join._candidates
    monkeypatch.setattr(ngram_join, "_candidates", lambda *a: seen.append(candidates(*a).count()) or candidates(*a))
    random.seed(11)
    base, docs = [f"w{i}" for i in range(120)], []
    for i in range(200):
        own = list(base)
        for _ in range(random.choice([1, 3, 4, 5])):
            own[random.randrange(len(own))] = random.choice(["x", "y", f"z{i}"])
        docs.append((i, " ".join(own)))
    got = ngram_join.near_duplicates(spark.createDataFrame(docs, DOCS).repartition(5), 5, 80, bits=16)
    got = sorted(map(tuple, got.select("doc_id", "n_shingles", "component_id").collect()), key=str)
    assert got == grouped(docs, 5, 80)
    assert 0 < sum(seen) < 600, seen


def test_differences_held_alike_are_met_once(spark, monkeypatch):
    """An edit that some copies share makes several shared differences; a copy is held once for all of those."""
    rows, materialise = [], ngram_join.materialise

    def counted(df, name):
        made = materialise(df, name)
        rows.extend([made.count()] * (name == "found"))
        return made

    monkeypatch.setattr(ngram_join, "materialise", counted)
    random.seed(5)
    base, docs = [f"w{i}" for i in range(120)], []
    for i in range(60):
        own = list(base)
        for k in random.sample(range(0, 120, 12), 3):
            own[k] = f"x{k}"
        docs.append((i, " ".join(own)))
    got = ngram_join.near_duplicates(spark.createDataFrame(docs, DOCS).repartition(5), 5, 80, bits=16)
    got = sorted(map(tuple, got.select("doc_id", "n_shingles", "component_id").collect()), key=str)
    assert got == grouped(docs, 5, 80)
    assert 0 < sum(rows) <= 60 * 6, rows


def test_near_duplicates_of_nothing(spark):
    assert ngram_join.near_duplicates(spark.createDataFrame([], DOCS), bits=16).count() == 0


def test_components(spark):
    links = [(i, i + 1) for i in range(20)] + [(100, i) for i in range(101, 130)] + [(7, 7)]
    roots = {r.node: r.root for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert len({roots[i] for i in range(21)}) == 1 and len({roots[i] for i in range(100, 130)}) == 1 and len(set(roots.values())) == 2


def test_urls(spark):
    urls = {
        "http://EXample.com/en/x": ("example.com", "/en/x", "example.com/en/", "block"),
        "https://a.www.example.com/en/q?x=1": ("a.www.example.com", "/en/q", "www.example.com/en/", "allow"),
        "http://net/fr/": ("net", "/fr/", "net/fr/", "block"),
        "ftp://x.org/login?a": ("x.org", "/login", None, "block"),
        "http://x.com?y=/en/": ("x.com", "", None, "allow"),
        "http://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
        "nope": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
    }
    df = spark.createDataFrame([(u, 1) for u in urls] * 2, "url string, rule int")
    df = df.withColumns({"_url": F.lit("x"), "first": F.lit(2), "kind": F.lit(3), "token": F.lit("net")})
    got = url_filter.judge_urls(df).collect()
    assert len(got) == 2 * len(urls)
    assert all((r.host, r.path, r.rule, r.verdict) == urls[r.url] for r in got)
    assert {(r._url, r["first"], r.kind, r.token) for r in got} == {("x", 2, 3, "net")}
    assert url_filter.judge_urls(df.limit(0)).count() == 0


def test_lines(spark):
    docs = [(i, "h", f"same line\n\nu{i}\nv{i}") for i in range(20)] + [(100 + i, "g", "same line\nz") for i in range(30)]
    docs += [(200, None, None), (201, "h", "same line"), (202, "h", "")]
    df = spark.createDataFrame(docs, "doc_id long, source string, text string").withColumn("n_lines", F.lit("other"))
    got = {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in line_dedup.drop_boilerplate(df).collect()}
    assert got[0] == ("\nu0\nv0", 3, 1)
    assert got[100] == ("same line\nz", 2, 0)  # copies of one page count once
    assert got[200] == (None, 0, 0) and got[201] == ("", 1, 1) and got[202] == ("", 0, 0)
    assert line_dedup.drop_boilerplate(df.limit(0)).count() == 0


def test_lines_by_share_alone(spark):
    docs = [(i, f"site{n}", ("header\n" if i % 5 == 0 else "") + f"u{i}\nv{i}\nw{i}") for n in (10, 50, 500) for i in range(n)]
    df = spark.createDataFrame(docs, "doc_id long, source string, text string").repartition(3)
    got = line_dedup.drop_boilerplate(df).collect()
    assert len(got) == len(docs)
    for r in got:
        assert (r.text, r.n_dropped) == (f"u{r.doc_id}\nv{r.doc_id}\nw{r.doc_id}", int(r.doc_id % 5 == 0)), r.source


def test_lines_of_pages_that_are_mostly_boilerplate(spark):
    docs = [(i, "h", f"header\nu{i}\nheader\nfooter") for i in range(20)] + [(50, "h", "header\nfooter"), (51, "h", None)]
    df = spark.createDataFrame(docs, "doc_id long, source string, text string")
    got = {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in line_dedup.drop_boilerplate(df).collect()}
    assert all(got[i] == (f"u{i}", 4, 3) for i in range(20))
    assert got[50] == ("", 2, 2) and got[51] == (None, 0, 0)


def test_lines_are_compared_without_blanks_only(spark):
    docs = [(i, "h", f" header  \n1u{i}1\nw{i}") for i in range(30)]
    got = line_dedup.drop_boilerplate(spark.createDataFrame(docs, "doc_id long, source string, text string")).collect()
    assert all((r.text, r.n_dropped) == (f"1u{r.doc_id}1\nw{r.doc_id}", 1) for r in got)


def test_null_and_empty_texts_are_one_page(spark):
    docs = [(i, "h", f"{'same' if i < 10 else f'x{i}'}\nu{i}") for i in range(198)] + [(300, "h", None), (301, "h", "")]
    got = line_dedup.drop_boilerplate(spark.createDataFrame(docs, "doc_id long, source string, text string"), ratio=0.05023).collect()
    assert {r.doc_id for r in got if r.n_dropped and r.doc_id < 10} == set(range(10))  # 10 of 199 pages, not of 200


def test_quality_keeps_columns_named_like_statistics(spark):
    good, bad = "a plain line of several common words .", "zz zz zz ## 99 %%"
    docs = [(i, good if i % 2 else bad, f"own {i}", -1.0) for i in range(60)] + [(70, None, "own 70", -1.0), (71, "", "own 71", -1.0)]
    df = spark.createDataFrame(docs, f"doc_id long, text string, note string, {quality.STATISTICS[1]} double")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    scored = quality.score_quality(df, labels)
    assert scored.columns == ["doc_id", "note", quality.STATISTICS[1], "held_out", "score", "predicted"]
    rows = {r.doc_id: r for r in scored.collect()}
    assert len(rows) == 62 and {r[2] for r in rows.values()} == {-1.0} and all(0 <= r.score <= 1 for r in rows.values())
    assert all(rows[i].predicted == i % 2 for i in range(60))
    kept = quality.keep_quality(df, labels)
    assert kept.columns == df.columns
    assert sorted(map(tuple, kept.collect())) == [d for d in docs if rows[d[0]].predicted]
