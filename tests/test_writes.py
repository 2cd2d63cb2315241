"""Key index, marts kept up to date, product history, rules as data."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from salesloom.operators import incremental as I
from salesloom.operators import key_index
from salesloom.plans import history, mart_state, quality, star


def test_index_reads_few_files_and_misses_none(spark, tmp_path):
    random.seed(4)
    path = str(tmp_path / "t")
    keys = [f"{random.getrandbits(60):x}" for _ in range(4000)]
    rows = [(k, i % 40) for i, k in enumerate(keys)] + [(None, 3), (None, 4)]
    spark.createDataFrame(rows, "k string, part int").repartition("part").write.partitionBy("part").parquet(path)
    target = spark.read.parquet(path)
    read = spark.read.option("basePath", path).schema(target.schema)
    files = target.inputFiles()
    assert len(files) == 40
    old = [f for f in files if not f.rpartition("part=")[2].startswith("7/")]
    for _ in range(2):
        key_index.refresh(spark, old, "kx_keys", "k", lambda paths: read.parquet(*paths))
    held = spark.table("kx_keys").select("file", "bucket")
    assert held.count() == held.distinct().count() and held.select("file").distinct().count() == 39
    staged = spark.createDataFrame([(keys[5],), (keys[45],), (keys[6],), ("absent",), (None,)], "k string")
    got = key_index.files_to_read(spark, files, "kx_keys", staged, "k")
    assert sorted(int(f.rpartition("part=")[2].split("/")[0]) for f in got) == [5, 6, 7]  # 7 is not indexed
    near = I.new_rows(staged, read.parquet(*got), "k")
    assert sorted(str(r.k) for r in near.collect()) == ["None", "absent"]
    assert key_index.files_to_read(spark, files, "kx_keys", staged.limit(0), "k") == [f for f in files if "part=7/" in f]


def test_index_of_numbers_answers_like_a_join(spark, tmp_path):
    path = str(tmp_path / "n")
    spark.range(3000).select((F.col("id") * 7 % 10007 - 5000).alias("k"), (F.col("id") % 11).alias("part")).repartition("part").write.partitionBy("part").parquet(path)
    target = spark.read.parquet(path)
    index = key_index.index_rows(target.select("k", F.col("part").cast("string").alias("file")), "k")
    staged = spark.range(-40, 40).select((F.col("id") * 3).alias("k"))
    told = {r.file for r in key_index.files_with(index, staged, "k").collect()}
    assert told >= {str(r.part) for r in target.join(staged, "k").select("part").distinct().collect()}


def facts_of(spark, rows):
    schema = "sale_id string, sale_date date, product_key long, location_key long, status_key long, total_amount_ars double, quantity long"
    return spark.createDataFrame(rows, schema)


def test_state_equals_a_rebuild(spark):
    random.seed(1)
    day = lambda m: dt.date(2026, m, random.randint(1, 28))
    loads = [[(f"{n}-{i}" if i else None, day(random.randint(n + 1, n + 2)) if i % 9 else None, i % 3, 1, 1, i / 4, i) for i in range(40)] for n in range(3)]
    name = "ms_state"
    for n, rows in enumerate(loads):
        before = {f for f in spark.table(name).inputFiles()} if n else set()
        mart_state.add_run(spark, name, facts_of(spark, rows), f"r{n}")
        mart_state.add_run(spark, name, facts_of(spark, rows), f"r{n}")
        kept = {f for f in spark.table(name).inputFiles()}
        assert before <= kept and all(f"run=r{n}/" in f for f in kept - before)  # only its own months are written
        want = facts_of(spark, [r for own in loads[: n + 1] for r in own])
        for by in ([], ["product_key"]):
            state = sorted(map(str, mart_state.kpis(spark.table(name), *by).collect()))
            assert state == sorted(map(str, mart_state.kpis(mart_state.partials(want).withColumns({"run": F.lit("x"), "covers": F.lit(None).cast("array<string>")}), *by).collect()))
    monthly = mart_state.kpi_monthly(spark.table(name))
    want = sorted(map(str, monthly.collect()))
    # a compaction that died before it dropped what it covers
    stale = spark.table(name).collect()
    assert set(mart_state.compact(spark, name, least=2)) == {"2026-02", "2026-03", "none"}
    assert sorted(map(str, mart_state.kpi_monthly(spark.table(name)).collect())) == want
    for run in {r.run for r in stale}:
        rows = spark.createDataFrame([r for r in stale if r.run == run], spark.table(name).schema)
        mart_state._write(spark, name, rows, run)
    assert sorted(map(str, mart_state.kpi_monthly(spark.table(name)).collect())) == want
    assert mart_state.compact(spark, name, least=2) == []


def test_history(spark):
    d = lambda m, n: dt.date(2026, m, n)
    rows = [("1", d(1, 5), "A", "p", "old", "x"), ("2", d(1, 5), "A", "p", "first", "x"), ("3", d(1, 9), "A", "p", "first", "x"),
            ("4", d(3, 2), "A", "p", "new", None), ("5", d(3, 4), "A", "p", "first", "x"), ("6", d(2, 1), "B", "p", "b", "y"),
            ("7", None, "A", "p", "lost", "x"), ("8", d(2, 2), None, None, "none", "z")]
    sales = spark.createDataFrame(rows, "sale_id string, sale_date date, sku string, publication_id string, product_title string, variant string")
    versions = history.product_history(sales, ["sale_date", "sale_id"])
    got = sorted((r.sku, r.valid_from, r.product_title, r.valid_to) for r in versions.collect())
    assert got == [("A", d(1, 5), "first", d(3, 2)), ("A", d(3, 2), "new", d(3, 4)), ("A", d(3, 4), "first", None), ("B", d(2, 1), "b", None)]
    facts = sales.withColumn("product_key", star.surrogate_key(*star.PRODUCT)).select("sale_id", "sale_date", "product_key")
    more = spark.createDataFrame([("9", d(1, 4)), ("10", d(2, 15)), ("11", d(12, 31))], "sale_id string, sale_date date")
    more = more.withColumns({"sku": F.lit("A"), "publication_id": F.lit("p")}).withColumn("product_key", star.surrogate_key(*star.PRODUCT))
    facts = facts.unionByName(more.select(*facts.columns))
    titles = {r.sale_id: r.product_title for r in history.as_of(facts, versions, "product_key", ["product_title"]).collect()}
    assert titles == {"1": "first", "2": "first", "3": "first", "4": "new", "5": "first", "6": "b", "7": None, "8": None, "9": None, "10": "first", "11": "first"}


@pytest.mark.parametrize("parts", [1, 5])
def test_rules_keep_a_bounded_sample(spark, parts):
    df = spark.range(1000).withColumns({"v": F.col("id") % 10, "n": F.lit(None).cast("int")}).repartition(parts)
    rules = {"ten": "v = 0", "never": "v > 9", "unknown": "n > 1", "all": "true"}
    got = {r.rule: r for r in quality.evaluate(df, rules, "id").collect()}
    assert {n: (r.failed, r.total) for n, r in got.items()} == {"ten": (100, 1000), "never": (0, 1000), "unknown": (0, 1000), "all": (1000, 1000)}
    sample = got["ten"].sample.split("|")
    assert len(sample) == 4 and all(int(x) % 10 == 0 for x in sample) and got["never"].sample == ""
    again = quality.evaluate(df.repartition(7), rules, "id").filter("rule = 'ten'").first().sample
    assert again == got["ten"].sample
