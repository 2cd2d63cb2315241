import datetime as dt

import pytest
from helpers import FLAT, files_of, grid_of, sale, write_workbook
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from salesloom.config import Config, ConfigError
from salesloom.operators import incremental as I
from salesloom.operators.conform import Rules
from salesloom.plans.ingest import ingest
from salesloom.plans import load
from salesloom.plans.load import Tables, load_incremental
from salesloom.streaming.files import ingest_stream, merge_batch, merge_stream, workbook_stream


def batch(spark, files, session, day):
    return ingest(
        grid_of(spark, files), files_of(spark, files), Config(), Rules(run_year=2026),
        session_id=session, loaded_at=dt.datetime(2026, 4, day, 3),
    )


def test_incremental_load(spark):
    tables = Tables("t_sales", "t_sales_load", "t_loads")
    first = {"a": [FLAT, sale(1), sale(2), sale(1, status="repetida"), sale(None), sale(None)],
             "b": [FLAT, sale(2, status="tarde"), sale(3)],
             "bad": [["x"]]}
    one = batch(spark, first, "s1", 16)
    report = {r.file_name: r for r in load_incremental(one.rows, tables=tables, sheets=one.sheets).collect()}
    a, b = report["a"], report["b"]
    assert (a.rows_in_file, a.duplicate_rows, a.rows_after_dedup, a.rows_inserted) == (5, 2, 3, 3)
    # sale 2 is no repeat within b, but came with a before
    assert (b.rows_in_file, b.duplicate_rows, b.rows_after_dedup, b.rows_already_existing, b.rows_inserted) == (2, 0, 2, 1, 1)
    assert (a.rows_present_for_hash, b.rows_present_for_hash) == (3, 1)
    stored = spark.table("t_sales")
    assert sorted((r.sale_id or "", r.sale_status) for r in stored.collect()) == [
        ("", "Entregado"), ("1", "Entregado"), ("2", "Entregado"), ("3", "Entregado")]

    again = batch(spark, {"a": first["a"]}, "s2", 17)
    row = load_incremental(again.rows, tables=tables).first()
    # known keys stay out, the null key comes back
    assert (row.rows_already_existing, row.rows_inserted, row.rows_inserted_derived) == (2, 1, 1)

    late = batch(spark, {"c": [FLAT, sale(1, status="cambiada"), sale(9)]}, "s3", 18)
    row = load_incremental(late.rows, tables=tables).first()
    assert (row.rows_already_existing, row.rows_inserted) == (1, 1)
    kept = spark.table("t_sales").filter("sale_id = '1'").collect()
    assert [r.sale_status for r in kept] == ["Entregado"]
    days = {str(r.load_date) for r in spark.table("t_sales").select("load_date").distinct().collect()}
    assert days == {"2026-04-16", "2026-04-17", "2026-04-18"}
    audit = spark.table("t_loads").collect()
    assert sorted(r.status for r in audit) == ["loaded"] * 4 + ["rejected: no header"]
    by_hash = I.count_by_hash(spark.table("t_sales"), "hash-a").first().row_count
    assert by_hash == 4


def test_whole_rows_pass_one_window(spark, monkeypatch):
    """The windows that count a file's own rows see keys and places only."""
    tables = Tables("w_sales", "w_sales_load", "w_loads")
    files = {"b": [FLAT, sale(1, status="b1"), sale(3), sale(None)], "a": [FLAT, sale(1), sale(1, status="a2"), sale(None)]}
    rows, seen, firsts = batch(spark, files, "s1", 16).rows, [], I.first_of_files
    monkeypatch.setattr(I, "first_of_files", lambda df, *a: seen.append(set(df.columns)) or firsts(df, *a))
    load.begin(rows, tables=tables)
    assert seen == [{"sale_id", "load_id", "file_path", "sheet", "source_row_number"}]
    staged = sorted((r.sale_id or "", r.file_name, r.sale_status) for r in spark.table("w_sales_load").collect())
    assert staged == [("", "a", "Entregado"), ("", "b", "Entregado"), ("1", "a", "Entregado"), ("3", "b", "Entregado")]
    counts = {r.file_name: (r.rows_in_file, r.rows_after_dedup, r.rows_inserted) for r in spark.table(tables.pending).collect()}
    assert counts == {"a": (3, 2, 2), "b": (3, 3, 2)}


@pytest.mark.parametrize("stop", ["staged", "begun", "half appended", "appended", "half settled"])
def test_a_load_that_died_is_finished(spark, stop):
    name = "d_" + stop.replace(" ", "_")
    tables = Tables(name, f"{name}_load", f"{name}_audit")
    old = batch(spark, {"o": [FLAT, sale(1), sale(None)]}, "s0", 15)
    load_incremental(old.rows, tables=tables)
    files = {"a": [FLAT, sale(1), sale(2), sale(3), sale(None)], "b": [FLAT, sale(3), sale(4), sale(None)], "x": [["?"]]}
    new = batch(spark, files, "s1", 16)
    if stop == "staged":
        load.stage(new.rows, Config(), tables)
    else:
        load.begin(new.rows, tables=tables, sheets=new.sheets)
    if stop == "half appended":
        half = spark.table(tables.staging).filter("sale_id = '2' OR (sale_id IS NULL AND file_name = 'b')")
        load.append_clustered(half, tables)
    elif stop in ("appended", "half settled"):
        load.append(spark, tables)
    if stop == "half settled":
        spark.table(tables.pending).filter("file_name = 'a'").drop("run").write.insertInto(tables.audit)
    for _ in range(2):
        report = {r.file_name: r for r in load_incremental(new.rows, tables=tables, sheets=new.sheets).collect()}
        counts = {n: (r.rows_after_dedup, r.rows_already_existing, r.rows_inserted) for n, r in report.items()}
        assert counts == {"a": (4, 1, 3), "b": (3, 1, 2)}
        assert sorted(r.sale_id or "" for r in spark.table(name).collect()) == ["", "", "", "1", "2", "3", "4"]
        statuses = sorted(r.status for r in spark.table(tables.audit).collect())
        assert statuses == ["loaded"] * 3 + ["rejected: no header"]
        assert spark.table(tables.pending).isEmpty() and load.recover(spark, tables) == []


def test_load_guards(spark):
    with pytest.raises(ConfigError):
        load_incremental(spark.createDataFrame([("1",)], "sale_id string"))
    with pytest.raises(ConfigError):
        load_incremental(spark.createDataFrame([("1",)], "file_hash string"))
    with pytest.raises(ValueError):
        load_incremental(spark.createDataFrame([], "sale_id string, file_hash string"))


def test_dedup_orders(spark):
    df = spark.createDataFrame([("k", 1, "a"), ("k", 2, "b"), (None, 1, "c"), (None, 2, "d")],
                               "k string, o int, v string")
    assert sorted(r.v for r in I.keep_first(df, "k", ["o"]).collect()) == ["a", "c"]
    assert sorted(r.v for r in I.keep_last(df, "k", ["o"]).collect()) == ["b", "d"]
    assert sorted(r.v for r in I.keep_first(df, "k", ["o"], ["v"]).collect()) == ["a", "c", "d"]


def test_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = I.keep_first(df, "k", ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.one_of(st.none(), st.integers(0, 12)), max_size=20),
    st.lists(st.one_of(st.none(), st.integers(0, 12)), min_size=1, max_size=20),
)
def test_merge_against_brute_force(spark, old, new):
    schema = "k int, n int"
    target = spark.createDataFrame([(k, i) for i, k in enumerate(old)], schema)
    staged = spark.createDataFrame([(k, 100 + i) for i, k in enumerate(new)], schema)
    deduped = I.keep_first(staged, "k", ["n"])
    firsts, seen = [], set()
    for i, k in enumerate(new):
        if k not in seen:
            seen.add(k)
            firsts.append((k, 100 + i))
    expected = [(k, n) for k, n in firsts if k is None or k not in old]
    got = [tuple(r) for r in I.new_rows(deduped, target, "k").select("k", "n").collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, expected))
    pairs = sum(old.count(k) for k, _ in firsts if k is not None)
    assert I.count_existing(deduped, target, "k").first().row_count == pairs
    merged = I.insert_only_merge(target, deduped, "k")
    assert merged.count() == len(old) + len(expected)
    assert I.new_rows(deduped.filter("k is not null"), merged, "k").count() == 0


def test_stream_twice(spark, tmp_path):
    source, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    rows = [(i % 7 if i else None, i) for i in range(30)]
    df = spark.createDataFrame(rows, "k int, n int")
    df.write.parquet(source)
    for _ in range(2):
        stream = spark.readStream.schema(df.schema).parquet(source)
        merge_stream(stream, out, "k", ["n"], mark).awaitTermination()
        got = sorted((-1 if r.k is None else r.k, r.n) for r in spark.read.parquet(out).collect())
        assert got == [(-1, 0), (0, 7)] + [(k, k) for k in range(1, 7)]
    spark.createDataFrame([(3, 99), (50, 100)], df.schema).write.mode("append").parquet(source)
    stream = spark.readStream.schema(df.schema).parquet(source)
    merge_stream(stream, out, "k", ["n"], mark).awaitTermination()
    assert spark.read.parquet(out).count() == 9


def test_workbook_stream(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    target, reports, mark = (str(tmp_path / n) for n in ("t", "r", "m"))

    def run():
        ingest_stream(workbook_stream(spark, str(inbox)), target, reports, mark,
                      rules=Rules(run_year=2026)).awaitTermination()
        return sorted(r.sale_id for r in spark.read.parquet(target).collect())

    write_workbook(inbox / "a.xlsx", {"S": [FLAT, sale(1), sale(2)]})
    assert run() == ["1", "2"]
    assert run() == ["1", "2"]
    write_workbook(inbox / "b.xlsx", {"S": [FLAT, sale(2), sale(3)]})
    assert run() == ["1", "2", "3"]
    assert spark.read.parquet(reports).count() == 2


def test_replayed_batch_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, 1), (None, 2), (2, 3)], "k int, n int")
    second = spark.createDataFrame([(2, 4), (5, 5), (None, 6)], "k int, n int")
    # a restart replays the last batch only; the earlier ones are committed
    for batch, number in ((first, 0), (second, 1), (second, 1)):
        merge_batch(batch, number, path, "k", ["n"])
    got = sorted((-1 if r.k is None else r.k, r.n) for r in spark.read.parquet(path).collect())
    assert got == [(-1, 2), (-1, 6), (1, 1), (2, 3), (5, 5)]


def test_a_small_load_does_not_shuffle_the_target(spark, tmp_path):
    spark.range(50_000).selectExpr("cast(id as string) sale_id").write.parquet(str(tmp_path / "t"))
    spark.range(49_990, 50_010).selectExpr("cast(id as string) sale_id").write.parquet(str(tmp_path / "s"))
    target, staged = spark.read.parquet(str(tmp_path / "t")), spark.read.parquet(str(tmp_path / "s"))
    for df, rows in ((I.new_rows(staged, target, "sale_id"), 10), (I.existing_pairs(staged, target, "sale_id"), 10)):
        assert df.count() == rows
        plan = df._jdf.queryExecution().executedPlan().toString()
        scan = next(k for k, line in enumerate(plan.splitlines()) if "FileScan" in line and f"{tmp_path}/t" in line)
        above = plan.splitlines()[:scan]
        near = max(k for k, line in enumerate(above) if "LeftSemi" in line)
        assert "BroadcastHashJoin" in above[near] and not any("Exchange hash" in line for line in above[near:scan])
