"""What joins, sums and output move: facts without a key, lines of orders, partial sums of a month, processed rows."""

import datetime as dt

import pytest
from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql import functions as F

from salesloom import samples
from salesloom.checks import writes
from salesloom.plans import mart_state, star
from salesloom.scratch import materialise
from salesloom.sinks import processed


@pytest.fixture
def unmeasured(spark):
    """Joins shuffle, as those of large tables do."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def plan_of(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def ancestors(plan: str, leaf: str) -> list[str]:
    """Operators above the first line of the plan that names ``leaf``."""
    above: list[tuple[int, str]] = []
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        above = [x for x in above if x[0] < depth]
        if leaf in line and "Scan" in line:
            return [x for _, x in above]
        above.append((depth, line.strip(" :+-")))
    raise AssertionError(f"{leaf} is not scanned")


def test_facts_without_a_key_are_spread(spark, unmeasured):
    rows = [(str(i), star.UNKNOWN) for i in range(200)] + [(f"n{i}", None) for i in range(200)] + [("a", 1), ("b", 2)]
    facts = spark.createDataFrame(rows, "sale_id string, k long")
    known = spark.createDataFrame([(1, "one")], "k long, name string")
    for members, unknown in ((known, 0), (star.with_unknown(known, "k"), 200)):
        got = star.lookup(facts, members, "k", ["name"])
        assert got.columns == ["k", "sale_id", "name"] and got.count() == 402
        assert [tuple(r) for r in got.filter("name IS NOT NULL").collect()] == [(1, "a", "one")]
        met = star.meet(facts, members, "k", ["sale_id"])
        assert met.count() == unknown + 1 and {r.k for r in met.collect()} == ({1, star.UNKNOWN} if unknown else {1})
    parts = got.withColumn("part", F.spark_partition_id()).select("k", "part").distinct().groupBy("k").count()
    assert all((r["count"] > 1) == (r["k"] in (None, star.UNKNOWN)) for r in parts.collect())


def test_lookup_takes_keys_of_other_kinds(spark):
    facts = spark.createDataFrame([("x", dt.date(2026, 1, 1), {"a": 1}), (None, None, None)], "t string, d date, m map<string,int>")
    named = spark.createDataFrame([("x", dt.date(2026, 1, 1), "y")], "t string, d date, name string")
    for key in ("t", "d"):
        got = star.lookup(facts, named, key, ["name"]).collect()
        assert sorted(str(r.name) for r in got) == ["None", "y"]


def test_history_lists_versions_by_year_and_joins_sales_once(spark, tmp_path, unmeasured):
    day = dt.datetime(1996, 1, 5)
    late = dt.datetime(2005, 6, 1)
    tables = {
        "region": ([(1, "R")], "r_regionkey int, r_name string"),
        "nation": ([(1, "N", 1)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([(1, 1, "S")], "c_custkey long, c_nationkey int, c_mktsegment string"),
        "part": ([(1, "P", "B")], "p_partkey long, p_name string, p_brand string"),
        "orders": ([(1, 1, "O", day, "5-LOW"), (2, 1, "O", late, "5-LOW"), (3, 1, "O", late, "1-URGENT")],
                   "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp, o_orderpriority string"),
        "lineitem": ([(1, 1, 1, 2.0, 9.5, "F", day), (2, 1, 1, 2.0, 9.5, "F", day), (3, 1, 1, 2.0, 9.5, "F", day)],
                     "l_orderkey long, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, "
                     "l_linestatus string, l_shipdate timestamp"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    met = writes.fct_history(spark, str(tmp_path))
    assert sorted((r.sale_id, r.variant, r.valid_from.year) for r in met.collect()) == [
        ("1-1-1", "5-LOW", 1996), ("2-1-1", "1-URGENT", 2005), ("3-1-1", "1-URGENT", 2005)]
    assert "l_orderkey" not in plan_of(met)  # the sales were written down
    made = [r for r in plan_of(met).splitlines() if "Generate explode" in r]
    assert len(made) == 1 and "sequence(year(" in made[0]


def test_lines_shuffle_twice(spark, tmp_path, unmeasured):
    day = dt.datetime(2026, 1, 5)
    tables = {
        "region": ([(1, "R")], "r_regionkey int, r_name string"),
        "nation": ([(1, "N", 1)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([(1, 1, "S")], "c_custkey long, c_nationkey int, c_mktsegment string"),
        "part": ([(1, "P", "B")], "p_partkey long, p_name string, p_brand string"),
        "orders": ([(1, 1, "O", day, "5-LOW"), (2, 9, "O", day, "5-LOW")],
                   "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp, o_orderpriority string"),
        "lineitem": ([(1, 1, 1, 2.0, 9.5, "F", day), (1, 9, 1, 2.0, 9.5, "F", day), (2, 1, 1, 2.0, 9.5, "F", day)],
                     "l_orderkey long, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, "
                     "l_linestatus string, l_shipdate timestamp"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    sold = samples.sales(spark, str(tmp_path))
    assert [r.sale_id for r in sold.collect()] == ["1-1-1"]  # other lines lack a part or a buyer
    shuffles = [x for x in ancestors(plan_of(sold), "l_orderkey") if x.startswith("Exchange")]
    assert len(shuffles) == 2


def test_a_run_shuffles_once_into_few_files(spark, unmeasured):
    rows = [(str(i), dt.date(2026, 1 + i % 3, 1), i, i % 5, 1, 1.0, 2) for i in range(500)]
    schema = "sale_id string, sale_date date, product_key long, location_key long, status_key long, total_amount_ars double, quantity long"
    parts = mart_state.partials(spark.createDataFrame(rows, schema))
    assert plan_of(parts).count("Exchange") == 1 and "hashpartitioning(sale_month" in plan_of(parts)
    name = "ms_dealt"
    for run in ("r0", "r1"):
        mart_state.add_run(spark, name, spark.createDataFrame(rows, schema), run)
    files = spark.table(name).inputFiles()
    assert len(files) <= 2 * 3 * 4  # runs, months, partitions of the session
    state = plan_of(mart_state.live(spark.table(name)))
    assert not [x for x in ancestors(state, "total") if x.startswith("Exchange")]
    assert mart_state.compact(spark, name, least=2)
    assert {r.run[:5] for r in spark.table(name).select("run").distinct().collect()} == {"base_"}
    total = mart_state.kpis(spark.table(name)).first()
    assert (total.total_sales, total.sale_count, total.units_sold) == (1000.0, 1000, 2000)


def test_scratch_is_packed(spark):
    assert all(".zstd." in f for f in materialise(spark.range(10), "packed").inputFiles())


def test_output_of_few_inputs_is_not_sorted(spark, tmp_path, monkeypatch):
    names, seen = ("csv", "parquet"), []
    for name in names:
        real = getattr(DataFrameWriter, name)

        def writing(self, *args, _real=real, **options):
            seen.append(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters"))
            return _real(self, *args, **options)

        monkeypatch.setattr(DataFrameWriter, name, writing)
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    files = 3 * processed.WRITERS  # more than a task writes at the same time
    rows = spark.range(60, numPartitions=2).select(
        F.concat(F.lit("f"), F.col("id") % files, F.lit(".csv")).alias("file_name"),
        F.concat(F.lit("in/f"), F.col("id") % files, F.lit(".csv")).alias("file_path"), "id",
    )
    saved = processed.save_processed(rows, str(tmp_path / "out"))
    assert seen == [str(processed.WRITERS)] * 2 and saved.parquet_saved
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    back = spark.read.parquet(saved.parquet_path)
    assert sorted(r.id for r in back.collect()) == list(range(60))
    assert back.select("output", "input").distinct().count() == files
