import datetime as dt

import pytest
from helpers import FLAT, files_of, grid_of, sale
from pyspark.sql import functions as F

from salesloom.config import Config
from salesloom.operators.conform import Rules
from salesloom.plans import marts, quality, star
from salesloom.plans.ingest import RejectedFiles, ingest
from salesloom.plans.load import Tables, load_incremental
from salesloom.plans.models import build_models

HEADER = FLAT + ["SKU", "Titulo de la publicacion", "Ciudad", "Provincia", "Pais"]


def full(i, day, units, total, sku, title, city, state="córdoba", country="argentina"):
    return [i, day, " Entregado ", units, total, sku, title, city, state, country]


@pytest.fixture(scope="module")
def models(spark):
    grid = grid_of(spark, {"a": [
        HEADER,
        full(1, "2026-01-05", 2, "100,50", "A", "viejo", "río  cuarto"),
        full(2, "2026-02-07", 1, "10", "A", "nuevo", "Río Cuarto"),
        full(3, "2026-02-08", 3, "30", None, "suelto", "  ", None, None),
        full(4, None, 0, "-5", "B", "b", "rosario", "santa fe"),
    ]})
    done = ingest(grid, files_of(spark, ["a"]), Config(), Rules(run_year=2026), "s",
                  dt.datetime(2026, 4, 16))
    load_incremental(done.rows, tables=Tables("m_raw", "m_load", "m_audit"))
    return build_models(spark, "m_raw", "m_")


def test_staging_and_dimensions(models):
    staged = {r.sale_id: r for r in models["stg_sales"].collect()}
    assert staged["1"].buyer_city == "Río Cuarto" and staged["3"].buyer_city is None
    products = {r.sku: r.product_title for r in models["dim_product"].collect()}
    assert products == {"A": "nuevo", "B": "b", None: None}
    # with the member of facts without a key
    assert models["dim_date"].count() == 36 and models["dim_location"].count() == 3
    assert models["dim_load"].count() == 1


def test_facts_point_to_members(models):
    facts = {r.sale_id: r for r in models["fct_sales"].collect()}
    assert facts["3"].product_key == star.UNKNOWN and facts["3"].location_key == star.UNKNOWN
    assert facts["4"].date_key == star.UNKNOWN and facts["1"].date_key == 20260105
    known = {r.product_key for r in models["dim_product"].collect()}
    assert {f.product_key for f in facts.values()} == known
    for name in ("date", "product", "location", "status"):
        met = models["fct_sales"].join(models[f"dim_{name}"], f"{name}_key")
        assert met.count() == len(facts)


def test_marts(models):
    total = models["mart_summary"].first()
    assert (total.total_sales, total.sale_count, total.units_sold) == (135.5, 4, 6)
    assert total.average_ticket == 135.5 / 4
    monthly = {r.month: r.total_sales for r in models["mart_monthly"].collect()}
    assert monthly == {dt.date(2026, 1, 1): 100.5, dt.date(2026, 2, 1): 40.0, None: -5.0}
    by_product = {r.product_title: r.units_sold for r in models["mart_product"].collect()}
    assert by_product == {"nuevo": 3, None: 3, "b": 0}


def test_quality(models):
    failed = {r.rule: r.failed for r in models["dq_summary"].collect()}
    assert failed["sale_date_null"] == 1 and failed["sale_id_null"] == 0
    assert failed["quantity_not_positive"] == 1 and failed["total_negative"] == 1


def test_duplicates(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), (None,), (None,)], "k string")
    row = quality.duplicate_summary(df, "k").first()
    assert (row.duplicated_keys, row.surplus_rows) == (1, 2)


def test_filters_reach_the_scan(models):
    chosen = marts.filter_sales(models["fct_sales"], dt.date(2026, 2, 1), None, sale_id=["2", "9"])
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(sale_date), GreaterThanOrEqual(sale_date" in plan
    assert [r.sale_id for r in chosen.collect()] == ["2"]


def test_checked_key_sets_unknown(spark):
    facts = spark.createDataFrame([(1, "x"), (2, "y")], "k long, v string")
    members = spark.createDataFrame([(1,)], "k long")
    got = {r.v: r.k for r in star.checked_key(facts, members, "k").collect()}
    assert got == {"x": 1, "y": star.UNKNOWN}
    named = members.withColumn("name", F.lit("one"))
    got = {r.v: (r.k, r.name) for r in star.lookup_checked(facts, named, "k", ["name"]).collect()}
    assert got == {"x": (1, "one"), "y": (star.UNKNOWN, None)}


def test_all_or_nothing(spark):
    grid = grid_of(spark, {"ok": [FLAT, sale(1)], "bad": [FLAT[:4], sale(1)[:4]]})
    done = ingest(grid, files_of(spark, ["ok", "bad"]), Config(), Rules(run_year=2026))
    with pytest.raises(RejectedFiles, match="1 sheets rejected.*total_amount_ars"):
        done.require_all()
    ok = ingest(grid.filter(F.col("file_path") == "ok"), files_of(spark, ["ok"]), Config())
    assert ok.require_all() is ok
