import datetime as dt

import pytest
from helpers import FLAT, files_of, grid_of, sale
from pyspark.sql import functions as F

from salesloom.config import Config, ConfigError
from salesloom.operators import grid as G
from salesloom.operators.conform import Rules, cast_declared, conversion_report
from salesloom.operators.headers import (
    detect_headers,
    header_candidates,
    header_labels,
)
from salesloom.operators.mapping import alias_conflicts, duplicate_targets, map_labels
from salesloom.plans.ingest import ingest

NOW = dt.datetime(2026, 4, 16, 3, 15, 22)
CONFIG = Config()

TWO_LEVEL = [
    [],
    ["Reporte de ventas"],
    [],
    [None, "Ventas", None, None, None, None, "Publicaciones", "Compradores", None, "Envíos"],
    [None, "# de venta", "Fecha de venta", "Estado", "Unidades", "Total (ARS)", "SKU", "Comprador",
     "Estado", "Fecha en camino"],
    [None, 2000001, "12 de abril de 2026 17:10 hs.", "Entregado", 2, "$ 1.234,50", "A-1", "Ana",
     "Córdoba", "13 de abril | 09:05"],
    [None, 2000002, "30 de diciembre de 2025", "En camino", "3,0", "ARS 10", " B ", None, "  ",
     "2 de enero | 10:00"],
]

FILES = {
    "two_level.xlsx": TWO_LEVEL,
    "flat.xlsx": [FLAT, sale(1), sale(2)],
    "reordered.xlsx": [FLAT[::-1], sale(1)[::-1], sale(2)[::-1]],
    "extra_column.xlsx": [FLAT + ["Columna nueva"], sale(1) + ["x"], sale(2) + [None]],
    "missing_required.xlsx": [FLAT[:4], sale(1)[:4]],
    "empty_required.xlsx": [FLAT, [1, "fecha", "x", None, "5"]],
    "blank_rows.xlsx": [FLAT, sale(1), [None] * 5, [], sale(2), [None] * 5, sale(3)],
    "duplicate_target.xlsx": [FLAT + ["Cantidad"], sale(1) + [1]],
    "repeated_header.xlsx": [
        ["Ventas", None, None, None, None, None],
        ["# de venta", "Fecha de venta", "Estado", "Unidades", "Total (ARS)", "Estado"],
        sale(1) + ["otro"],
    ],
    "title_above.xlsx": [["Reporte"], FLAT, sale(1)],
    "late_header.xlsx": [[f"linea {i}"] for i in range(15)] + [FLAT, sale(1)],
    "no_alias.xlsx": [["a", "b", "c", "d", "e"], [1, 2, 3, 4, 5]],
    "one_alias.xlsx": [["SKU"], ["x"]],
    "tie.xlsx": [["SKU"], ["SKU"], ["x"]],
    "bad_int.xlsx": [FLAT, sale(1), sale(2, units="1,5")],
    "bad_date.xlsx": [FLAT, sale(1, date="31 de febrero de 2026")],
}


@pytest.fixture(scope="module")
def result(spark):
    return ingest(
        grid_of(spark, FILES),
        files_of(spark, [*FILES, "empty.xlsx"]),
        CONFIG,
        Rules(run_year=2026),
        session_id="session_x",
        loaded_at=NOW,
    )


@pytest.fixture(scope="module")
def sheets(result):
    return {r.file_name: r for r in result.sheets.collect()}


def rows_of(result, name):
    return result.rows.filter(F.col("file_name") == name).orderBy("source_row_number").collect()


def test_status_of_every_layout(sheets):
    assert {n: s.status for n, s in sheets.items()} == {
        "two_level.xlsx": "accepted",
        "flat.xlsx": "accepted",
        "reordered.xlsx": "accepted",
        "extra_column.xlsx": "accepted",
        "missing_required.xlsx": "missing required columns",
        "empty_required.xlsx": "missing required columns",
        "blank_rows.xlsx": "accepted",
        "duplicate_target.xlsx": "duplicate targets",
        "repeated_header.xlsx": "accepted",
        "title_above.xlsx": "missing required columns",
        "late_header.xlsx": "no header",
        "no_alias.xlsx": "no header",
        "one_alias.xlsx": "missing required columns",
        "tie.xlsx": "missing required columns",
        "bad_int.xlsx": "unreadable values",
        "bad_date.xlsx": "unreadable values",
        "empty.xlsx": "empty",
    }


def test_header_details(sheets):
    two = sheets["two_level.xlsx"]
    assert (two.header_row, two.category_row_used, two.mapped_count) == (4, True, 9)
    assert two.unmapped_columns == [] and two.extra_columns == []
    assert sheets["no_alias.xlsx"].score == 2.5
    assert sheets["one_alias.xlsx"].score == 3.0
    assert sheets["tie.xlsx"].header_row == 0
    assert sheets["missing_required.xlsx"].missing_required == ["total_amount_ars"]
    assert sheets["empty_required.xlsx"].missing_required == ["quantity"]
    assert sheets["duplicate_target.xlsx"].duplicate_targets == ["quantity"]
    assert sheets["repeated_header.xlsx"].unmapped_columns == ["Ventas Estado__2"]
    assert sheets["bad_int.xlsx"].bad_columns == ["quantity"]
    assert sheets["bad_date.xlsx"].bad_columns == ["sale_date"]
    assert set(sheets["flat.xlsx"].missing_schema) >= {"load_id", "loaded_at", "sku"}


def test_typed_values(result):
    first, second = rows_of(result, "two_level.xlsx")
    assert first.sale_id == "2000001" and first.sale_date == dt.date(2026, 4, 12)
    assert (first.quantity, first.total_amount_ars, first.buyer_state) == (2, 1234.5, "Córdoba")
    assert first.shipped_at == dt.datetime(2026, 4, 13, 9, 5)
    assert (second.quantity, second.sku, second.buyer_name, second.buyer_state) == (3, "B", None, "")
    assert second.shipped_at == dt.datetime(2025, 1, 2, 10)
    assert first.return_quantity is None and first.extras == {}
    assert (first.header_row_detected, first.source_row_number, first.source_sheet) == (4, 6, "0")


def test_reordered_equals_flat(result):
    pick = lambda name: [(r.sale_id, r.sale_date, r.quantity, r.total_amount_ars) for r in rows_of(result, name)]  # noqa: E731, E501
    assert pick("flat.xlsx") == pick("reordered.xlsx")


def test_extras_and_blank_rows(result):
    assert [r.extras for r in rows_of(result, "extra_column.xlsx")] == [
        {"Columna nueva": "x"},
        {"Columna nueva": None},
    ]
    blank = rows_of(result, "blank_rows.xlsx")
    assert [r.source_row_number for r in blank] == [2, 3, 4]
    assert [r.physical_row_number for r in blank] == [2, 5, 7]


def test_metadata(result):
    row = rows_of(result, "flat.xlsx")[0]
    assert row.load_id.startswith("load_20260416T031522Z_") and len(row.load_id) == 30
    assert (row.session_load_id, row.file_hash, row.loaded_at) == ("session_x", "hash-flat.xlsx", NOW)


def test_one_huge_file_is_numbered_over_many_chunks(spark):
    n = 1000
    table = [["titulo"], [], FLAT] + [sale(i) if i % 7 else [None] * 5 for i in range(n)]
    grid = grid_of(spark, {"big.xlsx": table})
    out = ingest(grid, files_of(spark, ["big.xlsx"]), CONFIG, Rules(run_year=2026),
                 loaded_at=NOW, chunk_rows=64)
    got = [(r.sale_id, r.source_row_number, r.physical_row_number)
           for r in out.rows.orderBy("source_row_number").collect()]
    kept = [i for i in range(n) if i % 7]
    assert got == [(str(i), 4 + k, 4 + i) for k, i in enumerate(kept)]


def test_candidates_report(spark):
    grid = grid_of(spark, {"f": FILES["two_level.xlsx"]})
    rows = header_candidates(grid, CONFIG.alias_targets).orderBy("row_idx").collect()
    # category row: three alias-free cells; field row: seven aliases and two plain "estado"
    assert [r.score for r in rows] == [0.0, 0.0, 0.0, 1.0, 23.5, -0.5, 0.5]
    assert rows[4].values[0] == "# de venta"
    best = detect_headers(grid, CONFIG.alias_targets).first()
    assert best.header_row == 4 and best.header_found


def test_next_row_bonus_needs_the_very_next_row(spark):
    table = {"a": [["x y"], [5]], "b": [["x y"], [], [5]]}
    got = {
        r.file_path: r.score
        for r in header_candidates(grid_of(spark, table), CONFIG.alias_targets)
        .filter("row_idx = 0")
        .collect()
    }
    assert got == {"a": 0.5, "b": 0.0}


def test_labels(spark):
    grid = grid_of(spark, {"f": [[None, "Ventas", None, None, "Compradores", None],
                                 ["sku", "a", "a", None, "# de venta", None, "a"]]})
    found = detect_headers(grid, CONFIG.alias_targets).withColumn("header_found", F.lit(True))
    found = found.filter("header_row = 1")
    rows = header_labels(found).orderBy("pos").collect()
    assert [r.category_label for r in rows] == ["", "Ventas", "Ventas", "Ventas", "Compradores",
                                                "Compradores", "Compradores"]
    assert [r.source_label for r in rows] == [
        "sku", "Ventas a", "Ventas a__2", "Ventas", "Compradores # de venta", "Compradores",
        "Compradores a",
    ]


def test_unique_labels(spark):
    grid = grid_of(spark, {"f": [["sku", "sku", None, None, "sku", "fecha"]]})
    rows = header_labels(detect_headers(grid, CONFIG.alias_targets)).orderBy("pos").collect()
    assert [r.source_label for r in rows] == [
        "sku", "sku__2", "unnamed_column", "unnamed_column__2", "sku__3", "fecha",
    ]


def test_cells_beyond_the_header_get_a_label(spark):
    grid = grid_of(spark, {"f": [FLAT, sale(1) + [None, "suelto"]]})
    found = detect_headers(grid, CONFIG.alias_targets)
    labels = header_labels(found, G.column_fill(G.profile(grid)))
    rows = {r.pos: (r.source_label, r.filled) for r in labels.collect()}
    assert rows[5] == ("unnamed_column", False) and rows[6] == ("unnamed_column__2", True)


def test_duplicate_targets_list_their_sources(spark):
    grid = grid_of(spark, {"f": [["Cantidad", "Unidades", "sku"], [1, 2, "x"]]})
    labels = header_labels(detect_headers(grid, CONFIG.alias_targets))
    row = duplicate_targets(map_labels(labels, CONFIG)).first()
    assert (row.target, row.sources) == ("quantity", ["Cantidad", "Unidades"])


def test_config_guards(spark):
    with pytest.raises(ConfigError):
        Config(aliases={"a": ["Título"], "b": ["titulo"]}).alias_targets
    assert len(CONFIG.alias_targets) == 121 and len(CONFIG.schema) == 71
    clash = spark.createDataFrame([("Título", "a"), ("titulo ", "b"), ("x", "a")],
                                  "alias string, alias_target string")
    assert [tuple(r) for r in alias_conflicts(clash).collect()] == [("titulo", 2, "a", "b")]
    with pytest.raises(ConfigError):
        CONFIG.struct(["sale_id", "nope"])
    with pytest.raises(ConfigError):
        cast_declared(spark.range(1), CONFIG)


def test_conversion_report(result):
    report = conversion_report(result.rows, ["sku", "quantity"], ["file_name"])
    got = {(r.file_name, r.column_name): (r.rows, r.null_count) for r in report.collect()}
    assert got[("flat.xlsx", "sku")] == (2, 2) and got[("flat.xlsx", "quantity")] == (2, 0)


def test_lenient_dates_accept_the_file(spark):
    grid = grid_of(spark, {"f": FILES["bad_date.xlsx"]})
    out = ingest(grid, files_of(spark, ["f"]), CONFIG, Rules(run_year=2026, lenient_dates=True))
    assert [r.sale_date for r in out.rows.collect()] == [None]
