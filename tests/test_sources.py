import csv
import io
import datetime as dt
import hashlib
import random

import pytest
from helpers import FLAT, sale, write_workbook
from pyspark.sql import functions as F

from salesloom.config import Config
from salesloom.operators.conform import Rules
from salesloom.plans.ingest import ingest
from salesloom.scratch import materialise
from salesloom.sinks.processed import save_processed
from salesloom.sources.delimited import (
    number_lines,
    number_records,
    read_records,
    read_delimited,
    split_fields,
    text_lines,
)
from salesloom.sources.hashing import file_hashes, line_fingerprints
from salesloom.sources.workbook import binary_files, read_workbooks


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("books")
    write_workbook(
        path / "a.xlsx",
        {
            "Ventas": [
                ["Reporte"],
                [],
                FLAT + ["Fecha en camino"],
                [2000001, dt.datetime(2026, 4, 12, 17, 10), " x ", 2.0, 10.5, "3 de mayo | 09:05"],
                [None, None, "NA", None, None, None],
                [],
                [2000002, "12 de abril de 2026", True, 1, "$ 1.234,50", None],
            ],
            "Otra": [["b"], [1]],
        },
    )
    write_workbook(path / "b.xlsx", {"Ventas": [FLAT, sale(7)]})
    write_workbook(path / "none.xlsx", {"Ventas": []})
    (path / "broken.xlsx").write_bytes(b"not a zip")
    return str(path)


def cells(row):
    return [None if c is None else (c.v, c.kind) for c in row.cells]


def test_workbook_cells(spark, folder):
    rows = read_workbooks(spark, folder, 0, "a.xlsx").orderBy("row_idx").collect()
    assert [r.row_idx for r in rows] == [0, 1, 2, 3, 4, 5, 6]
    assert rows[1].cells == [] and cells(rows[2])[0] == ("# de venta", "str")
    assert cells(rows[3]) == [
        ("2000001", "num"), ("2026-04-12 17:10:00", "datetime"), (" x ", "str"), ("2", "num"),
        ("10.5", "num"), ("3 de mayo | 09:05", "str"),
    ]
    assert rows[4].cells == [] and cells(rows[6])[2] == ("True", "bool") and rows[6].sheet == "0"


def test_sheet_choice(spark, folder):
    by_name = read_workbooks(spark, folder, "Otra", "a.xlsx").collect()
    assert [cells(r) for r in by_name] == [[("b", "str")], [("1", "num")]]
    every = read_workbooks(spark, folder, None, "a.xlsx").select("sheet").distinct().collect()
    assert {r.sheet for r in every} == {"Ventas", "Otra"}


def test_workbooks_end_to_end(spark, folder, tmp_path):
    files = file_hashes(binary_files(spark, folder))
    out = ingest(read_workbooks(spark, folder), files, Config(), Rules(run_year=2026))
    status = {r.file_name: r.status for r in out.sheets.collect()}
    assert status == {"a.xlsx": "accepted", "b.xlsx": "accepted", "none.xlsx": "empty",
                      "broken.xlsx": "unreadable"}
    rows = out.rows.filter("file_name = 'a.xlsx'").orderBy("source_row_number").collect()
    assert [(r.sale_id, r.sale_date, r.quantity, r.total_amount_ars) for r in rows] == [
        ("2000001", dt.date(2026, 4, 12), 2, 10.5),
        ("2000002", dt.date(2026, 4, 12), 1, 1234.5),
    ]
    assert rows[0].file_hash == hashlib.sha256(open(f"{folder}/a.xlsx", "rb").read()).hexdigest()
    assert rows[0].shipped_at == dt.datetime(2026, 5, 3, 9, 5) and rows[1].sale_status == "True"

    saved = save_processed(out.rows, str(tmp_path / "out"))
    assert saved.parquet_saved and saved.parquet_error is None
    back = spark.read.parquet(saved.parquet_path)
    assert {r.output for r in back.select("output").distinct().collect()} == {
        "a_processed", "b_processed"}
    assert back.count() == 3
    part = next((tmp_path / "out" / "csv" / "output=b_processed").glob("*/*.csv"))
    assert part.read_bytes().startswith(b"\xef\xbb\xbffile_path,sheet,sale_id")


def test_hash_algorithms(spark, folder):
    content = open(f"{folder}/b.xlsx", "rb").read()
    files = binary_files(spark, folder, "b.xlsx")
    for name in ("sha256", "md5", "sha1", "sha512", "blake2b", "sha3_256"):
        assert file_hashes(files, name).first().file_hash == hashlib.new(name, content).hexdigest()
    with pytest.raises(ValueError):
        file_hashes(files, "nope")


def test_files_longer_than_a_value_are_hashed_by_lines(spark, tmp_path):
    random.seed(5)
    mark, noise = b"\xef\xbb\xbf", random.randbytes(30_000)
    contents = {
        "a.parquet": noise, "b.parquet": noise + b"\n", "c.csv": mark + b"x\r\ny\n" * 900, "d.csv": mark + b"z" * 2000,
        "e.gz": b"not packed\n" * 200, "no point": noise, "f {1}[2]*.csv": b"\n" * 3000, "short.csv": b"1\n2", "g": mark,
    }
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    limits = {"spark.sql.sources.binaryFile.maxLength": "1000", "spark.sql.files.maxPartitionBytes": "4k", "spark.sql.files.openCostInBytes": "1k"}
    before = {k: spark.conf.get(k) for k in limits}
    for k, v in limits.items():
        spark.conf.set(k, v)
    try:
        files = binary_files(spark, str(tmp_path))
        for name in ("sha256", "SHA-1", "blake2b"):
            for whole in (0, 1000):
                got = {r.file_path.rpartition("/")[2]: r.file_hash for r in file_hashes(files, name, whole).collect()}
                plain = name.lower().replace("-", "")
                assert got == {n: hashlib.new(plain, c).hexdigest() for n, c in contents.items()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_lines_are_not_broadcast_to_their_splits(spark, tmp_path):
    (tmp_path / "a.csv").write_text("".join(f"{i}\n" for i in range(2000)))
    (tmp_path / "b.csv").write_text('0,"x\ny"\n1,z\n')
    lines = materialise(text_lines(spark, str(tmp_path)), "lines")
    for number in (number_lines, number_records):
        records = number(lines).filter("row_idx < 1999")
        plan = records._jdf.queryExecution().executedPlan().toString()
        joins = [x for x in plan.splitlines() if "Join " in x]
        assert joins and all("LeftOuter" in x for x in joins), plan
        assert records.count() == 1999 + (3 if number is number_lines else 2)


def test_split_fields(spark):
    cases = {
        'a,b,c': ["a", "b", "c"],
        ',a,': ["", "a", ""],
        '"x, y",2': ["x, y", "2"],
        '"say ""hi""",""': ['say "hi"', ""],
        'a"b,c': ['a"b', "c"],
        '': [""],
        '"two\nlines",z': ["two\nlines", "z"],
    }
    df = spark.createDataFrame([(i, k) for i, k in enumerate(cases)], "i int, line string")
    got = [r.f for r in df.select("i", split_fields(F.col("line")).alias("f")).orderBy("i").collect()]
    assert got == list(cases.values())
    semi = spark.createDataFrame([("a;b,c",)], "line string")
    assert semi.select(split_fields(F.col("line"), ";").alias("f")).first().f == ["a", "b,c"]


@pytest.fixture
def tiny_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_lines_keep_their_place_over_splits(spark, tmp_path, tiny_splits):
    for name, n in (("one.csv", 400), ("two.csv", 3)):
        (tmp_path / name).write_text("".join(f"{name} line {i}\n" for i in range(n)))
    lines = text_lines(spark, str(tmp_path))
    assert lines.select("split_start").distinct().count() > 5
    rows = number_lines(lines).orderBy("file_path", "row_idx").collect()
    assert [(r.row_idx, r.record) for r in rows] == [
        (i, f"one.csv line {i}") for i in range(400)
    ] + [(i, f"two.csv line {i}") for i in range(3)]


def test_records_with_line_breaks_over_splits(spark, tmp_path, tiny_splits):
    rng = random.Random(4)
    records = [
        f'{i},"' + "\n".join("x" * rng.randint(0, 60) for _ in range(rng.randint(1, 4))) + '",z'
        for i in range(150)
    ]
    (tmp_path / "m.csv").write_text("\n".join(records) + "\n")
    lines = text_lines(spark, str(tmp_path))
    rows = number_records(lines).orderBy("row_idx").collect()
    assert [r.record for r in rows] == records and [r.row_idx for r in rows] == list(range(150))
    grid = read_delimited(spark, str(tmp_path)).orderBy("row_idx").collect()
    assert [c.cells[0].v for c in grid] == [str(i) for i in range(150)]
    assert grid[0].cells[1].v == records[0].split('"')[1] or grid[0].cells[1] is None


def test_delimited_end_to_end(spark, tmp_path):
    text = "﻿Reporte;;;;\n" + ";" * 4 + "\n" + ";".join(FLAT) + "\n"
    text += '7;12 de abril de 2026 17:10 hs.;"Entregado; ok";2;"$ 1.234,50"\n;;NA;;\n8;3/4/2026;x;1;5\n'
    (tmp_path / "v.csv").write_text(text, encoding="utf-8")
    grid = read_delimited(spark, str(tmp_path), sep=";")
    lines = number_lines(text_lines(spark, str(tmp_path)))
    out = ingest(grid, line_fingerprints(lines), Config(), Rules(run_year=2026))
    rows = out.rows.orderBy("source_row_number").collect()
    assert [(r.sale_id, r.sale_status, r.total_amount_ars, r.physical_row_number) for r in rows] == [
        ("7", "Entregado; ok", 1234.5, 4), ("8", "x", 5.0, 6)]
    assert [r.source_row_number for r in rows] == [4, 5] and len(rows[0].file_hash) == 64


def test_fingerprint_depends_on_order_and_text(spark, tmp_path):
    for name, body in (("a.csv", "x\ny\n"), ("b.csv", "x\ny\n"), ("c.csv", "y\nx\n")):
        (tmp_path / name).write_text(body)
    prints = line_fingerprints(number_lines(text_lines(spark, str(tmp_path))))
    got = {r.file_path[-5:]: r.file_hash for r in prints.collect()}
    assert got["a.csv"] == got["b.csv"] != got["c.csv"]


def test_a_quote_inside_a_plain_field_is_text(spark, tmp_path):
    body = '1,5" pipe,x\n2,"a ""b""\nc, ""d",y\n3,6" pipe,"z\n\n"\n4,7" rod,8" rod\n5,"",w\n'
    (tmp_path / "a.csv").write_text(body)
    want = list(csv.reader(io.StringIO(body)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        records = read_records(spark, str(tmp_path)).withColumn("f", split_fields(F.col("record"))).orderBy("row_idx")
        rows = records.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [r.row_idx for r in rows] == list(range(5))
    assert [r.f for r in rows] == want
