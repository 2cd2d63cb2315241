import hashlib

import pytest
from helpers import FLAT, sale, write_workbook

from salesloom.config import Config
from salesloom.operators.conform import Rules
from salesloom.plans import session
from salesloom.plans.load import Tables
from salesloom.plans.session import run_session

RULES = Rules(run_year=2026)


def test_workbooks_to_table_and_output(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    write_workbook(inbox / "uno.xlsx", {"S": [FLAT, sale(1), sale(2)]})
    write_workbook(inbox / "dos.xlsx", {"S": [FLAT + ["Nueva"], sale(2) + ["x"], sale(3) + [None]]})
    tables = Tables("se_sales", "se_load", "se_audit")
    out = run_session(spark, str(inbox), rules=RULES, session_id="s", tables=tables,
                      output_dir=str(tmp_path / "out"))
    assert out.saved.parquet_saved
    assert spark.read.parquet(out.saved.parquet_path).count() == 4
    assert sorted(r.sale_id for r in spark.table("se_sales").collect()) == ["1", "2", "3"]
    assert {r.file_name: r.rows_inserted for r in out.loaded.collect()} == {
        "dos.xlsx": 2, "uno.xlsx": 1}
    assert {r.session_load_id for r in spark.table("se_sales").collect()} == {"s"}


def test_strict_extras_keep_such_files_out(spark, tmp_path):
    write_workbook(tmp_path / "a.xlsx", {"S": [FLAT, sale(1)]})
    write_workbook(tmp_path / "b.xlsx", {"S": [FLAT + ["Nueva"], sale(3) + ["x"]]})
    tables = Tables("st_sales", "st_load", "st_audit")
    run_session(spark, str(tmp_path), rules=RULES, tables=tables, strict_extras=True)
    assert [r.sale_id for r in spark.table("st_sales").collect()] == ["1"]
    audit = {r.file_name: (r.status, r.rows_inserted) for r in spark.table("st_audit").collect()}
    assert audit == {"a.xlsx": ("loaded", 1), "b.xlsx": ("rejected: unknown columns", None)}


def test_delimited_hashes(spark, tmp_path):
    body = ",".join(FLAT) + "\n" + '1,12 de abril de 2026,ok,1,"1.234,50"\n'
    (tmp_path / "con espacio+.csv").write_text(body)
    out = run_session(spark, str(tmp_path), "delimited", rules=RULES)
    row = out.ingested.rows.first()
    assert row.file_hash == hashlib.sha256(body.encode()).hexdigest()
    assert (row.file_name, row.total_amount_ars) == ("con espacio+.csv", 1234.5)
    big = run_session(spark, str(tmp_path), "delimited", rules=RULES, hash_by="lines")
    other = big.ingested.rows.first().file_hash
    assert len(other) == 64 and other != row.file_hash


def test_unknown_source(spark):
    with pytest.raises(ValueError):
        run_session(spark, "x", "nope")


def test_known_content_is_not_parsed_again(spark, tmp_path, monkeypatch):
    inbox = tmp_path / "in"
    inbox.mkdir()
    write_workbook(inbox / "a.xlsx", {"S": [FLAT, sale(1), sale(2)]})
    tables = Tables("le_sales", "le_load", "le_audit")
    one = run_session(spark, str(inbox), rules=RULES, tables=tables, skip_known=True)
    assert [r.rows_inserted for r in one.loaded.collect()] == [2]
    (inbox / "copy of a.xlsx").write_bytes((inbox / "a.xlsx").read_bytes())
    parsed = []
    read = session.read_workbooks
    monkeypatch.setattr(session, "read_workbooks", lambda s, path, *a: parsed.append(path) or read(s, path, *a))
    assert run_session(spark, str(inbox), rules=RULES, tables=tables, skip_known=True) == session.Session(None, None, None)
    assert parsed == []
    write_workbook(inbox / "b.xlsx", {"S": [FLAT, sale(2), sale(3)]})
    three = run_session(spark, str(inbox), rules=RULES, tables=tables, skip_known=True)
    assert [r.file_name for r in three.loaded.collect()] == ["b.xlsx"]
    assert len(parsed) == 1 and [p.rpartition("/")[2] for p in parsed[0]] == ["b.xlsx"]
    # another layout reads all files anew
    other = Config(required=["sale_id"])
    four = run_session(spark, str(inbox), rules=RULES, tables=tables, config=other, skip_known=True)
    assert {r.file_name: r.rows_inserted for r in four.loaded.collect()} == {"a.xlsx": 0, "b.xlsx": 0, "copy of a.xlsx": 0}


def test_equal_names_are_saved_apart(spark, tmp_path):
    for folder, ids in (("x", [1, 2]), ("y", [3])):
        (tmp_path / folder).mkdir()
        write_workbook(tmp_path / folder / "enero.xlsx", {"S": [FLAT, *map(sale, ids)]})
        saved = run_session(spark, str(tmp_path / folder), rules=RULES, output_dir=str(tmp_path / "out")).saved
    back = spark.read.parquet(saved.parquet_path)
    assert sorted(r.sale_id for r in back.collect()) == ["1", "2", "3"]
    assert back.select("output", "input").distinct().count() == 2
