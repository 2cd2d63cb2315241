"""Small builders: grids from Python rows, and minimal workbooks."""

import datetime as dt
import zipfile
from xml.sax.saxutils import escape

from salesloom.operators.grid import GRID_SCHEMA

FLAT = ["# de venta", "Fecha de venta", "Estado de la venta", "Unidades", "Total (ARS)"]


def as_cell(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return (str(value), "bool")
    if isinstance(value, (int, float)):
        return (str(value), "num")
    if isinstance(value, dt.datetime):
        return (str(value), "datetime")
    return (str(value), "str")


def grid_of(spark, files, sheet="0"):
    rows = [
        (path, sheet, i, [as_cell(v) for v in row])
        for path, table in files.items()
        for i, row in enumerate(table)
    ]
    return spark.createDataFrame(rows, GRID_SCHEMA)


def files_of(spark, names):
    return spark.createDataFrame(
        [(n, f"hash-{n}") for n in names], "file_path string, file_hash string"
    )


def sale(i, date="12 de abril de 2026 17:10 hs.", status="Entregado", units=1, total="$ 1.234,50"):
    return [i, date, status, units, total]


def column_name(index):
    name = ""
    index += 1
    while index:
        index, rest = divmod(index - 1, 26)
        name = chr(65 + rest) + name
    return name


def write_workbook(path, sheets):
    """``sheets``: name -> rows of None / bool / number / str / datetime."""
    strings, ids = [], {}

    def cell(r, c, value):
        ref = f'{column_name(c)}{r + 1}'
        if value is None:
            return ""
        if isinstance(value, bool):
            return f'<c r="{ref}" t="b"><v>{int(value)}</v></c>'
        if isinstance(value, dt.datetime):
            serial = (value - dt.datetime(1899, 12, 30)).total_seconds() / 86400
            return f'<c r="{ref}" s="1"><v>{serial!r}</v></c>'
        if isinstance(value, (int, float)):
            return f'<c r="{ref}"><v>{value!r}</v></c>'
        if value not in ids:
            ids[value] = len(strings)
            strings.append(value)
        return f'<c r="{ref}" t="s"><v>{ids[value]}</v></c>'

    with zipfile.ZipFile(path, "w") as z:
        names = list(sheets)
        main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
        rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
        listed = "".join(
            f'<sheet name="{escape(n)}" sheetId="{i + 1}" r:id="rId{i + 1}"/>'
            for i, n in enumerate(names)
        )
        z.writestr(
            "xl/workbook.xml",
            f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets>{listed}</sheets></workbook>',
        )
        links = "".join(
            f'<Relationship Id="rId{i + 1}" Target="worksheets/sheet{i + 1}.xml"/>'
            for i in range(len(names))
        )
        z.writestr("xl/_rels/workbook.xml.rels", f"<Relationships>{links}</Relationships>")
        z.writestr(
            "xl/styles.xml",
            f'<styleSheet xmlns="{main}"><cellXfs><xf numFmtId="0"/><xf numFmtId="22"/></cellXfs></styleSheet>',
        )
        for i, name in enumerate(names):
            body = "".join(
                f'<row r="{r + 1}">' + "".join(cell(r, c, v) for c, v in enumerate(row)) + "</row>"
                for r, row in enumerate(sheets[name])
                if any(v is not None for v in row)
            )
            z.writestr(
                f"xl/worksheets/sheet{i + 1}.xml",
                f'<worksheet xmlns="{main}"><sheetData>{body}</sheetData></worksheet>',
            )
        items = "".join(f"<si><t>{escape(s)}</t></si>" for s in strings)
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}">{items}</sst>')
    return str(path)
