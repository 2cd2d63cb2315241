import datetime as dt
import re
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from salesloom.functions import dates, numbers, text


def run(spark, values, expr, kinds=None):
    """Evaluate ``expr(v, kind)`` over the values in order."""
    kinds = kinds or ["str"] * len(values)
    rows = [(i, v, k) for i, (v, k) in enumerate(zip(values, kinds))]
    df = spark.createDataFrame(rows, "i int, v string, k string")
    out = df.select("i", expr(F.col("v"), F.col("k")).alias("r")).orderBy("i").collect()
    return [row.r for row in out]


def test_normalize_text(spark):
    cases = {
        "  Título de la\npublicación ": "titulo de la publicacion",
        "# de venta": "# de venta",
        "Total (ARS)": "total (ars)",
        "Ventas__2": "ventas 2",
        None: "",
        "1.234,56": "1 234 56",
        "12/04/2026": "12/04/2026",
        "nº": "no",
        "Marca™ x": "marca x",
        "½ ﬁn ⑩ ＡＢ": "1 2 fin 10 ab",
        "한국 1": "1",
        " Año Niño\x1f": "ano nino",
    }
    got = run(spark, list(cases), lambda v, k: text.normalize_text(v))
    assert got == list(cases.values())


def expected_fold(value):
    return "".join(c for c in unicodedata.normalize("NFKD", value) if not unicodedata.combining(c))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.text(
            st.one_of(
                st.characters(exclude_categories=["Cs"], exclude_characters="\x00"),
                st.characters(min_codepoint=0xAC00, max_codepoint=0xD7A3),
            ),
            max_size=12,
        ),
        min_size=30,
        max_size=60,
    )
)
def test_fold_agrees_with_unicodedata(spark, values):
    got = run(spark, values, lambda v, k: text.strip_accents(v))
    assert got == [expected_fold(v) for v in values]
    once = run(spark, values, lambda v, k: text.normalize_text(v))
    again = run(spark, once, lambda v, k: text.normalize_text(v))
    assert once == again
    for raw, normal in zip(values, once):
        ascii_form = re.sub(r"[^a-z0-9#()/%]+", " ", expected_fold(raw.lower())).strip()
        if "İ" not in raw and "Σ" not in raw:
            assert normal == ascii_form


def test_strip_covers_unicode_space(spark):
    got = run(spark, [" x ", "  ", None, "  x\x1c\x85", "a  b"], lambda v, k: text.standardize_string(v))
    assert got == ["x", "", None, "x", "a  b"]


def test_numeric_like_after_normalising(spark):
    values = ["10", "12/04/2026", "10.5", "1.234,56", "10%", ""]
    got = run(spark, values, lambda v, k: text.is_numeric_like(text.normalize_text(v)))
    assert got == [True, True, False, False, False, False]


def test_numbers(spark):
    cases = {
        "$ 1.234,50": 1234.5,
        "ARS 10": 10.0,
        "12,5": 12.5,
        "1.234": 1.234,
        "1,234.56": 1.23456,
        "1.234.567": None,
        "1,234,567": None,
        "Ars 5": None,
        "": None,
        "abc": None,
        "1e3": 1000.0,
        "1d": None,
        "nan": None,
        "$ -1.234,50": -1234.5,
        "inf": float("inf"),
        "1e400": None,
        ".5": 0.5,
        "5.": 5.0,
        "--5": None,
        "$": None,
        "1 234": 1234.0,
        "0x10": None,
        "1_000": None,
        None: None,
        "12\n": 12.0,
    }
    got = run(spark, list(cases), lambda v, k: numbers.parse_float(v))
    assert got == list(cases.values())


def test_number_cells_keep_their_value(spark):
    got = run(
        spark,
        ["1234.5", "True", "1,5", "2026-04-12 00:00:00"],
        numbers.parse_float,
        kinds=["num", "bool", "str", "datetime"],
    )
    assert got == [1234.5, 1.0, 1.5, None]


def test_fix_thousands(spark):
    got = run(
        spark,
        ["1.234.567", "1,234,567", "1.234,5"],
        lambda v, k: numbers.parse_float(v, fix_thousands=True),
    )
    assert got == [1234567.0, 1234567.0, 1234.5]


def test_ints(spark):
    values = ["3", "3,0", "x", "1,5", "9223372036854775807", "9223372036854775808", "1e3", None, "inf"]
    assert run(spark, values, lambda v, k: numbers.parse_int(v)) == [
        3, 3, None, None, 9223372036854775807, None, 1000, None, None,
    ]
    assert run(spark, values, lambda v, k: numbers.int_error(v)) == [
        False, False, False, True, False, True, False, False, True,
    ]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-(10**11), 10**11), min_size=40, max_size=80))
def test_locale_rendering_round_trips(spark, cents):
    def render(n):
        whole, part = divmod(abs(n), 100)
        return ("-" if n < 0 else "") + f"{whole:,}".replace(",", ".") + f",{part:02d}"

    got = run(spark, ["$ " + render(n) for n in cents], lambda v, k: numbers.parse_float(v))
    assert got == [n / 100 for n in cents]


D = dt.datetime


@pytest.mark.parametrize("as_kind", [False, True])
def test_spanish_dates(spark, as_kind):
    cases = {
        "12 de abril de 2026 17:10 hs.": D(2026, 4, 12, 17, 10),
        "1 de Setiembre de 2025": D(2025, 9, 1),
        " 12  de ABRÍL de 2026 17:10hs ": D(2026, 4, 12, 17, 10),
        "3 de mayo | 09:05": D(2026, 5, 3, 9, 5),
        "3 de mayo": D(2026, 5, 3),
        "12 de foo": None,
        "31 de febrero de 2026": None,
        "": None,
        None: None,
    }
    got = run(
        spark,
        list(cases),
        lambda v, k: dates.parse_datetime(v, k if as_kind else None, F.lit(2026)),
    )
    assert got == list(cases.values())


def test_impossible_spanish_date_is_an_error(spark):
    values = ["31 de febrero de 2026", "30 de febrero", "12 de foo", "2026-02-31", None, "3 de mayo",
              "3 de mayo de 2026 25:00 hs"]
    got = run(spark, values, lambda v, k: dates.date_error(v, run_year=2026))
    assert got == [True, True, False, False, False, False, True]


def test_generic_dates(spark):
    cases = {
        "03/04/2026": D(2026, 3, 4),
        "13/04/2026": D(2026, 4, 13),
        "2026-04-12 17:10:00": D(2026, 4, 12, 17, 10),
        "2026-02-31": None,
        "45000": None,
        "2026": D(2026, 1, 1),
        "20260412": D(2026, 4, 12),
        "2026-04": D(2026, 4, 1),
        "04/2026": D(2026, 4, 1),
        "12.04.2026": D(2026, 12, 4),
        "13.04.2026": D(2026, 4, 13),
        "12/04/26": D(2026, 12, 4),
        "26/04/12": D(2012, 4, 26),
        "2026/13/04": None,
        "2026-04-12T17:10:05.123": D(2026, 4, 12, 17, 10, 5, 123000),
        "2026-04-12T17:10:05Z": D(2026, 4, 12, 17, 10, 5),
        "2026-04-12T17:10:05+03:00": D(2026, 4, 12, 14, 10, 5),
        "12 April 2026": D(2026, 4, 12),
        "April 12, 2026": D(2026, 4, 12),
        "12-Apr-26": D(2026, 4, 12),
        "12 Apr 2026 10:30": D(2026, 4, 12, 10, 30),
        "April 12, 2026 5:00 PM": D(2026, 4, 12, 17),
        "Sunday, April 12, 2026": D(2026, 4, 12),
        "Sun 12 Apr 2026": D(2026, 4, 12),
        "12/Apr/2026": D(2026, 4, 12),
        "12 Apr 2026 5": None,
        "03/04/2026 5:10 PM": D(2026, 3, 4, 17, 10),
        "2026-4-2": D(2026, 4, 2),
        "12 abril 2026": None,
        "nan": None,
        "2026-04-12 17:10 hs": None,
        "1": None,
        "1234": None,
        "12345678": None,
        "1600-01-01": None,
        "2300-01-01": None,
        "Jan 2026": D(2026, 1, 1),
        "2026-04-12 24:00:00": None,
        "2026-04-12 17": D(2026, 4, 12, 17),
        "31/12/2025": D(2025, 12, 31),
        "2026.04.12": D(2026, 4, 12),
        "32/01/2026": None,
        "32/01/03": D(2032, 1, 3),
        "99/01/02": D(1999, 1, 2),
        "1/2/3": D(2003, 1, 2),
    }
    got = run(spark, list(cases), lambda v, k: dates.parse_datetime(v, run_year=2026))
    assert dict(zip(cases, got)) == cases


def test_number_in_a_date_column(spark):
    got = run(spark, ["45000", "45000.7", "-5", "1e20", "True"],
              lambda v, k: dates.parse_datetime(v, k, run_year=2026),
              kinds=["num", "num", "num", "num", "bool"])
    assert got == [D(1970, 1, 1, 0, 0, 0, 45), D(1970, 1, 1, 0, 0, 0, 45),
                   D(1969, 12, 31, 23, 59, 59, 999999), None, None]
    serial = run(spark, ["45000", "45000.5"],
                 lambda v, k: dates.parse_datetime(v, k, run_year=2026, excel_serial=True),
                 kinds=["num", "num"])
    assert serial == [D(2023, 3, 15), D(2023, 3, 15, 12)]


def test_day_first_and_year_roll(spark):
    got = run(spark, ["03/04/2026", "04/13/2026"],
              lambda v, k: dates.parse_datetime(v, run_year=2026, dayfirst=True))
    assert got == [D(2026, 4, 3), D(2026, 4, 13)]
    rolled = run(spark, ["3 de enero | 09:05", "30 de diciembre | 10:00"],
                 lambda v, k: dates.roll_year(
                     dates.parse_datetime(v, reference_year=F.lit(2025)),
                     F.lit(D(2025, 12, 28)).cast("timestamp_ntz")))
    assert rolled == [D(2026, 1, 3, 9, 5), D(2025, 12, 30, 10)]


def test_date_drops_time(spark):
    got = run(spark, ["12 de abril de 2026 17:10 hs."], lambda v, k: dates.parse_date(v))
    assert got == [dt.date(2026, 4, 12)]
