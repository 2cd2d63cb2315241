"""Cells to the declared, typed schema."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesloom.config import YEAR_FROM_SALE, Config, ConfigError, resolve_type
from salesloom.functions import dates, numbers
from salesloom.functions.text import standardize_string

SALE_DATE = "sale_date"


@dataclass(frozen=True)
class Rules:
    """How to read ambiguous values; the defaults are the compatible ones."""

    run_year: int | None = None
    dayfirst: bool = False
    excel_serial: bool = False
    fix_thousands: bool = False
    lenient_dates: bool = False
    roll_year: bool = False


def _names(columns: list[str]) -> Column:
    return F.array(*[F.lit(c) for c in columns]).cast("array<string>")


def _cells_of(columns: list[str], all_columns: list[str]) -> Column:
    """Cells of the named columns, in that order; null where the file lacks one."""
    places = F.array(*[F.lit(all_columns.index(c)) for c in columns]).cast("array<int>")
    return F.transform(places, lambda i: F.get(F.col("cells"), F.get(F.col("positions"), i)))


def _number_texts(cells: Column, rules: Rules) -> Column:
    """Plain number texts; only text cells need cleaning."""
    unmarked = F.transform(
        cells,
        lambda c: F.struct(
            c["v"].alias("v"),
            c["kind"].alias("kind"),
            F.when(c["kind"] == "str", numbers.unmark(c["v"])).alias("text"),
        ),
    )
    return F.transform(
        unmarked,
        lambda c: F.when(
            c["v"].isNotNull(),
            numbers.number_text(c["v"], c["kind"], numbers.settle(c["text"], rules.fix_thousands)),
        ),
    )


def conform(
    rows: DataFrame, config: Config, rules: Rules = Rules(), keep: tuple[str, ...] = ()
) -> DataFrame:
    """Typed rows: ``keep`` columns, every file column of the schema, ``extras``, ``errors``.

    ``rows`` needs ``cells`` and the layout's ``positions`` and ``extras``.  Columns of
    one type are converted together, as one array expression, so the plan (and the
    code generated from it) does not grow with the 71 columns; text that several
    expressions need is computed once per cell.  The sale date is parsed first: other
    columns take their year from it.  ``errors`` names the columns whose value makes
    the file unacceptable.
    """
    columns = config.file_columns
    types = {name: resolve_type(config.schema[name]) for name in columns}
    of_type = lambda *kinds: [n for n in columns if isinstance(types[n], kinds)]
    ints, floats, flags = of_type(T.LongType), of_type(T.DoubleType), of_type(T.BooleanType)
    texts, dated = of_type(T.StringType), of_type(T.DateType, T.TimestampNTZType)
    days = [n for n in dated if n != SALE_DATE]
    has_sale = SALE_DATE in dated

    def stamps(apart: Column, year_of=None) -> Column:
        return dates.stamps_of(apart, year_of, rules.run_year, rules.dayfirst, rules.excel_serial)

    read = rows.select(
        *keep,
        "extras",
        "cells",
        _number_texts(_cells_of(ints, columns), rules).alias("int_texts"),
        _number_texts(_cells_of(floats, columns), rules).alias("float_texts"),
        dates.take_apart(_cells_of([SALE_DATE] if has_sale else [], columns)).alias("sale"),
        dates.take_apart(_cells_of(days, columns)).alias("dates"),
        F.transform(_cells_of(texts + flags, columns), lambda c: standardize_string(c["v"])).alias(
            "texts"
        ),
    )
    read = read.withColumn("sale_stamp", F.get(stamps(F.col("sale")), F.lit(0)))
    yearless = _names([n for n in days if n in YEAR_FROM_SALE])
    sale = F.col("sale_stamp")
    from_sale = lambda i: F.array_contains(yearless, F.get(_names(days), i))
    found = stamps(F.col("dates"), lambda i: F.when(from_sale(i), F.year(sale)))
    if rules.roll_year:
        found = F.transform(
            found, lambda s, i: F.when(from_sale(i), dates.roll_year(s, sale)).otherwise(s)
        )
    converted = read.select(
        "*",
        F.transform("int_texts", numbers.int_of).alias("ints"),
        F.transform("float_texts", numbers.float_of).alias("floats"),
        found.alias("stamps"),
    )
    bad_ints = F.transform(
        "int_texts",
        lambda t, i: F.when(
            F.get("ints", i).isNull() & numbers.float_of(t).isNotNull(), F.get(_names(ints), i)
        ),
    )
    unread_date = lambda c, stamp, name: F.when(
        stamp.isNull() & (c["kind"] == "str") & dates.is_spanish_date(c["parts"]), name
    )
    bad_sale = F.transform("sale", lambda c: unread_date(c, sale, F.lit(SALE_DATE)))
    bad_dates = F.transform(
        "dates", lambda c, i: unread_date(c, F.get("stamps", i), F.get(_names(days), i))
    )
    broken = bad_ints if rules.lenient_dates else F.concat(bad_sale, bad_ints, bad_dates)
    extras = F.map_from_entries(
        F.transform("extras", lambda e: F.struct(e["name"], F.get("cells", e["pos"])["v"]))
    )

    def typed(name: str) -> Column:
        if has_sale and name == SALE_DATE:
            return sale.cast(types[name])
        for array, members in (
            ("ints", ints), ("floats", floats), ("stamps", days), ("texts", texts + flags),
        ):
            if name in members:
                value = F.col(array)[members.index(name)]
                return F.lower(value).try_cast(types[name]) if name in flags else value.cast(
                    types[name]
                )
        raise ConfigError(f"No conversion for column {name}")

    return converted.select(
        *keep,
        *[typed(n).alias(n) for n in columns],
        extras.alias("extras"),
        F.array_compact(broken).alias("errors"),
    )


def conversion_report(rows: DataFrame, typed_columns: list[str], by: list[str]) -> DataFrame:
    """Per file and column: how many values ended up null (long form)."""
    counts = [F.count_if(F.col(c).isNull()).alias(c) for c in typed_columns]
    wide = rows.groupBy(*by).agg(F.count("*").alias("rows"), *counts)
    return wide.unpivot([*by, "rows"], typed_columns, "column_name", "null_count")


def cast_declared(df: DataFrame, config: Config) -> DataFrame:
    """Second cast pass before a load: every column to its declared type.

    Unreadable values become null; a column the schema does not know is an error.
    """
    unknown = [c for c in df.columns if c not in config.schema]
    if unknown:
        raise ConfigError(f"Columns not in the declared schema: {unknown}")
    return df.select(
        *[F.col(c).try_cast(resolve_type(config.schema[c])).alias(c) for c in df.columns]
    )
