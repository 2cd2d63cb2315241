"""Spanish sales-export dates to TIMESTAMP_NTZ / DATE, as native column expressions.

Order of attempts: a real date cell, "12 de abril de 2026 17:10 hs.",
"3 de mayo | 09:05" (year supplied), then a fixed family of generic layouts read
month first.  Values outside the 1677-2262 nanosecond range give null.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from salesloom.functions.text import fold, strip

# Spanish month names and their numbers.
SPANISH_MONTHS = {
    "enero": 1,
    "febrero": 2,
    "marzo": 3,
    "abril": 4,
    "mayo": 5,
    "junio": 6,
    "julio": 7,
    "agosto": 8,
    "septiembre": 9,
    "setiembre": 9,
    "octubre": 10,
    "noviembre": 11,
    "diciembre": 12,
}

# English month abbreviations accepted by the generic fallback.
ENGLISH_MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")

MONTH_WORD = "(" + "|".join(SPANISH_MONTHS) + ")"
ENGLISH_WORD = (
    "(jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?"
    "|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"
)
CLOCK = (
    "(?:[t ]+([0-9]{1,2})(?::([0-9]{2})(?::([0-9]{2})(?:\\.([0-9]{1,9}))?)?)?"
    " ?([ap]m)?(z|[+-][0-9]{2}:?[0-9]{2})?)?\\z"
)
# A bare number after a date that names its month is no hour.
NAMED_CLOCK = "(?![t ]+[0-9]{1,2}\\z)" + CLOCK
WEEKDAY = "(?:(?:mon|tue|tues|wed|wednes|thu|thur|thurs|fri|sat|satur|sun)(?:day)?\\.?,? )?"
LONG, SHORT, ORDERED, GUESSED = "long", "short", "ymd", "any"
# Layout tag, pattern, and where year | month | day | hour | minute | second |
# fraction | am-pm | zone sit in it.  The first pattern that fits decides.
LAYOUTS = (
    (LONG, f"^([0-9]{{1,2}}) de {MONTH_WORD} de ([0-9]{{4}})(?: ([0-9]{{1,2}}):([0-9]{{2}}) ?hs\\.?)?\\z",
     "$3|$2|$1|$4|$5||||"),
    (SHORT, f"^([0-9]{{1,2}}) de {MONTH_WORD}(?: \\| ([0-9]{{1,2}}):([0-9]{{2}}))?\\z",
     "|$2|$1|$3|$4||||"),
    (ORDERED, "^([0-9]{4})([-/.])([0-9]{1,2})\\2([0-9]{1,2})" + CLOCK,
     "$1|$3|$4|$5|$6|$7|$8|$9|$10"),
    (GUESSED, "^([0-9]{1,2})([-/.])([0-9]{1,2})\\2([0-9]{4}|[0-9]{1,2})" + CLOCK,
     "$1|$3|$4|$5|$6|$7|$8|$9|$10"),
    (ORDERED, "^([0-9]{4})([0-9]{2})([0-9]{2})\\z", "$1|$2|$3||||||"),
    (ORDERED, "^([0-9]{4})(?:-([0-9]{1,2}))?\\z", "$1|$2|1||||||"),
    (ORDERED, "^([0-9]{1,2})/([0-9]{4})\\z", "$2|$1|1||||||"),
    (ORDERED, f"^{WEEKDAY}([0-9]{{1,2}})[ /-]{ENGLISH_WORD}[ /-]([0-9]{{4}}|[0-9]{{2}})" + NAMED_CLOCK,
     "$3|$2|$1|$4|$5|$6|$7|$8|$9"),
    (ORDERED, f"^{WEEKDAY}{ENGLISH_WORD} ([0-9]{{1,2}}),? ([0-9]{{4}})" + NAMED_CLOCK,
     "$3|$1|$2|$4|$5|$6|$7|$8|$9"),
    (ORDERED, f"^{ENGLISH_WORD} ([0-9]{{4}})\\z", "$2|$1|1||||||"),
)

# White space that is not one plain blank between words.
SPACE = "[\\s\\p{Z}\\x1c-\\x1f\\x85]"
WIDE_SPACE = f"[{SPACE}&&[^ ]]{SPACE}*| {SPACE}+"

EARLIEST = dt.datetime(1677, 9, 21, 0, 12, 43, 145225)
LATEST = dt.datetime(2262, 4, 11, 23, 47, 16, 854775)


def month_number(word: Column) -> Column:
    """Month of a lower-case, accent-free Spanish month name; null when unknown."""
    months = F.create_map(*[F.lit(x) for item in SPANISH_MONTHS.items() for x in item])
    return F.try_element_at(months, word)


def date_texts(values: Column) -> Column:
    """Comparable forms of an array of dates: trimmed, lower case, no accents, single spaces."""
    lowered = F.transform(values, lambda v: F.lower(strip(v)))
    return F.transform(
        lowered, lambda v: F.regexp_replace(fold(v), WIDE_SPACE, " ")
    )


def date_parts(text: Column) -> Column:
    """One of :func:`date_texts` taken apart: [layout tag, year, month, day, hour, minute, second,
    fraction, am-pm, zone] as texts; null when no layout fits."""
    chosen = None
    for tag, pattern, order in LAYOUTS:
        rewritten = F.regexp_replace(text, pattern, f"{tag}|{order}")
        fits = text.rlike(pattern)
        chosen = F.when(fits, rewritten) if chosen is None else chosen.when(fits, rewritten)
    return F.split(chosen, "\\|")


def is_spanish_date(parts: Column) -> Column:
    """True for :func:`date_parts` of the two Spanish layouts, possible day or not."""
    return F.coalesce(F.get(parts, F.lit(0)).isin(LONG, SHORT), F.lit(False))


def _int(text: Column) -> Column:
    """Integer of a digits-only text; a failing cast would cost an exception per row, so
    anything else becomes null before it."""
    first = F.substring(text, 1, 1)
    return F.when((first >= "0") & (first <= "9"), text).try_cast("int")


def _or_zero(text: Column) -> Column:
    return F.coalesce(_int(text), F.lit(0))


def _in_range(stamp: Column) -> Column:
    low, high = (F.lit(x).cast("timestamp_ntz") for x in (EARLIEST, LATEST))
    return F.when((stamp >= low) & (stamp <= high), stamp)


def _full_year(year: Column, run_year: Column) -> Column:
    """Two-digit years land within fifty years of the run year."""
    near = year + (run_year - run_year % 100)
    moved = (
        F.when(near >= run_year + 50, near - 100).when(near < run_year - 50, near + 100).otherwise(near)
    )
    return F.when(year < 100, moved).otherwise(year)


def _month(text: Column) -> Column:
    """Month number from digits, a Spanish or an English name; an absent month is January."""
    names = F.array(*[F.lit(m) for m in ENGLISH_MONTHS])
    english = F.nullif(F.array_position(names, F.substring(text, 1, 3)).cast("int"), F.lit(0))
    return F.when(text == "", 1).otherwise(F.coalesce(_int(text), month_number(text), english))


def _fields(cell: Column) -> Column:
    """Typed fields of one taken-apart date; each is computed once per value."""
    p = cell["parts"]
    hour, half = _or_zero(p[4]), p[8]
    hour24 = F.when(half == "", hour).when(
        hour.between(1, 12), hour % 12 + F.when(half == "pm", 12).otherwise(0)
    )
    second = F.when(p[6] == "", F.lit("0")).otherwise(
        F.concat(p[6], F.lit("."), F.rpad(F.substring(p[7], 1, 6), 6, "0"))
    )
    return F.struct(
        cell["v"].alias("v"),
        cell["kind"].alias("kind"),
        p[0].alias("tag"),
        _int(p[1]).alias("a"),
        _int(p[2]).alias("b"),
        _int(p[3]).alias("c"),
        _month(p[2]).alias("month"),
        hour24.alias("hour"),
        _or_zero(p[5]).alias("minute"),
        second.cast("decimal(8,6)").alias("second"),
        p[9].alias("zone"),
    )


def _to_utc(stamp: Column, zone: Column) -> Column:
    digits = F.regexp_replace(zone, "[^0-9]", "")
    minutes = _or_zero(F.substring(digits, 1, 2)) * 60 + _or_zero(F.substring(digits, 3, 2))
    signed = F.when(F.startswith(zone, F.lit("-")), -minutes).otherwise(minutes)
    shifted = stamp - F.make_dt_interval(mins=signed)
    return F.when(zone.isin("", "z"), stamp).otherwise(shifted)


def _assemble(f: Column, year: Column, run_year: Column, dayfirst: bool) -> Column:
    a, b, c = f["a"], f["b"], f["c"]
    guessed = (f["tag"] == GUESSED) & (a <= 31)
    month_leads = (b > 12) if dayfirst else (a <= 12)
    y = F.when(f["tag"] == SHORT, year).otherwise(
        _full_year(F.when(guessed, c).otherwise(a), run_year)
    )
    m = F.when(guessed, F.when(month_leads, a).otherwise(b)).otherwise(f["month"])
    d = F.when(guessed, F.when(month_leads, b).otherwise(a)).otherwise(c)
    made = F.try_make_timestamp_ntz(y, m, d, f["hour"], f["minute"], f["second"])
    return _to_utc(made, f["zone"])


def _from_number(value: Column, excel_serial: bool) -> Column:
    """A bare number in a date column: nanoseconds since 1970, or an Excel day serial."""
    number = value.try_cast("double")
    if excel_serial:
        micros = F.round(number * 86400000000).try_cast("long")
        base = F.lit(dt.datetime(1899, 12, 30)).cast("timestamp_ntz")
    else:
        nanos = F.when(F.abs(number) < float(2**63), number)
        micros = F.floor(nanos / 1000).try_cast("long")
        base = F.lit(dt.datetime(1970, 1, 1)).cast("timestamp_ntz")
    whole = F.floor(micros / 1000000).try_cast("long")
    seconds = F.pmod(whole, F.lit(86400)) + (micros - whole * 1000000).cast("decimal(20,0)") / F.lit(
        1000000
    ).cast("decimal(7,0)")
    days = F.floor(whole / 86400).try_cast("int")
    return _in_range(base + F.make_dt_interval(days=days, secs=seconds.cast("decimal(18,6)")))


def take_apart(cells: Column) -> Column:
    """Array of ``struct<v, kind>`` to array of ``struct<v, kind, parts>``."""
    texts = date_texts(F.transform(cells, lambda c: c["v"]))
    return F.transform(
        F.arrays_zip(cells.alias("cell"), texts.alias("text")),
        lambda z: F.struct(
            z["cell"]["v"].alias("v"),
            z["cell"]["kind"].alias("kind"),
            F.when(z["text"].isNotNull(), date_parts(z["text"])).alias("parts"),
        ),
    )


def stamps_of(
    apart: Column,
    year_of: Callable[[Column], Column | None] | None = None,
    run_year: int | None = None,
    dayfirst: bool = False,
    excel_serial: bool = False,
) -> Column:
    """Array of TIMESTAMP_NTZ for :func:`take_apart` cells.

    ``year_of`` gives the year of a year-less date from its place in the array.  Cells without
    a value, most of a wide row's, are passed by.
    """
    this_year = F.lit(run_year) if run_year is not None else F.year(F.current_date())

    def stamp(f: Column, i: Column) -> Column:
        year = this_year if year_of is None else F.coalesce(year_of(i), this_year)
        return (
            F.when(f.isNull() | (f["kind"] == "bool"), F.lit(None).cast("timestamp_ntz"))
            .when(f["kind"] == "num", _from_number(f["v"], excel_serial))
            .otherwise(_assemble(f, year, this_year, dayfirst))
        )

    fields = F.transform(apart, lambda c: F.when(c["v"].isNotNull(), _fields(c)))
    return F.transform(F.transform(fields, stamp), lambda s: F.when(s.isNotNull(), _in_range(s)))


def _single(value: Column, kind: Column | None) -> Column:
    kind = F.lit("str") if kind is None else kind
    return take_apart(F.array(F.struct(value.alias("v"), kind.alias("kind"))))


def parse_datetime(
    value: Column,
    kind: Column | None = None,
    reference_year: Column | None = None,
    run_year: int | None = None,
    dayfirst: bool = False,
    excel_serial: bool = False,
) -> Column:
    """Any export date to TIMESTAMP_NTZ; null when unreadable.

    ``reference_year`` supplies the year of the short form, falling back to
    ``run_year`` (default: the current year).  All-numeric dates are month first
    unless that is impossible (``dayfirst`` swaps the preference); offsets are
    resolved to UTC.
    """
    year_of = None if reference_year is None else lambda i: reference_year
    return stamps_of(_single(value, kind), year_of, run_year, dayfirst, excel_serial)[0]


def date_error(value: Column, kind: Column | None = None, **options) -> Column:
    """True for a Spanish date that names an impossible day or time ("31 de febrero")."""
    unread = parse_datetime(value, kind, **options).isNull()
    bad = unread & is_spanish_date(_single(value, kind)[0]["parts"])
    return bad if kind is None else F.coalesce(kind == "str", F.lit(False)) & bad


def parse_date(value: Column, kind: Column | None = None, **options) -> Column:
    """Day of :func:`parse_datetime`; the time of day is dropped."""
    return F.to_date(parse_datetime(value, kind, **options))


def roll_year(stamp: Column, not_before: Column) -> Column:
    """Move a year-less stamp into the next year when it precedes the sale."""
    return F.when(stamp < not_before, stamp + F.make_ym_interval(F.lit(1))).otherwise(stamp)
