"""Strict typing of dirty values: numbers, dates, JSON points. What can't be read is null, never a guess."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that group digits: blank, no-break and narrow no-break space.
GROUPING = " \u00a0\u202f"
MOST_PRICE = 10**12


def grouped_decimal(s: Column, scale: int = 10) -> Column:
    """1 234,50 -> 1234.50 (FN10)."""
    return F.translate(s, "," + GROUPING, ".").try_cast(f"decimal(38,{scale})")


def digits(s: Column) -> Column:
    """All digits of a text as one number (FN11)."""
    return F.regexp_replace(s, "[^0-9]", "").try_cast("bigint")


def leading_float(s: Column) -> Column:
    """The first run of digits, points and commas as a number; two separators are null (FN12)."""
    return F.replace(F.regexp_extract(s, r"[\d.,]+", 0), F.lit(","), F.lit(".")).try_cast("double")


def face_value(s: Column) -> Column:
    """struct(value, unit) of '5 unit' (FN13), cut at the first white space; the unit is a raw label for the vocabulary."""
    first, rest = (F.regexp_extract(s, r"(?Us)^\s*(\S+)(?:\s+(.*))?$", i) for i in (1, 2))
    return F.struct(leading_float(first).alias("value"), F.nullif(rest, F.lit("")).alias("unit"))


def dotted_date(s: Column) -> Column:
    """d.m.yyyy, day and month of one or two digits, else null (FN14); but for a blank in place of a day's first digit, nothing may stand around it."""
    return F.when(s.rlike(r"^(\d\d?| \d)\.\d\d?\.(?!0000)\d{4}\z"), F.try_to_date(F.ltrim(s), "d.M.yyyy"))


def mintage(s: Column) -> Column:
    """struct(announced, actual) of 'a/b' (FN15); a zero is a number, a missing part null."""
    return F.struct(digits(F.get(F.split(s, "/"), F.lit(0))).alias("announced"), digits(F.get(F.split(s, "/"), F.lit(1))).alias("actual"))


def date_in_text(s: Column) -> Column:
    """The first ISO date that stands by itself, else the first of day, month and year with points, hyphens or slashes (FN17).

    An impossible ISO date is null and doesn't fall through.
    """
    iso = F.regexp_extract(s, r"(?U)\b([0-9]{4}-[0-9]{2}-[0-9]{2})\b", 1)
    other = F.translate(F.regexp_extract(s, r"(?U)\b([0-9]{2}[./-][0-9]{2}[./-][0-9]{4})\b", 1), "-/", "..")
    found = F.when(iso != "", F.try_to_date(iso, "yyyy-MM-dd")).when(other != "", F.try_to_date(other, "dd.MM.yyyy"))
    return F.when(F.year(found) > 0, found)


def iso_date(s: Column) -> Column:
    """A date in the standard's forms: 2024-01-31, 20240131, and by week 2024-W05-3, 2024W053, 2024-W05; what isn't one is null."""
    part = lambda i: F.regexp_extract(s, r"^([0-9]{4})-?W([0-9]{2})(?:-?([1-7]))?\z", i).try_cast("int")
    week_form = s.rlike(r"^[0-9]{4}(-W[0-9]{2}(-[1-7])?|W[0-9]{2}[1-7]?)\z")
    fourth = F.make_date(part(1), F.lit(1), F.lit(4))  # always in week 1
    monday = F.date_sub(fourth, F.weekday(fourth))
    # The year's last week is the one that 28 December is in.
    right = part(2).between(F.lit(1), F.weekofyear(F.make_date(part(1), F.lit(12), F.lit(28))))
    by_week = F.when(right, F.date_add(monday, (part(2) - 1) * 7 + F.coalesce(part(3), F.lit(1)) - 1))
    plain = F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}\z"), F.try_to_date(s, "yyyy-MM-dd")).when(s.rlike(r"^\d{8}\z"), F.try_to_date(s, "yyyyMMdd")).when(week_form & ~s.startswith("0000"), by_week)
    return F.when(F.year(plain) > 0, plain)


def price_fits(p: Column) -> Column:
    """Positive and below the column's bound, judged after rounding to cents and before narrowing (FL4)."""
    return F.coalesce((p > 0) & (F.round(p, 2) < F.lit(MOST_PRICE)), F.lit(False))


#: Kinds of a VARIANT that are numbers; a quoted number is read as a page's amount is.
NUMBER_KINDS = "^(BIGINT|DECIMAL|DOUBLE|FLOAT|INT|SMALLINT|TINYINT)"


def variant_number(value: Column) -> Column:
    """A VARIANT number, or a quoted one with grouped digits, exactly; null for a boolean and whatever else is no number."""
    kind, plain = F.schema_of_variant(value), F.try_variant_get(value, "$", "string")
    return F.when(kind.rlike(NUMBER_KINDS), plain.try_cast("decimal(38,20)")).when(kind == "STRING", grouped_decimal(F.trim(plain), 20))


def point_price(point: Column) -> Column:
    """The price of a VARIANT point: a number or a quoted number, not a boolean (FN18)."""
    return variant_number(F.try_variant_get(point, "$.price", "variant")).try_cast("decimal(38,6)")


def midnight(day: Column) -> Column:
    """Midnight of a day in the session's zone, which is UTC (FN19)."""
    return day.cast("timestamp")


def window_start(today: Column, days: int) -> Column:
    """The first of `days` days that end with today (FN19)."""
    return F.date_sub(today, days - 1)
