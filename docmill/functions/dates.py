"""Dates and times in text (DAT-01 to DAT-05); today is always an argument."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docmill.functions.charset import WS, bind, trim


def start_date(c: Column) -> Column:
    """Day/month/year after ``Inicio:`` as an ISO date, else null (DAT-01)."""
    p = rf"(?i)Inicio{WS}*:{WS}*(?:<b>)?{WS}*(\d{{1,2}})/(\d{{1,2}})/(\d{{4}})"
    day, month, year = (F.regexp_extract(c, p, k) for k in (1, 2, 3))
    return F.when(year != "", F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0")))


def iso_date(c: Column) -> Column:
    """Strictly DD/MM/YYYY to ISO, else null (DAT-02)."""
    p = r"^(\d{2})/(\d{2})/(\d{4})$"
    c = trim(c)
    return F.when(c.rlike(p), F.regexp_replace(c, p, "$3-$2-$1"))


def whole_days(later: Column, earlier: Column) -> Column:
    """Whole periods of 24 hours between two instants, rounded down (DAT-03)."""
    return F.floor((F.unix_millis(later.cast("timestamp")) - F.unix_millis(earlier.cast("timestamp"))) / F.lit(86_400_000)).cast("int")


def date_in(instant: Column, zone: str) -> Column:
    """The ISO date of a UTC instant in a zone (DAT-04); today is the date of an instant given by the caller."""
    return F.date_format(F.from_utc_timestamp(instant.cast("timestamp"), zone), "yyyy-MM-dd")


def dates_in(c: Column) -> Column:
    """array<struct<found, day>> of YYYY-MM[-DD] and DD/MM/YYYY from 2000 to 2100 (DAT-05): a missing day is 28, overflow rolls over."""

    def of(pattern: str, y: int, m: int, d: int) -> Column:
        def one(x: Column) -> Column:
            year, month = F.regexp_extract(x, pattern, y).cast("int"), F.regexp_extract(x, pattern, m).cast("int")
            day = F.coalesce(F.nullif(F.regexp_extract(x, pattern, d), F.lit("")).cast("int"), F.lit(28))
            first = F.add_months(F.make_date(year, F.lit(1), F.lit(1)), month - 1)
            return F.struct(x.alias("found"), F.when(year.between(2000, 2100), F.date_add(first, day - 1)).alias("day"))

        return F.filter(F.transform(F.regexp_extract_all(c, F.lit(pattern), F.lit(0)), one), lambda s: s.day.isNotNull())

    return F.concat(of(r"(\d{4})-(\d{2})(?:-(\d{2}))?", 1, 2, 3), of(r"(\d{2})/(\d{2})/(\d{4})", 3, 2, 1))


WEEKDAYS = ("lunes", "martes", "miércoles", "miercoles", "jueves", "viernes", "sábado", "sabado", "domingo")


def split_weekday(c: Column) -> Column:
    """struct<day, hours>: a leading weekday and the rest; N/D for what is missing (STR-01)."""
    return bind(trim(F.regexp_replace(F.coalesce(c, F.lit("")), f"{WS}+", " ")), _weekday_first)


def _weekday_first(c: Column) -> Column:
    first = F.substring_index(c, " ", 1)
    rest = trim(F.substr(c, F.length(first) + 1))
    known = F.lower(first).isin(*WEEKDAYS)
    nd = F.lit("N/D")
    return F.struct(F.when(known, first).otherwise(nd).alias("day"), F.when(~known, F.when(c == "", nd).otherwise(c)).when(rest == "", nd).otherwise(rest).alias("hours"))


def join_weekday(day: Column, hours: Column) -> Column:
    """Day and hours in one cell, without placeholders (STR-02)."""
    day, hours = trim(F.coalesce(day, F.lit(""))), trim(F.coalesce(hours, F.lit("")))
    d = (day != "") & ~F.lower(day).isin("ver horarios", "n/d")
    h = (hours != "") & (F.lower(hours) != "n/d")
    return F.when(d & h, F.concat(day, F.lit(" — "), hours)).when(d, day).when(h, hours).otherwise(F.lit("N/D"))
