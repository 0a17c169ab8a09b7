"""Periods of statistical series: ``2021M06``, ``2021Q2``, ``2021``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# strptime directive -> (pattern to parse, pattern to print)
_DIRECTIVES = {
    "%Y": ("yyyy", "yyyy"),
    "%y": ("yy", "yy"),
    "%m": ("M", "MM"),
    "%d": ("d", "dd"),
    "%b": ("MMM", "MMM"),
    "%B": ("MMMM", "MMMM"),
    "%H": ("H", "HH"),
    "%M": ("m", "mm"),
    "%S": ("s", "ss"),
}


def month_start(period: Column) -> Column:
    return F.try_to_date(F.regexp_extract(period, r"^(\d{4}M\d{1,2})", 1), "yyyy'M'M")


def month_end(period: Column) -> Column:
    return F.last_day(month_start(period))


def _quarter(period: Column, month_of_quarter: int) -> Column:
    year = F.regexp_extract(period, r"^(\d{4})Q[1-4]", 1).try_cast("int")
    quarter = F.regexp_extract(period, r"^\d{4}Q([1-4])", 1).try_cast("int")
    return F.make_date(year, (quarter - 1) * 3 + month_of_quarter, F.lit(1))


def quarter_start(period: Column) -> Column:
    return _quarter(period, 1)


def quarter_end(period: Column) -> Column:
    return F.last_day(_quarter(period, 3))


def year_start(period: Column) -> Column:
    return F.make_date(F.regexp_extract(period, r"^(\d{4})$", 1).try_cast("int"), F.lit(1), F.lit(1))


def year_end(period: Column) -> Column:
    return F.make_date(F.regexp_extract(period, r"^(\d{4})$", 1).try_cast("int"), F.lit(12), F.lit(31))


def period_kind(period: Column) -> Column:
    """``M``, ``Q``, ``Y`` or NULL; month is tried first, then quarter, then year."""
    return (
        F.when(period.rlike(r"\d{4}M\d{2}"), "M")
        .when(period.rlike(r"\d{4}Q\d"), "Q")
        .when(period.rlike(r"\d{4}"), "Y")
    )


def period_date(period: Column, kind: Column | None = None, anchor: str = "end") -> Column:
    """Date of a period of the given kind; a period of any other kind gives NULL."""
    if anchor not in ("start", "end"):
        raise ValueError("anchor is 'start' or 'end'")
    kind = period_kind(period) if kind is None else kind
    month, quarter, year = (
        (month_end, quarter_end, year_end) if anchor == "end" else (month_start, quarter_start, year_start)
    )
    return F.when(kind == "M", month(period)).when(kind == "Q", quarter(period)).when(kind == "Y", year(period))


def spark_pattern(strptime_format: str, printing: bool = False) -> str:
    """Datetime pattern for a strptime format such as ``%YM%m``."""
    out, i = "", 0
    while i < len(strptime_format):
        directive = strptime_format[i:i + 2]
        if directive in _DIRECTIVES:
            out += _DIRECTIVES[directive][printing]
            i += 2
        elif directive.startswith("%"):
            raise ValueError(f"format directive not supported: {directive}")
        else:
            char = strptime_format[i]
            out += f"'{char}'" if char.isalpha() else char
            i += 1
    return out


def parse_period(period: Column, strptime_format: str) -> Column:
    return F.try_to_date(period, spark_pattern(strptime_format))


def print_period(date: Column, strptime_format: str) -> Column:
    return F.date_format(date, spark_pattern(strptime_format, printing=True))


def reformat_month(period: Column, to_format: str = "%d/%m/%Y") -> Column:
    """``2021M06`` -> ``01/06/2021``."""
    return print_period(month_start(period), to_format)


def yesterday_month(date: Column) -> Column:
    """Label of the month that the day before ``date`` lies in, e.g. ``Aug 2021``."""
    return F.date_format(F.date_sub(date, 1), "MMM yyyy")
