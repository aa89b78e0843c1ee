"""Quarter labels, keys and calendar arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import col


def first_digit(c: Column | str) -> Column:
    """First digit of a text as int, null when there is none."""
    return F.regexp_extract(col(c), r"(\d)", 1).try_cast("int")


def year_quarter(year: Column | str, quarter: Column | str) -> Column:
    return F.concat(col(year).cast("string"), F.lit("-"), col(quarter))


def date_key(year: Column | str, quarter_num: Column | str) -> Column:
    return F.concat(col(year).cast("string"), F.lpad(col(quarter_num).cast("string"), 2, "0"))


def quarter_end(year: Column | str, quarter_num: Column | str) -> Column:
    return F.last_day(F.make_date(col(year), col(quarter_num) * 3, F.lit(1)))


def calendar_index(year: Column | str, quarter_num: Column | str) -> Column:
    """Gap-free quarter number ``year*4+quarter``."""
    return col(year) * 4 + col(quarter_num)


def label_year(label: Column | str) -> Column:
    return F.split(col(label), "-Q")[0].try_cast("int")


def label_quarter(label: Column | str) -> Column:
    return F.split(col(label), "-Q")[1].try_cast("int")


def shift_label(label: Column | str, steps: Column) -> tuple[Column, Column]:
    """(label, quarter number) of the quarter ``steps`` after a ``YYYY-Qn`` label."""
    k = label_year(label) * 4 + label_quarter(label) - 1 + steps
    year, quarter = F.floor(k / 4).cast("int"), (F.pmod(k, F.lit(4)) + 1).cast("int")
    return F.concat(year.cast("string"), F.lit("-Q"), quarter.cast("string")), quarter


def compact_label(label: Column | str) -> Column:
    return F.replace(col(label), F.lit("-"), F.lit(""))
