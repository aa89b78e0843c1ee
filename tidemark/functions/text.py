"""Text clean-up and composite keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .numeric import col


# Characters that count as white space at either end of a text.
WHITE_SPACE = "".join(map(chr, (
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)))


def strip(c: Column | str) -> Column:
    """Remove leading and trailing white space of any kind.

    A text that starts and ends with a visible ASCII character is left alone without a search through the list.
    """
    text = col(c).cast("string")
    last = F.substring(text, -1, 1)
    plain = (text >= "!") & (text < "\x7f") & (last >= "!") & (last < "\x7f")
    return F.when(plain, text).otherwise(F.btrim(text, F.lit(WHITE_SPACE)))


def key_text(c: Column | str, data_type: T.DataType) -> Column:
    """Identifier as trimmed text, null kept; whole-number doubles lose their ``.0``."""
    value = col(c)
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        whole = value.try_cast("bigint")
        value = F.when(whole.cast("double") == value, whole.cast("string")).otherwise(value.cast("string"))
    return strip(value.cast("string"))


def without_spaces(c: Column | str) -> Column:
    return F.replace(col(c), F.lit(" "), F.lit(""))


def text_or_nan(c: Column | str) -> Column:
    """Text form in which a missing value reads ``nan``."""
    return F.coalesce(col(c).cast("string"), F.lit("nan"))


def region_key(country: Column | str, province: Column | str) -> Column:
    return F.concat(
        F.upper(F.substring(col(country), 1, 2)),
        F.lit("_"),
        without_spaces(F.upper(F.substring(col(province), 1, 5))),
    )


def geo_key(region: Column | str, city: Column | str, postal: Column | str) -> Column:
    return F.concat(
        col(region), F.lit("_"), without_spaces(text_or_nan(city)),
        F.lit("_"), without_spaces(text_or_nan(postal)),
    )
