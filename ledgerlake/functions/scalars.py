"""Scalar functions F1-F28, all native Spark expressions (codegen, no
Python worker).  Each takes and returns ``Column``s."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "date_parts", "date_key", "quarter", "day_of_week", "is_weekend", "date_series",
    "mask_last", "mask_account", "mask_phone", "mask_card", "format_id", "strip_prefix_int",
    "clean_text", "round_half_even", "round2", "add_days", "date_cap", "format_ts",
    "first_element", "iso_timestamp", "months_since", "available_credit", "utilisation_pct",
    "monthly_installment", "as_col", "WHITESPACE",
]


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# F1
def date_parts(c) -> list[Column]:
    c = as_col(c)
    return [F.year(c).alias("year"), F.month(c).alias("month"), F.dayofmonth(c).alias("day")]


# date -> yyyyMMdd as int; NULL stays NULL
def date_key(c) -> Column:
    return F.date_format(as_col(c), "yyyyMMdd").cast("int")


# F3
def quarter(c) -> Column:
    return F.quarter(as_col(c))


# Monday = 0 .. Sunday = 6
def day_of_week(c) -> Column:
    return F.weekday(as_col(c))


# F5
def is_weekend(c) -> Column:
    return F.weekday(as_col(c)) >= 5


# one row per day between two dates, both included
def date_series(start, end) -> Column:
    return F.explode(F.sequence(as_col(start), as_col(end), F.expr("INTERVAL 1 DAY")))


# Fixed value: the mask prefix.
MASK = "****"


# F8/F9: '****' + last n characters; NULL stays NULL
def mask_last(c, n: int) -> Column:
    c = as_col(c).cast("string")
    return F.concat(F.lit(MASK), F.right(c, F.lit(n)))


def mask_account(c) -> Column:
    return mask_last(c, 4)


def mask_phone(c) -> Column:
    return mask_last(c, 3)


# '****' + a 4-digit number in 1000..9999, repeatable per id
def mask_card(id_col) -> Column:
    h = F.conv(F.substring(F.md5(as_col(id_col).cast("string")), 1, 8), 16, 10).cast("bigint")
    return F.concat(F.lit(MASK), (h % 9000 + 1000).cast("string"))


# prefix + zero-padded number; wider numbers are kept whole
def format_id(prefix: str, n, width: int = 7) -> Column:
    return F.format_string(f"{prefix}%0{width}d", as_col(n).cast("bigint"))


# strip a literal prefix and read the rest as an integer
def strip_prefix_int(c, prefix: str) -> Column:
    c = as_col(c)
    return F.when(c.startswith(prefix),
                  F.substring(c, len(prefix) + 1, 1 << 30)).otherwise(c).try_cast("bigint")


# Fixed value: the whitespace set of the text clean-up (space, tab, LF, VT, FF, CR).
WHITESPACE = " \t\n\x0b\x0c\r"


# newline -> space, then trim whitespace at both ends
def clean_text(c) -> Column:
    spaced = F.translate(as_col(c), "\n", " ")
    return F.btrim(spaced, F.lit(WHITESPACE))


# F16: round half to even, to an integer
def round_half_even(c) -> Column:
    return F.bround(as_col(c), 0).cast("bigint")


# half-even at 2 places on the double's shortest decimal text
# (1738.935 -> 1738.94).  Python's round() uses the exact binary value
# (1738.93499.. -> 1738.93); they differ only on such exact-text ties.
def round2(c) -> Column:
    return F.bround(as_col(c), 2)


# F18
def add_days(c, n) -> Column:
    return F.date_add(as_col(c).cast("date"), n if isinstance(n, Column) else F.lit(n))


# the earlier of the two dates (cap at an as-of day)
def date_cap(c, cap) -> Column:
    return F.least(as_col(c).cast("date"), as_col(cap).cast("date"))


# F20
def format_ts(c, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.date_format(as_col(c), pattern)


# element 0, NULL when the array is empty or NULL
def first_element(c) -> Column:
    return F.get(as_col(c), 0)


# ISO-8601 text, seconds precision
def iso_timestamp(c) -> Column:
    return F.date_format(as_col(c), "yyyy-MM-dd'T'HH:mm:ss")


# whole months between a date and the as-of date
def months_since(c, as_of) -> Column:
    return F.floor(F.months_between(as_col(as_of), as_col(c))).cast("int")


# F28
def available_credit(limit, outstanding) -> Column:
    return as_col(limit) - as_col(outstanding)


def utilisation_pct(limit, outstanding, places: int = 1) -> Column:
    return F.round(as_col(outstanding) / as_col(limit) * 100, places)


# F25
def monthly_installment(amount, term) -> Column:
    return as_col(amount).cast("double") / as_col(term)
