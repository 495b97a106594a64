"""Column helpers: text normalisation, tolerant parsing, money."""

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(12,2)"
# What text may be read as a type: all that fits, and little else. A cast of other text raises
# and catches an error inside Spark for every value, which costs far more than the look. Years
# from 300000 on are beyond every timestamp.
_BLANKS = r"[\x00-\x20\x7F]*"
_MAYBE = {
    "int": rf"^{_BLANKS}[+-]?[0-9.]+{_BLANKS}$",
    "bigint": rf"^{_BLANKS}[+-]?[0-9.]+{_BLANKS}$",
    "double": rf"^{_BLANKS}[+-]?(?:[0-9.]+(?:[eE][+-]?[0-9]+)?[fFdD]?"
    rf"|0[xX][0-9a-fA-F.]+[pP][+-]?[0-9]+[fFdD]?|(?i:nan|inf|infinity)){_BLANKS}$",
    "boolean": rf"(?i)^{_BLANKS}(?:t|true|y|yes|1|f|false|n|no|0){_BLANKS}$",
    "timestamp": rf"^(?!{_BLANKS}[+-]?[3-9][0-9]{{5}}{_BLANKS}$)",
}


def blank_to_null(col: Column) -> Column:
    """Trimmed text; nothing but spaces counts as missing."""
    return F.nullif(F.trim(col), F.lit(""))


def to_int(col: Column) -> Column:
    """Integer, or NULL where the value is none (never a made-up 0 or 1)."""
    return col.try_cast("int")


def parse_timestamp(col: Column, pattern: str) -> Column:
    """Timestamp in exactly this pattern, otherwise NULL."""
    return F.try_to_timestamp(col, F.lit(pattern))


def money(col: Column) -> Column:
    """Exact two-digit money; out of range becomes NULL instead of an error."""
    return col.try_cast(MONEY)


def mean_money(total: Column, count: Column) -> Column:
    """Average rounded to cents once, from the exact total (no rounded average in between)."""
    return F.round(total.cast("decimal(24,2)") / count, 2)


def does_not_fit(col: Column, type_name: str) -> Column:
    """True where a text value is present but cannot be read as the declared type."""
    value = col.try_cast(type_name)
    if type_name in _MAYBE:
        maybe = (F.typeof(col) != "string") | col.cast("string").rlike(_MAYBE[type_name])
        value = F.when(maybe, value)
    return col.isNotNull() & value.isNull()
