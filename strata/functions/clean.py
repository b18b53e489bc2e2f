"""Column expressions of the clean layer. All are built-in Spark expressions
(JVM side, whole-stage codegen); none is a Python UDF.

Rules followed by every expression:
* a blank value (empty or spaces only) is NULL; tabs and newlines are text;
* a value whose shape does not match its type becomes NULL, and so does a
  value whose shape matches but cannot be represented (month 13, 99999 as
  smallint, 12 integer digits as decimal(10,2)): the load never fails on data;
* ``\\z`` ends every pattern: Java's ``$`` also matches before a final newline.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Value shapes accepted by the guarded casts.
UNSIGNED_INT = r"^[0-9]+\z"
UNSIGNED_DECIMAL = r"^[0-9]+([.][0-9]+)?\z"
SIGNED_DECIMAL = r"^[-]?[0-9]+([.][0-9]+)?\z"
TIMESTAMP_SHAPE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}\z"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c) -> Column:
    """Trim spaces; an empty result is NULL."""
    return F.nullif(F.trim(_col(c)), F.lit(""))


def bounded(c, n: int) -> Column:
    """Cut text to at most ``n`` characters (a declared VARCHAR(n))."""
    return F.substring(_col(c), 1, n)


def clean_text(c, n: int | None = None) -> Column:
    v = blank_to_null(c)
    return v if n is None else bounded(v, n)


def zip5(c) -> Column:
    """Zip-code prefix: blank to NULL, left-padded with zeros to five
    characters (longer input is cut to five)."""
    return F.lpad(blank_to_null(c), 5, "0")


def state_code(c) -> Column:
    """Two-letter upper-case code; trailing padding is not kept."""
    return F.rtrim(bounded(F.upper(blank_to_null(c)), 2))


def lower_code(c, n: int = 20) -> Column:
    return bounded(F.lower(blank_to_null(c)), n)


def _guarded(c, pattern: str, type_name: str) -> Column:
    v = F.trim(_col(c))
    return F.when(v.rlike(pattern), v.try_cast(type_name))


def to_smallint(c) -> Column:
    return _guarded(c, UNSIGNED_INT, "smallint")


def to_int(c) -> Column:
    return _guarded(c, UNSIGNED_INT, "int")


def to_money(c) -> Column:
    """Unsigned decimal text to decimal(10,2), rounding half away from zero."""
    return _guarded(c, UNSIGNED_DECIMAL, "decimal(10,2)")


def to_coordinate(c) -> Column:
    """Optionally negative decimal text to decimal(18,14)."""
    return _guarded(c, SIGNED_DECIMAL, "decimal(18,14)")


def to_timestamp(c) -> Column:
    """``YYYY-MM-DD HH:MM:SS`` text to a zone-less timestamp."""
    return _guarded(c, TIMESTAMP_SHAPE, "timestamp_ntz")


def has_text(c) -> Column:
    """True when the value has a non-space character."""
    return F.coalesce(F.trim(_col(c)), F.lit("")) != F.lit("")
