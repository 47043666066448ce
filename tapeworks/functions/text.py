"""Text -> typed value, with the reject rules of the ingest.

Each converter returns NULL when the text must be rejected, so a caller can
test ``converted.isNull()``. Spark's casts are looser than the rules we keep
(``'2020'`` casts to a date, ``'12.0'`` and ``' 1_0'`` are questionable ints, a
bare time casts to *today*), so every cast sits behind a regular expression.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
# Characters stripped from both ends of a value: every character Python's
# str.isspace() accepts (the source trimmed with str.strip()).
WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
              "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
              "\u2028\u2029\u202f\u205f\u3000")
_ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"
_INT = r"^[+-]?\d+$"
_DECIMAL = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
# ISO date-time: date, optional 'T' or space, hh:mm, optional :ss and fraction.
_ISO_DATETIME = r"^\d{4}-\d{2}-\d{2}([T ]\d{1,2}:\d{2}(:\d{2}(\.\d{1,9})?)?)?$"
_ISO_PREFIX = r"^\d{4}-\d{2}-\d{2}"

# Lenient date-time forms accepted besides ISO 8601 (Spark datetime patterns; a
# single letter takes one digit or two, two-digit years are 2000 to 2099).
TIMESTAMP_FORMATS = (
    "yyyy-M-d H:mm[:ss][.SSSSSS]",
    "yyyy-M-d h:mm[:ss] a",
    "yyyy-M-d",
    "yyyy/M/d H:mm[:ss][.SSSSSS]",
    "yyyy/M/d h:mm[:ss] a",
    "yyyy/M/d",
    "M/d/yyyy H:mm[:ss][.SSSSSS]",
    "M/d/yyyy h:mm[:ss] a",
    "M/d/yyyy",
    "M/d/yy H:mm[:ss]",
    "M/d/yy h:mm[:ss] a",
    "M/d/yy",
    "MMM d yyyy H:mm[:ss]",
    "MMM d yyyy h:mm[:ss] a",
    "MMM d yyyy",
    "MMM d, yyyy H:mm[:ss]",
    "MMM d, yyyy h:mm[:ss] a",
    "MMM d, yyyy",
    "MMM d H:mm:ss yyyy",
    "d MMM yyyy H:mm[:ss]",
    "d MMM yyyy",
    "d-MMM-yyyy H:mm[:ss]",
    "d-MMM-yyyy",
    "yyyyMMdd'T'HHmmss",
    "yyyyMMddHHmmss",
    "yyyyMMdd",
)
# A time (never a bare date) followed by its offset from UTC.
_OFFSET = r"^(.*:\d{2}(?:\.\d+)?(?: ?[AaPp][Mm])?|\d{8}T?\d{6}) ?(Z|z|UTC|GMT|[+-]\d{2}:?\d{2})$"
_DAY_NAME = r"^(?i:mon|tue|wed|thu|fri|sat|sun)[a-z]*,? +"
_NOON = r"[AaPp][Mm]$"


def strip_ws(c: Column) -> Column:
    """Trim all leading and trailing whitespace (Spark's one-argument ``trim``
    only drops spaces). A character-set trim, no regular expression."""
    return F.btrim(c, F.lit(WHITESPACE))


def _trimmed(text: Column, stripped: bool) -> Column:
    return text if stripped else strip_ws(text)


def strict_date(text: Column, stripped: bool = False) -> Column:
    """``yyyy-mm-dd`` only, after trimming; anything else -> NULL."""
    t = _trimmed(text, stripped)
    return F.when(t.rlike(_ISO_DATE), t.try_cast(T.DateType()))


def lenient_timestamp(text: Column, formats=TIMESTAMP_FORMATS, stripped: bool = False) -> Column:
    """Date-time text -> TIMESTAMP_NTZ: ISO 8601 first; text that does not
    start with a padded ISO date, or ends in AM / PM, tries ``formats``. A day
    name in front is ignored.

    A time with an offset (``Z``, ``+02:00``, ``-0400``) is an instant and becomes
    its UTC wall-clock time; a time without one is taken as it is, whatever the
    session's zone. A time without a date is rejected (it would otherwise depend
    on the day the job runs).
    """
    t = _trimmed(text, stripped)
    offset = F.regexp_extract(t, _OFFSET, 2)
    core = F.regexp_replace(F.when(offset != "", F.regexp_extract(t, _OFFSET, 1)).otherwise(t),
                            _DAY_NAME, "")
    digits = F.regexp_replace(offset, "[^0-9]", "")
    minutes = (F.when(F.length(digits) == 4,
                      60 * F.substring(digits, 1, 2).try_cast("int") + F.substring(digits, 3, 2).try_cast("int"))
               .otherwise(0) * F.when(offset.startswith("-"), -1).otherwise(1))
    # Other forms are read as UTC instants (explicit offset) and turned into
    # wall-clock time by arithmetic, so no session zone (or DST gap) applies.
    utc = F.concat(core, F.lit(" +0000"))
    others = [F.try_to_timestamp(utc, F.lit(fmt + " xx")) for fmt in formats]
    wall = F.timestamp_add("MICROSECOND", F.unix_micros(F.coalesce(*others)),
                           F.lit("1970-01-01 00:00:00").cast(T.TimestampNTZType()))
    # Full ISO text: one regex on the common path. ISO-looking text that fails
    # the full pattern is refused; anything else tries the other formats.
    iso = t.rlike(_ISO_DATETIME)
    read = (F.when(core.rlike(_ISO_DATETIME), core.try_cast(T.TimestampNTZType()))
            .when(~core.rlike(_ISO_PREFIX) | core.rlike(_NOON), wall))
    return (F.when(iso, t.try_cast(T.TimestampNTZType()))
             .otherwise(F.timestamp_add("MINUTE", -minutes, read)))


def strict_int(text: Column, stripped: bool = False) -> Column:
    """Optional sign and digits only; out of 32-bit range -> NULL."""
    t = _trimmed(text, stripped)
    return F.when(t.rlike(_INT), t.try_cast(T.IntegerType()))


def strict_decimal(text: Column, dtype: T.DecimalType = T.DecimalType(10, 2),
                   stripped: bool = False) -> Column:
    """Plain decimal number, rounded half-up to the scale; out of range -> NULL."""
    t = _trimmed(text, stripped)
    return F.when(t.rlike(_DECIMAL), t.try_cast(dtype))


def convert_text(text: Column, dtype: T.DataType, stripped: bool = False) -> Column:
    """Dispatch on the target type: the CSV path, where every value is text.

    ``stripped=True`` when ``text`` is already trimmed (the parsers trim in a
    projection of its own, so the trim is not repeated inside every branch).
    """
    if isinstance(dtype, T.DateType):
        return strict_date(text, stripped)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        ts = lenient_timestamp(text, stripped=stripped)
        return ts if isinstance(dtype, T.TimestampNTZType) else ts.cast(dtype)
    if isinstance(dtype, T.IntegerType):
        return strict_int(text, stripped)
    if isinstance(dtype, T.DecimalType):
        return strict_decimal(text, dtype, stripped)
    if isinstance(dtype, T.StringType):
        return _trimmed(text, stripped)
    raise TypeError(f"unsupported target type {dtype}")
