"""Cleansing and typing of raw string columns (all pandas-parity rules).

Every helper takes and returns a ``Column`` and stays inside whole-stage
codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kassa.constants import MISSING_ID_TOKENS, TRUE_TOKENS

# plain decimal / scientific notation; rejects '1.0d', 'NaN', '1,234.56' after comma swap
_NUMBER_RE = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
_INF_RE = r"^(?i)[+-]?inf(inity)?$"
# characters Python's str.strip() removes (ASCII whitespace, separators, Unicode spaces)
_STRIP_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004"
                "\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Python ``str.strip`` on text: leading/trailing whitespace incl. NBSP.

    A character-set trim (``btrim``), not a regex, so it stays cheap per row;
    a text with visible ASCII characters at both ends is taken as it is.
    """
    col = _col(c).cast("string")
    visible = F.ascii(col).between(33, 126) & F.ascii(F.right(col, F.lit(1))).between(33, 126)
    return F.when(visible, col).otherwise(F.btrim(col, F.lit(_STRIP_CHARS)))


def normalise_identifier(c) -> Column:
    """Key normalisation: strip; null or a missing token (any case) -> ''."""
    s = F.coalesce(strip(c), F.lit(""))
    return F.when(F.lower(s).isin(*MISSING_ID_TOKENS), F.lit("")).otherwise(s)


def to_number(s: Column) -> Column:
    """Strict text -> double: decimal or scientific literal, or +-inf; else null.

    Spark's own cast would accept '1.0d' and 'NaN'; pandas does not.
    """
    t = strip(s)
    inf = F.when(t.startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf")))
    return (F.when(t.rlike(_NUMBER_RE), t.try_cast("double"))
             .when(t.rlike(_INF_RE), inf))


def coerce_numeric(c, dtype: T.DataType | None = None) -> Column:
    """Money parsing: drop spaces/NBSP, decimal comma -> point, strict parse.

    Columns that are already numeric are only cast to double.
    """
    col = _col(c)
    if dtype is not None and isinstance(dtype, T.NumericType):
        return col.cast("double")
    cleaned = col.cast("string")
    for old, new in (("\u00a0", ""), (" ", ""), (",", ".")):
        cleaned = F.replace(cleaned, F.lit(old), F.lit(new))
    return to_number(cleaned)


def parse_yyyymmdd(c, dtype: T.DataType | None = None) -> Column:
    """``yyyymmdd`` text -> date; anything else (incl. 7 digits) -> null."""
    col = _col(c)
    if isinstance(dtype, T.DateType):
        return col
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return col.cast("date")
    s = strip(col)
    iso = F.concat_ws("-", F.substring(s, 1, 4), F.substring(s, 5, 2), F.substring(s, 7, 2))
    return F.when(s.rlike(r"^\d{8}$") & ~s.startswith("0000"), iso.try_cast("date"))  # there is no year 0


def parse_iso_date(c, dtype: T.DataType | None = None) -> Column:
    """ISO date text (``yyyy-MM-dd`` optionally with a time part) -> date."""
    col = _col(c)
    if isinstance(dtype, T.DateType):
        return col
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return col.cast("date")
    s = strip(col)
    return F.when(s.rlike(r"^\d{4}-\d{1,2}-\d{1,2}([ T].*)?$"),
                  F.try_to_timestamp(F.substring_index(F.regexp_replace(s, "T", " "), " ", 1),
                                     F.lit("yyyy-M-d")).cast("date"))


def truthy(c) -> Column:
    """Boolean normalisation: trimmed lower text in {1,true,yes,y}; null -> false."""
    s = F.lower(F.coalesce(strip(c), F.lit("nan")))
    return s.isin(*TRUE_TOKENS)


def safe_ratio(num, den) -> Column:
    """x / y with a zero (or null) divisor giving null."""
    return F.try_divide(_col(num), F.when(_col(den) != 0, _col(den)))


def clip_at_zero(c) -> Column:
    """Negative -> 0; null stays null."""
    col = _col(c)
    return F.when(col < 0, F.lit(0.0)).otherwise(col)


def month_start(c) -> Column:
    return F.trunc(_col(c), "MM")


def ceil_div(a: Column, b: Column) -> Column:
    """ceil(a / b) for integers a >= 0, b > 0.

    Both operands stay below 2**53, so the double quotient is exact enough
    for floor: a non-integer quotient is at least 1/b away from an integer.
    """
    return F.floor((a + b - F.lit(1)) / b).cast("long")
