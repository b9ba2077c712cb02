"""Pseudonymisation as native column expressions (sha1 in the JVM, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kassa.constants import POSTAL_LETTERS, POSTAL_PREFIX, PSEUDONYM_PREFIXES
from kassa.functions.clean import strip


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


DIGEST_DIGITS = 40   # all of sha1: what groups, joins and distinct counts run on
DISPLAY_DIGITS = 8   # what reports show


def hashed_token(text: Column, prefix: str) -> Column:
    """prefix + the upper-case hex digits of sha1(text)."""
    return F.concat(F.lit(prefix), F.upper(F.sha1(text)))


def display_id(c, prefix: str) -> Column:
    """The short form of a pseudonym, for showing only: prefix + 8 hex digits.

    Short forms of different identifiers can be equal, so nothing is grouped
    or joined by them. Texts that are no pseudonym stay as they are.
    """
    col = _col(c)
    whole = len(prefix) + DIGEST_DIGITS
    return F.when((F.length(col) == whole) & col.startswith(prefix),
                  F.substring(col, 1, len(prefix) + DISPLAY_DIGITS)).otherwise(col)


def display_ids(df: DataFrame) -> DataFrame:
    """``df`` with the short form of every pseudonym column it has."""
    return df.withColumns({c: display_id(c, p) for c, p in PSEUDONYM_PREFIXES if c in df.columns})


def pseudonymise(c, prefix: str) -> Column:
    """Identifier hashing with pandas' ``str(value).strip()`` semantics.

    A null (a key that found no match in a left join) is hashed as the text
    'nan'; an empty string stays empty.
    """
    t = strip(F.coalesce(_col(c).cast("string"), F.lit("nan")))
    return F.when(t == "", F.lit("")).otherwise(hashed_token(t, prefix))


def hashed_postal(text: Column) -> Column:
    """Masked postal code 'T d L d L d' from the first five sha1 hex digits.

    digit = hex value % 10, letter = 'A' + hex value % 26; empty text -> ''.
    """
    h = F.sha1(text)

    def nib(i: int) -> Column:  # value of the i-th (lower-case) hex digit
        code = F.ascii(F.substring(h, i, 1))
        return F.when(code >= 97, code - 87).otherwise(code - 48)

    def digit(i: int) -> Column:
        return (nib(i) % 10).cast("string")

    def letter(i: int) -> Column:
        return F.substring(F.lit(POSTAL_LETTERS), (nib(i) % 26) + 1, 1)

    masked = F.concat(F.lit(POSTAL_PREFIX), digit(1), letter(2), digit(3), letter(4), digit(5))
    return F.when(F.coalesce(text, F.lit("")) == "", F.lit("")).otherwise(masked)


def packed(c: str) -> Column:
    """An identifier as bytes, no two alike: a text of a prefix and 40 upper-case hex digits as prefix, 0xFF and 20 bytes."""
    col = F.col(f"`{c}`")
    prefix, digits = F.expr(f"left(`{c}`, length(`{c}`) - 40)"), F.right(col, F.lit(40))
    return F.when(col.rlike("^[A-Z]{1,8}[0-9A-F]{40}$"), F.concat(F.encode(prefix, "UTF-8"), F.lit(b"\xff"), F.unhex(digits))) \
            .otherwise(F.encode(col, "UTF-8"))


def unpacked(c: str) -> Column:
    """The identifier that :func:`packed` made the bytes of (0xFF is in no text)."""
    prefix, mark, digits = (F.expr(f"substring(`{c}`, {span})") for span in (f"1, length(`{c}`) - 21", f"length(`{c}`) - 20, 1", f"length(`{c}`) - 19, 20"))
    return F.when((F.octet_length(f"`{c}`") > 21) & (mark == F.lit(b"\xff")), F.concat(F.decode(prefix, "UTF-8"), F.hex(digits))) \
            .otherwise(F.decode(F.col(f"`{c}`"), "UTF-8"))
