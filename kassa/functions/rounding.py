"""Output rounding that two engines reproduce bit for bit.

Sums of doubles depend on summation order, and decimal rounding of a double
differs between engines at exact decimal ties (x.xx5). So values are first
snapped to a binary grid, ``floor(x * 2**k + 0.5) / 2**k`` (power-of-two
scaling is exact; grid boundaries never coincide with 2- or 4-decimal data),
then rounded to ``s`` decimals (exact, because m * 5**s < 2**53). ``k`` and
``s`` follow the magnitude, keeping roughly 9 significant digits. Scales
must be literals in Spark, hence the CASE ladder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# (upper bound of |x|, binary digits k, decimal places s)
LADDER = ((2.0 ** -10, 40, 10), (1.0, 30, 9), (2.0 ** 10, 20, 6), (2.0 ** 20, 10, 3),
          (2.0 ** 24, 6, 2), (2.0 ** 44, 2, 2))


def sig_round(c) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    a = F.abs(col)
    expr = None
    for bound, k, s in LADDER:
        snapped = F.round(F.floor(col * F.lit(2.0 ** k) + F.lit(0.5)).cast("double") * F.lit(2.0 ** -k), s)
        expr = F.when(a < bound, snapped) if expr is None else expr.when(a < bound, snapped)
    return expr.otherwise(col)


def sig_round_sql(expr: str) -> str:
    """Same ladder as SQL text (DuckDB)."""
    parts = " ".join(
        f"WHEN abs({expr}) < {bound!r} THEN round(CAST(floor(({expr}) * {2.0 ** k!r} + 0.5) AS DOUBLE) * {2.0 ** -k!r}, {s})"
        for bound, k, s in LADDER)
    return f"(CASE {parts} ELSE CAST({expr} AS DOUBLE) END)"


def round_doubles(df: DataFrame) -> DataFrame:
    """Apply :func:`sig_round` to every double column (for comparisons/output)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(sig_round(F.col(f"`{f.name}`").cast("double")).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)
