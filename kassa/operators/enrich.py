"""Enrichment of the sales lines with the four dimensions.

pandas-merge semantics: left outer joins, duplicates fan out, clashing
non-key columns get ``_x``/``_y``. Keys are normalised on both sides first, so
the empty "missing" key matches an empty dimension key like any other value.

Where lines are numbered (``_seq`` is a long), the copies of a line that a
repeated dimension key makes are numbered too, in the order of the dimension's
rows, so that ``_seq`` stays unique and keeps the order of a pandas merge.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kassa.functions.clean import normalise_identifier
from kassa.operators.common import stored
from kassa.operators.joins import hot_keys, left_join_skew_safe, most_copies, size_bound_ok, suffix_clashes

FACT_KEYS = ("Contact_ID", "Item_ID", "Promotion_ID", "Store_transaction_ID")


def strip_headers(df: DataFrame) -> DataFrame:
    """Column names stripped of surrounding whitespace (CSV headers)."""
    return df.toDF(*[c.strip() for c in df.columns])


def prepared_dimension(df: DataFrame, key: str, rename: dict[str, str] | None = None) -> DataFrame:
    """A dimension with clean headers and its key normalised."""
    df = strip_headers(df)
    for a, b in (rename or {}).items():
        if a in df.columns:
            df = df.withColumnRenamed(a, b)
    return df.withColumn(key, normalise_identifier(key))


#: names of the copy numbers of each dimension's rows
COPY = "__copy_{}"


def numbered_copies(dim: DataFrame, key: str, copy: str) -> tuple[DataFrame, int]:
    """``dim`` with each row's number among the rows of its key, and the largest number of such rows."""
    copies = most_copies(dim, key)
    if copies > 1:
        order = [F.col("_seq")] if "_seq" in dim.columns else []
        same = Window.partitionBy(key).orderBy(*order, *[F.col(f"`{c}`") for c in dim.columns if c != "_seq"])
        dim = dim.withColumn(copy, F.row_number().over(same) - 1)
    return dim, copies


def needed_rows(fact: DataFrame, dims: dict[str, tuple[DataFrame, str, str]]) -> dict[str, DataFrame]:
    """Of large dimensions (each with the fact's key and its own) those of which the fact has few keys, cut to these and stored.

    One scan of the fact estimates how many of each dimension's keys occur at
    all; the rows left out match no line.
    """
    if not dims:
        return {}
    some = fact.agg(*[F.approx_count_distinct(fkey).alias(name) for name, (_, fkey, _) in dims.items()]).first()
    out = {}
    for name, (dim, fkey, dkey) in dims.items():
        if some[name] * 4 < dim.count():
            keys = fact.select(F.col(fkey).alias(dkey)).distinct()
            out[name] = stored(dim.join(keys, dkey, "left_semi").select(*[F.col(f"`{c}`") for c in dim.columns]), name)
    return out


def merge_sales_with_references(sales: DataFrame, dims: dict[str, DataFrame],
                                known_small: dict[str, bool] | None = None,
                                prepare: Callable[[str, DataFrame], DataFrame] | None = None) -> DataFrame:
    """J1-J4. ``known_small`` passes broadcast bounds already checked upstream
    (True = proven small, False = proven large); others are checked here.
    ``prepare`` makes of a dimension (by its name) the rows to join, which are stored."""
    df = strip_headers(sales).withColumns({k: normalise_identifier(k) for k in FACT_KEYS})
    salt = ["_seq"] if "_seq" in df.columns else None
    numbered = salt and isinstance(df.schema["_seq"].dataType, T.LongType)
    plan = (
        ("contact", "Contact_ID", "Contact_ID", None),
        ("item", "Item_ID", "SKU", None),
        ("promotion", "Promotion_ID", "PROMO_ID", {"LIBELLE": "LIBELLE_x"}),
        ("store", "Store_transaction_ID", "STORE_ID", {"LIBELLE": "LIBELLE_y"}),
    )
    ready = {name: prepared_dimension(dims[name], dkey, rename) for name, _, dkey, rename in plan}
    copies = {}
    for name, _, dkey, _ in plan:
        if numbered:
            ready[name], copies[name] = numbered_copies(ready[name], dkey, COPY.format(name))
        ready[name] = ready[name].drop("_seq")
        if prepare:
            ready[name] = stored(prepare(name, ready[name]), name)
    is_small = dict(known_small or {})
    for name in ready:
        if name not in is_small:
            is_small[name] = size_bound_ok(ready[name])
    ready |= needed_rows(df, {name: (ready[name], fkey, dkey) for name, fkey, dkey, _ in plan if not is_small[name]})
    is_small |= {name: size_bound_ok(ready[name]) for name in is_small if not is_small[name] and name not in (known_small or {})}
    large = [fkey for name, fkey, _, _ in plan if not is_small[name]]
    hot = hot_keys(df, large) if large else {}  # one pass for all shuffled joins
    for name, fkey, dkey, _ in plan:
        keys = [fkey] if fkey == dkey else []
        df, dim = suffix_clashes(df, ready[name], keys)
        df = left_join_skew_safe(df, dim, fkey, dkey, salt_source=salt, assume_small=is_small[name],
                                 broadcast_max_bytes=-1, hot_values=hot.get(fkey))
    repeated = [name for name, n in copies.items() if n > 1]
    for name in repeated:
        df = df.withColumn("_seq", F.col("_seq") * copies[name] + F.coalesce(F.col(COPY.format(name)), F.lit(0)))
    return df.drop(*[COPY.format(name) for name in repeated])
