"""Join strategies with explicit size and skew handling.

* :func:`sized_broadcast` hints a broadcast only after measuring the side's
  bytes and finding them under a bound; beyond it the plan stays a shuffle
  join (AQE may still convert it at run time from real shuffle statistics).
* :func:`left_join_skew_safe` is a left outer equi-join whose hot key values
  are salted over ``buckets`` sub-keys on the fact side and replicated on the
  dimension side, so no single task receives a whole hot group. Hot keys are
  found by frequent-items sketches and a recount of their few candidates.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024
DEFAULT_SALT_BUCKETS = 64
HOT_SHARE = 1 / 64  # a key with more than this share of the fact's rows is hot


def _value_bytes(c: Column, dt: T.DataType) -> Column:
    """Bytes of one value: texts as long as they are, nested values as their text."""
    if isinstance(dt, T.BinaryType):
        return F.octet_length(c)
    if isinstance(dt, (T.StringType, T.StructType, T.ArrayType, T.MapType)):
        return F.octet_length(c.cast("string"))
    return F.lit(16 if isinstance(dt, T.DecimalType) else 8)


def measured_bytes(df: DataFrame) -> int:
    """Bytes of all rows of ``df``, added up map-side (16 more for each row)."""
    per_row = F.lit(16)
    for f in df.schema.fields:
        per_row = per_row + F.coalesce(_value_bytes(F.col(f"`{f.name}`"), f.dataType), F.lit(0))
    return int(df.agg(F.coalesce(F.sum(per_row.cast("long")), F.lit(0))).first()[0])


def most_copies(df: DataFrame, key: str) -> int:
    """Rows of the key that most rows share (0 for an empty frame)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]


def size_bound_ok(df: DataFrame, max_bytes: int | None = None) -> bool:
    """True when the measured bytes of ``df`` stay under ``max_bytes``."""
    return measured_bytes(df) <= (DEFAULT_BROADCAST_BYTES if max_bytes is None else max_bytes)


def sized_broadcast(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """Broadcast hint behind a checked size bound; unchanged otherwise."""
    return F.broadcast(df) if size_bound_ok(df, max_bytes) else df


def hot_keys(df: DataFrame, columns: Sequence[str], share: float = HOT_SHARE) -> dict[str, list]:
    """For each column its values that more than ``share`` of all rows have.

    Each task keeps a frequent-items sketch of every column (Misra-Gries
    counters, some thousand entries whatever the number of different keys);
    sketches merge in two steps. A value above ``share`` is never missing from
    the merged sketch, whose few candidates are then counted exactly.
    """
    out: dict[str, list] = {c: [] for c in columns}
    if df.isEmpty():  # sketches of no rows do not combine
        return out
    most = math.ceil(1 / share)
    tracked = max(1000, 16 * most)
    own = [f"s{i}" for i in range(len(columns))]
    text = [f"CAST(`{c}` AS STRING)" for c in columns]
    sketches = df.groupBy(F.pmod(F.spark_partition_id(), F.lit(256)).alias("g")).agg(
        F.count(F.lit(1)).alias("n"), *[F.expr(f"approx_top_k_accumulate({t}, {tracked})").alias(s) for t, s in zip(text, own, strict=True)])
    top = sketches.agg(F.sum("n").alias("n"), *[F.expr(f"approx_top_k_estimate(approx_top_k_combine({s}, {tracked}), {2 * most})").alias(s) for s in own]).first()
    found = {c: [t["item"] for t in top[s] if t["item"] is not None and t["count"] > top["n"] * share] for c, s in zip(columns, own, strict=True)}
    if not any(found.values()):
        return out
    keys = [F.when(F.col(c).cast("string").isin(found[c]), F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v"))) for c in columns if found[c]]
    counts = df.select(F.explode(F.array_compact(F.array(*keys))).alias("k")).groupBy("k.c", "k.v").agg(F.count(F.lit(1)).alias("n"))
    for r in counts.where(F.col("n") > top["n"] * share).collect():
        out[r["c"]].append(r["v"])
    return out


def left_join_skew_safe(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
                        hot_values: Sequence[str] | None = None,
                        buckets: int = DEFAULT_SALT_BUCKETS,
                        broadcast_max_bytes: int | None = None,
                        salt_source: Sequence[str] | None = None,
                        assume_small: bool = False) -> DataFrame:
    """``fact LEFT JOIN dim ON fact_key = dim_key`` robust to hot keys.

    Dimensions under a checked byte bound are broadcast (no skew issue). Larger ones
    are sort-merge joined on (key, salt): fact rows with a hot key get a
    deterministic salt in [0, buckets) hashed from ``salt_source`` columns,
    and the dimension rows carrying a hot key are replicated once per salt
    value. Rows and multiplicities equal the plain left join. When both keys
    share a name the result keeps one key column (pandas ``on=`` merge).
    ``hot_values`` are counted from the fact unless given; ``assume_small``
    skips the size check when the caller has already proven the bound.
    """
    same = fact_key == dim_key
    dkey = "__dim_key" if same else dim_key
    d = dim.withColumnRenamed(dim_key, dkey) if same else dim
    if assume_small or size_bound_ok(dim, broadcast_max_bytes):
        joined = fact.join(F.broadcast(d), F.col(fact_key) == F.col(dkey), "left")
    else:
        hot = list(hot_keys(fact, [fact_key])[fact_key] if hot_values is None else hot_values)
        src = [F.col(c) for c in (salt_source or fact.columns)]
        is_hot = F.col(fact_key).isin(hot) if hot else F.lit(False)
        dim_hot = F.col(dkey).isin(hot) if hot else F.lit(False)
        fact_s = fact.withColumn("__salt", F.when(is_hot, F.pmod(F.xxhash64(*src), F.lit(buckets))).otherwise(F.lit(0)).cast("int"))
        dim_s = d.withColumn("__dsalt", F.explode(F.when(dim_hot, F.sequence(F.lit(0), F.lit(buckets - 1))).otherwise(F.array(F.lit(0)))))
        joined = fact_s.join(dim_s, (F.col(fact_key) == F.col(dkey)) & (F.col("__salt") == F.col("__dsalt")), "left") \
                       .drop("__salt", "__dsalt")
    return joined.drop(dkey) if same else joined


def left_join_one_row(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, small: bool,
                      hot_values: Sequence[str] = (), copy: str | None = None, buckets: int = DEFAULT_SALT_BUCKETS) -> DataFrame:
    """``fact LEFT JOIN dim`` where ``dim`` has one row for each key (and number in the column ``copy``, which both have).

    The dimension is grouped by that key, so Spark knows that the join neither
    adds nor drops rows and leaves it out where no column of ``dim`` is asked
    for. A large dimension is joined by shuffle: lines with a hot key are dealt
    by texts that no stripped key equals, and get their values from the hot
    keys' own rows (fewer than 1 / HOT_SHARE keys), which are broadcast.
    """
    keys = ["__key"] + (["__copy"] if copy else [])
    own = {dim_key: "__key"} | ({copy: "__copy"} if copy else {})
    values = [c for c in dim.columns if c not in own]
    one = dim.groupBy(*[F.col(c).alias(k) for c, k in own.items()])
    d = one.agg(*[F.first(f"`{c}`").alias(c) for c in values]) if values else one.count().drop("count")
    d = d.withColumn(dim_key, F.col("__key")) if dim_key != fact_key else d
    added = [c for c in d.columns if c not in keys]

    def matches(key: Column) -> Column:
        return (key == F.col("__key")) & (F.col(copy) == F.col("__copy")) if copy else key == F.col("__key")

    if small:
        return fact.join(F.broadcast(d), matches(F.col(fact_key)), "left").drop(*keys)
    if not hot_values:
        return fact.join(d, matches(F.col(fact_key)), "left").drop(*keys)
    is_hot = F.col(fact_key).isin(list(hot_values))
    dealt = F.when(is_hot, F.concat(F.lit("\t"), F.pmod(F.xxhash64("_seq"), F.lit(buckets)).cast("string"))).otherwise(F.col(fact_key))
    out = fact.withColumn("__dealt", dealt).join(d, matches(F.col("__dealt")), "left").drop("__dealt", *keys)
    few = d.where(F.col("__key").isin(list(hot_values))).withColumnsRenamed({c: f"__hot_{c}" for c in added})
    out = out.join(F.broadcast(few), matches(F.col(fact_key)), "left").drop(*keys)
    return out.withColumns({c: F.when(is_hot, F.col(f"`__hot_{c}`")).otherwise(F.col(f"`{c}`")) for c in added}).drop(*[f"__hot_{c}" for c in added])


def suffix_clashes(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """pandas-merge naming: clashing non-key columns get ``_x`` / ``_y``."""
    clash = (set(left.columns) & set(right.columns)) - set(keys)
    for c in clash:
        left = left.withColumnRenamed(c, f"{c}_x")
        right = right.withColumnRenamed(c, f"{c}_y")
    return left, right
