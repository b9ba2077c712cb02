"""Shared building blocks: first line per transaction (T1), null-safe sums,
top-k (O2) and top-k per group (W4) without unbounded single-task windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def zsum(c) -> Column:
    """pandas ``sum``: all-null (or empty) gives 0, not null."""
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.sum(col), F.lit(0.0))


#: types whose values an aggregation buffer holds in place, so that Spark aggregates by hash
FIXED_WIDTH = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType)


def first_line_per_transaction(df: DataFrame, cols: Sequence[str], key: str = "transaction_id") -> DataFrame:
    """``drop_duplicates(key)`` keeping the first line in ingestion order.

    One aggregation on the key; partial aggregation runs map-side, so even a
    huge transaction is reduced to one row per partition before the shuffle.
    Where ``_seq`` numbers the lines (a long, all different) and all columns
    are of fixed width, each is taken by the least number and Spark aggregates
    by hash; else the columns go together as a struct.
    """
    keep = [c for c in cols if c != key]
    types = {f.name: f.dataType for f in df.schema.fields}
    numbered = isinstance(types["_seq"], T.LongType)
    if numbered and all(isinstance(types[c], FIXED_WIDTH) for c in keep):
        return df.groupBy(key).agg(*[F.min_by(c, "_seq").alias(c) for c in keep], F.min("_seq").alias("_seq"))
    # ties on _seq (lines that are not numbered) are broken by the values themselves
    order = F.col("_seq") if numbered else F.struct(F.col("_seq"), *[F.col(c) for c in keep])
    return (df.groupBy(key)
              .agg(F.min_by(F.struct(*[F.col(c) for c in keep], F.col("_seq")), order).alias("_f"))
              .select(key, *[F.col(f"_f.{c}").alias(c) for c in keep], F.col("_f._seq").alias("_seq")))


def top_k(df: DataFrame, k: int, order: Sequence[Column]) -> DataFrame:
    """O2: global top-k (TakeOrderedAndProject: per-partition top-k, then merge)."""
    return df.orderBy(*order).limit(k)


def top_k_per_group(df: DataFrame, k: int, group: Sequence[str], order: Sequence[Column],
                    rank_col: str | None = None, salt_buckets: int | None = None) -> DataFrame:
    """First k rows of each group in ``order`` (exact).

    Two stages so that one hot group never lands whole in one task: rows are
    spread over ``salt_buckets`` sub-groups (by default as many as there are
    shuffle partitions) by a hash of all columns, each sub-group keeps its own top k, then the k * salt_buckets survivors per
    group are ranked again. The global top k of a group is always among the
    sub-group winners.
    """
    salt_buckets = salt_buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(salt_buckets))
    staged = df.withColumn("_salt", salt)
    w1 = Window.partitionBy(*group, "_salt").orderBy(*order)
    survivors = staged.withColumn("_r1", F.row_number().over(w1)).where(F.col("_r1") <= k).drop("_r1", "_salt")
    w2 = Window.partitionBy(*group).orderBy(*order)
    out = survivors.withColumn("_r2", F.row_number().over(w2)).where(F.col("_r2") <= k)
    return out.withColumn(rank_col, F.col("_r2").cast("long")).drop("_r2") if rank_col else out.drop("_r2")


def stored(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write an aggregate that several consumers read as parquet in the shared folder.

    Later reads start from the stored columns instead of re-running the whole
    upstream job, and a lost executor costs a re-read only.
    """
    from kassa.session import new_path, shuffles_dropped
    spark = df.sparkSession
    path = new_path(spark, name)
    with shuffles_dropped(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def share_pct(value: str, *group: str) -> Column:
    """100 x value / sum of value over ``group`` of an already grouped, bounded
    frame (null when that total is 0): the total comes from the aggregate
    itself, so the data is not aggregated again."""
    total = F.sum(value).over(Window.partitionBy(*group))
    return F.try_divide(F.col(value), F.when(total != 0, total)) * 100.0
