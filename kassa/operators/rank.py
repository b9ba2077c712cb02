"""Global order statistics without a single-task window.

``Window.orderBy(...)`` with no partition moves every row to one task. Here the
frame is range-partitioned on the (unique) order key, sorted inside each
partition and stored; the position of a row is then

    rank = (rows in all earlier partitions) + (position inside its partition) + 1

where the per-partition counts form a table with one row per partition (a
proven broadcast bound). The position inside a partition comes from
``monotonically_increasing_id`` (partition index in the upper bits, row index
in the lower 33 bits) evaluated right after the sort and stored with the row,
so that the counting pass and the numbering pass see the same positions.

Quantiles order the distinct values with their counts (ties are one row). The
cut points of scores are found without ordering (:mod:`kassa.operators.selection`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kassa.operators.common import stored

_LOW_BITS = (1 << 33) - 1


def _partitions(df: DataFrame, n: int | None) -> int:
    return n or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def global_order(df: DataFrame, order: Sequence[Column], rank_col: str = "_rank",
                 running: dict[str, Column] | None = None,
                 partitions: int | None = None, total_col: str | None = None,
                 grand: dict[str, str] | None = None) -> DataFrame:
    """Add a 1-based ``rank_col`` following ``order`` (must be a total order).

    ``running`` maps output names to value columns whose running sum (in that
    order, current row included) is added as well. ``total_col`` names an
    optional column holding the total row count, and ``grand`` maps output
    names to running sums whose grand total is added (both are read off the
    per-partition sums, so no second pass over the data).
    """
    running = dict(running or {})
    staged = df
    for name, expr in running.items():
        staged = staged.withColumn(f"_v_{name}", expr)
    staged = (staged.repartitionByRange(_partitions(df, partitions), *order)
                    .sortWithinPartitions(*order)
                    .withColumn("_mid", F.monotonically_increasing_id()))
    staged = stored(staged, "order")
    staged = (staged.withColumn("_pid", F.shiftright("_mid", 33))
                    .withColumn("_pos", F.col("_mid").bitwiseAND(F.lit(_LOW_BITS))))
    stats = staged.groupBy("_pid").agg(
        F.count(F.lit(1)).alias("_cnt"),
        *[F.coalesce(F.sum(f"_v_{k}"), F.lit(0.0)).alias(f"_s_{k}") for k in running])
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stats.select(
        "_pid",
        F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"),
        F.sum("_cnt").over(Window.partitionBy()).alias("_total"),
        *[F.coalesce(F.sum(f"_s_{k}").over(before), F.lit(0.0)).alias(f"_o_{k}") for k in running],
        *[F.sum(f"_s_{k}").over(Window.partitionBy()).alias(name) for name, k in (grand or {}).items()])
    # one row per partition: bounded by the partition count, safe to broadcast
    out = staged.join(F.broadcast(offsets), "_pid")
    out = out.withColumn(rank_col, (F.col("_off") + F.col("_pos") + 1).cast("long"))
    if running:
        within = Window.partitionBy("_pid").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
        for k in running:
            out = out.withColumn(k, F.col(f"_o_{k}") + F.sum(f"_v_{k}").over(within))
    if total_col:
        out = out.withColumn(total_col, F.col("_total").cast("long"))
    drop = ["_pid", "_pos", "_mid", "_off", "_total"] + [f"_o_{k}" for k in running] + [f"_v_{k}" for k in running]
    return out.drop(*drop)


def quantile_rank_score(df: DataFrame, value: str, key: str, out: str,
                        desired_bins: int = 5, reverse: bool = False) -> DataFrame:
    """Quantile score 1..desired_bins of rank(method='first') — qcut on ranks.

    Ties in ``value`` are broken by ``key`` ascending. With n rows and
    q = min(desired_bins, n) bins, rank r falls in bin
    ``max(1, ceil((r-1)*q/(n-1)))``; fewer than ``desired_bins`` bins are
    stretched by ``ceil(s*desired/q)``; n <= 1 gives the middle score;
    ``reverse`` ranks descending and then flips (score -> desired+1-score).
    """
    from kassa.operators.selection import quantile_rank_scores
    return quantile_rank_scores(df, [(value, out, reverse)], key, desired_bins)


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float],
                    names: Sequence[str] | None = None) -> DataFrame:
    """One-row frame of exact linear-interpolated quantiles (numpy 'linear').

    The values are counted first (map-side, so ties become one row), the
    distinct values are ordered with their running count, and the 2 *
    len(probs) neighbouring order statistics are read off; no task holds all
    distinct values (Spark's exact ``percentile`` would merge a value->count
    map of the whole column in one task).
    """
    names = list(names or [f"q{int(round(p * 100))}" for p in probs])
    vals = df.select(F.col(value).cast("double").alias("_x")).where(F.col("_x").isNotNull())
    counts = vals.groupBy("_x").agg(F.count(F.lit(1)).cast("double").alias("_c"))
    ranked = global_order(counts, [F.col("_x").asc()], rank_col="_r", running={"_to": F.col("_c")}, grand={"_n": "_to"})
    n, to = F.col("_n"), F.col("_to")
    since = to - F.col("_c")
    per_row, keep = {}, None
    for i, p in enumerate(probs):
        h = (n - 1) * F.lit(float(p))
        lo = F.floor(h).cast("double")
        hi = F.least(lo + 1, n - 1)
        a, b = (since <= lo) & (lo < to), (since <= hi) & (hi < to)
        per_row[f"_a{i}"] = F.when(a, F.col("_x"))
        per_row[f"_b{i}"] = F.when(b, F.col("_x"))
        per_row[f"_g{i}"] = h - lo
        keep = (a | b) if keep is None else (keep | a | b)
    picked = ranked.where(keep).withColumns(per_row)
    agg = picked.agg(*[F.max(f"_a{i}").alias(f"_a{i}") for i in range(len(probs))],
                     *[F.max(f"_b{i}").alias(f"_b{i}") for i in range(len(probs))],
                     *[F.first(f"_g{i}").alias(f"_g{i}") for i in range(len(probs))])
    out = []
    for i, name in enumerate(names):
        a, b, g = F.col(f"_a{i}"), F.col(f"_b{i}"), F.col(f"_g{i}")
        out.append(F.when(g >= 0.5, b - (b - a) * (F.lit(1.0) - g)).otherwise(a + (b - a) * g).alias(name))
    return agg.select(*out)


def approx_quantiles(df: DataFrame, value: str, probs: Sequence[float], names: Sequence[str] | None = None,
                     accuracy: int = 10_000) -> DataFrame:
    """One-row frame of approximate quantiles (Greenwald-Khanna sketches merged
    across partitions, relative rank error 1/accuracy). One aggregation pass,
    no global sort; use when exact order statistics are not required."""
    names = list(names or [f"q{int(round(p * 100))}" for p in probs])
    q = F.percentile_approx(F.col(value).cast("double"), [float(p) for p in probs], accuracy)
    return df.agg(q.alias("_q")).select(*[F.col("_q")[i].alias(n) for i, n in enumerate(names)])
