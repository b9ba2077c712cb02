"""W5 quantile rank score and distributed order statistics vs brute force."""
import numpy as np
import pandas as pd
import pytest

from kassa.operators.rank import exact_quantiles, global_order, quantile_rank_score
from pyspark.sql import functions as F


def _brute_score(values, keys, reverse, k=5):
    s = pd.Series(values, index=keys).sort_index()
    if s.empty:
        return {}
    ranked = s.rank(method="first", ascending=not reverse)
    nb = min(k, ranked.nunique())
    if nb <= 1:
        return {key: k // 2 + 1 for key in s.index}
    scores = pd.qcut(ranked, nb, labels=False) + 1
    if nb < k:
        scores = np.ceil(scores * k / nb)
    if reverse:
        scores = k + 1 - scores
    return {key: int(v) for key, v in scores.items()}


@pytest.mark.parametrize("n", [0, 1, 2, 3, 5, 7, 23, 101])
@pytest.mark.parametrize("reverse", [False, True])
def test_quantile_rank_score(spark, n, reverse):
    rng = np.random.default_rng(n)
    values = [float(v) for v in rng.integers(0, 4, size=n)]  # many ties
    keys = [f"c{i:04d}" for i in rng.permutation(n)]
    df = spark.createDataFrame(list(zip(keys, values)), "k string, v double").repartition(3)
    got = {r["k"]: r["s"] for r in quantile_rank_score(df, "v", "k", "s", reverse=reverse).collect()}
    assert got == _brute_score(values, keys, reverse)


def test_exact_quantiles(spark):
    rng = np.random.default_rng(7)
    vals = rng.normal(size=257).round(3)
    df = spark.createDataFrame([(float(v),) for v in vals], "x double").repartition(5)
    row = exact_quantiles(df, "x", [0.2, 0.25, 0.5, 0.8]).first()
    expect = np.quantile(vals, [0.2, 0.25, 0.5, 0.8])
    assert np.allclose([row[c] for c in row.__fields__], expect, rtol=0, atol=1e-12)


def test_global_order_running_sum(spark):
    df = spark.range(200).select((F.col("id") * 37 % 200).alias("k"), (F.col("id") % 7).cast("double").alias("v"))
    out = global_order(df, [F.col("k").asc()], rank_col="r", running={"cum": F.col("v")}, partitions=6,
                       total_col="n", grand={"all": "cum"}).toPandas()
    out = out.sort_values("k")
    assert list(out["r"]) == list(range(1, 201))
    assert np.allclose(out["cum"].values, out["v"].cumsum().values)
    assert set(out["n"]) == {200} and set(out["all"]) == {out["v"].sum()}


def test_quantiles_of_ties(spark):
    """Nine tenths of the rows share one value."""
    vals = [1.0] * 900 + [float(v) for v in range(100)]
    df = spark.createDataFrame([(v,) for v in vals], "x double").repartition(7)
    row = exact_quantiles(df, "x", [0.0, 0.2, 0.5, 0.91, 1.0]).first()
    assert list(row) == pytest.approx(list(np.quantile(vals, [0.0, 0.2, 0.5, 0.91, 1.0])), abs=1e-12)


def test_tied_customers_share_the_work(spark):
    """90 % of the customers have one frequency: the ordering splits them by key."""
    from kassa.operators.rank import global_order
    n = 4000
    df = spark.range(n).select(F.concat(F.lit("c"), F.sha1(F.col("id").cast("string"))).alias("k"), F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(F.lit(1)).alias("v"))
    ordered = global_order(df, [F.col("v").asc(), F.col("k").asc()], partitions=8)
    sizes = [r["count"] for r in ordered.withColumn("p", F.floor((F.col("_rank") - 1) * 8 / n)).groupBy("p").count().collect()]
    assert sum(sizes) == n and max(sizes) <= n / 8 + 1
    placed = df.repartitionByRange(8, "v", "k").groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in placed) < 2.5 * n / 8
    scored = {r["k"]: r["s"] for r in quantile_rank_score(df, "v", "k", "s").collect()}
    rows = {r["k"]: float(r["v"]) for r in df.collect()}
    assert scored == _brute_score(list(rows.values()), list(rows), False)


def test_approx_quantiles_close(spark):
    from kassa.operators.rank import approx_quantiles
    df = spark.range(10_000).select((F.col("id") * 1.0).alias("x"))
    row = approx_quantiles(df, "x", [0.25, 0.5, 0.75]).first()
    assert abs(row["q50"] - 4999.5) <= 10 and abs(row["q25"] - 2499.75) <= 10
