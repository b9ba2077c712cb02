"""Order statistics by narrowing against numpy and plain sorting."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from kassa.operators.selection import quantile_rank_scores, quantile_values, values_at_ranks


def frame(spark, values, keys=None):
    keys = keys or [f"k{i:05d}" for i in range(len(values))]
    return spark.createDataFrame([(k, *map(float, v)) for k, v in zip(keys, values, strict=True)], "k string, a double, b double").repartition(5)


@pytest.mark.parametrize("small", [3, 10_000])
def test_values_at_ranks(spark, small):
    rng = np.random.default_rng(1)
    a = np.concatenate([np.full(1500, 7.0), rng.normal(0, 100, 1000), rng.integers(-3, 3, 500)])
    b = np.exp(rng.normal(0, 8, 3000))
    df = frame(spark, np.stack([a, b], 1))
    ranks = [1, 2, 600, 1199, 1200, 1201, 1500, 2999, 3000]
    got = values_at_ranks(df, {"a": ranks, "b": ranks}, small)
    for c, x in (("a", np.sort(a)), ("b", np.sort(b))):
        for r in ranks:
            assert got[c][r].value == x[r - 1] and got[c][r].below == int((x < x[r - 1]).sum())


@pytest.mark.parametrize("small", [2, 10_000])
def test_scores_of_several_measures(spark, small):
    rng = np.random.default_rng(2)
    n = 700
    values = np.stack([rng.integers(0, 3, n), np.where(rng.random(n) < 0.9, 1, rng.integers(0, 50, n))], 1)
    keys = ["CUST" + format(int(x), "040X") for x in rng.permutation(n) * 7919 % 100_003]
    df = frame(spark, values, keys)
    out = {r["k"]: (r["s"], r["t"]) for r in quantile_rank_scores(df, [("a", "s", True), ("b", "t", False)], "k", small=small).collect()}
    for i, reverse in ((0, True), (1, False)):
        order = sorted(range(n), key=lambda j: ((-1 if reverse else 1) * values[j, i], keys[j]))
        for place, j in enumerate(order):
            score = max(1, -(-place * 5 // (n - 1)))
            assert out[keys[j]][i] == (6 - score if reverse else score)


def test_keys_of_any_length(spark):
    """One key may begin another; order is that of the bytes."""
    keys = ["", "a", "aa", "aaa", "aaaa", "ab", "é", "z", "😀", "aab", "zz", "Z"]
    df = frame(spark, [(1, 1)] * len(keys), keys)
    out = {r["k"]: r["s"] for r in quantile_rank_scores(df, [("a", "s", False)], "k", small=1).collect()}
    for place, k in enumerate(sorted(keys, key=str.encode)):
        assert out[k] == max(1, -(-place * 5 // (len(keys) - 1)))


def test_quantiles_and_no_sort(spark):
    rng = np.random.default_rng(3)
    values = np.stack([rng.integers(0, 9, 400), rng.normal(size=400).round(2)], 1)
    df = frame(spark, values)
    probs = [0.0, 0.2, 0.37, 0.5, 0.8, 1.0]
    for small in (2, 10_000):
        got = quantile_values(df, ["a", "b"], probs, small)
        assert np.allclose(got["a"], np.quantile(values[:, 0], probs), atol=1e-12) and np.allclose(got["b"], np.quantile(values[:, 1], probs), atol=1e-12)
    assert quantile_values(df.where("false"), ["a"], [0.5]) == {"a": [None]}
    plan = quantile_rank_scores(df, [("a", "s", False)], "k")._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Window" not in plan and df.where(F.lit(False)).count() == 0
