"""ST1-ST3, ST8 and p-values against closed forms."""
import math

import numpy as np
import pytest

from kassa.operators.stats import ab_test_promo, promo_regression, transaction_value_histogram


def _t_tail(t, dof):
    """Two-sided p by the trapezoid rule on the density (x = tan a, so the whole tail is covered)."""
    a = np.linspace(math.atan(abs(t) / math.sqrt(dof)), math.pi / 2, 400_001)
    f = np.cos(a) ** (dof - 1)
    const = math.exp(math.lgamma((dof + 1) / 2) - math.lgamma(dof / 2)) / math.sqrt(math.pi)
    return 2 * const * float(((f[1:] + f[:-1]) / 2 * np.diff(a)).sum())


def _lines(spark, rows):
    # transaction_id, transaction_value (line), quantity, promo_flag
    return spark.createDataFrame(rows, "transaction_id string, transaction_value double, quantity_item double, "
                                       "promo_flag boolean")


def test_regression_matches_lstsq(spark):
    rng = np.random.default_rng(3)
    rows, y, x = [], [], []
    for i in range(40):
        promo = bool(i % 3 == 0)
        v = float(rng.normal(100 + 15 * promo, 10))
        rows.append((f"t{i}", v, 1.0, promo))
        y.append(v)
        x.append(int(promo))
    out = {r["term"]: r for r in promo_regression(_lines(spark, rows)).collect()}
    X = np.column_stack([np.ones(len(x)), x])
    beta, *_ = np.linalg.lstsq(X, np.array(y), rcond=None)
    resid = np.array(y) - X @ beta
    s2 = resid @ resid / (len(y) - 2)
    se = np.sqrt(np.diag(s2 * np.linalg.inv(X.T @ X)))
    assert out["Intercept"]["coef"] == pytest.approx(beta[0], rel=1e-10)
    assert out["Promo_Flag"]["coef"] == pytest.approx(beta[1], rel=1e-10)
    assert out["Intercept"]["std_err"] == pytest.approx(se[0], rel=1e-10)
    assert out["Promo_Flag"]["std_err"] == pytest.approx(se[1], rel=1e-10)
    t = beta[1] / se[1]
    assert out["Promo_Flag"]["p_value"] == pytest.approx(_t_tail(t, len(y) - 2), rel=1e-8)


def test_regression_small_and_single_class(spark):
    assert promo_regression(_lines(spark, [("a", 1.0, 1.0, True), ("b", 2.0, 1.0, False)])).count() == 0
    rows = [(f"t{i}", float(i), 1.0, False) for i in range(5)]
    out = {r["term"]: r for r in promo_regression(_lines(spark, rows)).collect()}
    assert out["Intercept"]["coef"] == pytest.approx(2.0)
    assert out["Promo_Flag"]["coef"] is None


def test_welch(spark):
    a = [10.0, 12.0, 9.0, 14.0]
    b = [7.0, 8.0, 6.5, 9.5, 8.0]
    rows = [(f"p{i}", v, 1.0, True) for i, v in enumerate(a)] + [(f"n{i}", v, 1.0, False) for i, v in enumerate(b)]
    r = ab_test_promo(_lines(spark, rows)).first()
    va, vb = np.var(a, ddof=1) / len(a), np.var(b, ddof=1) / len(b)
    t = (np.mean(a) - np.mean(b)) / math.sqrt(va + vb)
    dof = (va + vb) ** 2 / (va ** 2 / (len(a) - 1) + vb ** 2 / (len(b) - 1))
    assert r["t_stat"] == pytest.approx(t, rel=1e-12)
    assert r["dof"] == pytest.approx(dof, rel=1e-12)
    assert r["lift"] == pytest.approx(np.mean(a) - np.mean(b))
    one = ab_test_promo(_lines(spark, rows[:4])).first()
    assert one["lift"] is None and one["t_stat"] is None and one["promo_mean"] == pytest.approx(np.mean(a))


def test_histogram_edges(spark):
    from pyspark.sql import functions as F
    rows = [("a", 0.0), ("b", 19.99), ("c", 20.0), ("d", 40.0), ("e", -5.0)]
    df = spark.createDataFrame(rows, "transaction_id string, transaction_value double") \
        .withColumn("_seq", F.lit(1))
    h = {r["bin"]: r["count"] for r in transaction_value_histogram(df, 20.0).collect()}
    assert h == {0: 2, 1: 2}  # [0,20) and [20,40] — last bin closed


def test_zero_variance_gives_nulls_not_errors(spark):
    rows = [(f"p{i}", 5.0, 1.0, True) for i in range(3)] + [(f"n{i}", 5.0, 1.0, False) for i in range(3)]
    out = {r["term"]: r for r in promo_regression(_lines(spark, rows)).collect()}
    assert out["Promo_Flag"]["coef"] == 0.0 and out["Promo_Flag"]["std_err"] == 0.0 and out["Promo_Flag"]["t"] is None
    ab = ab_test_promo(_lines(spark, rows)).first()
    assert ab["lift"] == 0.0 and ab["t_stat"] is None and ab["p_value"] is None


def test_chi_square_needs_both_promo_columns(spark):
    from kassa.operators.stats import chi_square_promo_usage
    rows = [(f"c{i}", "X", False, 1.0, float(10 + i), float(10 + i)) for i in range(12)]  # nobody used a promotion
    df = spark.createDataFrame(rows, "contact_id string, city string, promo_flag boolean, quantity_item double, "
                                     "line_sales_value double, line_original_value double")
    assert chi_square_promo_usage(df).count() == 0
