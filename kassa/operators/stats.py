"""Statistics: G21 transaction roll-up, ST1 OLS, ST2 Welch t-test, ST3/ST4
chi-square on a contingency table, ST5/ST6 quartiles and value classes, ST7
box-plot statistics, ST8 fixed-width histogram.

Everything data-sized is a Spark aggregate of sufficient statistics; the
p-values are column expressions on the one or two rows that are left.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kassa.constants import PROMO_USE_LABELS, VALUE_CLASSES
from kassa.functions.tails import chi2_tail, t_two_sided
from kassa.operators.common import first_line_per_transaction, stored, zsum
from kassa.operators.customers import customer_city_value
from kassa.operators.rank import approx_quantiles, exact_quantiles


def transaction_rollup(df: DataFrame) -> DataFrame:
    """Per transaction: summed value, summed quantity, any promo line."""
    return df.groupBy("transaction_id").agg(
        zsum("transaction_value").alias("transaction_value"),
        zsum("quantity_item").alias("quantity_item"),
        F.bool_or("promo_flag").alias("promo_flag"))


def _group_moments(tx: DataFrame) -> DataFrame:
    x = F.col("promo_flag")
    y = F.col("transaction_value")
    t = tx.where(y.isNotNull() & x.isNotNull())
    return t.agg(
        F.count_if(~x).cast("long").alias("n0"), F.count_if(x).cast("long").alias("n1"),
        F.avg(F.when(~x, y)).alias("mean0"), F.avg(F.when(x, y)).alias("mean1"),
        F.var_samp(F.when(~x, y)).alias("var0"), F.var_samp(F.when(x, y)).alias("var1"))


def promo_regression(df: DataFrame) -> DataFrame:
    """ST1: OLS of transaction value on the promo flag (intercept + slope), with two-sided p-values.

    With a binary regressor the normal equations close on group moments:
    slope = mean1 - mean0, intercept = mean0, SSE = Σ within-group squares,
    se(intercept) = sqrt(s2/n0), se(slope) = sqrt(s2 (1/n0 + 1/n1)),
    s2 = SSE/(n-2). Empty when n - 2 <= 0. A single-class flag makes the
    design singular: slope, its error and t are null.
    """
    m = _group_moments(transaction_rollup(df))
    n = F.col("n0") + F.col("n1")
    ss = (F.coalesce(F.col("var0"), F.lit(0.0)) * (F.col("n0") - 1)
          + F.coalesce(F.col("var1"), F.lit(0.0)) * (F.col("n1") - 1))
    s2 = ss / (n - 2)
    both = (F.col("n0") > 0) & (F.col("n1") > 0)
    b0 = F.when(both, F.col("mean0")).otherwise(F.coalesce(F.col("mean0"), F.col("mean1")))
    b1 = F.when(both, F.col("mean1") - F.col("mean0"))
    se0 = F.when(both, F.sqrt(s2 / F.col("n0"))).otherwise(F.sqrt(s2 / n))
    se1 = F.when(both, F.sqrt(s2 * (F.lit(1.0) / F.col("n0") + F.lit(1.0) / F.col("n1"))))
    rows = m.where(n - 2 > 0).select(
        (n - 2).alias("dof"),
        F.explode(F.array(
            F.struct(F.lit("Intercept").alias("term"), b0.alias("coef"), se0.alias("std_err")),
            F.struct(F.lit("Promo_Flag").alias("term"), b1.alias("coef"), se1.alias("std_err")))).alias("r"))
    out = rows.select("r.term", "r.coef", "r.std_err", F.try_divide(F.col("r.coef"), F.col("r.std_err")).alias("t"),
                      "dof")
    return out.withColumn("p_value", t_two_sided(F.col("t"), F.col("dof").cast("double"))).drop("dof")


def ab_test_promo(df: DataFrame) -> DataFrame:
    """ST2: Welch two-sample t-test, promo vs non-promo transaction values.

    One row: means, lift, t, Welch-Satterthwaite dof and the two-sided p. An empty group
    gives null lift / t / p.
    """
    m = _group_moments(transaction_rollup(df))
    a = F.col("var1") / F.col("n1")
    b = F.col("var0") / F.col("n0")
    both = (F.col("n0") > 0) & (F.col("n1") > 0)
    t = F.when(both, F.try_divide(F.col("mean1") - F.col("mean0"), F.sqrt(a + b)))
    dof = F.when(both, F.try_divide((a + b) * (a + b),
                                    a * a / (F.col("n1") - 1) + b * b / (F.col("n0") - 1)))
    out = m.select(F.col("mean1").alias("promo_mean"), F.col("mean0").alias("nonpromo_mean"),
                   F.when(both, F.col("mean1") - F.col("mean0")).alias("lift"),
                   t.alias("t_stat"), dof.alias("dof"))
    return out.withColumn("p_value", t_two_sided(F.col("t_stat"), F.col("dof")))


def customer_prices(df: DataFrame) -> DataFrame:
    """Unit price and promotion touches of each customer row, stored: quartiles, classes and box plot read it."""
    return stored(customer_city_value(df).select("unit_price", "promotion_touches"), "prices")


def unit_price_quartiles(df: DataFrame, approx: bool = False, prices: DataFrame | None = None) -> DataFrame:
    """ST5: 25/50/75 % of customer unit price (linear, exact, distributed);
    ``approx`` swaps in mergeable sketches (one pass, no sort)."""
    if approx:
        return approx_quantiles(customer_city_value(df), "unit_price", [0.25, 0.5, 0.75], ["q25", "q50", "q75"])
    src = customer_city_value(df) if prices is None else prices
    return exact_quantiles(src, "unit_price", [0.25, 0.5, 0.75], ["q25", "q50", "q75"])


def customer_value_classes(df: DataFrame, prices: DataFrame | None = None) -> DataFrame:
    """ST6: Low <= q25 < Medium <= q75 < High, and promotion use per customer row."""
    v = customer_prices(df) if prices is None else prices
    q = unit_price_quartiles(df, prices=v).first()  # three numbers
    up = F.col("unit_price")
    low, med, high = VALUE_CLASSES
    cls = F.when(up <= F.lit(q["q25"]), F.lit(low)).when(up <= F.lit(q["q75"]), F.lit(med)).otherwise(F.lit(high))
    used = F.when(F.col("promotion_touches") > 0, F.lit(PROMO_USE_LABELS[1])).otherwise(F.lit(PROMO_USE_LABELS[0]))
    return v.withColumn("customer_category", cls).withColumn("promotion_used", used)


def promo_usage_contingency(df: DataFrame, prices: DataFrame | None = None) -> DataFrame:
    """ST4 (long form of the crosstab): customers per value class x promo use,
    zero cells included for every observed row and column label."""
    c = customer_value_classes(df, prices)
    counts = c.groupBy("customer_category", "promotion_used").agg(F.count(F.lit(1)).cast("long").alias("_c"))
    # at most six rows from here on
    rows = counts.groupBy("customer_category").agg(F.map_from_entries(F.collect_list(F.struct("promotion_used", "_c"))).alias("_cells"))
    labels = F.array_distinct(F.flatten(F.collect_list(F.map_keys("_cells")).over(Window.partitionBy())))
    out = rows.withColumn("_labels", labels).withColumn("promotion_used", F.explode("_labels"))
    return out.select("customer_category", "promotion_used",
                      F.coalesce(F.try_element_at("_cells", F.col("promotion_used")), F.lit(0)).cast("long").alias("customers"))


def promo_usage_crosstab(df: DataFrame, prices: DataFrame | None = None) -> DataFrame:
    """The contingency table in wide form (pivot on the fixed labels)."""
    long = promo_usage_contingency(df, prices)
    return long.groupBy("customer_category").pivot("promotion_used", list(PROMO_USE_LABELS)) \
               .agg(F.sum("customers")).na.fill(0)


def chi_square_promo_usage(df: DataFrame, prices: DataFrame | None = None) -> DataFrame:
    """ST3: Pearson chi-square of value class x promo use; Yates correction when
    dof = 1; only when both promo-use columns occur (else empty)."""
    long = promo_usage_contingency(df, prices)
    every = Window.partitionBy()  # over at most six cells
    e = long.withColumns({
        "_rt": F.sum("customers").over(Window.partitionBy("customer_category")),
        "_ct": F.sum("customers").over(Window.partitionBy("promotion_used")),
        "_n": F.sum("customers").over(every),
        "_r": F.size(F.collect_set("customer_category").over(every)),
        "_k": F.size(F.collect_set("promotion_used").over(every)),
    })
    e = e.withColumn("_e", F.col("_rt") * F.col("_ct") / F.col("_n")).withColumn("dof", (F.col("_r") - 1) * (F.col("_k") - 1))
    diff = F.col("_e") - F.col("customers")
    corr = F.when(F.col("dof") == 1, F.signum(diff) * F.least(F.lit(0.5), F.abs(diff))).otherwise(F.lit(0.0))
    obs = F.col("customers") + corr
    stat = e.where(F.col("_k") == 2).agg(F.sum((obs - F.col("_e")) * (obs - F.col("_e")) / F.col("_e")).alias("statistic"),
                                         F.max("dof").cast("long").alias("dof"))
    return stat.where(F.col("dof").isNotNull()).withColumn("p_value", chi2_tail(F.col("statistic"), F.col("dof").cast("double")))


def box_plot_stats(df: DataFrame, prices: DataFrame | None = None) -> DataFrame:
    """ST7: quartiles of customer unit price and whiskers at the last value
    within 1.5 IQR (matplotlib default), no fliers."""
    v = customer_prices(df) if prices is None else prices
    q = unit_price_quartiles(df, prices=v).first()  # three numbers
    q1, q2, q3 = (F.lit(q[c]).cast("double") for c in ("q25", "q50", "q75"))
    iqr = q3 - q1
    up = F.col("unit_price")
    return v.agg(
        F.min(F.when(up >= q1 - 1.5 * iqr, up)).alias("whisker_low"),
        F.max(F.when(up <= q3 + 1.5 * iqr, up)).alias("whisker_high")) \
        .select(q1.alias("q1"), q2.alias("median"), q3.alias("q3"), iqr.alias("iqr"), "whisker_low", "whisker_high")


def transaction_value_histogram(df: DataFrame, bin_width: float = 20.0) -> DataFrame:
    """ST8: fixed-width bins from the minimum of non-negative first-line
    transaction values; bins are left-closed, the last one closed; empty bins
    listed (one row per bin, generated with a distributed range)."""
    first = first_line_per_transaction(df, ["transaction_value"]).where(F.col("transaction_value") >= 0)
    tx = stored(first.groupBy("transaction_value").agg(F.count(F.lit(1)).alias("_c")), "values")  # ties are one row
    stats = tx.agg(F.min("transaction_value").alias("lo"), F.max("transaction_value").alias("hi")).first()  # two numbers
    spark = df.sparkSession
    if stats is None or stats["lo"] is None:
        return spark.createDataFrame([], "bin int, bin_start double, bin_end double, count long")
    lo, hi, w = float(stats["lo"]), float(stats["hi"]), float(bin_width)
    nbins = max(int(math.ceil((hi - lo + w) / w)) - 1, 1)
    idx = F.least(F.floor((F.col("transaction_value") - F.lit(lo)) / F.lit(w)).cast("int"), F.lit(nbins - 1))
    counts = tx.groupBy(idx.alias("bin")).agg(F.sum("_c").cast("long").alias("count"))
    bins = spark.range(nbins).select(F.col("id").cast("int").alias("bin"))
    return bins.join(counts, "bin", "left").select(
        "bin", (F.lit(lo) + F.col("bin") * F.lit(w)).alias("bin_start"),
        (F.lit(lo) + (F.col("bin") + 1) * F.lit(w)).alias("bin_end"),
        F.coalesce("count", F.lit(0)).cast("long").alias("count"))
