"""Promotion analytics: G8-G13 and the active-promotion timeline G26."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kassa.constants import PROMO_LABELS, UNKNOWN_LABEL, UNSPECIFIED_PROMO_LABEL
from kassa.functions.clean import clip_at_zero, parse_iso_date, safe_ratio
from kassa.functions.privacy import packed
from kassa.operators.common import share_pct, top_k, zsum
from kassa.operators.rank import global_order


def promotion_summary(df: DataFrame) -> DataFrame:
    """(transaction, flag) sums, then per flag: orders, revenue, average
    order value, total / average discount, units. A transaction with promo and
    non-promo lines counts in both groups."""
    per_tx = df.groupBy("transaction_id", "promo_flag").agg(
        zsum("transaction_value").alias("tv"), zsum("line_discount").alias("disc"),
        zsum("quantity_item").alias("qty"))
    label = F.when(F.col("promo_flag"), F.lit(PROMO_LABELS[True])).otherwise(F.lit(PROMO_LABELS[False]))
    return per_tx.groupBy(label.alias("promotion")).agg(
        F.count(F.lit(1)).cast("long").alias("orders"),
        zsum("tv").alias("revenue"),
        F.avg("tv").alias("avg_order_value"),
        zsum("disc").alias("total_discount"),
        F.avg("disc").alias("avg_discount_per_order"),
        zsum("qty").alias("units"))


def promo_overall(df: DataFrame) -> DataFrame:
    """Transaction grain (any promo line marks the transaction), then per
    flag: GMV (line sales), units, orders, ASP, AOV, discount, rate, share %."""
    tx = df.groupBy("transaction_id").agg(
        zsum("line_sales_value").alias("gmv"), zsum("quantity_item").alias("units"),
        zsum("line_discount").alias("discount_value"), zsum("line_original_value").alias("original_value"),
        F.bool_or("promo_flag").alias("promo_flag"))
    g = tx.groupBy("promo_flag").agg(
        zsum("gmv").alias("gmv"), zsum("units").alias("units"), F.count(F.lit(1)).cast("long").alias("orders"),
        zsum("discount_value").alias("discount_value"), zsum("original_value").alias("original_value"))
    return g.select(
        "promo_flag", "gmv", "units", "orders",
        safe_ratio("gmv", "units").alias("asp"),
        safe_ratio("gmv", "orders").alias("aov"),
        "discount_value",
        safe_ratio("discount_value", "original_value").alias("avg_discount_rate"),
        share_pct("gmv").alias("gmv_share_pct"))  # over the two flags


def analysis_base(df: DataFrame) -> DataFrame:
    """P9/P10 label defaults and clipped discount used by the promo lenses."""
    return df.withColumns({
        "category": F.coalesce("category", F.lit(UNKNOWN_LABEL)),
        "store_name": F.coalesce("store_name", "store_id"),
        "store_city": F.coalesce("city", F.lit(UNKNOWN_LABEL)),
        "store_province": F.coalesce("province", F.lit(UNKNOWN_LABEL)),
        "promo_label": F.coalesce("promo_label", F.lit(UNSPECIFIED_PROMO_LABEL)),
        "original_value": F.col("line_original_value"),
        "discount_value": clip_at_zero("line_discount"),
        "gmv": F.col("line_sales_value"),
    })


def _promo_measures(grouped) -> DataFrame:
    return grouped.agg(
        zsum("gmv").alias("gmv"), zsum("quantity_item").alias("units"),
        F.countDistinct(packed("transaction_id")).cast("long").alias("orders"),
        zsum("discount_value").alias("discount_value"), zsum("original_value").alias("original_value"))


def _ratios(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "asp": safe_ratio("gmv", "units"),
        "aov": safe_ratio("gmv", "orders"),
        "avg_discount_rate": safe_ratio("discount_value", "original_value"),
    })


def promo_effect(df: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """Per dimensions + flag; GMV share % within the dimension group
    (0 when the group total is 0); ``row_rank`` follows GMV, largest first."""
    base = analysis_base(df)
    g = _ratios(_promo_measures(base.groupBy(*dimensions, "promo_flag")))
    total = F.sum("gmv").over(Window.partitionBy(*dimensions))  # two flags a group
    share = F.when(total == 0, F.lit(0.0)).otherwise(F.col("gmv") / total * 100.0)
    order = [F.col("gmv").desc(), *[F.col(c) for c in dimensions], F.col("promo_flag")]
    return global_order(g.withColumn("gmv_share_pct", share), order, rank_col="row_rank")


def promo_hotspots(df: DataFrame, k: int = 30) -> DataFrame:
    """Promo lines by (category, store, promo label); top ``k`` by GMV."""
    base = analysis_base(df).where(F.col("promo_flag"))
    g = _ratios(_promo_measures(base.groupBy("category", "store_name", "promo_label")))
    return top_k(g, k, [F.col("gmv").desc(), F.col("category"), F.col("store_name"), F.col("promo_label")])


def top_promotions(df: DataFrame, k: int = 10, exclude_missing: bool = False) -> DataFrame:
    """Per promotion id ('' = no promotion is one group unless
    ``exclude_missing``): revenue (line-summed transaction value), distinct
    orders, units; top ``k``."""
    if exclude_missing:
        df = df.where(F.col("promotion_id") != "")
    g = (df.where(F.col("promotion_id").isNotNull()).groupBy("promotion_id")
           .agg(zsum("transaction_value").alias("revenue"),
                F.countDistinct(packed("transaction_id")).cast("long").alias("orders"),
                zsum("quantity_item").alias("units")))
    return top_k(g, k, [F.col("revenue").desc(), F.col("promotion_id")])


def promo_share_long(df: DataFrame) -> DataFrame:
    """Revenue and order share of each G8 group, unpivoted."""
    s = promotion_summary(df)
    both = Window.partitionBy()  # over the two groups
    rev_tot, ord_tot = F.sum("revenue").over(both), F.sum("orders").over(both)
    wide = s.select(
        "promotion",
        F.when(rev_tot != 0, F.col("revenue") / rev_tot).otherwise(F.lit(0.0)).alias("Revenue Share"),
        F.when(ord_tot != 0, F.col("orders") / ord_tot).otherwise(F.lit(0.0)).alias("Order Share"))
    return wide.unpivot(["promotion"], ["Revenue Share", "Order Share"], "metric", "share")


def promotion_timeline(promotions: DataFrame, as_of: str | None = None) -> DataFrame:
    """Distinct active promotions per month.

    A promotion is active in every month from its start month to its end month
    (null end -> ``as_of``, default today); null start is skipped; start after
    end yields no month unless both fall in the same month (then one). Rows
    without an id make their months appear and are not counted.

    A sweep: a promotion's overlapping intervals become one, each leaves +1
    where it begins and -1 after its end, and running sums over the months with
    such events give the level up to the next. The work follows the number of
    intervals, however long they are.
    """
    t = {f.name: f.dataType for f in promotions.schema.fields}
    start = parse_iso_date("START_DATE", t.get("START_DATE"))
    fill = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    end = F.coalesce(parse_iso_date("END_DATE", t.get("END_DATE")), fill)

    def month(d: Column) -> Column:
        return F.year(d) * 12 + F.month(d) - 1

    p = promotions.select(F.col("PROMO_ID").alias("promo_id"), month(start).alias("s"), month(end).alias("e")).where("s <= e")
    p = p.groupBy("promo_id", "s").agg(F.max("e").alias("e"))  # at most one row a month for each promotion
    before = Window.partitionBy("promo_id").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("promo_id").orderBy("s").rowsBetween(Window.unboundedPreceding, 0)
    p = p.withColumn("new", F.when(F.max("e").over(before) >= F.col("s"), 0).otherwise(1)).withColumn("run", F.sum("new").over(upto))
    runs = p.groupBy("promo_id", "run").agg(F.min("s").alias("s"), F.max("e").alias("e"))
    known = F.col("promo_id").isNotNull().cast("long")
    events = runs.select(F.explode(F.array(F.struct(F.col("s").alias("m"), F.lit(1).alias("all"), known.alias("n")),
                                           F.struct((F.col("e") + 1).alias("m"), F.lit(-1).alias("all"), (-known).alias("n")))).alias("x"))
    steps = events.groupBy("x.m").agg(F.sum("x.all").alias("all"), F.sum("x.n").alias("n"))
    w = Window.orderBy("m")  # one row for each month with an event
    sofar = w.rowsBetween(Window.unboundedPreceding, 0)
    levels = steps.select("m", F.sum("all").over(sofar).alias("all"), F.sum("n").over(sofar).alias("n"), F.lead("m").over(w).alias("next"))
    months = levels.where("all > 0").select(F.explode(F.sequence("m", F.col("next") - 1)).alias("m"), "n")
    first = F.make_date(F.floor(F.col("m") / 12).cast("int"), (F.col("m") % 12 + 1).cast("int"), F.lit(1))
    return months.select(first.alias("month"), F.col("n").cast("long").alias("active_promotions"))
