"""Sales KPIs: G1-G7, G18-G20, G24, G25 (with W1/W2 shares)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kassa.constants import UNKNOWN_LABEL

from kassa.functions.clean import month_start, parse_iso_date, safe_ratio
from kassa.functions.privacy import display_id, packed
from kassa.operators.common import first_line_per_transaction, stored, top_k, zsum
from kassa.operators.rank import global_order


def compute_highlights(df: DataFrame) -> DataFrame:
    """G1: one row — revenue from first lines (per transaction), distinct orders,
    units over all lines, average order value, top city by line-summed
    transaction value, online share. Empty input gives zeros."""
    # one scan: every line counts for its transaction and for its city; both partial sums combine map-side
    sides = F.explode(F.array(F.struct(F.col("transaction_id").alias("tx"), F.lit(None).cast("string").alias("city"), F.lit(True).alias("by_tx")),
                              F.struct(F.lit(None).cast("string").alias("tx"), F.col("city"), F.lit(False).alias("by_tx")))).alias("k")
    g = (df.select(sides, "transaction_value", "quantity_item", "_seq").groupBy("k.by_tx", "k.tx", "k.city")
           .agg(F.min_by("transaction_value", "_seq").alias("_first"), zsum("transaction_value").alias("_rev"), zsum("quantity_item").alias("_units")))
    tx, city = F.col("by_tx"), ~F.col("by_tx")
    best = F.when(city & F.col("city").isNotNull(), F.struct(-F.col("_rev"), "city"))
    one = g.agg(zsum(F.when(tx, F.col("_first"))).alias("total_revenue"), F.count_if(tx).cast("long").alias("total_orders"),
                zsum(F.when(city, F.col("_units"))).alias("total_units"),
                zsum(F.when(city & (F.lower("city") == "online"), F.col("_rev"))).alias("_online"), F.min(best).alias("_top"))
    return highlight_row(one)


def highlight_row(one: DataFrame) -> DataFrame:
    """G1 from its sums: ``total_revenue, total_units, total_orders, _online`` and ``_top`` = (-revenue, city)."""
    rev = F.col("total_revenue")
    return one.select(
        rev, "total_units", "total_orders",
        F.when(F.col("total_orders") > 0, rev / F.col("total_orders")).otherwise(F.lit(0.0)).alias("avg_order_value"),
        F.col("_top.city").alias("top_city"),
        (-F.col("_top").getField("col1")).alias("top_city_revenue"),
        F.when(rev != 0, F.col("_online") / rev).otherwise(F.lit(0.0)).alias("online_share"),
    )


def monthly_kpi_summary(df: DataFrame) -> DataFrame:
    """Per month — revenue (line-summed transaction value), distinct orders,
    units, distinct customers ('' counts as one), average order value.

    Pre-aggregated to (month, transaction, customer) first so the two exact
    distinct counts expand the reduced rows, not the lines.
    """
    pre = (df.groupBy(month_start("date_transaction").alias("month"), "transaction_id", "contact_id")
             .agg(F.sum("transaction_value").alias("_rev"), F.sum("quantity_item").alias("_units")))
    out = pre.groupBy("month").agg(
        zsum("_rev").alias("revenue"),
        F.countDistinct("transaction_id").cast("long").alias("orders"),
        zsum("_units").alias("units"),
        F.countDistinct("contact_id").cast("long").alias("unique_customers"))
    return out.withColumn("avg_order_value", safe_ratio("revenue", "orders"))


def monthly_sales_series(df: DataFrame) -> DataFrame:
    """Revenue and orders from first lines (month of that line), units from
    all lines; months only present in units are dropped (left join)."""
    # one scan: a line counts for its transaction (first line) and for its month (units)
    month = month_start("date_transaction")
    sides = F.explode(F.array(F.struct(F.col("transaction_id").alias("tx"), F.lit(None).cast("date").alias("m"), F.lit(True).alias("by_tx")),
                              F.struct(F.lit(None).cast("string").alias("tx"), month.alias("m"), F.lit(False).alias("by_tx")))).alias("k")
    g = (df.select(sides, month.alias("_m"), "transaction_value", "quantity_item", "_seq").groupBy("k.by_tx", "k.tx", "k.m")
           .agg(F.min_by("_m", "_seq").alias("_first_m"), F.min_by("transaction_value", "_seq").alias("_first_value"), zsum("quantity_item").alias("_units")))
    tx = F.col("by_tx")
    out = g.groupBy(F.when(tx, F.col("_first_m")).otherwise(F.col("m")).alias("month")).agg(
        zsum(F.when(tx, F.col("_first_value"))).alias("revenue"), F.count_if(tx).cast("long").alias("orders"),
        zsum(F.when(~tx, F.col("_units"))).alias("units"))
    return out.where(F.col("orders") > 0)


def daily_units(df: DataFrame) -> DataFrame:
    """Units per transaction date."""
    return df.groupBy("date_transaction").agg(zsum("quantity_item").alias("units"))


def category_revenue_share(df: DataFrame, top_n: int = 10) -> DataFrame:
    """Top-N categories by line-summed revenue; share of the total over all
    non-null categories (0 when that total is 0)."""
    cat = df.where(F.col("category").isNotNull()).groupBy("category").agg(zsum("transaction_value").alias("revenue"))
    total = F.sum("revenue").over(Window.partitionBy())  # over the categories, already summed
    shared = cat.withColumn("share", F.when(total != 0, F.col("revenue") / total).otherwise(F.lit(0.0)))
    return top_k(shared, top_n, [F.col("revenue").desc(), F.col("category").asc()])


def _pareto(agg: DataFrame, key_cols: list[str], value: str = "gmv") -> DataFrame:
    """Share %, cumulative share % in value-desc order, Pareto-80 flag.

    The running sum uses the distributed global order (no single-task window).
    """
    agg = stored(agg, "groups")
    total = agg.agg(zsum(value)).scalar()
    shared = agg.withColumn("gmv_share_pct", F.try_divide(F.col(value), total) * 100.0)
    order = [F.col(value).desc()] + [F.col(c).asc() for c in key_cols]
    ranked = global_order(shared, order, rank_col="gmv_rank", running={"gmv_cum_share_pct": F.col("gmv_share_pct")})
    return ranked.withColumn("pareto_80", F.col("gmv_cum_share_pct") <= 80.0)


def category_pareto(df: DataFrame) -> DataFrame:
    """Per category (null -> 'Unknown'): GMV (line-summed transaction value),
    units, distinct orders, ASP, share %, cumulative share %, Pareto-80."""
    agg = (df.withColumn("category", F.coalesce("category", F.lit(UNKNOWN_LABEL)))
             .groupBy("category")
             .agg(zsum("transaction_value").alias("gmv"), zsum("quantity_item").alias("units"),
                  F.countDistinct("transaction_id").cast("long").alias("orders")))
    agg = agg.withColumn("asp", safe_ratio("gmv", "units"))
    return _pareto(agg, ["category"])


def sku_top50(df: DataFrame, k: int = 50) -> DataFrame:
    """Per (SKU, label) as G6; only the top ``k`` by GMV are returned.

    Cumulative share of the top k needs only the rows above them and the
    grand total: distributed top-k first, then a window over k rows.
    """
    label = F.coalesce(F.col("sku_description"), display_id("sku", "SKU"), display_id("item_id", "ITEM"))
    agg = (df.withColumn("sku_label", label)
             .groupBy("sku", "sku_label")
             .agg(zsum("transaction_value").alias("gmv"), zsum("quantity_item").alias("units"),
                  F.countDistinct("transaction_id").cast("long").alias("orders")))
    agg = stored(agg, "skus")
    total = agg.agg(zsum("gmv")).scalar()
    order = [F.col("gmv").desc(), F.col("sku").asc_nulls_first(), F.col("sku_label").asc_nulls_first()]
    top = top_k(agg, k, order)
    w = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)  # k rows only
    out = (top.withColumn("asp", safe_ratio("gmv", "units"))
              .withColumn("gmv_share_pct", F.try_divide(F.col("gmv"), total) * 100.0)
              .withColumn("gmv_rank", F.row_number().over(Window.orderBy(*order)).cast("long")))
    out = out.withColumn("gmv_cum_share_pct", F.sum("gmv_share_pct").over(w))
    return out.withColumn("pareto_80", F.col("gmv_cum_share_pct") <= 80.0)


def units_by_location(df: DataFrame) -> DataFrame:
    """Units per (latitude, longitude, city) where geo is present."""
    return (df.dropna(subset=["latitude", "longitude"])
              .groupBy("latitude", "longitude", "city").agg(zsum("quantity_item").alias("units")))


def avg_transaction_value_by_location(df: DataFrame) -> DataFrame:
    """Mean first-line transaction value per location."""
    tx = first_line_per_transaction(df.withColumn("transaction_id", packed("transaction_id")), ["transaction_value", "latitude", "longitude", "city"])
    return (tx.dropna(subset=["latitude", "longitude"])
              .groupBy("latitude", "longitude", "city").agg(F.avg("transaction_value").alias("avg_transaction_value")))


def avg_transaction_value(df: DataFrame) -> DataFrame:
    """Mean of non-negative first-line transaction values (one row)."""
    tx = first_line_per_transaction(df.withColumn("transaction_id", packed("transaction_id")), ["transaction_value"])  # bytes: half as long
    return tx.where(F.col("transaction_value") >= 0).agg(
        F.avg("transaction_value").alias("avg_transaction_value"),
        F.count(F.lit(1)).cast("long").alias("transactions"))


def store_opening_trend(stores: DataFrame) -> DataFrame:
    """Store openings per year (unparseable OPEN_DATE dropped), in year order (``row_rank``)."""
    t = {f.name: f.dataType for f in stores.schema.fields}
    d = parse_iso_date("OPEN_DATE", t.get("OPEN_DATE"))
    return (stores.select(d.alias("_d")).where(F.col("_d").isNotNull())
                  .groupBy(F.year("_d").alias("year")).agg(F.count(F.lit(1)).cast("long").alias("openings"))
                  .withColumn("row_rank", F.row_number().over(Window.orderBy("year")).cast("long")))  # years only


def web_account_share(contacts: DataFrame) -> DataFrame:
    """Share of contacts per upper-cased raw web-account value (null -> 'NAN')."""
    v = F.upper(F.coalesce(F.col("Has_Web_Account").cast("string"), F.lit("nan")))
    counts = contacts.groupBy(v.alias("has_web_account")).agg(F.count(F.lit(1)).cast("long").alias("contacts"))
    return counts.withColumn("share", F.col("contacts") / F.sum("contacts").over(Window.partitionBy()))  # over a few raw values
