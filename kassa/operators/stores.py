"""Store and location performance: G14-G17."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kassa.constants import UNKNOWN_LABEL

from kassa.functions.clean import safe_ratio
from kassa.operators.common import share_pct, stored, top_k, top_k_per_group, zsum
from kassa.operators.rank import global_order


def store_profitability(df: DataFrame) -> DataFrame:
    """Per (store name, city), null keys kept: revenue (line-summed
    transaction value), units, discount, discount per unit; ``row_rank``
    follows revenue, largest first."""
    g = df.groupBy("store_name", "city").agg(
        zsum("transaction_value").alias("revenue"), zsum("quantity_item").alias("units"),
        zsum("line_discount").alias("discount"))
    return rank_profitability(g)


def rank_profitability(g: DataFrame) -> DataFrame:
    """G14 from its sums per (store name, city)."""
    g = g.withColumn("avg_discount_per_unit", safe_ratio("discount", "units"))
    return global_order(g, [F.col("revenue").desc(), F.col("store_name"), F.col("city")], rank_col="row_rank")


def rank_performance(g: DataFrame, keys: list[str]) -> DataFrame:
    """Ratios, share of the total, and ``row_rank`` by GMV, largest first."""
    g = g.withColumns({
        "aov": safe_ratio("gmv", "orders"),
        "items_per_order": safe_ratio("units", "orders"),
    })
    ranked = global_order(g, [F.col("gmv").desc(), *[F.col(k) for k in keys]], rank_col="row_rank",
                          running={"_to": F.col("gmv")}, grand={"_sum": "_to"})
    share = F.try_divide(F.col("gmv"), F.when(F.col("_sum") != 0, F.col("_sum"))) * 100.0
    return ranked.withColumn("gmv_share_pct", share).drop("_to", "_sum")


def _measures(grouped) -> DataFrame:
    return grouped.agg(zsum("transaction_value").alias("gmv"), zsum("quantity_item").alias("units"),
                       F.countDistinct("transaction_id").cast("long").alias("orders"))


STORE_KEYS = ["store_id", "store_name", "store_city", "store_province"]
CITY_KEYS = ["province", "city"]


def store_labels(df: DataFrame) -> DataFrame:
    """Label defaults of G15."""
    return df.withColumns({
        "store_name": F.coalesce("store_name", "store_id"),
        "store_city": F.coalesce("city", F.lit(UNKNOWN_LABEL)),
        "store_province": F.coalesce("province", F.lit(UNKNOWN_LABEL)),
    })


def city_labels(df: DataFrame) -> DataFrame:
    """Label defaults of G16."""
    return df.withColumns({"province": F.coalesce("province", F.lit(UNKNOWN_LABEL)),
                           "city": F.coalesce("city", F.lit(UNKNOWN_LABEL))})


def store_deep_dive(df: DataFrame) -> DataFrame:
    """Per (store id, name, city, province) with label defaults."""
    return rank_performance(_measures(store_labels(df).groupBy(*STORE_KEYS)), STORE_KEYS)


def city_performance(df: DataFrame) -> DataFrame:
    """Per (province, city) with 'Unknown' defaults."""
    return rank_performance(_measures(city_labels(df).groupBy(*CITY_KEYS)), CITY_KEYS)


def city_category_mix(df: DataFrame, k: int = 5) -> DataFrame:
    """Value per (city, category), share % within the city, top ``k``
    categories per city."""
    base = df.withColumns({"city": F.coalesce("city", F.lit(UNKNOWN_LABEL)),
                           "category": F.coalesce("category", F.lit(UNKNOWN_LABEL))})
    g = base.groupBy("city", "category").agg(zsum("transaction_value").alias("transaction_value"))
    g = g.withColumn("gmv_share_pct", share_pct("transaction_value", "city"))  # over a city's categories
    return top_k_per_group(g, k, ["city"], [F.col("transaction_value").desc(), F.col("category").asc()],
                           rank_col="rank_in_city")


def store_top_bottom(df: DataFrame, k: int = 15) -> DataFrame:
    """G15 views: the ``k`` stores with the highest GMV and the ``k`` with the
    lowest (two distributed top-k), tagged by ``view`` with a 1-based rank."""
    d = stored(store_deep_dive(df).drop("row_rank"), "store_view")
    top = top_k(d, k, [F.col("gmv").desc(), F.col("store_id")]).withColumn("view", F.lit("top"))
    bottom = top_k(d, k, [F.col("gmv").asc(), F.col("store_id")]).withColumn("view", F.lit("bottom"))
    w = Window.partitionBy("view").orderBy(F.when(F.col("view") == "top", -F.col("gmv")).otherwise(F.col("gmv")),
                                           "store_id")  # at most 2k rows
    return top.unionByName(bottom).withColumn("view_rank", F.row_number().over(w).cast("long"))
