"""Customer lifecycle: G22/G23 customer value, C1-C3 cohorts, C4-C7 dashboard
RFM, C8-C12 report RFM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kassa.constants import DASHBOARD_SEGMENTS, RECENCY_BUCKETS, REPORT_SEGMENTS, UNKNOWN_LABEL
from kassa.functions.clean import month_start, safe_ratio
from kassa.functions.privacy import packed, unpacked
from kassa.operators.common import first_line_per_transaction, share_pct, stored, top_k, zsum
from kassa.operators.joins import left_join_skew_safe
from kassa.operators.selection import quantile_rank_scores, quantile_values


# ---------------------------------------------------------------- G22 / G23
def customer_city_value(df: DataFrame) -> DataFrame:
    """Per (customer, city): promo touches, quantity, sales, original value,
    unit price (rows without a finite unit price dropped)."""
    g = df.groupBy(packed("contact_id").alias("contact_id"), "city").agg(  # bytes: half as long as the text
        F.count_if("promo_flag").cast("long").alias("promotion_touches"),
        zsum("quantity_item").alias("quantity"),
        zsum("line_sales_value").alias("total_sales"),
        zsum("line_original_value").alias("total_original"))
    g = g.withColumn("contact_id", unpacked("contact_id"))
    up = safe_ratio("total_sales", "quantity")
    finite = F.when(F.abs(up) != F.lit(float("inf")), up)
    return g.withColumn("unit_price", finite).where(F.col("unit_price").isNotNull())


def top_customers(df: DataFrame, k: int = 10) -> DataFrame:
    """Top ``k`` customer/city rows by sales."""
    v = customer_city_value(df)
    t = top_k(v, k, [F.col("total_sales").desc(), F.col("contact_id"), F.col("city")])
    return t.select("contact_id", "city", F.col("total_sales").alias("sales"), F.col("quantity").alias("units"),
                    "promotion_touches")


# ---------------------------------------------------------------- cohorts
def _known(df: DataFrame, exclude_missing: bool) -> DataFrame:
    """Q22: the empty contact id counts as one customer unless excluded."""
    return df.where(F.col("contact_id") != "") if exclude_missing else df


def _customer_months(df: DataFrame) -> DataFrame:
    """Distinct (customer, order month) pairs with the cohort month and index.

    One aggregation gathers a customer's distinct months (as many as the data
    has months, combined map-side, so the hot '' customer stays small).
    """
    months = (df.where(F.col("contact_id").isNotNull()).groupBy("contact_id")
                .agg(F.collect_set(month_start("date_transaction")).alias("_months")))
    p = months.select("contact_id", F.array_min("_months").alias("cohort_month"), F.explode("_months").alias("order_month"))
    idx = ((F.year("order_month") - F.year("cohort_month")) * 12
           + (F.month("order_month") - F.month("cohort_month")) + 1)
    return p.withColumn("cohort_index", idx.cast("int"))


def cohort_sizes(df: DataFrame, exclude_missing: bool = False) -> DataFrame:
    """Distinct customers per first-purchase month."""
    first = (_known(df, exclude_missing).where(F.col("contact_id").isNotNull()).groupBy("contact_id")
             .agg(month_start(F.min("date_transaction")).alias("cohort_month")))
    return first.groupBy("cohort_month").agg(F.count(F.lit(1)).cast("long").alias("cohort_size"))


def cohort_retention(df: DataFrame, exclude_missing: bool = False) -> DataFrame:
    """C1 (long form): retention per (cohort month, index) = distinct customers
    / cohort size, rounded half-even to 3 places; every observed index is
    listed for every cohort, missing cells are 0 (R2 unstack fill)."""
    p = _customer_months(_known(df, exclude_missing))
    counts = p.groupBy("cohort_month", "cohort_index").agg(F.count(F.lit(1)).cast("long").alias("_c"))
    # from here on one row a month and index: at most the square of the data's months
    observed = F.collect_set("cohort_index").over(Window.partitionBy())
    cohorts = (counts.withColumn("_all", observed).groupBy("cohort_month")
                     .agg(F.map_from_entries(F.collect_list(F.struct("cohort_index", "_c"))).alias("_cells"), F.first("_all").alias("_all")))
    cells = cohorts.select("cohort_month", "_cells", F.explode("_all").alias("cohort_index"))
    count = F.coalesce(F.try_element_at("_cells", F.col("cohort_index")), F.lit(0))
    return cells.select("cohort_month", "cohort_index", F.bround(count / F.element_at("_cells", F.lit(1)), 3).alias("retention"))


def cohort_retention_matrix(df: DataFrame, indexes: Sequence[int] | None = None) -> DataFrame:
    """C1 (wide form, R2): one column per cohort index, like the unstacked table.

    ``indexes`` names the columns; by default every index that some customer
    reached. An index nobody reached is null.
    """
    cells = cohort_retention(df)
    if indexes is None:
        cells = stored(cells, "retention")  # at most the square of the data's months
        indexes = [r[0] for r in cells.select("cohort_index").distinct().orderBy("cohort_index").collect()]
    return cells.groupBy("cohort_month").pivot("cohort_index", list(indexes)).agg(F.first("retention"))


def retention_curve(df: DataFrame, horizon: int = 6) -> DataFrame:
    """Long-form retention for the first ``horizon`` months."""
    return cohort_retention(df).where(F.col("cohort_index") <= horizon)


# ---------------------------------------------------------------- dashboard RFM
def rfm_dashboard(df: DataFrame, fix_recency: bool = False, exclude_missing: bool = False) -> DataFrame:
    """C4: from first lines: recency (days to max date + 1), frequency, monetary
    (first-line transaction values), first non-null latitude/longitude/city,
    R/F/M quantile-rank scores and their sum.

    Reference behaviour (default): R is ranked on recency descending and then
    flipped, so the most recent customers get R = 1 (Q13). ``fix_recency``
    gives them R = 5 instead.
    """
    tx = first_line_per_transaction(_known(df, exclude_missing),
                                    ["contact_id", "date_transaction", "transaction_value",
                                         "city", "latitude", "longitude"])
    tx = tx.where(F.col("contact_id").isNotNull())

    def first_non_null(c):
        return F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("_seq")))

    rfm = tx.groupBy("contact_id").agg(
        F.max("date_transaction").alias("_last"),
        F.count("transaction_id").cast("long").alias("frequency"),
        zsum("transaction_value").alias("monetary"),
        first_non_null("latitude").alias("latitude"),
        first_non_null("longitude").alias("longitude"),
        first_non_null("city").alias("city"))
    rfm = stored(rfm, "rfm")  # one row a customer; the cuts below read three narrow columns of it
    current = F.date_add(rfm.agg(F.max("_last")).scalar(), 1)
    rfm = rfm.select("contact_id", F.datediff(current, "_last").alias("recency"), "frequency", "monetary", "latitude", "longitude", "city")
    rfm = quantile_rank_scores(rfm, [("recency", "r_score", True), ("frequency", "f_score", False), ("monetary", "m_score", False)], "contact_id")
    if fix_recency:
        rfm = rfm.withColumn("r_score", (F.lit(6) - F.col("r_score")).cast("int"))
    return rfm.withColumn("rfm_score", F.col("r_score") + F.col("f_score") + F.col("m_score"))


def _labels(spark: SparkSession, labels, name: str) -> DataFrame:
    return spark.createDataFrame([(i, s) for i, s in enumerate(labels)], f"_ord int, {name} string")


def dashboard_segment(score) -> F.Column:
    s = F.col(score) if isinstance(score, str) else score
    a, g, lo, ch = DASHBOARD_SEGMENTS
    return (F.when(s <= 6, F.lit(a)).when(s <= 9, F.lit(g)).when(s <= 12, F.lit(lo)).otherwise(F.lit(ch)))


def rfm_segments(df: DataFrame) -> DataFrame:
    """Segment by score (<=6, <=9, <=12, else) and summarise; empty segments
    are listed with 0 customers."""
    return segments_from_rfm(rfm_dashboard(df))


def segments_from_rfm(rfm: DataFrame) -> DataFrame:
    """C5 on an already computed :func:`rfm_dashboard` frame."""
    rfm = rfm.withColumn("segment", dashboard_segment("rfm_score"))
    g = rfm.groupBy("segment").agg(
        F.count(F.lit(1)).cast("long").alias("customers"),
        F.avg("r_score").alias("avg_r"), F.avg("f_score").alias("avg_f"), F.avg("m_score").alias("avg_m"),
        zsum("monetary").alias("revenue"))
    labels = _labels(rfm.sparkSession, DASHBOARD_SEGMENTS, "segment")
    out = labels.join(g, "segment", "left")
    return out.select("segment", F.coalesce("customers", F.lit(0)).cast("long").alias("customers"),
                      "avg_r", "avg_f", "avg_m", F.coalesce("revenue", F.lit(0.0)).alias("revenue"))


def rfm_score_distribution(df: DataFrame) -> DataFrame:
    """Customers per total RFM score."""
    return score_distribution_from_rfm(rfm_dashboard(df))


def score_distribution_from_rfm(rfm: DataFrame) -> DataFrame:
    return rfm.groupBy("rfm_score").agg(F.count(F.lit(1)).cast("long").alias("customers"))


def rfm_by_location(df: DataFrame) -> DataFrame:
    """Mean RFM score per location (geo present)."""
    return location_from_rfm(rfm_dashboard(df))


def location_from_rfm(rfm: DataFrame) -> DataFrame:
    return (rfm.dropna(subset=["latitude", "longitude"])
               .groupBy("latitude", "longitude", "city").agg(F.avg("rfm_score").alias("avg_rfm_score")))


# ---------------------------------------------------------------- report RFM
def rfm_base(df: DataFrame, exclude_missing: bool = False) -> DataFrame:
    """Per (customer, transaction) GMV, then per customer: recency (days to
    the overall max date), distinct transactions, monetary, last purchase."""
    df = _known(df, exclude_missing)
    per_tx = df.groupBy("contact_id", "transaction_id").agg(
        F.max("date_transaction").alias("tx_date"), F.min("date_transaction").alias("_first"), zsum("line_sales_value").alias("gmv"))
    base = per_tx.groupBy("contact_id").agg(
        F.count(F.lit(1)).cast("long").alias("frequency"),
        zsum("gmv").alias("monetary"),
        F.max("tx_date").alias("last_purchase"), F.min("_first").alias("_first"))
    base = stored(base, "customers")  # the reference date comes from the same aggregate
    ends = base.agg(F.max("last_purchase").alias("b"), F.min("_first").alias("a")).select(F.struct("a", "b")).scalar()
    recency = F.coalesce(F.datediff(ends.getField("b"), "last_purchase"), F.datediff(ends.getField("b"), ends.getField("a")))
    return base.select("contact_id", recency.alias("recency"), "frequency", "monetary", "last_purchase")


def _score(col: str, cuts: Sequence[float], ascending: bool) -> F.Column:
    c = F.col(col)
    scores = [5, 4, 3, 2] if not ascending else [1, 2, 3, 4]
    expr = None
    for cut, s in zip(cuts, scores, strict=True):
        cond = c <= F.lit(cut)
        expr = F.when(cond, F.lit(s)) if expr is None else expr.when(cond, F.lit(s))
    return expr.otherwise(F.lit(1 if not ascending else 5))


def rfm_report(df: DataFrame) -> DataFrame:
    """C9/C10 mapping: quintile scores (R: low recency -> 5; F, M: high -> 5),
    digit string, and segment by R+F+M (>=12, >=9, >=6, else)."""
    base = rfm_base(df)
    probs = [0.2, 0.4, 0.6, 0.8]
    cuts = quantile_values(base, ["recency", "frequency", "monetary"], probs)  # four numbers each
    out = base.withColumns({
        "r": _score("recency", cuts["recency"], ascending=False),
        "f": _score("frequency", cuts["frequency"], ascending=True),
        "m": _score("monetary", cuts["monetary"], ascending=True),
    })
    total = F.col("r") + F.col("f") + F.col("m")
    c, lo, p, a = REPORT_SEGMENTS
    seg = F.when(total >= 12, F.lit(c)).when(total >= 9, F.lit(lo)).when(total >= 6, F.lit(p)).otherwise(F.lit(a))
    return out.withColumns({
        "rfm_score": F.concat(F.col("r").cast("string"), F.col("f").cast("string"), F.col("m").cast("string")),
        "rfm_segment": seg,
    })


def rfm_report_segments(df: DataFrame) -> DataFrame:
    """Per segment: customers, mean recency/frequency/monetary, GMV, shares."""
    r = rfm_report(df)
    g = r.groupBy("rfm_segment").agg(
        F.count("contact_id").cast("long").alias("customers"),  # one row a customer
        F.avg("recency").alias("avg_recency"), F.avg("frequency").alias("avg_frequency"),
        F.avg("monetary").alias("avg_monetary"), zsum("monetary").alias("gmv"))
    return g.withColumns({"customer_share_pct": share_pct("customers"), "gmv_share_pct": share_pct("gmv")})  # over the segments


def rfm_segment_category(df: DataFrame) -> DataFrame:
    """C11: lines joined to their customer's segment (inner, J8): GMV, orders,
    GMV share within the segment (0 when the segment total is 0)."""
    seg = rfm_report(df).select(F.col("contact_id").alias("_cid"), "rfm_segment")
    lines = df.select("contact_id", "category", "line_sales_value", "transaction_id", "_seq")
    j = left_join_skew_safe(lines, seg, "contact_id", "_cid", salt_source=["_seq"]) \
        .where(F.col("_cid").isNotNull())
    g = (j.withColumn("category", F.coalesce("category", F.lit(UNKNOWN_LABEL)))
          .groupBy("rfm_segment", "category")
          .agg(zsum("line_sales_value").alias("gmv"), F.countDistinct("transaction_id").cast("long").alias("orders")))
    total = F.sum("gmv").over(Window.partitionBy("rfm_segment"))  # over a segment's categories
    return g.withColumn("gmv_share_pct", F.when(total != 0, F.col("gmv") / total * 100.0).otherwise(F.lit(0.0)))


def recency_buckets(df: DataFrame, include_zero: bool = False) -> DataFrame:
    """Right-closed recency buckets (0,30] ... (365, inf); recency 0 falls
    outside every bucket (reference behaviour) unless ``include_zero``. All six
    buckets are listed."""
    r = rfm_base(df)
    rec = F.col("recency")
    expr = None
    for label, lo, hi in RECENCY_BUCKETS:
        cond = (rec > lo) if hi is None else ((rec > lo) & (rec <= hi))
        if include_zero and lo == 0:
            cond = (rec >= 0) & (rec <= hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    g = (r.withColumn("recency_bucket", expr).where(F.col("recency_bucket").isNotNull())
          .groupBy("recency_bucket")
          .agg(F.count("contact_id").cast("long").alias("customers"), zsum("monetary").alias("gmv")))
    labels = _labels(df.sparkSession, [b[0] for b in RECENCY_BUCKETS], "recency_bucket")
    out = labels.join(g, "recency_bucket", "left").select(
        "recency_bucket", F.col("_ord").alias("bucket_order"),
        F.coalesce("customers", F.lit(0)).cast("long").alias("customers"),
        F.coalesce("gmv", F.lit(0.0)).alias("gmv"))
    return out.withColumn("customer_share_pct", share_pct("customers"))  # over the six buckets
