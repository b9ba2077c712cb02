"""The dashboard and the notebook report as sets of DataFrames.

``dashboard_views`` applies the quantity filter and the sidebar FilterSpec once
and stores that frame in the shared folder (several tabs read it). The RFM
frame, the customers' prices and the promotion summary are computed once and
feed all their views. What a view needs as numbers (cut points, quartiles) is
computed when it is built; the views themselves are lazy. ``release`` of
``kassa.session`` removes the stored frames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kassa.operators import customers as C
from kassa.operators import kpi as K
from kassa.operators import promo as P
from kassa.operators import quality as Q
from kassa.operators import stats as S
from kassa.operators import stores as ST
from kassa.operators.common import stored, top_k
from kassa.operators.filters import FilterSpec, apply_filters, non_negative_quantity


def dashboard_views(curated: DataFrame, spec: FilterSpec | None = None, store: bool = True) -> dict[str, DataFrame]:
    data = apply_filters(non_negative_quantity(curated), spec or FilterSpec())
    if store:
        data = stored(data, "dashboard")
    rfm = C.rfm_dashboard(data)
    prices = S.customer_prices(data)
    return {
        # sales overview
        "highlights": K.compute_highlights(data),
        "daily_units": K.daily_units(data),
        "monthly_sales": K.monthly_sales_series(data),
        "units_by_location": K.units_by_location(data),
        # customer insights
        "customer_city_value": C.customer_city_value(data),
        "box_plot": S.box_plot_stats(data, prices),
        "unit_price_quartiles": S.unit_price_quartiles(data, prices=prices),
        "promo_usage_crosstab": S.promo_usage_crosstab(data, prices),
        "chi_square": S.chi_square_promo_usage(data, prices),
        "top_customers": C.top_customers(data),
        # transaction value
        "avg_transaction_value": K.avg_transaction_value(data),
        "transaction_value_histogram": S.transaction_value_histogram(data),
        "avg_transaction_value_by_location": K.avg_transaction_value_by_location(data),
        # RFM (one RFM frame for all four views)
        "rfm": rfm,
        "rfm_score_distribution": C.score_distribution_from_rfm(rfm),
        "rfm_segments": C.segments_from_rfm(rfm),
        "rfm_by_location": C.location_from_rfm(rfm),
        # promotion impact
        "promotion_summary": P.promotion_summary(data),
        "promo_share_long": P.promo_share_long(data),
        "top_promotions": P.top_promotions(data),
        "store_snapshot": top_k(ST.store_profitability(data), 10,
                                [F.col("revenue").desc(), F.col("store_name"), F.col("city")]),
        # retention cohorts
        "cohort_retention_matrix": C.cohort_retention_matrix(data),
        "retention_curve": C.retention_curve(data),
        "cohort_sizes": C.cohort_sizes(data),
        # data quality
        "data_quality": Q.data_quality_report(data, Q.DASHBOARD_QUALITY_COLUMNS),
    }


def notebook_report(curated: DataFrame, promotions: DataFrame | None = None, stores: DataFrame | None = None,
                    contacts: DataFrame | None = None) -> dict[str, DataFrame]:
    """The report's tables: KPIs, merchandise mix, promotion lifecycle and
    uplift, store and geography views, engagement, network, RFM."""
    out = {
        "monthly_kpi_summary": K.monthly_kpi_summary(curated),
        "category_revenue_share": K.category_revenue_share(curated),
        "category_pareto": K.category_pareto(curated),
        "sku_top50": K.sku_top50(curated),
        "promotion_summary": P.promotion_summary(curated),
        "promo_overall": P.promo_overall(curated),
        "promo_effect_category": P.promo_effect(curated, ["category"]),
        "promo_effect_store": P.promo_effect(curated, ["store_province", "store_name"]),
        "promo_effect_label": P.promo_effect(curated, ["promo_label"]),
        "promo_hotspots": P.promo_hotspots(curated),
        "store_profitability": ST.store_profitability(curated),
        "store_top_bottom": ST.store_top_bottom(curated),
        "city_performance": ST.city_performance(curated),
        "city_category_mix": ST.city_category_mix(curated),
        "transactions": S.transaction_rollup(curated),
        "promo_regression": S.promo_regression(curated),
        "ab_test": S.ab_test_promo(curated),
        "rfm_report": C.rfm_report(curated),
        "rfm_report_segments": C.rfm_report_segments(curated),
        "rfm_segment_category": C.rfm_segment_category(curated),
        "recency_buckets": C.recency_buckets(curated),
    }
    if promotions is not None:
        out["promotion_timeline"] = P.promotion_timeline(promotions)
    if stores is not None:
        out["store_opening_trend"] = K.store_opening_trend(stores)
    if contacts is not None:
        out["web_account_share"] = K.web_account_share(contacts)
    return out
