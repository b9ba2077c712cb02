"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each builds (once per session) the curated table from the driver's raw test
tables and runs one operator on the whole table. Doubles are rounded to ~9
significant digits for engine-independent comparison and identifiers are shown
in their short form; ``_seq`` is internal.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kassa.functions.privacy import display_id, display_ids
from kassa.functions.rounding import round_doubles
from kassa.plans.curated import curated_from_testdata

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}


def _finish(df: DataFrame, round_output: bool = True) -> DataFrame:
    if "_seq" in df.columns:
        df = df.drop("_seq")
    df = display_ids(df)
    return round_doubles(df) if round_output else df


def register(name: str, round_output: bool = True, whole_rows: bool = False):
    def deco(fn: Callable[[DataFrame], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return _finish(fn(curated_from_testdata(spark, sf_dir, whole_rows=whole_rows)), round_output)
        run.__name__ = name
        run.__doc__ = fn.__doc__
        REGISTRY[name] = run
        return fn
    return deco


def register_raw(name: str):
    """Queries over the raw (pre-curation) tables or the curation job itself."""
    def deco(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return _finish(fn(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        REGISTRY[name] = run
        return fn
    return deco


@register("curated_sales", whole_rows=True)
def _curated(df: DataFrame) -> DataFrame:
    """The whole curated table (cleaning, joins, masking, hashing, typing)."""
    return df


# ------------------------------------------------------------------ imports
from pyspark.sql import functions as F  # noqa: E402

from kassa.operators import customers as C  # noqa: E402
from kassa.operators import kpi as K  # noqa: E402
from kassa.operators import promo as P  # noqa: E402
from kassa.operators import quality as Q  # noqa: E402
from kassa.operators import stats as S  # noqa: E402
from kassa.operators import stores as ST  # noqa: E402
from kassa.operators.filters import FilterSpec, apply_filters, facet_values, non_negative_quantity, sidebar_facets  # noqa: E402
from kassa.sources import testdata as TD  # noqa: E402
from kassa.sources.sample import sample_transactions  # noqa: E402

dash = non_negative_quantity  # the dashboard's F1 filter runs before every tab


# ------------------------------------------------------------------ sales KPIs
@register("monthly_kpi_summary")
def _q_monthly(df):
    """G2 monthly KPIs."""
    return K.monthly_kpi_summary(df)


@register("highlights")
def _q_highlights(df):
    """G1 headline KPIs (dashboard)."""
    return K.compute_highlights(dash(df))


@register("monthly_sales_series")
def _q_mss(df):
    return K.monthly_sales_series(dash(df))


@register("daily_units")
def _q_daily(df):
    return K.daily_units(dash(df))


@register("category_revenue_share")
def _q_cat_share(df):
    return K.category_revenue_share(df, top_n=10)


@register("category_pareto")
def _q_cat_pareto(df):
    return K.category_pareto(df)


@register("sku_top50")
def _q_sku(df):
    return K.sku_top50(df, 50)


@register("units_by_location")
def _q_units_loc(df):
    return K.units_by_location(dash(df))


@register("avg_transaction_value_by_location")
def _q_atv_loc(df):
    return K.avg_transaction_value_by_location(dash(df))


@register("avg_transaction_value")
def _q_atv(df):
    return K.avg_transaction_value(dash(df))


# ------------------------------------------------------------------ promotions
@register("promotion_summary")
def _q_promo_sum(df):
    return P.promotion_summary(df)


@register("promo_overall")
def _q_promo_overall(df):
    return P.promo_overall(df)


@register("promo_effect_category")
def _q_pe_cat(df):
    return P.promo_effect(df, ["category"])


@register("promo_effect_store")
def _q_pe_store(df):
    return P.promo_effect(df, ["store_province", "store_name"])


@register("promo_effect_label")
def _q_pe_label(df):
    return P.promo_effect(df, ["promo_label"])


@register("promo_hotspots")
def _q_hot(df):
    return P.promo_hotspots(df, 30)


@register("top_promotions")
def _q_top_promo(df):
    return P.top_promotions(dash(df), 10)


@register("promo_share_long")
def _q_share_long(df):
    return P.promo_share_long(dash(df))


# ------------------------------------------------------------------ stores
@register("store_profitability")
def _q_store_prof(df):
    return ST.store_profitability(df)


@register("store_deep_dive")
def _q_store_dd(df):
    return ST.store_deep_dive(df)


@register("store_top_bottom15")
def _q_store_tb(df):
    return ST.store_top_bottom(df, 15)


@register("city_performance")
def _q_city_perf(df):
    return ST.city_performance(df)


@register("city_category_top5")
def _q_city_cat(df):
    return ST.city_category_mix(df, 5)


# ------------------------------------------------------------------ customers
@register("customer_city_value")
def _q_ccv(df):
    return C.customer_city_value(dash(df))


@register("top_customers")
def _q_top_cust(df):
    return C.top_customers(dash(df), 10)


@register("cohort_retention")
def _q_cohort(df):
    return C.cohort_retention(df)


@register("cohort_retention_matrix", round_output=False)
def _q_cohort_matrix(df):
    """R2 wide matrix over all observed indexes (a retention has three places; nothing is left to round)."""
    return C.cohort_retention_matrix(df)


@register("cohort_sizes")
def _q_cohort_sizes(df):
    return C.cohort_sizes(df)


@register("retention_curve")
def _q_ret_curve(df):
    return C.retention_curve(df, 6)


@register("rfm_dashboard")
def _q_rfm_dash(df):
    return C.rfm_dashboard(dash(df))


@register("rfm_segments")
def _q_rfm_seg(df):
    return C.rfm_segments(dash(df))


@register("rfm_score_distribution")
def _q_rfm_dist(df):
    return C.rfm_score_distribution(dash(df))


@register("rfm_by_location")
def _q_rfm_loc(df):
    return C.rfm_by_location(dash(df))


@register("rfm_report")
def _q_rfm_report(df):
    return C.rfm_report(df)


@register("rfm_report_segments")
def _q_rfm_report_seg(df):
    return C.rfm_report_segments(df)


@register("rfm_segment_category")
def _q_rfm_seg_cat(df):
    return C.rfm_segment_category(df)


@register("recency_buckets")
def _q_recency(df):
    return C.recency_buckets(df)


# ------------------------------------------------------------------ statistics
@register("transaction_rollup")
def _q_rollup(df):
    return S.transaction_rollup(df)


@register("promo_regression")
def _q_ols(df):
    return S.promo_regression(df)


@register("ab_test_promo")
def _q_ab(df):
    return S.ab_test_promo(df)


@register("unit_price_quartiles")
def _q_quart(df):
    return S.unit_price_quartiles(dash(df))


@register("promo_usage_contingency")
def _q_contingency(df):
    return S.promo_usage_contingency(dash(df))


@register("promo_usage_crosstab")
def _q_crosstab(df):
    return S.promo_usage_crosstab(dash(df))


@register("chi_square_promo_usage")
def _q_chi(df):
    return S.chi_square_promo_usage(dash(df))


@register("box_plot_stats")
def _q_box(df):
    return S.box_plot_stats(dash(df))


@register("transaction_value_histogram")
def _q_hist(df):
    return S.transaction_value_histogram(dash(df), 20.0)


# ------------------------------------------------------------------ quality, filters, sampling
@register("data_quality")
def _q_quality(df):
    return Q.data_quality_report(dash(df), Q.DASHBOARD_QUALITY_COLUMNS)


@register("data_quality_all", whole_rows=True)
def _q_quality_all(df):
    """D1 over every curated column (the profile's default form)."""
    return Q.data_quality_report(df.drop("_seq"))


@register("short_transaction_ids")
def _q_short_ids(df):
    """A1: short forms of the transaction pseudonyms, no two alike (beside the whole digests)."""
    from kassa.operators.privacy import short_identifiers
    return short_identifiers(df, "transaction_id", "TRX")


FILTER_EXAMPLE = FilterSpec(years=[1996, 1997], quarters=[1, 2, 4], cities=["Calgary", "Edmonton", "Online", "Leduc"],
                            day_range=(9500, 10100))


@register("filtered_highlights")
def _q_filtered(df):
    """F2/F3 sidebar filters, then G1."""
    return K.compute_highlights(apply_filters(dash(df), FILTER_EXAMPLE))


ITEM_FILTER = FilterSpec(months=[1, 2, 3, 7, 11], categories=["ECONOMY", "STANDARD", "PROMO", "SMALL"],
                         stores=["AB Store 002 - Edmonton", "AB Store 004 - Lethbridge", "AB Store 008 - Airdrie", "Alberta Online Store 01"])


@register("filtered_lines")
def _q_filtered_lines(df):
    """F2 by month, category and store: the lines that are left."""
    return apply_filters(dash(df), ITEM_FILTER).select("transaction_id", "item_id", "month", "category", "store_name", "quantity_item")


@register("filtered_items")
def _q_filtered_items(df):
    """F2 by item: monthly units of the chosen items (identifiers are whole digests)."""
    from hashlib import sha1
    items = ["ITEM" + sha1(str(i).encode()).hexdigest().upper() for i in (1, 5, 17, 42, 99, 150)]
    return (apply_filters(dash(df), FilterSpec(items=items)).groupBy("item_id", "year", "month")
                    .agg(F.coalesce(F.sum("quantity_item"), F.lit(0.0)).alias("units"), F.count(F.lit(1)).cast("long").alias("lines")))


@register("sidebar_facets")
def _q_facets(df):
    """Every facet and the day bounds that the sidebar offers after FILTER_EXAMPLE."""
    shown = F.when(F.col("facet") == "item_id", display_id("value", "ITEM")).otherwise(display_id("value", "ABSTORE"))
    return sidebar_facets(dash(df), FILTER_EXAMPLE).withColumn("value", shown)


@register("facet_cities")
def _q_facet(df):
    return facet_values(dash(df), "city")


@register("sample_transactions")
def _q_sample(df):
    """At most 20 transactions per month (sha1 order), all their lines."""
    return sample_transactions(df, 20)


# ------------------------------------------------------------------ raw-table jobs
@register_raw("store_lookup")
def _q_store_lookup(spark, sf_dir):
    """A3/A4 masked store identities."""
    from kassa.operators.privacy import build_store_lookup
    return build_store_lookup(TD.raw_store(spark, sf_dir).withColumnRenamed("LIBELLE", "LIBELLE_y"))


@register_raw("store_opening_trend")
def _q_openings(spark, sf_dir):
    return K.store_opening_trend(TD.raw_store(spark, sf_dir))


@register_raw("web_account_share")
def _q_web(spark, sf_dir):
    return K.web_account_share(TD.raw_contact(spark, sf_dir))


_MONTH_FILES: dict[tuple, tuple] = {}


def _month_files(spark, sf_dir):
    """The raw tables as month files and dimension files in the shared folder, written once per session."""
    from kassa.sources.testdata import write_month_files
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _MONTH_FILES:
        _MONTH_FILES[key] = write_month_files(spark, sf_dir)
    return _MONTH_FILES[key]


@register_raw("curated_from_month_files")
def _q_month_files(spark, sf_dir):
    """S1-S6 over files: the month files and dimension files discovered, read in splits and curated."""
    from kassa.sources.files import load_and_prepare_data
    root, years = _month_files(spark, sf_dir)
    return load_and_prepare_data(spark, root, sales_dirs=years)


@register_raw("available_months")
def _q_months(spark, sf_dir):
    """The months that the sales folders offer."""
    from kassa.sources.files import list_available_months
    root, years = _month_files(spark, sf_dir)
    return list_available_months(spark, root, years)


CHOSEN_MONTHS = ("199601", "199602", "199607", "199711")


@register_raw("pipeline_chosen_months")
def _q_pipeline(spark, sf_dir):
    """The pipeline object over chosen months of the files, then its monthly sales."""
    from kassa.plans.facade import RetailDataPipeline
    root, years = _month_files(spark, sf_dir)
    pipeline = RetailDataPipeline(spark, root, years, CHOSEN_MONTHS)
    return pipeline.monthly_sales(pipeline.run())


_PARTIALS: dict[tuple, object] = {}


def _partials(spark, sf_dir):
    """The store of monthly partials over the curated table, built once per session; one month is then refreshed."""
    from kassa.plans.partials import MonthlyPartials
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _PARTIALS:
        store, curated = MonthlyPartials(spark), curated_from_testdata(spark, sf_dir)
        store.refresh(curated)
        store.refresh(curated, [(1996, 2)])
        _PARTIALS[key] = store
    return _PARTIALS[key]


PARTIAL_MONTHS = [(1996, 1), (1996, 2), (1997, 11)]


@register_raw("partials_highlights")
def _q_partials_highlights(spark, sf_dir):
    """G1 of three months, merged from their partials."""
    return _partials(spark, sf_dir).highlights(PARTIAL_MONTHS)


@register_raw("partials_monthly_kpi")
def _q_partials_kpi(spark, sf_dir):
    """G2 of all months from partials."""
    return _partials(spark, sf_dir).monthly_kpi_summary()


@register_raw("partials_sales_series")
def _q_partials_series(spark, sf_dir):
    """G3 of all months from partials."""
    return _partials(spark, sf_dir).monthly_sales_series()


@register_raw("partials_store_deep_dive")
def _q_partials_stores(spark, sf_dir):
    """G15 of three months from partials."""
    return _partials(spark, sf_dir).store_deep_dive(PARTIAL_MONTHS)


@register_raw("sample_extract")
def _q_extract(spark, sf_dir):
    """S8 as a whole: the keys and rows of the sampled sales and of every dimension cut to them."""
    from kassa.sources.sample import extract_sample
    raw = TD.raw_tables(spark, sf_dir)
    out = None
    for name, df in extract_sample(raw.sales, raw.dims(), 20).items():
        key = {"sales": "Transaction_ID", "contact": "Contact_ID", "item": "SKU", "promotion": "PROMO_ID", "store": "STORE_ID"}[name]
        rows = df.groupBy(F.lit(name).alias("table_name"), F.col(key).alias("key")).agg(F.count(F.lit(1)).cast("long").alias("n_rows"))
        out = rows if out is None else out.unionByName(rows)
    return out


@register_raw("promotion_timeline")
def _q_timeline(spark, sf_dir):
    return P.promotion_timeline(TD.raw_promotion(spark, sf_dir), as_of="2000-01-01")
