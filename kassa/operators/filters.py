"""F1-F8: row filters and facet lists (dashboard sidebar as a FilterSpec)."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def non_negative_quantity(df: DataFrame) -> DataFrame:
    """keep lines with quantity >= 0 (null quantity is removed too)."""
    return df.where(F.col("quantity_item") >= 0)


@dataclass
class FilterSpec:
    """conjunctive IN-lists; an empty list means no filter."""
    years: list[int] = field(default_factory=list)
    quarters: list[int] = field(default_factory=list)
    months: list[int] = field(default_factory=list)
    day_range: tuple[int, int] | None = None  # inclusive days since 1970-01-01
    categories: list[str] = field(default_factory=list)
    items: list[str] = field(default_factory=list)
    cities: list[str] = field(default_factory=list)
    stores: list[str] = field(default_factory=list)


def apply_filters(df: DataFrame, spec: FilterSpec) -> DataFrame:
    """Filter chain in sidebar order; Catalyst pushes year/month into the scan
    (partition pruning on the curated table) and the rest into parquet."""
    for col, values in (("year", spec.years), ("quarter", spec.quarters), ("month", spec.months)):
        if values:
            df = df.where(F.col(col).isin(list(values)))
    if spec.day_range is not None:
        lo, hi = spec.day_range
        df = df.where(F.col("days_since_epoch").between(int(lo), int(hi)))
    for col, values in (("category", spec.categories), ("item_id", spec.items), ("city", spec.cities),
                        ("store_name", spec.stores)):
        if values:
            df = df.where(F.col(col).isin(list(values)))
    return df


def facet_values(df: DataFrame, column: str) -> DataFrame:
    """sorted distinct non-null values of one dimension."""
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def sidebar_facets(df: DataFrame, spec: FilterSpec) -> DataFrame:
    """What the sidebar offers after ``spec``: ``facet, value, low, high``.

    The lists cascade: each facet holds the distinct non-null values of the
    rows that pass the choices made before it (year, quarter, month, day range,
    category, item, city, store). ``day_bounds`` (all rows) and ``day_default``
    (rows that pass year, quarter and month) have ``low`` and ``high`` as days
    since 1970-01-01, and no value. Without a day range the default one holds,
    which every row in question passes. One scan; the distinct values combine
    map-side.
    """
    def chosen(column: str, values) -> Column:
        return F.col(column).isin(list(values)) if values else F.lit(True)

    passed, offers = F.lit(True), []
    day = F.col("days_since_epoch")
    steps = [("year", spec.years), ("quarter", spec.quarters), ("month", spec.months), ("days", None), ("category", spec.categories),
             ("item_id", spec.items), ("city", spec.cities), ("store_name", spec.stores)]
    for column, values in steps:
        if column == "days":
            offers += [F.struct(F.lit("day_bounds").alias("facet"), F.lit(None).cast("string").alias("value"), day.alias("day")),
                       F.when(passed, F.struct(F.lit("day_default").alias("facet"), F.lit(None).cast("string").alias("value"), day.alias("day")))]
            passed = passed & (day.between(*map(int, spec.day_range)) if spec.day_range is not None else F.lit(True))
            continue
        offers.append(F.when(passed & F.col(column).isNotNull(), F.struct(
            F.lit(column).alias("facet"), F.col(column).cast("string").alias("value"), F.lit(None).cast("int").alias("day"))))
        passed = passed & chosen(column, values)
    rows = df.select(F.explode(F.filter(F.array(*offers), lambda o: o.isNotNull())).alias("o"))
    return rows.groupBy("o.facet", "o.value").agg(F.min("o.day").alias("low"), F.max("o.day").alias("high"))


def drop_null(df: DataFrame, subset: list[str]) -> DataFrame:
    """drop rows with a null in any of ``subset``."""
    return df.dropna(subset=subset)


def promo_lines(df: DataFrame) -> DataFrame:
    """F8: promotion lines only."""
    return df.where(F.col("promo_flag"))
