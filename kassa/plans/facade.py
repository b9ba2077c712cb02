"""Facade with the reference pipeline's entry points, on Spark."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from kassa.operators import customers, kpi, promo, stores
from kassa.sources.files import load_and_prepare_data


@dataclass
class RetailDataPipeline:
    spark: SparkSession
    base_path: str
    sales_dirs: Sequence[str] | None = None
    months: Sequence[str] | None = None

    def run(self) -> DataFrame:
        return load_and_prepare_data(self.spark, self.base_path, self.sales_dirs, self.months)

    def summarize(self, data: DataFrame) -> DataFrame:
        return kpi.compute_highlights(data)

    def promotion_summary(self, data: DataFrame) -> DataFrame:
        return promo.promotion_summary(data)

    def profitability_by_store(self, data: DataFrame) -> DataFrame:
        return stores.store_profitability(data)

    def monthly_sales(self, data: DataFrame) -> DataFrame:
        return kpi.monthly_sales_series(data)

    def cohorts(self, data: DataFrame) -> tuple[DataFrame, DataFrame]:
        return customers.cohort_retention(data), customers.cohort_sizes(data)
