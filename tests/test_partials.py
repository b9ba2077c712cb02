"""Answers merged from monthly partials equal a scan of the lines."""
import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from kassa.functions.rounding import round_doubles
from kassa.operators import kpi, stores
from kassa.operators.filters import non_negative_quantity
from kassa.plans.partials import MonthlyPartials, chosen

SCHEMA = ("transaction_id string, contact_id string, store_id string, store_name string, city string, province string, date_transaction date, "
          "transaction_value double, quantity_item double, line_discount double, year int, month int, _seq long")


def lines(spark, n=900, seed=1, months=((2023, 1), (2023, 2), (2024, 1))):
    rng, rows = random.Random(seed), []
    for i in range(n):
        y, m = rng.choice(months)
        s = rng.randint(0, 5)
        rows.append((f"t{rng.randint(0, n // 4)}", rng.choice(["", "c1", "c2", None, f"c{i}"]), f"s{s}", rng.choice([f"n{s}", None]), rng.choice(["Online", "Calgary", None, f"city{s}"]),
                     rng.choice(["AB", None]), dt.date(y, m, rng.randint(1, 28)), rng.choice([None, float(rng.randint(1, 400))]),
                     rng.choice([None, -1.0, 1.0, 2.5]), rng.choice([None, 0.5, 3.0]), y, m, (i * 7919) % 100_003))
    return spark.createDataFrame(rows, SCHEMA)


def rows(df):
    return sorted(map(tuple, round_doubles(df.select(*sorted(df.columns))).collect()), key=repr)


def agree(store, curated, months):
    for counted in (False, True):
        some = curated.where(chosen(months))
        some = non_negative_quantity(some) if counted else some
        for name, full in (("highlights", kpi.compute_highlights), ("monthly_kpi_summary", kpi.monthly_kpi_summary),
                           ("monthly_sales_series", kpi.monthly_sales_series), ("daily_units", kpi.daily_units),
                           ("store_profitability", stores.store_profitability), ("store_deep_dive", stores.store_deep_dive), ("city_performance", stores.city_performance)):
            assert rows(getattr(store, name)(months, counted)) == rows(full(some)), (name, counted, months)


@pytest.mark.parametrize("months", [None, [(2023, 2)], [(2023, 1), (2024, 1)], [(2020, 1)]])
def test_any_month_set(spark, months):
    df = lines(spark)
    store = MonthlyPartials(spark)
    store.refresh(df)
    agree(store, df, months)


def test_a_late_file_changes_one_month_only(spark, tmp_path):
    path = f"file://{tmp_path}/store"
    store = MonthlyPartials(spark, path)
    first = lines(spark)
    store.refresh(first)

    def files():
        return {os.path.join(d, p) for d, _, names in os.walk(tmp_path) for p in names if p.startswith("part-")}

    before = files()
    late = first.unionByName(lines(spark, 60, 2, ((2023, 2),)).withColumn("_seq", F.col("_seq") + 1_000_000))
    store.refresh(late, [(2023, 2)])
    kept = [p for p in before if p in files()]
    assert 0 < len(kept) < len(before)
    agree(store, late, None)
    # a month that has lost all its lines is gone, a new one is added
    gone = late.where(~chosen([(2023, 2)])).unionByName(lines(spark, 40, 3, ((2025, 7),)).withColumn("_seq", F.col("_seq") + 2_000_000))
    store.refresh(gone, [(2023, 2), (2025, 7)])
    agree(store, gone, None)
    agree(store, gone, [(2023, 2), (2025, 7)])


def test_only_chosen_months_are_read(spark):
    store = MonthlyPartials(spark)
    store.refresh(lines(spark))
    plan = store.daily_units([(2023, 2)])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "year" in plan.split("PartitionFilters: [")[1][:200]


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange ")


def test_many_places_are_dealt_once_and_few_combined(spark):
    """Lines of many places shuffle once, those of few are summed map-side first; both give the same sums."""
    df = lines(spark).withColumns({"counted": F.coalesce(F.col("quantity_item") >= 0, F.lit(False)), "place": F.col("_seq") % 7})
    many, few = (MonthlyPartials._tables(df, most, 7) for most in (300, 300_000_000))
    assert exchanges(many["lines"]) == 1 and exchanges(many["orders"]) == 1 and exchanges(few["lines"]) == 2
    for name in many:
        assert rows(many[name]) == rows(few[name])


def test_building_leaves_no_shuffle_files(spark):
    """Shuffle files of the store's tables go when these are written, not when the driver collects its garbage."""
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}

    df, store, before = lines(spark), MonthlyPartials(spark), shuffled()
    part = MonthlyPartials._tables(df.withColumns({"counted": F.lit(True), "place": F.lit(1)}), 300, 7)
    store._write(part["lines"], "lines")
    store._write(part["customers"], "customers")
    assert not shuffled() - before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"
