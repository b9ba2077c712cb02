"""F1-F4 filters, facets, and push-down into the curated parquet scan."""
import contextlib
import io
import os

import pytest
from pyspark.sql import functions as F

from kassa.operators.filters import FilterSpec, apply_filters, facet_values, non_negative_quantity


def _lines(spark):
    rows = [(2023, 1, 1, 19360, "Shoes", "I1", "Calgary", "AB001", 1.0),
            (2023, 2, 1, 19390, "Bags", "I2", "Edmonton", "AB002", -1.0),
            (2024, 4, 2, 19820, None, "I1", "Calgary", "AB001", None),
            (2024, 5, 2, 19850, "Shoes", "I3", "Online", "ABWEB01", 3.0)]
    return spark.createDataFrame(rows, "year int, month int, quarter int, days_since_epoch int, category string, "
                                       "item_id string, city string, store_name string, quantity_item double")


def test_filter_chain(spark):
    df = _lines(spark)
    assert non_negative_quantity(df).count() == 2  # negative and null quantities removed
    assert apply_filters(df, FilterSpec()).count() == 4  # empty lists filter nothing
    assert apply_filters(df, FilterSpec(years=[2024], cities=["Calgary", "Online"])).count() == 2
    assert apply_filters(df, FilterSpec(day_range=(19360, 19390))).count() == 2  # inclusive
    assert apply_filters(df, FilterSpec(categories=["Shoes"], quarters=[2])).count() == 1


def test_facets_cascade(spark):
    df = _lines(spark)
    assert [r[0] for r in facet_values(df, "category").collect()] == ["Bags", "Shoes"]  # null dropped, sorted
    narrowed = apply_filters(df, FilterSpec(years=[2024]))
    assert [r[0] for r in facet_values(narrowed, "city").collect()] == ["Calgary", "Online"]


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.001"), reason="driver test tables absent")
def test_filters_reach_the_scan(spark):
    from kassa.plans.curated import curated_from_testdata
    cur = curated_from_testdata(spark, "/root/testdata/sf0.001")
    q = apply_filters(cur, FilterSpec(years=[1996], cities=["Calgary"])).groupBy("city").agg(F.sum("quantity_item"))
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        q.explain("formatted")
    plan = buf.getvalue()
    assert "PartitionFilters: [isnotnull(year" in plan and "(year" in plan
    assert "EqualTo(city,Calgary)" in plan
    assert "ReadSchema: struct<city:string,quantity_item:double>" in plan


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.001"), reason="driver test tables absent")
def test_bucketed_table_avoids_transaction_shuffle(spark):
    from kassa.operators.common import first_line_per_transaction
    from kassa.operators.stats import transaction_rollup
    from kassa.plans.curated import curated_from_testdata
    from kassa.sources.files import save_curated_table
    cur = curated_from_testdata(spark, "/root/testdata/sf0.001")
    import uuid
    from kassa.session import checkpoint_dir
    tag = uuid.uuid4().hex
    t = save_curated_table(cur, f"kassa_bucketed_{tag}", buckets=4,
                           path=f"{checkpoint_dir(spark).rstrip('/')}/kassa-bucketed-{tag}")
    for q in (first_line_per_transaction(t, ["transaction_value"]), transaction_rollup(t)):
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            q.explain()
        assert "Exchange hashpartitioning(transaction_id" not in buf.getvalue()
    assert t.count() == cur.count()
    assert sorted(transaction_rollup(t).collect()) == sorted(transaction_rollup(cur).collect())
