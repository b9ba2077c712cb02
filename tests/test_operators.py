"""Cohorts, recency buckets, promotion timeline, contingency/Yates on micro fixtures."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from kassa.operators.customers import cohort_retention, cohort_sizes, recency_buckets
from kassa.operators.promo import promotion_timeline
from kassa.operators.stats import chi_square_promo_usage


def _lines(spark, rows):
    return spark.createDataFrame(rows, "contact_id string, transaction_id string, date_transaction date, "
                                       "line_sales_value double")


def test_cohorts(spark):
    d = dt.date
    rows = [("a", "t1", d(2023, 1, 5), 1.0), ("a", "t2", d(2023, 3, 2), 1.0),   # skips February
            ("b", "t3", d(2023, 1, 9), 1.0),                                   # single purchase
            ("", "t4", d(2023, 2, 1), 1.0), ("", "t5", d(2023, 3, 1), 1.0),    # missing contact is one customer
            ("c", "t6", d(2023, 2, 7), 1.0), ("c", "t7", d(2023, 2, 8), 1.0)]
    df = _lines(spark, rows)
    ret = {(str(r[0]), r[1]): r[2] for r in cohort_retention(df).collect()}
    assert ret[("2023-01-01", 1)] == 1.0
    assert ret[("2023-01-01", 2)] == 0.0      # zero-filled cell
    assert ret[("2023-01-01", 3)] == 0.5
    assert ret[("2023-02-01", 2)] == 0.5      # '' came back in March
    assert ("2023-02-01", 4) not in ret      # only observed indexes
    sizes = {str(r[0]): r[1] for r in cohort_sizes(df).collect()}
    assert sizes == {"2023-01-01": 2, "2023-02-01": 2}


def test_recency_buckets(spark):
    base = dt.date(2024, 1, 1)
    rec = [0, 1, 30, 31, 365, 366]
    rows = [(f"c{i}", f"t{i}", base - dt.timedelta(days=r), 1.0) for i, r in enumerate(rec)]
    out = {r["recency_bucket"]: r["customers"] for r in recency_buckets(_lines(spark, rows)).collect()}
    assert out == {"0-30 days": 2, "31-60": 1, "61-90": 0, "91-180": 0, "181-365": 1, "365+": 1}  # 0 dropped


def test_promotion_timeline(spark):
    rows = [("P1", None, "2023-03-01"),            # null start: skipped
            ("P2", "2023-01-15", None),            # null end -> as_of
            ("P3", "2023-02-10", "2023-02-10"),    # start = end
            ("P4", "2023-02-20", "2023-02-03"),    # reversed inside one month: still 1 month
            ("P5", "2023-04-01", "2023-02-01")]    # reversed across months: none
    df = spark.createDataFrame(rows, "PROMO_ID string, START_DATE string, END_DATE string")
    got = {str(r[0]): r[1] for r in promotion_timeline(df, as_of="2023-03-31").collect()}
    assert got == {"2023-01-01": 1, "2023-02-01": 3, "2023-03-01": 1}


def test_chi_square_yates(spark):
    # 2x2 through the operator path: classes by unit price, promo use by touches
    rows = []
    for i in range(40):
        price = 10.0 if i < 10 else 50.0
        promo = (i % 4 == 0) if i < 10 else (i % 2 == 0)
        rows.append((f"c{i}", "X", promo, 1.0, price, price))
    df = spark.createDataFrame(rows, "contact_id string, city string, promo_flag boolean, quantity_item double, "
                                     "line_sales_value double, line_original_value double")
    r = chi_square_promo_usage(df).first()
    assert r is not None and r["dof"] in (1, 2)
    from kassa.operators.stats import promo_usage_contingency
    cells = {(x[0], x[1]): x[2] for x in promo_usage_contingency(df).collect()}
    rows_ = sorted({k[0] for k in cells})
    cols_ = sorted({k[1] for k in cells})
    n = sum(cells.values())
    stat = 0.0
    dof = (len(rows_) - 1) * (len(cols_) - 1)
    for a in rows_:
        for b in cols_:
            e = sum(cells[(a, c)] for c in cols_) * sum(cells[(x, b)] for x in rows_) / n
            o = cells[(a, b)]
            if dof == 1:
                o = o + (0.5 if e > o else -0.5) * (1 if abs(e - o) >= 0.5 else 2 * abs(e - o))
            stat += (o - e) ** 2 / e
    assert r["statistic"] == pytest.approx(stat, rel=1e-12)


def test_options(spark):
    d = dt.date
    rows = [("a", "t1", d(2023, 1, 5), 1.0), ("", "t2", d(2023, 1, 9), 1.0), ("b", "t3", d(2023, 2, 1), 1.0)]
    df = _lines(spark, rows)
    assert cohort_sizes(df).agg(F.sum("cohort_size")).first()[0] == 3
    assert cohort_sizes(df, exclude_missing=True).agg(F.sum("cohort_size")).first()[0] == 2
    promos = spark.createDataFrame([("P1", "2023-01-01", None)], "PROMO_ID string, START_DATE string, END_DATE string")
    assert promotion_timeline(promos).count() >= 12  # open-ended: runs to today


def test_promotion_timeline_by_brute_force(spark):
    """Overlapping, nested, touching and repeated intervals, over centuries too."""
    import datetime as dt
    import random
    rng = random.Random(4)
    rows, active = [], {}
    for i in range(300):
        a = dt.date(rng.randint(2018, 2021), rng.randint(1, 12), rng.randint(1, 28))
        b = a + dt.timedelta(days=rng.choice([-40, -3, 0, 20, 31, 200, 900]))
        rows.append((rng.choice([None, "", *(f"P{k}" for k in range(25))]), str(a), None if i % 17 == 0 else str(b)))
    rows += [("old", "1203-05-09", "2950-01-31"), ("old", "1800-01-01", "1900-01-01"), (None, "1100-01-01", "1100-03-01"), ("x", None, "2020-01-01")]
    for k, a, b in rows:
        if a:
            (y, m), (ye, me) = (tuple(map(int, d.split("-")[:2])) for d in (a, b or "2021-06-30"))
            for t in range(y * 12 + m - 1, ye * 12 + me):
                active.setdefault(dt.date(t // 12, t % 12 + 1, 1), set()).add(k)
    df = spark.createDataFrame(rows, "PROMO_ID string, START_DATE string, END_DATE string").repartition(4)
    got = {r["month"]: r["active_promotions"] for r in promotion_timeline(df, as_of="2021-06-30").collect()}
    assert got == {m: len(ids - {None}) for m, ids in active.items()} and len(got) > 20_000


def test_identifiers_are_grouped_as_bytes(spark):
    """Whole pseudonyms are shuffled as 23 or 24 bytes, not as texts of 43 and more, and come back as texts."""
    from pyspark.sql import functions as F

    from kassa.functions.privacy import hashed_token, packed, unpacked
    from kassa.operators import customers, kpi, promo
    ids = spark.range(40).select(hashed_token(F.col("id").cast("string"), "CUST").alias("k")).union(
        spark.createDataFrame([("",), ("C",), ("CUST" + "0" * 40,), ("0" * 40,), ("é" * 30,), (None,)], "k string"))
    back = ids.withColumn("p", packed("k")).select("k", unpacked("p").alias("u")).collect()
    assert all(r["k"] == r["u"] for r in back) and len(back) == 46
    df = ids.select(F.col("k").alias("transaction_id"), F.col("k").alias("contact_id"), F.lit("c").alias("city"), F.lit("c").alias("category"), F.lit("p").alias("province"),
                    F.lit("s").alias("store_id"), F.lit("s").alias("store_name"), F.lit("l").alias("promo_label"), F.lit(True).alias("promo_flag"),
                    *[F.lit(2.0).alias(c) for c in ("quantity_item", "line_sales_value", "line_original_value", "line_discount", "transaction_value")],
                    F.monotonically_increasing_id().alias("_seq"))
    for out in (customers.top_customers(df, 50), promo.promo_effect(df, ["category"]), kpi.avg_transaction_value(df)):
        assert out.count()
    assert {r["contact_id"] for r in customers.top_customers(df, 50).collect()} == {r["k"] for r in back}
    assert promo.promo_effect(df, ["category"]).first()["orders"] == 45  # null is no order
    for plan in (customers.top_customers(df, 50), promo._promo_measures(promo.analysis_base(df).groupBy("category")), kpi.avg_transaction_value(df)):
        assert "unhex" in plan._jdf.queryExecution().optimizedPlan().toString()
