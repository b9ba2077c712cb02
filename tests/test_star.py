"""The curated table over a stored narrow fact equals the plain curation, and only asked-for dimensions are joined."""
import pytest
from pyspark.sql import functions as F

import kassa.operators.joins as J
from kassa.operators.promo import promo_overall
from kassa.plans.curated import curate, curated_star


def raw(spark):
    """Sales with missing, unknown and very frequent keys; every dimension has repeated and missing keys."""
    i = F.col("id")
    sales = spark.range(0, 900, 1, 6).select(
        F.when(i % 41 == 0, F.lit(None)).otherwise((i / 3).cast("int").cast("string")).alias("Transaction_ID"),
        F.when(i % 5 == 0, F.lit(" null ")).otherwise((i % 23).cast("string")).alias("Contact_ID"),
        F.concat(F.lit(" "), (i % 19).cast("string")).alias("Item_ID"),
        F.when(i % 3 == 0, F.concat(F.lit("P"), (i % 4).cast("string"))).otherwise(F.lit("")).alias("Promotion_ID"),
        F.when(i % 29 == 0, F.lit(None)).otherwise((i % 7).cast("string")).alias("Store_transaction_ID"),
        F.when(i % 31 == 0, F.lit("20230231")).otherwise(F.date_format(F.date_add(F.lit("2023-01-05").cast("date"), (i % 200).cast("int")), "yyyyMMdd")).alias("Date_transaction"),
        F.format_string("%d,5", i).alias("Unit_original_price"), (i * 0.75).alias("Unit_sale_price"), (i % 100 + 0.5).alias("Transaction_value"),
        F.when(i % 13 == 0, F.lit(None)).otherwise((i % 5).cast("double")).alias("Quantity_item"), (i + 1).alias("_seq"))
    dims = {
        "contact": spark.createDataFrame([(str(k % 20), str(1950 + k), ["yes", None, "0"][k % 3], str(k % 9), f"T{k}") for k in range(24)] + [("NA", None, "1", None, None)],
                                         "Contact_ID string, YearOfBirth string, Has_Web_Account string, Store_Of_Creation string, PostalCode string"),
        "item": spark.createDataFrame([(str(k % 15), f"e{k}", ["shoes", None, "bags"][k % 3], f"name {k}") for k in range(17)], ["SKU", "EAN", "Catégorie", "Style - Description FR"]),
        "promotion": spark.createDataFrame([("P0", "zero"), ("P0", "again"), ("P1", None), ("P9", "nine"), ("none", "no id")] + [(f"Q{k}", "unused") for k in range(40)], ["PROMO_ID", "LIBELLE"]),
        "store": spark.createDataFrame([(str(k % 5), f"{'ecom' if k == 2 else 'shop'} {k}", f"City {k % 3}", k) for k in range(6)], "STORE_ID string, LIBELLE string, CITY string, _seq long"),
    }
    return sales, dims


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("bound", [J.DEFAULT_BROADCAST_BYTES, -1])
def test_star_equals_plain_curation(spark, monkeypatch, bound):
    sales, dims = raw(spark)
    plain = curate(sales, dims)
    want = rows(plain)
    monkeypatch.setattr(J, "DEFAULT_BROADCAST_BYTES", bound)
    star = curated_star(sales, dims)
    assert star.schema.simpleString() == plain.schema.simpleString()
    assert rows(star) == want and len({r[-1] for r in want}) == len(want) > 900


def test_dimensions_nobody_asks_for_are_left_out(spark, monkeypatch):
    """A question without dimension columns reads the fact alone, however large the dimensions are."""
    sales, dims = raw(spark)
    monkeypatch.setattr(J, "DEFAULT_BROADCAST_BYTES", -1)
    star = curated_star(sales, dims)

    def joins(df):
        return df._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter")

    assert joins(promo_overall(star)) == 0
    assert 1 <= joins(star.groupBy("category").count()) <= 2  # the item and its hot keys


def test_stored_fact_is_narrow(spark):
    """Lines are stored with their keys and numbers; no pseudonym, label or measure is."""
    star = curated_star(*raw(spark))
    stored = spark.read.parquet(*[p for p in star.inputFiles() if "kassa-facts" in p])
    assert set(stored.columns) & {"EAN", "Catégorie", "Line_Sales_Value", "store_name", "promo_label", "SKU"} == set()
    assert stored.where(F.col("Transaction_ID").startswith("TRX")).isEmpty() and len(stored.columns) <= 20


def test_packed_identifiers_are_short_and_differ(spark):
    from kassa.functions.privacy import hashed_token, packed
    ids = spark.range(50).select(hashed_token(F.col("id").cast("string"), "TRX").alias("k")).union(
        spark.createDataFrame([("",), ("TRX",), ("trx" + "0" * 40,), ("TRX" + "0" * 40,), ("CUST" + "0" * 40,), ("0" * 40,), (None,)], "k string"))
    assert ids.select(packed("k").alias("p")).distinct().count() == 57
    assert ids.limit(50).agg(F.max(F.octet_length(packed("k")))).first()[0] == 24


def test_partials_hold_places_by_number(spark):
    """A line's partials do not repeat the names of its place, and places keep their numbers."""
    from kassa.plans.partials import MonthlyPartials
    curated = curate(*raw(spark))
    store = MonthlyPartials(spark)
    store.refresh(curated)
    first = rows(spark.read.parquet(f"{store.path}/places"))
    assert len(first) == len({r[0] for r in first}) == curated.select("store_id", "store_name", "city", "province").distinct().count()
    store.refresh(curated, [(2023, 2)])
    assert rows(spark.read.parquet(f"{store.path}/places")) == first
    for name in ("lines", "orders"):
        assert not {"store_id", "store_name", "city", "transaction_id"} & set(spark.read.parquet(f"{store.path}/{name}").columns)


def test_quality_cells_are_numbers_and_bytes(spark):
    """What is shuffled for distinct counts: doubles as eight bytes, not as text."""
    from kassa.operators.quality import data_quality_report
    df = spark.createDataFrame([(0.0, 1, True, None), (-0.0, 1, None, "a"), (float("nan"), 2, False, "b"), (None, None, False, "a"), (float("nan"), 1 << 60, True, "")],
                               "d double, n long, b boolean, s string").withColumn("m", F.col("n") + 1)
    got = {r["column"]: (r["missing_count"], r["zero_count"], r["unique_values"]) for r in data_quality_report(df).collect()}
    assert got == {"d": (1, 2, 2), "n": (1, 0, 3), "b": (1, 2, 2), "s": (1, None, 3), "m": (1, 0, 3)}
    plan = data_quality_report(df.select("d"))._jdf.queryExecution().optimizedPlan().toString()
    assert "cast(d" not in plan


@pytest.mark.parametrize("build", [curate, curated_star])
def test_dimensions_are_masked_once_a_row_of_theirs(spark, build):
    """Lines take masks, pseudonyms and parsed values of customers, items and stores as they are stored."""
    df = build(*raw(spark))
    for c in ("postal_code", "store_of_creation", "year_of_birth", "has_web_account", "store_id"):
        plan = df.select(c)._jdf.queryExecution().optimizedPlan().toString()
        assert not {"sha1", "rlike", "RLIKE", "lower("} & {w for w in ("sha1", "rlike", "RLIKE", "lower(") if w in plan.split("Join")[0]}, c


def test_quality_counts_chunks_of_rows(spark):
    """Values are counted in chunks before they meet, not one cell at a time; packed bytes are those of the column expression."""
    import pyarrow as pa
    from kassa.functions.privacy import packed
    from kassa.operators.quality import data_quality_report, packed_values
    df = spark.range(0, 50000, 1, 4).select((F.col("id") % 3).alias("k"), F.when(F.col("id") % 5 != 0, F.concat(F.lit("TRX"), F.upper(F.sha1((F.col("id") % 7).cast("string"))))).alias("s"),
                                            (F.col("id") % 2).cast("decimal(12,2)").alias("m"), F.expr("date'2024-01-01' + cast(id % 9 as int)").alias("t"))
    report = data_quality_report(df)
    assert "Generate" not in report._jdf.queryExecution().optimizedPlan().toString()
    got = {r["column"]: (r["missing_count"], r["zero_count"], r["unique_values"]) for r in report.collect()}
    assert got == {"k": (0, 16667, 3), "s": (10000, None, 7), "m": (0, 25000, 2), "t": (0, None, 9)}
    texts = ["", "TRX", "TRX" + "0F" * 20, "CUST" + "A9" * 20, "trx" + "0" * 40, "0" * 40, "A" + "f" * 40, "é" * 22, "ABCDEFGH" + "1" * 40, "ABCDEFGHI" + "1" * 40]
    want = [bytes(r[0]) for r in spark.createDataFrame([(t,) for t in texts], "k string").select(packed("k")).collect()]
    found = {int(p): v for places, short in packed_values(pa.array(["x", *texts]).slice(1)) for p, v in zip(places, short.to_pylist(), strict=True)}
    assert [found[i] for i in range(len(texts))] == want


@pytest.mark.parametrize("bound", [J.DEFAULT_BROADCAST_BYTES, -1])
def test_whole_rows_travel_without_month_and_place(spark, monkeypatch, bound):
    """Questions for all columns get the same rows; large dimensions meet lines that hold no more than keys and numbers."""
    from kassa.plans.curated import star_frame, stored_star
    sales, dims = raw(spark)
    want = rows(curate(sales, dims))
    monkeypatch.setattr(J, "DEFAULT_BROADCAST_BYTES", bound)
    star = stored_star(sales, dims)
    frame = star_frame(star, whole_rows=True)
    assert rows(frame) == want
    scans = [line for line in frame._jdf.queryExecution().sparkPlan().toString().splitlines() if "Scan" in line and "Transaction_ID" in line]
    assert scans and not any("latitude" in line or "city" in line for line in scans)
