"""S1-S7 and streaming ingestion on CSV fixtures in a scratch folder."""
import hashlib
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from kassa.plans.facade import RetailDataPipeline
from kassa.sources.files import list_available_months, list_sales_files, load_reference_tables, load_sales


def _w(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)


@pytest.fixture(scope="module")
def root():
    r = tempfile.mkdtemp(prefix="kassa-src-", dir="/tmp")
    head = ("Transaction_ID,Contact_ID,Item_ID,Promotion_ID,Store_transaction_ID,Date_transaction,"
            "Unit_original_price,Unit_sale_price,Transaction_value,Quantity_item\n")
    _w(f"{r}/2023/Base_sales_202301.csv", head +
       "T1,C1,I1,P1,S1,20230105,10,8,30,2\n"
       "T1,C1,I2,,S1,20230105,5,5,30,1\n"
       "T2, NA ,I1,,S9,20230132,10,10,10,1\n"          # bad date: dropped
       "T3,C2,I3,null,S2,20230120,\"1 000,5\",900,900,1\n")
    _w(f"{r}/2023/Base_sales_202302.csv", head + "T4,C1,I1,P1,S3,20230201,10,7,14,2\n")
    _w(f"{r}/2023/Base_sales_202302.xlsx", "not really a workbook")
    _w(f"{r}/2023/Base_sales_202303.xlsx", "not really a workbook")
    # other column order, one column missing (union by name fills null)
    _w(f"{r}/2024/Base_sales_202401.csv",
       " Quantity_item ,Transaction_ID,Contact_ID,Item_ID,Promotion_ID,Store_transaction_ID,Date_transaction,"
       "Unit_sale_price,Transaction_value\n3,T5,C3,I2,,S1,20240110,4,12\n")
    _w(f"{r}/base/Base_contact.csv", "Contact_ID,YearOfBirth,Has_Web_Account,Store_Of_Creation,PostalCode\n"
                                     "C1,1980,Yes,S2,T2X 1A1\nC2,abc,0,,\nC3,2030,1,S7,T9Z\n")
    _w(f"{r}/base/Base_item.csv", "SKU,EAN,Catégorie,Style - Description FR\nI1,E1,Shoes,Red shoe\n"
                                  "I2,E2,,Blue hat\nI3,E3,Bags,\n")
    _w(f"{r}/base/Base_promotions.csv", "PROMO_ID,LIBELLE,START_DATE,END_DATE\nP1,Spring,2023-01-01,2023-02-15\n")
    _w(f"{r}/base/Base_stores.csv", "STORE_ID,LIBELLE,COUNTRY,PROVINCE,CITY,OPEN_DATE,CLOSE_DATE\n"
                                    "S1,Shop A,FR,IDF,Paris,2001-01-01,\nS2,ECOM web,FR,IDF,Paris,2010-05-05,\n"
                                    "S3,Shop B,FR,ARA,Lyon,2015-01-01,\n")
    return r


def test_discovery(spark, root):
    months = [r[0] for r in list_available_months(spark, root).collect()]
    assert months == ["202301", "202302", "202303", "202401"]
    files = {r["month_key"]: r["ext"] for r in list_sales_files(spark, root).collect()}
    assert files["202302"] == "csv" and files["202303"] == "xlsx"
    with pytest.raises(ValueError):
        load_sales(spark, root)  # 202303 exists only as XLSX
    with pytest.raises(FileNotFoundError):
        list_sales_files(spark, root, sales_dirs=["1999"])


def test_load_and_curate(spark, root):
    sales = load_sales(spark, root, months=["202301", "202302", "202401"])
    assert sales.count() == 6
    assert "Unit_original_price" in sales.columns
    p = RetailDataPipeline(spark, root, months=["202301", "202302", "202401"])
    cur = p.run()
    rows = {(r["transaction_id"], r["item_id"]): r for r in cur.collect()}
    assert len(rows) == 5  # the bad date is dropped
    tx1 = "TRX" + hashlib.sha1(b"T1").hexdigest().upper()
    r = rows[(tx1, "ITEM" + hashlib.sha1(b"I1").hexdigest().upper())]
    assert r["store_id"] == "AB001" and r["city"] == "Calgary" and r["promo_flag"] is True
    assert r["line_sales_value"] == 16.0 and r["category"] == "Shoes" and r["has_web_account"] is True
    assert r["store_of_creation"] == "ABWEB01"  # S2 is the online store
    tx3 = "TRX" + hashlib.sha1(b"T3").hexdigest().upper()
    r3 = [v for k, v in rows.items() if k[0] == tx3][0]
    assert r3["unit_original_price"] == 1000.5 and r3["promo_flag"] is False and r3["year_of_birth"] is None
    r5 = [v for v in rows.values() if v["year"] == 2024][0]
    assert r5["unit_original_price"] is None and r5["customer_age"] is None and r5["quantity_item"] == 3.0
    h = p.summarize(cur).first()
    assert h["total_orders"] == 4 and h["total_revenue"] == 30 + 900 + 14 + 12  # first line per transaction


def test_first_line_follows_file_order(spark, root):
    from kassa.operators.common import first_line_per_transaction
    sales = load_sales(spark, root, months=["202301"]).repartition(3)
    first = {r["Transaction_ID"]: r["Item_ID"] for r in
             first_line_per_transaction(sales, ["Transaction_ID", "Item_ID"], key="Transaction_ID").collect()}
    assert first["T1"] == "I1"


def test_streaming_ingestion(spark, root):
    from kassa.streaming.ingest import start_month_ingestion
    out = tempfile.mkdtemp(prefix="kassa-out-", dir="/tmp") + "/curated"
    ck = tempfile.mkdtemp(prefix="kassa-ck-", dir="/tmp")
    q = start_month_ingestion(spark, root, out, checkpoint_location=ck)
    q.awaitTermination(120)
    got = spark.read.parquet(out)
    assert got.count() == 5
    assert got.where(F.col("year") == 2024).count() == 1
    # restart with the same checkpoint: nothing is re-ingested; a newly landed month is picked up alone
    head = ("Transaction_ID,Contact_ID,Item_ID,Promotion_ID,Store_transaction_ID,Date_transaction,"
            "Unit_original_price,Unit_sale_price,Transaction_value,Quantity_item\n")
    q2 = start_month_ingestion(spark, root, out, checkpoint_location=ck)
    q2.awaitTermination(120)
    assert spark.read.parquet(out).count() == 5
    # a batch that runs again (its checkpoint was lost after the write) overwrites its own rows
    q2 = start_month_ingestion(spark, root, out, checkpoint_location=tempfile.mkdtemp(prefix="kassa-ck-", dir="/tmp"))
    q2.awaitTermination(120)
    assert spark.read.parquet(out).count() == 5
    from kassa.operators.kpi import compute_highlights
    assert compute_highlights(spark.read.parquet(out)).first()["total_orders"] == 4
    _w(f"{root}/2024/Base_sales_202402.csv", head + "T9,C1,I1,,S1,20240203,10,10,20,2\nT9,C1,I2,,S1,20240203,5,5,20,1\n")
    q3 = start_month_ingestion(spark, root, out, checkpoint_location=ck)
    q3.awaitTermination(120)
    again = spark.read.parquet(out)
    assert again.count() == 7
    assert again.where((F.col("year") == 2024) & (F.col("month") == 2)).count() == 2


def test_sample_dimension(spark):
    from kassa.sources.sample import sample_dimension
    fact = spark.createDataFrame([("a",), ("b",)], "k string")
    dim = spark.createDataFrame([("a", 1), ("c", 2)], "key string, v int")
    assert [r["key"] for r in sample_dimension(dim, fact, "key", "k").collect()] == ["a"]


def test_extract_sample(spark):
    from kassa.sources.sample import extract_sample
    from kassa.sources.testdata import raw_tables
    sf = "/root/testdata/sf0.001"
    if not os.path.exists(sf):
        return
    t = raw_tables(spark, sf)
    ex = extract_sample(t.sales, t.dims(), per_month=3)
    per_month = ex["sales"].select(F.substring("Date_transaction", 1, 6).alias("m"), "Transaction_ID").distinct() \
        .groupBy("m").count().agg(F.max("count")).first()[0]
    assert per_month <= 3
    used = {r[0] for r in ex["sales"].select("Item_ID").distinct().collect()}
    assert {r[0] for r in ex["item"].select("SKU").collect()} <= used
    assert ex["store"].count() <= t.store.count()


def test_cli_curate(spark, root):
    import subprocess
    import sys as _sys
    import tempfile as _tf
    out = _tf.mkdtemp(prefix="kassa-cli-", dir="/tmp") + "/curated"
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    r = subprocess.run([_sys.executable, "-m", "kassa", "curate", "--root", root, "--out", out,
                        "--months", "202301", "202302", "--master", "local[2]", "--size-partitions"],
                       cwd=repo, capture_output=True, text=True, timeout=600)
    assert '"rows": 4' in r.stdout, r.stderr[-2000:]  # 3 (one bad date dropped) + 1


def test_csv_dialect(spark, tmp_path):
    """Doubled quotes, commas and line breaks inside quotes, and missing tokens."""
    from kassa.sources.files import read_sales_files
    _w(f"{tmp_path}/2023/Base_sales_202301.csv", 'Transaction_ID,Remark,Label\nT1,"Shoe ""XL"", red",NA\nT2,"line 1\nline 2",None\nT3,plain \\ text,n/a x\n')
    _w(f"{tmp_path}/2023/Base_sales_202302.csv", "Label,Transaction_ID\nnull,T4\nkept,T5\n")
    _w(f"{tmp_path}/2024/Base_sales_202301.csv", "Transaction_ID,Remark,Label\nT6,,#N/A\n")
    paths = [f"{tmp_path}/2024/Base_sales_202301.csv", f"{tmp_path}/2023/Base_sales_202302.csv", f"{tmp_path}/2023/Base_sales_202301.csv"]
    df = read_sales_files(spark, paths)
    rows = [(r["Transaction_ID"], r["Remark"], r["Label"]) for r in df.orderBy("_seq").collect()]
    assert rows == [("T1", 'Shoe "XL", red', None), ("T2", "line 1\nline 2", None), ("T3", "plain \\ text", "n/a x"), ("T4", None, None),
                    ("T5", None, "kept"), ("T6", None, None)]
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 2  # one scan for each header


def test_shared_folder_is_required_off_local(monkeypatch):
    """Without spark.checkpoint.dir only a local master gets a scratch folder."""
    from types import SimpleNamespace

    from kassa import session

    def fake(master):
        sc = SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda p: None,
                             getConf=lambda: SimpleNamespace(get=lambda k, d=None: d))
        return SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda k, d=None: d))

    for master in ("yarn", "spark://host:7077", "local-cluster[3,2,1024]", "k8s://x"):
        with pytest.raises(RuntimeError):
            session.checkpoint_dir(fake(master))
    assert session.checkpoint_dir(fake("local[4]"))


def test_release_removes_own_tables(spark):
    from kassa.operators.common import stored
    from kassa.session import _STORED, new_path
    kept = list(_STORED)
    df = stored(spark.range(3).toDF("x"), "gone")
    path = _STORED[-1][1]
    assert df.count() == 3
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    assert fs.exists(target)
    from kassa import session
    mine = session._STORED[:]
    session._STORED[:] = [mine[-1]]
    assert session.release(spark) == 1 and not fs.exists(target)
    session._STORED[:] = kept
    assert new_path(spark, "x").startswith(spark.sparkContext.getCheckpointDir().rstrip("/"))
