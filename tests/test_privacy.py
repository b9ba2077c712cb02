"""A1-A5 pseudonymisation and store masking (Q3, Q9-Q12)."""
import hashlib
import os

from pyspark.sql import functions as F

from kassa.functions.privacy import display_id, hashed_postal, hashed_token, pseudonymise
from kassa.operators.privacy import apply_store_masking, build_store_lookup


def _postal_spec(value: str) -> str:
    """Independent statement of the postal mask: T, d, L, d, L, d from sha1 hex digits 0..4."""
    if not value:
        return ""
    h = hashlib.sha1(value.encode()).hexdigest()
    d = [int(c, 16) for c in h[:5]]
    return "T" + str(d[0] % 10) + chr(65 + d[1] % 26) + str(d[2] % 10) + chr(65 + d[3] % 26) + str(d[4] % 10)


def test_hash_tokens(spark):
    df = spark.createDataFrame([("nan",), (" 42 ",), ("",), (None,)], "v string")
    rows = df.select(hashed_token(F.coalesce("v", F.lit("x")), "CUST").alias("h"),
                     pseudonymise("v", "CUST").alias("p"), hashed_postal(F.col("v")).alias("z")).collect()
    assert rows[0]["h"] == "CUST" + hashlib.sha1(b"nan").hexdigest().upper()
    assert rows[1]["p"] == "CUST" + hashlib.sha1(b"42").hexdigest().upper()
    assert rows[2]["p"] == ""
    assert rows[3]["p"] == rows[0]["h"]  # null is hashed as 'nan'
    assert rows[1]["z"] == _postal_spec(" 42 ")
    assert rows[2]["z"] == ""


def _stores(spark):
    rows = [("1", "Main Street", "Paris", 1), ("2", "ECOM shop", "Lyon", 2), ("3", "Corner", "paris ", 3),
            ("4", "Online outlet", None, 4), ("5", "Kiosk", "", 5), ("1", "Duplicate", "Nice", 6),
            ("NA", "Ghost", "Oslo", 7), ("6", "Depot", "Rome", 8)]
    return spark.createDataFrame(rows, "STORE_ID string, LIBELLE_y string, CITY string, _seq long")


def test_store_lookup(spark):
    lk = {r["store_key"]: r for r in build_store_lookup(_stores(spark)).collect()}
    assert set(lk) == {"1", "2", "3", "4", "5", "6"}  # 'NA' consumed a number but is not matchable
    assert lk["1"]["new_id"] == "AB001" and lk["1"]["new_city"] == "Calgary"
    assert lk["1"]["new_name"] == "AB Store 001 - Calgary"
    assert lk["2"]["new_id"] == "ABWEB01" and lk["2"]["new_city"] == "Online" and lk["2"]["latitude"] is None
    assert lk["3"]["new_id"] == "AB002" and lk["3"]["new_city"] == "Calgary"  # same city after strip/lower
    assert lk["4"]["new_id"] == "ABWEB02"
    assert lk["5"]["new_id"] == "AB003" and lk["5"]["new_city"] == "Calgary"  # empty city -> first city
    # cities in first-seen order: paris, lyon (online store still takes a slot), nice, oslo, rome
    assert lk["6"]["new_id"] == "AB005" and lk["6"]["new_city"] == "St. Albert"


def test_store_lookup_independent_of_partitioning(spark):
    a = sorted(map(tuple, build_store_lookup(_stores(spark)).collect()))
    b = sorted(map(tuple, build_store_lookup(_stores(spark).repartition(7)).collect()))
    assert a == b


def test_store_masking_fallbacks(spark):
    lookup = build_store_lookup(_stores(spark))
    fact = spark.createDataFrame(
        [("1", "3", None), (None, "99", "T2X"), ("", None, "  ")],
        "STORE_ID string, Store_Of_Creation string, PostalCode string")
    rows = apply_store_masking(fact, lookup).collect()
    assert rows[0]["STORE_ID"] == "AB001" and rows[0]["Store_Of_Creation"] == "AB002"
    assert rows[0]["PostalCode"] == _postal_spec("nan")
    unmatched = "ABSTORE" + hashlib.sha1(b"Store").hexdigest().upper()
    assert rows[1]["STORE_ID"] == "" and rows[1]["LIBELLE_y"] == unmatched and rows[1]["CITY"] == ""
    assert rows[1]["Store_Of_Creation"] == "ST" + hashlib.sha1(b"99").hexdigest().upper()
    assert rows[1]["PROVINCE"] == "AB" and rows[1]["COUNTRY"] == "CAN"
    assert rows[2]["Store_Of_Creation"] == "" and rows[2]["PostalCode"] == ""


def test_short_forms(spark):
    df = spark.createDataFrame([("42",), ("",), (None,)], "v string")
    rows = df.select(display_id(pseudonymise("v", "CUST"), "CUST").alias("s"), display_id(F.lit("Unspecified promo"), "OFFER").alias("o")).collect()
    assert [r["s"] for r in rows] == ["CUST" + hashlib.sha1(b"42").hexdigest()[:8].upper(), "", "CUST11E623A3"]
    assert rows[0]["o"] == "Unspecified promo"


def test_identifiers_stay_distinct(spark):
    """As many pseudonyms as order keys at sf0.1, where short forms collide."""
    path = "/root/testdata/sf0.1/orders.parquet"
    if not os.path.exists(path):
        return
    ids = spark.read.parquet(path).select(F.col("o_orderkey").cast("string").alias("k")).distinct()
    whole = ids.select(pseudonymise("k", "TRX").alias("p"))
    n = ids.count()
    assert whole.distinct().count() == n
    assert whole.select(display_id("p", "TRX")).distinct().count() < n


def test_short_identifiers_are_one_to_one(spark):
    """Digests that share the display form get more digits; forms once given stay."""
    from kassa.operators.privacy import short_identifiers
    made = ["ID" + "ABCDEF12" + x.ljust(32, "0") for x in ("A", "AB", "ABC1", "ABC2", "F")] + ["ID" + f"{i:08X}" + "7" * 32 for i in range(50)]
    df = spark.createDataFrame([(x,) for x in [*made, *made[:3], "", "plain", None]], "k string").repartition(3)
    first = short_identifiers(df, "k", "ID")
    got = {r["identifier"]: r["short"] for r in first.collect()}
    assert set(got) == {*made, "", "plain"} and len(set(got.values())) == len(got)
    assert got["plain"] == "plain" and got[""] == "" and all(got[x] == x[:10] for x in made[5:])
    assert all(x.startswith(got[x]) and sum(y.startswith(got[x]) for y in made) == 1 and len(got[x]) > 10 for x in made[:5])
    assert got[made[4]] == made[4][:11] and got[made[2]] == made[2][:14]
    later = made + ["ID" + "ABCDEF12" + "F1".ljust(32, "0"), "ID" + f"{7:08X}" + "8" * 32]
    again = {r["identifier"]: r["short"] for r in short_identifiers(spark.createDataFrame([(x,) for x in later], "k string"), "k", "ID", first).collect()}
    assert all(again[x] == got[x] for x in got) and len(set(again.values())) == len(again) == len(got) + 2
    assert short_identifiers(df.where("false"), "k", "ID").count() == 0
