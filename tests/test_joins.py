"""Join strategies: the salted path equals the plain left join."""
from pyspark.sql import functions as F

from kassa.operators.joins import hot_keys, left_join_skew_safe, measured_bytes, size_bound_ok


def _fact_dim(spark):
    fact = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("")).otherwise((F.col("id") % 50).cast("string")).alias("k"),
        F.col("id").alias("v"))
    dim = spark.createDataFrame([(str(i), f"d{i}") for i in range(40)] + [("", "empty-a"), ("", "empty-b"),
                                                                         ("7", "dup")], "dk string, label string")
    return fact, dim


def _rows(df):
    return sorted(((r["v"], r["label"]) for r in df.collect()), key=repr)


def test_salted_equals_plain(spark):
    fact, dim = _fact_dim(spark)
    plain = fact.join(dim, fact.k == dim.dk, "left")
    salted = left_join_skew_safe(fact, dim, "k", "dk", broadcast_max_bytes=-1, buckets=8)
    broad = left_join_skew_safe(fact, dim, "k", "dk")
    assert _rows(salted) == _rows(plain) == _rows(broad)
    assert salted.count() == plain.count() == 2 * 1000 + 2000 + 40  # '' rows fan out x2, key '7' x2


def test_same_name_key_kept_once(spark):
    fact, dim = _fact_dim(spark)
    out = left_join_skew_safe(fact, dim.withColumnRenamed("dk", "k"), "k", "k", broadcast_max_bytes=-1)
    assert out.columns.count("k") == 1


def test_size_bound(spark):
    df = spark.range(1000)
    assert size_bound_ok(df, 10_000_000)
    assert not size_bound_ok(df, 1000)


def test_long_texts_are_measured(spark):
    """A hundred rows of a megabyte each are no small side, whatever the row count says."""
    df = spark.range(100).select("id", F.repeat(F.lit("x"), 1_000_000).alias("t"))
    assert measured_bytes(df) > 100_000_000
    assert not size_bound_ok(df)


def test_hot_keys_are_counted(spark):
    fact = spark.range(2000).select(F.when(F.col("id") % 4 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("v"))
    assert hot_keys(fact, ["k"]) == {"k": ["hot"]}
    dim = spark.createDataFrame([("hot", "a"), ("hot", "b"), ("5", "c")], "dk string, label string")
    salted = left_join_skew_safe(fact, dim, "k", "dk", broadcast_max_bytes=-1, buckets=8)
    plain = fact.join(dim, fact.k == dim.dk, "left")
    assert _rows(salted) == _rows(plain)
    plan = salted._jdf.queryExecution().optimizedPlan().toString()
    assert "hot" in plan and "__salt" in plan


def test_curation_identical_on_salted_path(spark, monkeypatch):
    """Force every dimension join onto the salted sort-merge path (the 100 TB
    plan) and compare the curated table with the broadcast plan."""
    import os

    import kassa.operators.joins as J
    from kassa.plans.curated import curate
    from kassa.sources.testdata import raw_tables
    sf = "/root/testdata/sf0.001"
    if not os.path.exists(sf):
        return
    t = raw_tables(spark, sf)

    def rows(df):
        return sorted(map(tuple, df.drop("_seq").collect()), key=repr)
    broadcast = rows(curate(t.sales, t.dims()))
    monkeypatch.setattr(J, "DEFAULT_BROADCAST_BYTES", -1)
    salted_df = curate(t.sales, t.dims())
    plan = salted_df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("__dsalt") >= 4  # contact, item, promotion, store joins all salted
    assert rows(salted_df) == broadcast


def test_shuffle_partition_sizing(spark):
    import os

    from kassa.session import input_bytes, size_shuffle_partitions
    sf = "/root/testdata/sf0.01"
    if not os.path.exists(sf):
        return
    old = spark.conf.get("spark.sql.shuffle.partitions")
    old_adv = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    try:
        size = input_bytes(spark, [f"{sf}/lineitem.parquet"])
        assert size == os.path.getsize(f"{sf}/lineitem.parquet")
        n = size_shuffle_partitions(spark, [f"{sf}/lineitem.parquet"], target_bytes=100_000, expansion=1.0, minimum=1)
        assert n == size // 100_000 + 1
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(n)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old_adv)


def test_hot_keys_without_gathering_the_keys(spark):
    """Sketches, not keys, cross the shuffle; candidates below the share are recounted and left out."""
    fact = spark.range(0, 60_000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, "").when(F.col("id") % 40 == 1, "warm").when(F.col("id") % 100 == 2, "cool").otherwise(F.col("id").cast("string")).alias("k"),
        F.when(F.col("id") % 2 == 0, F.lit(None)).otherwise((F.col("id") % 70).cast("int")).alias("j"))
    assert {c: sorted(v) for c, v in hot_keys(fact, ["k", "j"]).items()} == {"k": ["", "warm"], "j": []}
    assert hot_keys(fact.where("false"), ["k", "j"]) == {"k": [], "j": []}
    assert hot_keys(fact, ["j"], share=1 / 69)["j"] == [] and len(hot_keys(fact, ["j"], share=1 / 71)["j"]) == 35
