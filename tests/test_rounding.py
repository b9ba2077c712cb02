"""The comparison rounding gives bit-identical doubles in Spark and DuckDB."""
import duckdb
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from kassa.functions.rounding import sig_round, sig_round_sql

ties = st.integers(-10**9, 10**9).map(lambda n: n / 1000 + 0.0005)      # x.xxx5 decimal ties
money = st.integers(-10**12, 10**12).map(lambda n: n / 100)               # 2-decimal sums
anything = st.floats(allow_nan=False, allow_infinity=False, min_value=-1e15, max_value=1e15)
values = st.lists(st.one_of(ties, money, anything), min_size=1, max_size=200)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(values)
def test_spark_and_duckdb_round_identically(spark, xs):
    df = spark.createDataFrame([(i, float(x)) for i, x in enumerate(xs)], "i int, x double")
    got = [r[0] for r in df.orderBy("i").select(sig_round("x")).collect()]
    con = duckdb.connect()
    con.execute("CREATE TABLE t(i INTEGER, x DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(float(x) for x in xs)))
    want = [r[0] for r in con.execute(f"SELECT {sig_round_sql('x')} FROM t ORDER BY i").fetchall()]
    assert got == want
