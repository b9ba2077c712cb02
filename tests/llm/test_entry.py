"""Registration of the text operators, and parity with SQL on the driver's tables."""
import os

import duckdb
import pytest

import __spark_entry__ as E
from kassa.llm import queries as Q
from tools.check_oracle import TABLES, rows_of

SF = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    names = sorted(E.queries())
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and set(Q.ORACLE) <= set(Q.REGISTRY)


@pytest.mark.skipif(not os.path.exists(SF), reason="driver test tables absent")
@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_parity(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = E.queries()[name](spark, SF)
    want = con.execute(E.oracle_sql()[name]).fetchdf()
    cols = sorted(got.columns)
    assert sorted(want.columns) == cols
    assert rows_of([r.asDict() for r in got.collect()], cols) == rows_of(want.to_dict("records"), cols)


def test_workers_need_no_repository():
    """Functions travel by value: a driver elsewhere, workers without the package on their path."""
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = ("import sys; sys.path.insert(0, %r)\n"
            "from pyspark.sql import SparkSession\n"
            "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
            "import __spark_entry__ as E\n"
            "for n in ('op1_quality', 'op2_language', 'op3_bpe', 'op5_suffix_dedup', 'op7_near_dedup', 'op9_line_dedup', 'op10_decontamination'):\n"
            "    print('ROWS', n, E.queries()[n](s, %r).count())\n") % (root, SF)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd="/tmp", env=env, capture_output=True, text=True, timeout=600)
    assert out.stdout.count("ROWS") == 7, out.stderr[-2000:]
