"""Every registered query against its DuckDB twin on the sf0.001 tables."""
import os

import duckdb
import pytest

import __spark_entry__ as E
from oracle_sql import ORACLE
from tools.check_oracle import TABLES, rows_of

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver test tables absent")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["month", "revenue", "orders", "units", "unique_customers", "avg_order_value"]


def test_every_query_has_a_twin_or_is_documented():
    from kassa.plans.queries import REGISTRY
    assert set(REGISTRY) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_parity(spark, con, name):
    sdf = E.queries()[name](spark, SF)
    cols = sorted(sdf.columns)
    a = rows_of([r.asDict() for r in sdf.collect()], cols)
    assert a, "no rows to compare"
    odf = con.execute(E.oracle_sql()[name]).fetchdf()
    assert sorted(odf.columns) == cols
    b = rows_of(odf.to_dict("records"), cols)
    assert a == b


def test_import_without_the_text_operators(tmp_path):
    """The entry and the base queries work when the llm folder and the pipeline are gone."""
    import shutil
    import subprocess
    import sys as _sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(f"{root}/kassa", tmp_path / "kassa", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for f in ("__spark_entry__.py", "oracle_sql.py"):
        shutil.copy(f"{root}/{f}", tmp_path)
    code = "import __spark_entry__ as E; q = E.queries(); print('N', len(q), set(q) == set(E.oracle_sql()), any(x.startswith('op') for x in q))"
    out = subprocess.run([_sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=300,
                         env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert "N 68 True False" in out.stdout, out.stdout + out.stderr[-2000:]
