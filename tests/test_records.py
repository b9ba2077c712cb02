"""CSV files read in splits: equal to Python's csv module wherever the splits fall."""
import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from kassa.sources import records as R
from kassa.sources.files import load_reference_tables, load_sales


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "97", "spark.sql.files.openCostInBytes": "0"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def write(path, rows, quoting=csv.QUOTE_MINIMAL, end="\n"):
    path.parent.mkdir(parents=True, exist_ok=True)
    text = io.StringIO()
    csv.writer(text, quoting=quoting, lineterminator=end).writerows(rows)
    path.write_text(text.getvalue(), encoding="utf-8", newline="")
    return text.getvalue()


def random_rows(seed, n=150):
    rng = random.Random(seed)
    bits = ["a", "bc", '"', ",", "\n", "\r\n", " ", "é", "x" * 30, '""', '",', ',"']
    return [["h1", "h 2", "h3"]] + [["".join(rng.choices(bits, k=rng.randint(0, 12))) for _ in range(3)] for _ in range(n)]


def parsed(spark, paths):
    records, splits = R.read_records(spark, paths)
    return R.parse_records(records, ["a", "b", "c"]), splits


@pytest.mark.parametrize(("quoting", "end"), [(csv.QUOTE_ALL, "\n"), (csv.QUOTE_MINIMAL, "\r\n"), (csv.QUOTE_MINIMAL, "\n")])
def test_splits_anywhere(spark, tmp_path, small_splits, quoting, end):
    want = {}
    for k in range(2):
        rows = random_rows(k)
        write(tmp_path / f"f{k}.csv", rows, quoting, end)
        want[f"f{k}.csv"] = [(i, *[c or None for c in r]) for i, r in enumerate(rows) if i]
    df, splits = parsed(spark, [str(tmp_path / f) for f in want])
    assert splits.count() > 100
    got = df.collect()
    for name, rows in want.items():
        assert sorted((r["_n"], r["a"], r["b"], r["c"]) for r in got if r["_path"].endswith(name)) == rows


def test_a_field_longer_than_many_splits_and_an_open_quote(spark, tmp_path, small_splits):
    long = "line of a very long field\n" * 60 + 'with "quotes"'
    rows = [["a", "b", "c"], ["1", long, "x"], ["2", "y", long + "z"]]
    text = write(tmp_path / "f.csv", rows)
    (tmp_path / "f.csv").write_text(text + '3,"never closed\nto the end', encoding="utf-8")
    got = sorted((r["_n"], r["a"], r["b"], r["c"]) for r in parsed(spark, [str(tmp_path / "f.csv")])[0].collect())
    assert got[:2] == [(1, "1", long, "x"), (2, "2", "y", long + "z")]
    assert got[2][:2] == (3, "3") and "never closed\nto the end" in got[2][2]


def test_quotes_that_are_text(spark, tmp_path, small_splits):
    """A quote inside an unquoted field opens nothing."""
    body = "a,b,c\n" + "".join(f'{i},5" pipe,say "hi"\n{i}b,"two\nlines, ""here""",6"\n' for i in range(40))
    (tmp_path / "f.csv").write_text(body, encoding="utf-8")
    got = {r["a"]: (r["b"], r["c"]) for r in parsed(spark, [str(tmp_path / "f.csv")])[0].collect()}
    assert len(got) == 80 and got["7"] == ('5" pipe', 'say "hi"') and got["7b"] == ('two\nlines, "here"', '6"')


def test_blank_lines_and_empty_files(spark, tmp_path, small_splits):
    (tmp_path / "f.csv").write_text('a,b,c\n\n1,"x\n\ny",2\r\n\r\n3,4,5', encoding="utf-8", newline="")
    (tmp_path / "g.csv").write_text("a,b,c\n", encoding="utf-8")
    df, _ = parsed(spark, [str(tmp_path / "f.csv"), str(tmp_path / "g.csv")])
    assert sorted((r["_n"], r["a"], r["b"], r["c"]) for r in df.collect()) == [(1, "1", "x\n\ny", "2"), (2, "3", "4", "5")]


def test_dense_numbers_and_folders_of_parts(spark, tmp_path, small_splits):
    """Lines are numbered from 1 in the order of folder, month, part and row, whatever the splits."""
    want = []
    for folder, month, parts in (("2023", "202301", 1), ("2023", "202302", 3), ("2024", "202401", 2)):
        for p in range(parts):
            rows = [[f"{month}-{p}-{i}", 'line 1\n"line" 2', "NA"] for i in range(25)]
            name = f"Base_sales_{month}.csv" if parts == 1 else f"Base_sales_{month}.csv/part-{p:05d}-x.csv"
            write(tmp_path / folder / name, [["Transaction_ID", "Remark", "Label"], *rows])
            want += [r[0] for r in rows]
    df = load_sales(spark, str(tmp_path))
    got = sorted((r["_seq"], r["Transaction_ID"], r["Remark"], r["Label"], r["Source_File"]) for r in df.collect())
    assert [g[1] for g in got] == want and [g[0] for g in got] == list(range(1, len(want) + 1))
    assert {g[2] for g in got} == {'line 1\n"line" 2'} and {g[3] for g in got} == {None}
    assert {g[4] for g in got} == {"Base_sales_202301.csv", "Base_sales_202302.csv", "Base_sales_202401.csv"}
    some = load_sales(spark, str(tmp_path), months=["202302"])
    assert some.count() == 75 and some.agg(F.max("_seq")).first()[0] == 75


def test_copies_of_a_line_follow_the_dimension(spark, tmp_path):
    """A repeated dimension key fans a line out; the copies are numbered in the dimension's order."""
    from kassa.operators.common import first_line_per_transaction
    from kassa.operators.enrich import merge_sales_with_references
    head = ["Transaction_ID", "Contact_ID", "Item_ID", "Promotion_ID", "Store_transaction_ID", "Value"]
    write(tmp_path / "2023/Base_sales_202301.csv", [head, ["T1", "C1", "I1", "P1", "S1", "1"], ["T1", "C2", "I1", "", "S1", "2"], ["T2", "C9", "I9", "", "", "3"]])
    write(tmp_path / "base/Base_contact.csv", [["Contact_ID", "YearOfBirth"], ["C1", "1990"], ["C1", "1980"], ["C2", "1970"]])
    write(tmp_path / "base/Base_item.csv", [["SKU", "EAN"], ["I1", "z"], ["I1", "a"], ["I1", "m"]])
    write(tmp_path / "base/Base_promotions.csv", [["PROMO_ID", "LIBELLE"], ["P1", "x"]])
    write(tmp_path / "base/Base_stores.csv", [["STORE_ID", "LIBELLE"], ["S1", "x"]])
    df = merge_sales_with_references(load_sales(spark, str(tmp_path)), load_reference_tables(spark, str(tmp_path)))
    got = [(r["Transaction_ID"], r["Value"], r["YearOfBirth"], r["EAN"]) for r in df.orderBy("_seq").collect()]
    assert got == [("T1", "1", y, e) for y in ("1990", "1980") for e in "zam"] + [("T1", "2", "1970", e) for e in "zam"] + [("T2", "3", None, None)]
    assert df.select("_seq").distinct().count() == 10
    first = first_line_per_transaction(df, ["EAN", "YearOfBirth"], key="Transaction_ID").where("Transaction_ID = 'T1'").first()
    assert (first["EAN"], first["YearOfBirth"]) == ("z", "1990")


def test_first_lines_by_hash(spark):
    from kassa.operators.common import first_line_per_transaction
    df = spark.createDataFrame([(f"t{i % 40}", float(i), i % 7, None if i % 3 else 5.0, (i * 37) % 1000) for i in range(400)],
                               "transaction_id string, v double, k int, w double, _seq long")
    out = first_line_per_transaction(df, ["v", "k", "w"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    want = {}
    for r in sorted(df.collect(), key=lambda r: r["_seq"]):
        want.setdefault(r["transaction_id"], tuple(r))
    assert {r["transaction_id"]: (r["transaction_id"], r["v"], r["k"], r["w"], r["_seq"]) for r in out.collect()} == want


def test_workers_need_no_repository(tmp_path):
    """A driver elsewhere, workers without the package on their path."""
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    write(tmp_path / "2023/Base_sales_202301.csv", [["Transaction_ID", "Remark"], ["T1", "a\nb"], ["T2", "c"]])
    code = (f"import sys; sys.path.insert(0, {root!r})\n"
            "from pyspark.sql import SparkSession\n"
            "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
            "from kassa.sources.files import load_sales\n"
            f"print('ROWS', load_sales(s, {str(tmp_path)!r}).count())\n")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd="/tmp", env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS 2" in out.stdout, out.stderr[-2000:]


def test_line_ends_equal_a_plain_walk():
    import pyarrow as pa
    rng = random.Random(5)
    lines = ["", '"', '""'] + ["".join(rng.choices(['"', '"', ",", "a", "é"], k=rng.randint(0, 25))) for _ in range(3000)]

    def walk(line, state):
        for x in line.split('"')[:-1]:
            state = R.OUTSIDE if state == R.INSIDE else R.INSIDE if x.endswith(",") or (x == "" and state == R.OUTSIDE) else R.PLAIN
        return state == R.INSIDE

    for part in (pa.array(lines), pa.array(lines)[7:900], pa.array([""])):
        end0, end1 = R.line_ends(part)
        assert end0.tolist() == [walk(x, R.OUTSIDE) for x in part.to_pylist()]
        assert end1.tolist() == [walk(x, R.INSIDE) for x in part.to_pylist()]


def test_whole_files_are_not_read_for_fragments(spark, tmp_path):
    """A file in one split leaves no record open at its end, unless a quote stays open."""
    write(tmp_path / "f.csv", [["a", "b", "c"], ["1", "x\ny", "z"]])
    (tmp_path / "g.csv").write_text('a,b,c\n1,"open', encoding="utf-8")
    _, splits = R.read_records(spark, [str(tmp_path / f) for f in ("f.csv", "g.csv")])
    assert sorted((r["path"][-5:], r["leaves"]) for r in splits.collect()) == [("f.csv", False), ("g.csv", True)]
