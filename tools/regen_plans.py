"""Refresh the plan trees in PLANS.md from the current code (notes are kept).

usage: python tools/regen_plans.py [sf_dir]
Each ```-block in PLANS.md is replaced, in order, by the condensed executed
plan of the matching case below.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

KEEP = re.compile(r"(Exchange|Join|Aggregate|Window|Scan|Sort |TakeOrdered|Subquery|Expand|Filter|"
                  r"ResultQueryStage|ShuffleQueryStage|BroadcastQueryStage|AQEShuffleRead|Generate)")


def condensed(df, strip_chars: str) -> str:
    df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    txt = buf.getvalue().replace(strip_chars, "<ws>")
    m = re.search(r"== Final Plan ==\n(.*?)\+- == Initial Plan ==", txt, re.S)
    out = []
    for line in (m.group(1).splitlines() if m else []):
        if not KEEP.search(line):
            continue
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r"\[plan_id=\d+\]", "", line)
        line = re.sub(r"functions=\[.*", "functions=[...])", line)
        line = re.sub(r"(FileScan parquet \[[^\]]*\]).*", r"\1 ...", line)
        line = re.sub(r"(Generate explode\().*", r"\1...)", line)
        out.append(line.rstrip()[:150])
    return "\n".join(out)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from kassa.functions.clean import _STRIP_CHARS
    from kassa.operators import customers as C
    from kassa.operators import kpi as K
    from kassa.operators.filters import apply_filters, non_negative_quantity
    from kassa.operators.quality import DASHBOARD_QUALITY_COLUMNS, data_quality_report
    from kassa.plans.curated import curate, curated_from_testdata
    from kassa.plans.queries import FILTER_EXAMPLE
    from kassa.session import build_session
    from kassa.sources.testdata import raw_tables
    spark = build_session("local[8]", shuffle_partitions=16, extra={"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    cur = curated_from_testdata(spark, sf)
    t = raw_tables(spark, sf)
    cases = [
        curate(t.sales, t.dims()),
        K.monthly_kpi_summary(cur),
        K.compute_highlights(apply_filters(non_negative_quantity(cur), FILTER_EXAMPLE)),
        C.rfm_dashboard(non_negative_quantity(cur)),
        C.rfm_segment_category(cur),
        data_quality_report(cur, DASHBOARD_QUALITY_COLUMNS),
    ]
    path = os.path.join(ROOT, "PLANS.md")
    doc = open(path, encoding="utf-8").read()
    blocks = re.findall(r"```\n(.*?)\n```", doc, re.S)
    if len(blocks) != len(cases):
        raise SystemExit(f"PLANS.md has {len(blocks)} plan blocks, expected {len(cases)}")
    for old, df in zip(blocks, cases):
        doc = doc.replace("```\n" + old + "\n```", "```\n" + condensed(df, _STRIP_CHARS) + "\n```", 1)
    open(path, "w", encoding="utf-8").write(doc)
    print("PLANS.md refreshed")


if __name__ == "__main__":
    main()
