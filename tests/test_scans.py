"""How often each query reads the curated table: input records in Spark's event log."""
import glob
import json
import os
import subprocess
import sys

import pytest

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver test tables absent")

#: queries that join the fact with what they found in it
TWICE = {"rfm_segment_category", "sample_transactions"}
NAMES = ("highlights monthly_sales_series category_revenue_share category_pareto sku_top50 promo_overall promo_effect_category promo_effect_store "
         "promo_effect_label promo_share_long store_profitability store_deep_dive store_top_bottom15 city_performance city_category_top5 "
         "cohort_retention cohort_retention_matrix cohort_sizes retention_curve rfm_dashboard rfm_segments rfm_report rfm_report_segments "
         "rfm_segment_category recency_buckets unit_price_quartiles promo_usage_contingency promo_usage_crosstab chi_square_promo_usage "
         "box_plot_stats transaction_value_histogram data_quality data_quality_all sidebar_facets sample_transactions").split()

CHILD = """
import sys
sys.path.insert(0, {root!r})
from kassa.session import build_session
spark = build_session("local[4]", shuffle_partitions=4, extra={{"spark.eventLog.enabled": "true", "spark.eventLog.dir": "file://{log}",
                      "spark.eventLog.rolling.enabled": "false", "spark.eventLog.compress": "false", "spark.ui.showConsoleProgress": "false"}})
spark.sparkContext.setLogLevel("ERROR")
from kassa.plans.curated import curated_from_testdata
from kassa.plans.queries import REGISTRY
print("FACT", curated_from_testdata(spark, {sf!r}).count())
for name in {names!r}:
    spark.sparkContext.setJobGroup(name, name)
    REGISTRY[name](spark, {sf!r}).write.format("noop").mode("overwrite").save()
spark.stop()
"""


@pytest.fixture(scope="module")
def reads(tmp_path_factory):
    log = tmp_path_factory.mktemp("events")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", CHILD.format(root=root, log=log, sf=SF, names=NAMES)], capture_output=True, text=True, timeout=1200)
    assert "FACT" in out.stdout, out.stderr[-2000:]
    fact = int(out.stdout.split("FACT")[1].split()[0])
    group, total = {}, {}
    for line in open(glob.glob(f"{log}/*")[0], encoding="utf-8"):
        e = json.loads(line)
        if e["Event"] == "SparkListenerJobStart":
            for s in e["Stage IDs"]:
                group[s] = e["Properties"].get("spark.jobGroup.id")
        elif e["Event"] == "SparkListenerTaskEnd" and group.get(e["Stage ID"]) in NAMES:
            key = (group[e["Stage ID"]], e["Stage ID"])
            total[key] = total.get(key, 0) + (e.get("Task Metrics") or {}).get("Input Metrics", {}).get("Records Read", 0)
    # stages that read the fact, and what the others read of stored aggregates, both in facts
    out = {n: [0.0, 0.0] for n in NAMES}
    for (name, _), n in total.items():
        out[name][n < 0.8 * fact] += n / fact
    return out


@pytest.mark.parametrize("name", NAMES)
def test_reads_of_the_fact(reads, name):
    scans, rest = reads[name]
    assert 0.8 <= scans <= (2.05 if name in TWICE else 1.05)
    assert rest <= 3  # at this size customers x cities are half as many as the lines
