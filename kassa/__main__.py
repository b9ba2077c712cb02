"""Command line: curate monthly sales files into the partitioned curated table.

    spark-submit --py-files kassa.zip kassa/__main__.py curate --root s3://bucket/retail --out s3://bucket/retail/curated
    python -m kassa curate --root /data/retail --out /data/curated --months 202301 202302 --size-partitions
"""

from __future__ import annotations

import argparse
import json


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="kassa")
    sub = ap.add_subparsers(dest="cmd", required=True)
    c = sub.add_parser("curate", help="raw month files + reference tables -> curated parquet (year/month)")
    c.add_argument("--root", required=True, help="folder with <year>/Base_sales_<month>.csv and base/")
    c.add_argument("--out", required=True, help="output folder (shared storage)")
    c.add_argument("--sales-dirs", nargs="*", default=None)
    c.add_argument("--months", nargs="*", default=None)
    c.add_argument("--size-partitions", action="store_true", help="size shuffle partitions from the input bytes")
    c.add_argument("--master", default=None)
    args = ap.parse_args(argv)

    from kassa.plans.curated import curate
    from kassa.session import build_session, release, size_shuffle_partitions
    from kassa.sources.files import DEFAULT_SALES_DIRS, load_reference_tables, load_sales, write_curated
    spark = build_session(args.master, app="kassa-curate")
    if args.size_partitions:
        dirs = args.sales_dirs or list(DEFAULT_SALES_DIRS)
        size_shuffle_partitions(spark, [f"{args.root.rstrip('/')}/{d}" for d in dirs])
    curated = curate(load_sales(spark, args.root, args.sales_dirs, args.months), load_reference_tables(spark, args.root))
    write_curated(curated, args.out)
    print(json.dumps({"out": args.out, "rows": spark.read.parquet(args.out).count()}))
    release(spark)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
