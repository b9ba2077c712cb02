"""Monthly sales files and reference tables on any Hadoop-compatible FS.

Layout (as the reference expects):
    <root>/<year dir>/Base_sales_<month>.csv     one file per month
    <root>/base/Base_contact.csv, Base_item.csv, Base_promotions.csv, Base_stores.csv

A month or a dimension may also be a folder of that name with part files
(``Base_sales_<month>.csv/part-*``), as Spark writes them; parts follow each
other by name.

Files are listed with Spark's ``binaryFile`` source selecting only the path
(no content is read), so listing works on HDFS/S3/ABFS alike. XLSX inputs are
recognised during discovery but not decoded (a per-file single-machine
parser); a month available only as XLSX raises.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from kassa.constants import MISSING_CELL_TOKENS
from kassa.operators.common import stored
from kassa.sources.records import parse_records, read_records

DEFAULT_SALES_DIRS = ("2023", "2024")
SALES_GLOB = "Base_sales_*.*"
REFERENCE_TABLES = (("contact", "Base_contact"), ("item", "Base_item"),
                    ("promotion", "Base_promotions"), ("store", "Base_stores"))


#: a part file's path up to the folder that stands for one file
PART_OF = r"^(.*/Base_[^/]*)/part-[^/]*$"


def _listing(spark: SparkSession, path: str, glob: str) -> DataFrame | None:
    """Paths of the files under ``path`` whose name matches, and of folders so named that hold part files."""
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path")
        parts = (spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", True)
                 .load(path).select(F.regexp_extract("path", PART_OF, 1).alias("path")).distinct())
    except AnalysisException:
        return None
    name = F.element_at(F.split("path", "/"), -1)
    folder = F.regexp_replace(F.element_at(F.split("path", "/"), -2), "/+$", "")
    named = "^" + glob.replace(".", r"\.").replace("*", ".*") + "$"
    return files.unionByName(parts.where(name.rlike(named) & (folder == path.rstrip("/").split("/")[-1])))


def list_sales_files(spark: SparkSession, root: str, sales_dirs: Sequence[str] | None = None,
                     months: Sequence[str] | None = None) -> DataFrame:
    """Chosen file per (year dir, month): dir_rank, month_key, month_token, path, ext.

    Month = last '_' token of the file stem; selection is case-insensitive;
    CSV is preferred over XLSX, then the first path in sort order.
    """
    frames = []
    for rank, d in enumerate(sales_dirs or DEFAULT_SALES_DIRS):
        lst = _listing(spark, f"{root.rstrip('/')}/{d}", SALES_GLOB)
        if lst is not None:
            frames.append(lst.withColumn("dir_rank", F.lit(rank)))
    if not frames:
        raise FileNotFoundError(f"no sales folder with month files under {root}")
    files = frames[0]
    for f in frames[1:]:
        files = files.unionByName(f)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    files = files.select("dir_rank", "path",
                         F.lower(F.regexp_extract(name, r"\.([^./]+)$", 1)).alias("ext"),
                         F.substring_index(stem, "_", -1).alias("month_token"))
    files = files.withColumn("month_key", F.lower("month_token")).where(F.col("ext").isin("csv", "xlsx"))
    if months:
        files = files.where(F.col("month_key").isin([m.lower() for m in months]))
    pref = F.struct(F.when(F.col("ext") == "csv", 0).otherwise(1), F.col("path"))
    return (files.groupBy("dir_rank", "month_key")
                 .agg(F.min_by(F.struct("path", "ext", "month_token"), pref).alias("f"))
                 .select("dir_rank", "month_key", "f.month_token", "f.path", "f.ext"))


def list_available_months(spark: SparkSession, root: str, sales_dirs: Sequence[str] | None = None,
                          first: int | None = None) -> DataFrame:
    """Sorted distinct month tokens (optionally the first ``first``)."""
    m = list_sales_files(spark, root, sales_dirs).select(F.col("month_token").alias("month")).distinct() \
        .orderBy("month")
    return m.limit(first) if first else m


def _cells(df: DataFrame, columns: Sequence[str]) -> list:
    """The named text columns, stripped of white space in their names, with missing-value tokens as null."""
    return [F.when(~F.col(f"`{c}`").isin(*MISSING_CELL_TOKENS), F.col(f"`{c}`")).alias(c.strip()) for c in columns]


def _read_csv_strings(spark: SparkSession, paths: str | list[str], multiline: bool = True) -> tuple[DataFrame, DataFrame | None]:
    """CSV as text columns by the rules of pandas' reader, with ``_path`` and ``_row``; and the table of splits.

    A doubled quote inside a quoted field is one quote, commas and line breaks
    inside quotes belong to the field, and the usual missing-value tokens are
    null in every column. Files are read in splits wherever their line breaks
    stand (:mod:`kassa.sources.records`), and what they hold is stored as
    columns; ``_row`` is a row's number in its file. ``multiline=False``
    declares that no field holds a line break: then Spark's own reader takes
    the splits, ``_row`` is (split offset, row id), and there is no table.
    """
    reader = (spark.read.option("header", True).option("inferSchema", False).option("enforceSchema", False)
              .option("mode", "PERMISSIVE").option("quote", '"').option("escape", '"').option("multiLine", multiline))
    paths = [paths] if isinstance(paths, str) else list(paths)
    if multiline:
        columns = reader.csv(paths[0]).columns  # of the header alone
        records, splits = read_records(spark, paths)
        parsed = parse_records(records, columns)
        return stored(parsed.select(*_cells(parsed, columns), "_path", F.col("_n").alias("_row")), "rows"), splits
    df = reader.csv(paths)
    row = F.struct(F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("r"))
    return df.select(*_cells(df, df.columns), F.col("_metadata.file_path").alias("_path"), row.alias("_row")), None


def _header(spark: SparkSession, path: str) -> str:
    first = spark.read.text(path).limit(1).first()
    return first[0].lstrip("\ufeff") if first else ""


def load_sales(spark: SparkSession, root: str, sales_dirs: Sequence[str] | None = None,
               months: Sequence[str] | None = None, multiline: bool = True) -> DataFrame:
    """All-string union (by name) of the selected month files.

    Adds ``Source_File`` and ``_seq``, the line's place in file + row order: a
    dense number from 1, of the counts that the splits give; with
    ``multiline=False`` a struct of the same order.
    """
    chosen = list_sales_files(spark, root, sales_dirs, months).orderBy("dir_rank", "month_key")
    files = chosen.collect()  # file metadata only: one row per month file
    if not files:
        raise FileNotFoundError(f"no month file Base_sales_*.csv under {root}")
    xlsx = [r["path"] for r in files if r["ext"] != "csv"]
    if xlsx:
        raise ValueError(f"XLSX sales files are not supported, convert to CSV: {xlsx}")
    df, splits = _read_groups(spark, [r["path"] for r in files], sales_dirs, multiline)
    if splits is None:
        return df.withColumn("_seq", F.struct("_file", "_row")).drop("_file", "_row", "_path")
    # a file's rows come after those of all files before it: one row for each file
    rows = splits.groupBy("path").agg((F.max(F.col("first") + F.col("starts")) - 1).alias("rows"))
    earlier = Window.orderBy(_file_order(F.col("path"), sales_dirs)).rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(rows.select(F.col("path").alias("_path"), F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("_before")), "files")
    return df.join(F.broadcast(starts), "_path").withColumn("_seq", F.col("_before") + F.col("_row")).drop("_file", "_row", "_path", "_before")


def _file_order(path: Column, sales_dirs: Sequence[str] | None) -> Column:
    """A file's place by its own folder, month and name, whatever other files there are."""
    whole = F.when(path.rlike(PART_OF), F.regexp_extract(path, PART_OF, 1)).otherwise(path)
    part = F.when(path.rlike(PART_OF), F.element_at(F.split(path, "/"), -1)).otherwise(F.lit(""))
    steps = F.split(whole, "/")
    folder = F.url_decode(F.element_at(steps, -2))
    rank = F.lit("9999")
    for k, d in reversed(list(enumerate(sales_dirs or DEFAULT_SALES_DIRS))):
        rank = F.when(folder == d.strip("/").split("/")[-1], F.lit(f"{k:04d}")).otherwise(rank)
    name = F.url_decode(F.element_at(steps, -1))
    month = F.lower(F.substring_index(F.regexp_replace(name, r"\.[^.]*$", ""), "_", -1))
    return F.concat_ws("/", rank, month, name, part)


def _read_groups(spark: SparkSession, paths: Sequence[str], sales_dirs: Sequence[str] | None,
                 multiline: bool) -> tuple[DataFrame, DataFrame | None]:
    """Union by name with ``Source_File, _file`` (order of the file), ``_row, _path``; and the splits of all files."""
    with ThreadPoolExecutor(8) as pool:  # only the first line of each file is read here
        headers = list(pool.map(lambda p: _header(spark, p), paths))
    groups: dict[str, list[str]] = {}
    for path, header in zip(paths, headers, strict=True):
        groups.setdefault(header, []).append(path)
    out = splits = None
    for group in groups.values():
        df, own = _read_csv_strings(spark, group, multiline)
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
        splits = own if splits is None else splits.unionByName(own)
    whole = F.when(F.col("_path").rlike(PART_OF), F.regexp_extract("_path", PART_OF, 1)).otherwise(F.col("_path"))
    name = F.url_decode(F.element_at(F.split(whole, "/"), -1))
    return out.withColumns({"Source_File": name, "_file": _file_order(F.col("_path"), sales_dirs)}), splits


def read_sales_files(spark: SparkSession, paths: Sequence[str], sales_dirs: Sequence[str] | None = None,
                     multiline: bool = True) -> DataFrame:
    """Union by name of CSV month files: one scan for all files with the same header.

    ``_seq`` is (the file's own folder and month, row), so files that arrive
    later, in another call, take their place among the others.
    """
    df, _ = _read_groups(spark, paths, sales_dirs, multiline)
    return df.withColumn("_seq", F.struct(F.col("_file").alias("f"), F.col("_row").alias("r"))).drop("_file", "_row", "_path")


def load_reference_tables(spark: SparkSession, root: str, multiline: bool = True) -> dict[str, DataFrame]:
    """The four dimension tables (all strings, headers stripped).

    ``_seq`` is the file order: for first-appearance rules of stores, and for
    the order of rows that share a key.
    """
    base = f"{root.rstrip('/')}/base"
    tables = {}
    for key, name in REFERENCE_TABLES:
        csv = _listing(spark, base, f"{name}.csv")
        if csv is None or csv.limit(1).count() == 0:
            xlsx = _listing(spark, base, f"{name}.xlsx")
            if xlsx is not None and xlsx.limit(1).count() > 0:
                raise ValueError(f"XLSX reference table not supported, convert to CSV: {base}/{name}.xlsx")
            raise FileNotFoundError(f"no file for the {key} table: {base}/{name}.csv")
        df, _ = _read_csv_strings(spark, f"{base}/{name}.csv", multiline)
        # parts of a folder follow each other by name; a single file needs no more than the row
        part = F.regexp_extract("_path", "/part-([^/]*)$", 1)
        tables[key] = df.withColumn("_seq", F.struct(part.alias("p"), F.col("_row").alias("r"))).drop("_path", "_row")
    return tables


def load_and_prepare_data(spark: SparkSession, root: str, sales_dirs: Sequence[str] | None = None,
                          months: Sequence[str] | None = None) -> DataFrame:
    """The curated table for the selected months (lazy)."""
    from kassa.plans.curated import curate
    return curate(load_sales(spark, root, sales_dirs, months), load_reference_tables(spark, root))


def write_curated(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """S6 reuse: curated parquet partitioned by year/month (S5 pruning). ``_seq``
    goes with it: operators that need the order of lines run on the re-read table."""
    df.write.mode(mode).partitionBy("year", "month").parquet(path)


def read_curated(spark: SparkSession, path: str, years: Sequence[int] | None = None,
                 months: Sequence[int] | None = None) -> DataFrame:
    """Read the curated table; year/month filters prune partitions at the scan."""
    df = spark.read.parquet(path)
    if years:
        df = df.where(F.col("year").isin(list(years)))
    if months:
        df = df.where(F.col("month").isin(list(months)))
    return df


def save_curated_table(df: DataFrame, table: str, buckets: int | None = None, path: str | None = None) -> DataFrame:
    """S6 reuse as a catalog table, partitioned by year/month and bucketed +
    sorted by transaction id.

    Transaction-grain operators (first line per transaction, transaction
    roll-up, promotion summary) then find their input already hash-partitioned
    on the key: Spark plans them without a shuffle. Size ``buckets`` so a
    bucket of one month is a few hundred MB. ``path`` makes it an external
    table at that (shared) location instead of the warehouse folder.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    w = df.write.mode("overwrite")
    if path:
        w = w.option("path", path)
    w.partitionBy("year", "month").bucketBy(n, "transaction_id").sortBy("transaction_id").saveAsTable(table)
    return spark.table(table)
