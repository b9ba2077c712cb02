"""New month files -> curated table, incrementally.

A file stream watches the year folders for ``Base_sales_*.csv`` and yields the
paths of newly landed files (``binaryFile`` source, content not read). Each
micro-batch reads its files with the batch loader (all-string CSV, union by
name, so per-file column layouts may differ), curates them against the
dimension tables and writes them to its own folder ``epoch=<id>`` of the
curated table, partitioned by year and month. A batch that is run again after
a crash overwrites its own folder, so no month is there twice; the stream
checkpoint records which files were done. ``availableNow`` processes what has
landed and stops; otherwise the folders are polled every minute.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kassa.plans.curated import curate
from kassa.session import checkpoint_dir
from kassa.sources.files import DEFAULT_SALES_DIRS, load_reference_tables, read_sales_files


_BINARY_FILE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("modificationTime", T.TimestampType(), False),
    T.StructField("length", T.LongType(), False),
    T.StructField("content", T.BinaryType(), True),
])


def start_month_ingestion(spark: SparkSession, root: str, out_path: str,
                          sales_dirs: Sequence[str] | None = None,
                          checkpoint_location: str | None = None, available_now: bool = True):
    """Start the stream; returns the StreamingQuery (call ``awaitTermination``)."""
    dirs = list(sales_dirs or DEFAULT_SALES_DIRS)
    dims = load_reference_tables(spark, root)
    ckpt = checkpoint_location or f"{checkpoint_dir(spark).rstrip('/')}/kassa-ingest-stream"
    streams = []
    for rank, d in enumerate(dirs):
        s = (spark.readStream.format("binaryFile").schema(_BINARY_FILE_SCHEMA)
             .option("pathGlobFilter", "Base_sales_*.csv")
             .load(f"{root.rstrip('/')}/{d}").select("path", F.lit(rank).alias("dir_rank")))
        streams.append(s)
    src = streams[0]
    for s in streams[1:]:
        src = src.unionByName(s)

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        # one row per new file (metadata only), in folder then month order
        paths = [r["path"] for r in batch.orderBy("dir_rank", "path").collect()]
        if not paths:
            return
        sales = read_sales_files(spark, paths, dirs)
        curate(sales, dims).write.mode("overwrite").partitionBy("year", "month").parquet(f"{out_path.rstrip('/')}/epoch={epoch_id}")

    writer = src.writeStream.foreachBatch(write_batch).option("checkpointLocation", ckpt)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
