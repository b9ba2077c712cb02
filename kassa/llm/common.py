"""Helpers shared by the text operators: stored intermediate tables, fresh
column names, and byte-level access to Arrow string columns."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kassa.session import new_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stash(df: DataFrame) -> DataFrame:
    """Write ``df`` to a table of its own in the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, and a result used
    several times is computed once. ``kassa.session.release`` removes it.
    """
    spark = df.sparkSession
    path = new_path(spark, "stash")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have yet."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name = "_" + name
    return name


def whole(c: str) -> Column:
    """Text column with null read as the empty text."""
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def text_bytes(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Arrow strings as one UTF-8 byte array plus n+1 offsets; nulls are empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    arr = arr.fill_null("") if arr.null_count else arr
    arr = arr.cast(pa.large_binary())
    _, off, data = arr.buffers()
    if len(arr) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(arr) + 1, np.int64)
    offsets = np.frombuffer(off, np.int64, len(arr) + 1, arr.offset * 8)
    buf = np.frombuffer(data, np.uint8)
    return buf[offsets[0]:offsets[-1]], offsets - offsets[0]


def row_blocks(offsets: np.ndarray, most_bytes: int) -> Iterator[tuple[int, int]]:
    """Runs [i, j) of consecutive texts of at most ``most_bytes`` together (one text at least)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most_bytes, side="right")) - 1)
        yield i, j
        i = j


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64 output bits (splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def share(spark: SparkSession, obj: object) -> Broadcast:
    """Broadcast an object of this package; workers need no copy of its code."""
    bounded_batches(spark)
    return spark.sparkContext.broadcast({"raw": cloudpickle.dumps(obj)})


def shared(held: Broadcast):
    """The object that ``share`` sent, opened once in each Python worker."""
    box = held.value
    if "open" not in box:
        box["open"] = pickle.loads(box.pop("raw"))
    return box["open"]


BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batches to a size at which a Python worker's
    copies of a batch of texts stay small; smaller settings are kept."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = spark.conf.get(key, None)
        number = int("".join(c for c in now if c.isdigit() or c == "-")) if now and now.rstrip("bB").lstrip("-").isdigit() else 0
        if number <= 0 or number > most:
            spark.conf.set(key, str(most))
