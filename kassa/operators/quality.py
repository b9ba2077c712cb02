"""Column-level data-quality profile."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# the functions below travel to Python workers by value, so executors need no copy of the repository
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def pandas_dtype(dt: T.DataType) -> str:
    """The dtype label pandas shows for the same column in the reference."""
    if isinstance(dt, (T.StringType, T.StructType, T.ArrayType, T.MapType, T.BinaryType)):
        return "object"
    if isinstance(dt, T.BooleanType):
        return "bool"
    if isinstance(dt, (T.DoubleType, T.FloatType, T.DecimalType)):
        return "float64"
    if isinstance(dt, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "datetime64[ns]"
    if isinstance(dt, T.IntegerType):
        return "int32"
    if isinstance(dt, (T.LongType, T.ShortType, T.ByteType)):
        return "int64"
    return dt.simpleString()


DASHBOARD_QUALITY_COLUMNS = ("transaction_id", "contact_id", "promotion_id", "transaction_value", "quantity_item",
                             "latitude", "longitude", "city", "category")


#: types whose values a double tells apart
AS_NUMBER = (T.DoubleType, T.FloatType, T.IntegerType, T.ShortType, T.ByteType, T.BooleanType)


def _canonical_value(c: str, dt: T.DataType) -> Column:
    """Value as a number (-0.0 folded into 0.0) or as text, one for each distinct value; zero of other numbers is the empty text."""
    col = F.col(f"`{c}`")
    if isinstance(dt, AS_NUMBER):
        return col.cast("double") + F.lit(0.0)
    if isinstance(dt, T.DateType):
        return F.unix_date(col).cast("double")
    return F.when(col == 0, F.lit("")).otherwise(col.cast("string")) if isinstance(dt, T.NumericType) else col.cast("string")


CELL = "_i short, _d double, _v binary, _c long"
CHUNK_ROWS, CHUNK_BYTES = 1 << 16, 64 << 20  # rows whose values are counted together in a task


def packed_values(values: pa.Array) -> Iterator[tuple[np.ndarray, pa.Array]]:
    """Texts as bytes, no two alike, in parts (places and bytes): 40 upper-case hex digits behind a prefix as 0xFF and 20 bytes.

    The same bytes as :func:`kassa.functions.privacy.packed`.
    """
    values = values.cast(pa.large_binary())
    at = np.frombuffer(values.buffers()[1], np.int64)[values.offset:values.offset + len(values) + 1]
    text = np.frombuffer(values.buffers()[2] or b"", np.uint8)
    size, rest = np.diff(at), np.ones(len(values), bool)
    for n in np.unique(size[(size > 40) & (size <= 48)]).tolist():
        places = np.flatnonzero(size == n)
        rows = text[at[places][:, None] + np.arange(n)]
        prefix, digits = rows[:, :n - 40], rows[:, n - 40:]
        number, letter = (digits >= ord("0")) & (digits <= ord("9")), (digits >= ord("A")) & (digits <= ord("F"))
        fits = ((prefix >= ord("A")) & (prefix <= ord("Z"))).all(1) & (number | letter).all(1)
        nibbles = np.where(number, digits - ord("0"), digits - ord("A") + 10)[fits]
        short = np.concatenate([prefix[fits], np.full((len(nibbles), 1), 255, np.uint8), nibbles[:, ::2] << 4 | nibbles[:, 1::2]], axis=1)
        rest[places[fits]] = False
        yield places[fits], pa.Array.from_buffers(pa.binary(n - 19), len(short), [None, pa.py_buffer(short.astype(np.uint8).tobytes())]).cast(pa.binary())
    yield np.flatnonzero(rest), values.filter(pa.array(rest)).cast(pa.binary())


def count_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The different values of each column in some tens of thousands of rows, with their counts."""

    def part(i: int, numbers: pa.Array | None, texts: pa.Array | None, counts: pa.Array) -> pa.RecordBatch:
        n = len(counts)
        return pa.RecordBatch.from_arrays([pa.array(np.full(n, i, np.int16)), pa.nulls(n, pa.float64()) if numbers is None else numbers,
                                           pa.nulls(n, pa.binary()) if texts is None else texts, counts], ["_i", "_d", "_v", "_c"])

    def counted(chunk: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(chunk)
        for i, column in enumerate(table.columns):
            values, counts = column.value_counts().flatten()
            if pa.types.is_floating(values.type):
                yield part(i, values, None, counts)
                continue
            there = values.is_valid()
            if values.null_count:
                yield part(i, None, None, counts.filter(values.is_null()))
            present, found = values.filter(there), counts.filter(there)
            for places, short in packed_values(present):
                if len(places):
                    yield part(i, None, short, found.take(pa.array(places)))

    chunk, rows, size = [], 0, 0
    for batch in batches:
        if batch.num_rows:
            chunk, rows, size = [*chunk, batch], rows + batch.num_rows, size + batch.nbytes
        if rows >= CHUNK_ROWS or size >= CHUNK_BYTES:
            yield from counted(chunk)
            chunk, rows, size = [], 0, 0
    if chunk:
        yield from counted(chunk)


def data_quality_report(df: DataFrame, focus_columns: Sequence[str] | None = None,
                        approx_distinct: bool = False) -> DataFrame:
    """Per column: pandas dtype label, missing count, missing % (2 dp,
    half-even), zero count (numeric and boolean columns only; false counts as
    zero), distinct non-null values. Unknown columns raise; the caller sorts
    (missing % desc).

    One scan: a task counts the values of each column in chunks of rows
    (:func:`count_cells`), and the (column, value) pairs are summed map-side
    and over all; missing, zero and distinct counts all follow from them.
    What is shuffled is short: eight bytes for a double, 20 for the 40 digits
    of a pseudonym. ``approx_distinct`` uses HyperLogLog++ and moves no values at all.
    ``row_rank`` orders by missing %, largest first, then as the columns stand.
    """
    cols = list(focus_columns) if focus_columns is not None else [c for c in df.columns if c != "_seq"]
    unknown = [c for c in cols if c not in df.columns]
    if unknown:
        raise KeyError(f"No such columns: {unknown}")
    types = {f.name: f.dataType for f in df.schema.fields}
    numeric = [isinstance(types[c], (T.BooleanType, T.NumericType)) for c in cols]
    names = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(pandas_dtype(types[c])).alias("dtype"), F.lit(n).alias("numeric"))
                      for c, n in zip(cols, numeric, strict=True)])

    def is_zero(c: str):
        return ~F.col(f"`{c}`") if isinstance(types[c], T.BooleanType) else F.col(f"`{c}`") == 0

    if approx_distinct:
        aggs = [F.count(F.lit(1)).cast("long").alias("_n")]
        for i, c in enumerate(cols):
            zero = F.count_if(is_zero(c)).cast("long") if numeric[i] else F.lit(None).cast("long")
            aggs += [F.count_if(F.col(f"`{c}`").isNull()).cast("long").alias(f"m{i}"), zero.alias(f"z{i}"),
                     F.approx_count_distinct(f"`{c}`").cast("long").alias(f"u{i}")]
        cells = F.explode(F.array(*[F.struct(F.lit(i).alias("_i"), F.col(f"m{i}").alias("missing_count"), F.col(f"z{i}").alias("zero_count"),
                                             F.col(f"u{i}").alias("unique_values")) for i in range(len(cols))])).alias("r")
        out = df.agg(*aggs).where(F.col("_n") > 0).select("_n", cells).select("_n", "r.*")
    else:
        cells = df.select(*[_canonical_value(c, types[c]).alias(f"c{i}") for i, c in enumerate(cols)]).mapInArrow(count_cells, CELL)
        counted = cells.groupBy("_i", "_d", "_v").agg(F.sum("_c").alias("_c"))
        missing = F.col("_d").isNull() & F.col("_v").isNull()
        numbers = F.col("_i").isin([i for i in range(len(cols)) if numeric[i]])
        zero = numbers & F.coalesce(F.col("_d") == 0, F.octet_length("_v") == 0, F.lit(False))
        out = counted.groupBy(F.col("_i").cast("int").alias("_i")).agg(
            F.sum("_c").cast("long").alias("_n"),
            F.coalesce(F.sum(F.when(missing, F.col("_c"))), F.lit(0)).cast("long").alias("missing_count"),
            F.coalesce(F.sum(F.when(zero, F.col("_c"))), F.lit(0)).cast("long").alias("zero_count"),
            F.count_if(~missing).cast("long").alias("unique_values"))
    named = out.withColumn("_c", F.element_at(names, F.col("_i") + 1))
    named = named.withColumn("zero_count", F.when(F.col("_c.numeric"), F.col("zero_count")))
    pct = F.bround(F.col("missing_count") / F.col("_n") * 100.0, 2)
    rank = F.row_number().over(Window.orderBy(F.col("missing_pct").desc(), "_i")).cast("long")  # one row a column
    return (named.withColumn("missing_pct", pct).withColumn("row_rank", rank)
                 .select("_c.column", "_c.dtype", "missing_count", "missing_pct", "zero_count", "unique_values", "row_rank"))
