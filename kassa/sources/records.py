"""CSV records from files read in splits, line breaks inside quotes included.

A split of a file cannot know whether it begins inside a quoted field. Here
every split is scanned for both cases: does it end inside quotes if it begins
outside, does it if it begins inside, and how many records begin in it. These
answers, one row for each split, compose along a file: a prefix scan over them
fixes where each split stands, and which number its first record has. Then all
splits assemble their records in parallel; a record that crosses the end of its
split is put together from the fragments of the splits it touches.

The text reader delivers a split's lines in order; a line's effect (its end for
both cases) and the walk over a split's lines run in Python, on whole Arrow
batches. Whole records are parsed by ``from_csv``.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kassa.operators.common import stored

# the functions below travel to Python workers by value, so executors need no copy of the repository
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PLAIN, INSIDE, OUTSIDE = 0, 1, 2
#: what a quote does to the three states: after a comma, after another quote or at the line's begin, after other text
AFTER_COMMA, AFTER_QUOTE, AFTER_TEXT = (INSIDE, OUTSIDE, INSIDE), (PLAIN, OUTSIDE, INSIDE), (PLAIN, OUTSIDE, PLAIN)
SUMMARY = "path string, block long, end0 boolean, end1 boolean, starts0 long, starts1 long"
RECORD = "path string, owner long, block long, n long, whole boolean, text string"
CSV_OPTIONS = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": "true"}


def line_ends(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """For each line whether it ends inside quotes, if it begins outside and if it begins inside.

    A quote opens a field at the field's beginning, and a doubled quote stays
    inside; any other quote of an unquoted field is text (``PLAIN``). What a
    quote does is a map of states; the maps of a line's quotes are composed in
    pairs until one is left.
    """
    lines = lines.cast(pa.large_string())
    at = np.frombuffer(lines.buffers()[1], np.int64)[lines.offset:lines.offset + len(lines) + 1]
    text = np.frombuffer(lines.buffers()[2] or b"", np.uint8)[at[0]:at[-1]]
    at = at - at[0]
    quotes = np.flatnonzero(text == ord('"'))
    line = np.searchsorted(at, quotes, "right") - 1
    before = np.where(quotes == at[line], ord('"'), text[quotes - 1])
    maps = np.array([AFTER_TEXT, AFTER_QUOTE, AFTER_COMMA], np.int8)[(before == ord('"')) + 2 * (before == ord(","))]
    while len(line):
        first = np.concatenate([[True], line[1:] != line[:-1]])
        place = np.arange(len(line)) - np.maximum.accumulate(np.where(first, np.arange(len(line)), 0))
        left = np.flatnonzero(place % 2 == 0)
        if len(left) == len(line):  # one map a line
            break
        paired = left + 1 < len(line)
        paired[paired] = place[left[paired] + 1] % 2 == 1
        maps[left[paired]] = np.take_along_axis(maps[left[paired] + 1], maps[left[paired]], 1)
        maps, line = maps[left], line[left]
    end0, end1 = np.zeros(len(lines), bool), np.ones(len(lines), bool)
    end0[line], end1[line] = maps[:, OUTSIDE] == INSIDE, maps[:, INSIDE] == INSIDE
    return end0, end1


def line_flags(lines: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``line_ends`` and whether a line is blank."""
    return *line_ends(lines), pc.is_in(lines, pa.array(["", "\r"], lines.type)).to_numpy(zero_copy_only=False)


def file_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``path, block, line``: the lines of each split in order."""
    text = spark.read.option("lineSep", "\n").text(list(paths))
    return text.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line"))


def states(end0: np.ndarray, end1: np.ndarray, start: bool) -> np.ndarray:
    """State after each line: lines whose end is the same in both cases reset it, the others keep or turn it."""
    at = np.arange(len(end0))
    turns = np.cumsum(end0 & ~end1)
    last = np.maximum.accumulate(np.where(end0 == end1, at, -1))
    turned = (turns - np.where(last >= 0, turns[last], 0)) % 2 == 1
    return np.where(last >= 0, end0[last], start) ^ turned


def split_runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, pa.RecordBatch]]:
    """The runs of rows of one split."""
    path, block = batch.column("path"), batch.column("block")
    n = batch.num_rows
    if n == 0:
        return
    new = np.ones(n, bool)
    new[1:] = pc.or_(pc.not_equal(path.slice(1), path.slice(0, n - 1)), pc.not_equal(block.slice(1), block.slice(0, n - 1))).to_numpy(zero_copy_only=False)
    at = np.flatnonzero(new).tolist()
    for i, j in zip(at, [*at[1:], n], strict=True):
        yield path[i].as_py(), block[i].as_py(), batch.slice(i, j - i)


def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each split: its end and the records that begin in it, for both states at its start."""
    done: dict[tuple[str, int], list] = {}
    for batch in batches:
        for path, block, rows in split_runs(batch):
            end0, end1, blank = line_flags(rows.column("line"))
            now = done.setdefault((path, block), [False, True, 0, 0])
            for case in (0, 1):
                after = states(end0, end1, now[case])
                before = np.concatenate([[now[case]], after[:-1]])
                now[case] = bool(after[-1])
                now[2 + case] += int((~before & ~blank).sum())
    rows = [(p, b, *x) for (p, b), x in done.items()]
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 6, (pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64()), strict=True)],
                                     ["path", "block", "end0", "end1", "starts0", "starts1"])


def split_states(summary: DataFrame) -> DataFrame:
    """``path, block, inside, leaves, owner, first``: the prefix scan over each file's splits.

    ``inside``: the split begins inside quotes, in a record that began in the
    split ``owner``; ``leaves``: it ends inside quotes; ``first`` is the number in the file of the first record
    that begins in it. One row for each split, so a file's rows are few.
    """
    w = Window.partitionBy("path").orderBy("block")
    earlier = w.rowsBetween(Window.unboundedPreceding, -1)
    turns = F.sum(F.when(F.col("end0") & ~F.col("end1"), 1).otherwise(0))
    reset = F.last(F.when(F.col("end0") == F.col("end1"), F.struct("end0", "turns")), ignorenulls=True)
    out = summary.withColumn("turns", turns.over(w))
    out = out.withColumns({"_reset": reset.over(earlier), "_turns": F.coalesce(F.lag("turns").over(w), F.lit(0))})
    turned = (F.col("_turns") - F.coalesce("_reset.turns", F.lit(0))) % 2 == 1
    out = out.withColumn("inside", F.coalesce("_reset.end0", F.lit(False)) != turned)
    out = out.withColumn("starts", F.when(F.col("inside"), F.col("starts1")).otherwise(F.col("starts0")))
    leaves = F.when(F.col("inside"), F.col("end1")).otherwise(F.col("end0")).alias("leaves")
    return out.select("path", "block", "inside", leaves, F.last(F.when(F.col("starts") > 0, F.col("block")), ignorenulls=True).over(earlier).alias("owner"),
                      F.coalesce(F.sum("starts").over(earlier), F.lit(0)).alias("first"), "starts")


class Assembler:
    """Turns the lines of one split, as they come, into records and fragments."""

    def __init__(self, path: str, block: int, inside: bool, owner: int | None, first: int):
        self.path, self.block, self.state, self.n = path, block, inside, first
        self.open = [owner, None, []] if inside else None  # split of the record's begin, its number, its lines

    def feed(self, rows: pa.RecordBatch) -> list[tuple]:
        line = rows.column("line")
        end0, end1, blank = line_flags(line)
        after = states(end0, end1, self.state)
        before = np.concatenate([[self.state], after[:-1]])
        self.state = bool(after[-1])
        starts = ~before & ~blank
        number = self.n + np.cumsum(starts) - 1
        self.n += int(starts.sum())
        single = starts & ~after
        out = [(self.block, int(n), True, t) for n, t in zip(number[single].tolist(), line.filter(pa.array(single)).to_pylist(), strict=True)]
        rest = before | (starts & after)
        for begins, ends, n, t in zip(starts[rest].tolist(), (~after[rest]).tolist(), number[rest].tolist(), line.filter(pa.array(rest)).to_pylist(), strict=True):
            if begins:
                self.open = [self.block, n, []]
            self.open[2].append(t)
            if ends:
                out.append((self.open[0], self.open[1], self.open[1] is not None, "\n".join(self.open[2])))
                self.open = None
        return out

    def close(self) -> list[tuple]:
        """What the split leaves open."""
        return [(self.open[0], self.open[1], False, "\n".join(self.open[2]))] if self.open and self.open[2] else []


def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows(split: Assembler, found: list[tuple]) -> pa.RecordBatch:
        owner, n, whole, text = zip(*found, strict=True)
        size = len(found)
        return pa.RecordBatch.from_arrays([pa.array([split.path] * size, pa.string()), pa.array(owner, pa.int64()), pa.array([split.block] * size, pa.int64()),
                                           pa.array(n, pa.int64()), pa.array(whole, pa.bool_()), pa.array(text, pa.string())],
                                          ["path", "owner", "block", "n", "whole", "text"])

    split = None
    for batch in batches:
        for path, block, run in split_runs(batch):
            if split is None or (split.path, split.block) != (path, block):
                if split is not None and (left := split.close()):
                    yield rows(split, left)
                split = Assembler(path, block, *(run.column(c)[0].as_py() for c in ("inside", "owner", "first")))
            if found := split.feed(run):
                yield rows(split, found)
    if split is not None and (left := split.close()):
        yield rows(split, left)


def read_records(spark: SparkSession, paths: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(records, splits): every record of the files as text, and the scan's table.

    Records: ``path, n, text`` with ``n`` the record's number in its file, from
    0 (the header); empty lines between records are no records. A split of any
    file is one task, wherever it begins. ``splits`` has a row for each split.
    """
    lines = file_lines(spark, paths)
    splits = stored(split_states(lines.mapInArrow(summarise, SUMMARY)), "splits")
    # one row for each split of some 100 MB: small beside what one task reads
    placed = lines.join(F.broadcast(splits.drop("starts", "leaves")), ["path", "block"])
    found = placed.mapInArrow(assemble, RECORD)
    # fragments come only from splits that a record crosses into or out of; no other split passes through Python for them
    crossed = splits.where("inside or leaves").select("path", "block")
    fragments = placed.join(F.broadcast(crossed), ["path", "block"], "left_semi").mapInArrow(assemble, RECORD).where(~F.col("whole"))
    joined = (fragments.groupBy("path", "owner").agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("block", "text"))).alias("parts"))
                       .select("path", "n", F.array_join(F.transform("parts", lambda p: p["text"]), "\n").alias("text")))
    records = found.where("whole").select("path", "n", "text").unionByName(joined)
    text = F.when(F.col("text").endswith("\r"), F.expr("substring(text, 1, length(text) - 1)")).otherwise(F.col("text"))
    return records.withColumn("text", text), splits


def parse_records(records: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Records as text columns (``path, n`` and the named ones), the header left out."""
    schema = ", ".join(f"c{i} STRING" for i in range(len(columns)))
    parsed = records.where("n > 0").select("path", "n", F.from_csv("text", F.lit(schema), CSV_OPTIONS).alias("c"))
    return parsed.select(*[F.col(f"c.c{i}").alias(c) for i, c in enumerate(columns)], F.col("path").alias("_path"), F.col("n").alias("_n"))
