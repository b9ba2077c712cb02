"""Operator 6: exact deduplication by deterministic block naming.

Every text is cut into fixed-size blocks. Blocks are compared by content: the
blocks that occur more than once are sorted, and their place in the order is
their integer name. Then adjacent pairs of names are named in the same way,
level after level, until every document is left with one name. Two documents
have the same (level, name) exactly when their texts are equal; no hash takes
part, so no collision can join different texts.

A block (or pair) that occurs once settles its document: no other text can be
equal, so the document leaves with an identity of its own and later levels see
only documents whose every block has a twin.

DataFrame operations only. Text crosses the shuffle twice (counting blocks,
handing their names back); all later levels move integers. Counts combine
map-side and the names come back through plain joins whose hot keys AQE can
split, so a block or a group that holds a third of all rows is never gathered
in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kassa.llm.common import stash, whole

BLOCK_CHARS = 4096


def name_repeated(rows: DataFrame, key: list[str], short: list[Column] | None = None) -> DataFrame:
    """Integer names, in sort order, of the keys that occur in more than one row.

    ``short`` are small values that range-partition the keys in place of the
    keys themselves, of which the driver would be sent a sample.
    """
    repeated = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    ordered = repeated.repartitionByRange(*(short or key)).sortWithinPartitions(*(short or []), *key)
    return stash(ordered.withColumn("name", F.monotonically_increasing_id()))


def document_identities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per distinct (id, text): ``doc_id, text_sha256, level, name, n``.

    ``level, name`` identify the text among all texts that have a twin; both
    are null for a text that no other row has. ``n`` counts repeated rows of
    the same id and text. Null text is the empty text (one empty block); a
    null id is a value like any other. Other columns are ignored.
    """
    text = whole(text_col)
    cut = F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % block_chars), 0)
    rows = (docs.select(F.col(id_col).alias("doc_id"), F.unhex(F.sha2(text, 256)).alias("sha"),
                        F.when(text == "", F.array(F.lit(""))).otherwise(cut).alias("blocks"))
                .select("doc_id", "sha", F.posexplode("blocks").alias("idx", "block")))
    names = name_repeated(rows, ["block"], [F.substring("block", 1, 16), F.xxhash64("block")])
    named = rows.join(names, "block", "left").select("doc_id", "sha", "idx", "name")
    doc = ["doc_id", "sha"]
    # repeated rows of one document meet here and only their number goes on
    level = stash(named.groupBy(*doc, "idx").agg(F.first("name").alias("name"), F.count(F.lit(1)).alias("n")))
    done, depth = [], 0
    while True:
        alone = (level.groupBy(*doc).agg(F.max(F.col("name").isNull()).alias("unique"), F.max("idx").alias("last"),
                                         F.max("n").alias("n"), F.max("name").alias("name")))
        ended = alone.where("unique or last = 0")
        done.append(ended.select(*doc, F.when(~F.col("unique"), F.lit(depth)).alias("level"),
                                 F.when(~F.col("unique"), F.col("name")).alias("name"), "n"))
        # pairs of adjacent names; -1 stands for the missing right side of an odd tail
        even = F.col("idx") % 2 == 0
        going = (level.groupBy(*doc, F.expr("idx div 2").cast("int").alias("idx"))
                      .agg(F.max(F.when(even, F.col("name"))).alias("a"),
                           F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1)).alias("b"),
                           F.max(F.col("name").isNull()).alias("gone"), F.max("n").alias("n"),
                           F.max(F.when(~even, 1).otherwise(0)).alias("two")))
        on = (F.col("l.doc_id").eqNullSafe(F.col("r.doc_id"))) & (F.col("l.sha") == F.col("r.sha"))
        going = going.alias("l").join(alone.where("not unique and last > 0").select(*doc).alias("r"), on, "left_semi")
        pairs = stash(going.select("doc_id", "sha", "idx", "a", "b", "n"))
        if pairs.isEmpty():
            break
        names = name_repeated(pairs, ["a", "b"])
        level = stash(pairs.join(names, ["a", "b"], "left").select(*doc, "idx", "name", "n"))
        depth += 1
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return stash(out.select("doc_id", F.lower(F.hex("sha")).alias("text_sha256"), "level", "name", "n"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Duplicate groups of equal texts; the row with the largest id stays.

    Returns one row per input row: ``doc_id, keep_id, group_size, kept,
    text_sha256``. Rows that repeat an id with the same text count in the
    group's size; exactly one of them is kept. Null ids sort below all others.
    An empty table gives an empty result.
    """
    ids = document_identities(docs, id_col, text_col, block_chars)
    single = ids.where("name is null").select("doc_id", F.col("doc_id").alias("keep_id"),
                                              F.col("n").alias("group_size"), "n", "text_sha256")
    twins = ids.where("name is not null")
    groups = stash(twins.groupBy("level", "name").agg(F.max("doc_id").alias("keep_id"), F.sum("n").alias("group_size")))
    shared = twins.join(groups, ["level", "name"]).select("doc_id", "keep_id", "group_size", "n", "text_sha256")
    copies = F.explode(F.expr("sequence(1L, n)")).alias("copy")
    return (single.unionByName(shared).select("*", copies)
                  .select("doc_id", "keep_id", F.col("group_size").cast("long").alias("group_size"),
                          (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"), "text_sha256"))
