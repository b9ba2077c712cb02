"""Corpus pipeline: from raw documents to token ids in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; its result is written as Parquet and read again as the next one's docs.
All but the last return the columns of ``documents``. A stage looks at the
columns ``doc_id`` and ``text`` only and passes others through; null texts
count as empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kassa.llm.bpe import round_trip_documents
from kassa.llm.common import fresh, read_table, stash, whole
from kassa.llm.decontaminate import SEGMENT_WORDS, clean_documents
from kassa.llm.line_dedup import drop_shared_lines
from kassa.llm.near_dedup import drop_near_duplicates
from kassa.llm.quality import fit_quality, keep_good
from kassa.llm.queries import tokenizer_path


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the byte-level network, fitted to the labels, gives 0.5 or more."""
    return keep_good(docs, fit_quality(docs, read_table(spark, sf_dir, "labels")))


def own_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten or more of them share; ``n_chars`` follows the text."""
    a, b = fresh(docs, "_lines"), fresh(docs, "_dropped")
    out = drop_shared_lines(docs, n_lines=a, n_dropped=b).drop(a, b)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the least doc_id, of each class of near duplicates."""
    return drop_near_duplicates(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item and no passage of one occurs."""
    return clean_documents(docs, read_table(spark, sf_dir, "benchmark"), segment_words=SEGMENT_WORDS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, token_ids, round_trip``: ids of each whole text, and whether they decode to it."""
    out = round_trip_documents(docs.select("doc_id", whole("text").alias("text")), tokenizer_path())
    return out.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids", (F.col("decoded") == F.col("text")).alias("round_trip"))


STAGES = [
    ("quality", good_quality),
    ("line_dedup", own_lines),
    ("near_dedup", one_of_each),
    ("decontamination", without_benchmark),
    ("bpe", tokens),
]

#: SQL expresses neither the network nor the weighted sampling; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = stash(docs)
    return docs
