"""Operator 13: secret scan with an incremental ledger of blobs.

Every version of every path is addressed by the SHA-256 of its content (its
blob). The ledger holds, for each blob, which rule versions have been run on it
and the spans they found. An update scans only the pairs of blob and rule
version that the ledger lacks: content met before, under whatever path or in
whatever earlier update, is not scanned again, and a changed rule is run alone.
Findings join back to every path and version that has the blob.

Equal contents meet map-side first, so a blob that a third of all rows share
crosses the shuffle once for each task. The way back moves digests and spans,
no text; its join salts blobs that many rows share.

Places come from the pieces between the matches: a match starts after all
pieces before it and all earlier matches, in code points. Running sums are
taken in blocks, so that a text of many matches costs no more than in
proportion. DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kassa.llm.common import stash, whole
from kassa.operators.joins import left_join_skew_safe
from kassa.session import new_path


class Rule(NamedTuple):
    """A kind of secret. Matches of ``pattern``, leftmost first and not overlapping, of which ``group`` has ``least`` characters."""
    kind: str
    pattern: str
    group: int
    least: int
    version: int = 1

    @property
    def id(self) -> str:
        return f"{self.kind}@{self.version}"


def either_case(pattern: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in pattern)


# --- fixed values: the rules; the first three are the base ---------------------
ASSIGNED = "password|passwd|secret|token|api_?key"
RULES = (
    Rule("assign", "(" + either_case(ASSIGNED) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),  # runs of 24 and more are the runs that stay
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 20),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 0),
)
BASE = ("assign", "access", "hex")
_SPANS = "array<struct<rule:string,start:int,end:int>>"
_ENTRY = f"blob string, rules array<string>, spans {_SPANS}"
_RUN = 256


def running(sizes: Column) -> Column:
    """Sums of all earlier elements, for each element."""
    def sums(values: Column) -> Column:
        start = F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("all"))
        return F.aggregate(values, start, lambda a, x: F.struct((a["sum"] + x).alias("sum"), F.concat(a["all"], F.array(a["sum"])).alias("all")))

    runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / _RUN).cast("int")), lambda k: sums(F.slice(sizes, k * _RUN + 1, _RUN)))

    def joined(rs: Column) -> Column:
        return F.flatten(F.zip_with(rs, sums(F.transform(rs, lambda r: r["sum"]))["all"], lambda r, s: F.transform(r["all"], lambda x: x + s)))
    return F.element_at(F.transform(F.array(runs), joined), 1)


def rule_spans(text: Column, rule: Rule) -> Column:
    """The rule's spans in a text: ``array<struct<rule, start, end>>``, code points, end exclusive."""
    pattern = F.lit(rule.pattern)
    sizes = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length)
    asked = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.length) if rule.group else sizes
    # a match begins where the pieces and matches before it, and the piece just before it, end
    between = F.transform(F.split(text, rule.pattern, -1), F.length)
    steps = F.zip_with(F.slice(between, 1, F.size(between) - 1), sizes, lambda gap, size: gap + size)
    ends = F.zip_with(running(steps), steps, lambda before, step: before + step)
    spans = F.zip_with(F.zip_with(ends, sizes, lambda e, s: F.struct(F.lit(rule.id).alias("rule"), (e - s).alias("start"), e.alias("end"))), asked,
                       lambda span, n: F.struct(span.alias("span"), n.alias("n")))
    kept = F.transform(F.filter(spans, lambda s: s["n"] >= rule.least), lambda s: s["span"])
    return F.when(F.regexp_like(text, pattern), kept).otherwise(F.array().cast(_SPANS))


class Ledger:
    """Which rule versions have been run on which blob, and what they found.

    A Parquet table at ``path`` in shared storage, to which updates append; a
    table of its own in the shared folder if no path is given.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, rules: Sequence[Rule] = RULES):
        self.spark, self.rules = spark, tuple(rules)
        self.path = path or new_path(spark, "ledger")

    def entries(self) -> DataFrame:
        """``blob, rules, spans``: a row for each blob and update that scanned it."""
        target = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not target.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(target):
            return self.spark.createDataFrame([], _ENTRY)
        return self.spark.read.schema(_ENTRY).parquet(self.path)

    def unseen(self, versions: DataFrame, text_col: str = "text") -> DataFrame:
        """``blob, text, todo``: contents with the rules that have not been run on them."""
        text = whole(text_col)
        blobs = versions.select(F.sha2(text, 256).alias("blob"), text.alias("text")).groupBy("blob").agg(F.first("text").alias("text"))
        every = F.array(*[F.lit(r.id) for r in self.rules])
        entries = self.entries()
        if entries.isEmpty():
            return blobs.withColumn("todo", every)
        seen = entries.groupBy("blob").agg(F.flatten(F.collect_list("rules")).alias("seen"))
        todo = F.array_except(every, F.coalesce("seen", F.array().cast("array<string>")))
        return blobs.join(seen, "blob", "left").select("blob", "text", todo.alias("todo")).where(F.size("todo") > 0)

    def update(self, versions: DataFrame, text_col: str = "text") -> None:
        """Scan what the ledger lacks. Null text is the empty content."""
        spans = [F.when(F.array_contains("todo", r.id), rule_spans(F.col("text"), r)).otherwise(F.array().cast(_SPANS)) for r in self.rules]
        found = self.unseen(versions, text_col).select("blob", F.col("todo").alias("rules"), F.concat(*spans).alias("spans"))
        found.write.mode("append").parquet(self.path)

    def found(self) -> DataFrame:
        """``blob, spans``: blobs with any span of the current rules, in order of start, then rule."""
        place = F.array(*[F.lit(r.id) for r in self.rules])
        kinds = F.array(*[F.lit(r.kind) for r in self.rules])
        spans = F.flatten(F.collect_set("spans"))  # an update that was run twice says the same twice
        rows = self.entries().where(F.size("spans") > 0).groupBy("blob").agg(F.array_distinct(spans).alias("spans"))
        current = F.filter("spans", lambda s: F.array_contains(place, s["rule"]))
        order = F.array_sort(F.transform(current, lambda s: F.struct(s["start"].alias("start"), F.array_position(place, s["rule"]).cast("int").alias("rule"), s["end"].alias("end"))))
        named = F.transform(order, lambda s: F.struct(F.element_at(kinds, s["rule"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
        return rows.select("blob", named.alias("spans")).where(F.size("spans") > 0)

    def paths(self, versions: DataFrame, id_cols: Sequence[str] = ("doc_id",), text_col: str = "text") -> DataFrame:
        """Each version's ``id_cols`` with ``blob`` and ``spans`` (null where none); all rows, repeated ones too."""
        named = versions.select(*[F.col(f"`{c}`").alias(f"id{k}") for k, c in enumerate(id_cols)], F.sha2(whole(text_col), 256).alias("blob"))
        met = left_join_skew_safe(stash(named), stash(self.found()), "blob", "blob")
        return met.select(*[F.col(f"id{k}").alias(c) for k, c in enumerate(id_cols)], "blob", "spans")


def scan_secrets(versions: DataFrame, ledger: Ledger | None = None, id_cols: Sequence[str] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """Scan all versions that ``ledger`` does not know, and return every version's findings.

    ``id_cols`` (as they are), ``blob`` (hex SHA-256 of the content), ``spans``:
    ``array<struct<kind, start, end>>`` by start, then rule; empty without
    findings. Null text is the empty text. Repeated rows stay; columns other
    than ``id_cols`` and the text are ignored whatever their names. An empty
    table gives an empty result.
    """
    ledger = ledger or Ledger(versions.sparkSession)
    ledger.update(versions, text_col)
    out = ledger.paths(versions, id_cols, text_col)
    return out.withColumn("spans", F.coalesce("spans", F.array().cast("array<struct<kind:string,start:int,end:int>>")))


def secret_report(docs: DataFrame) -> DataFrame:
    """Per document: ``doc_id, n_assign, n_access, n_hex, base_sha256, spans``."""
    def text(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [(F.size("spans") - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in BASE]
    return scan_secrets(docs).select("doc_id", *counts, F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))


def secret_sql() -> str:
    """SQL twin: every document scanned by itself."""
    kinds = []
    for k, r in enumerate(RULES):
        p = "'" + r.pattern.replace("'", "''") + "'"
        kinds.append(f"""SELECT row_id, {k} AS k, '{r.kind}' AS kind, string_split_regex(text, {p}) AS ps, regexp_extract_all(text, {p}, 0) AS ms,
                         regexp_extract_all(text, {p}, {r.group}) AS vs, {r.least} AS least FROM d""")
    return f"""
        WITH d AS (SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text FROM documents),
        m AS ({' UNION ALL '.join(kinds)}),
        e AS (SELECT row_id, k, kind, ms, vs, least, ps, unnest(range(1, len(ms) + 1)) AS i FROM m WHERE len(ms) > 0),
        s AS (SELECT row_id, k, kind, list_sum(list_transform(ps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS a,
                     length(ms[i]) AS n FROM e WHERE length(vs[i]) >= least),
        j AS (SELECT row_id, count(*) FILTER (WHERE k = 0) AS n_assign, count(*) FILTER (WHERE k = 1) AS n_access, count(*) FILTER (WHERE k = 2) AS n_hex,
                     string_agg(kind || ':' || a::BIGINT || ':' || (a + n)::BIGINT, ',' ORDER BY a, k) FILTER (WHERE k < {len(BASE)}) AS base,
                     string_agg(kind || ':' || a::BIGINT || ':' || (a + n)::BIGINT, ',' ORDER BY a, k) AS spans
              FROM s GROUP BY row_id)
        SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
               sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM d LEFT JOIN j USING (row_id)"""
