"""Operator 11: Merkle manifest of a dataset, by nested-struct rollup.

Every row is a leaf; the leaves of one group (source) form a tree in the order
of their ids, and the groups' roots form one tree above them. A node is the
hash of up to three consecutive nodes below it.

**Ranks.** Distinct rows are counted, range-partitioned by (group, id, leaf),
sorted and stored. A row's rank in its group is its place in the partition's
run of that group plus the rows that earlier partitions hold of the group; the
table of those sums has one row for each partition and group that meet.

**Rollup.** In base 3 a rank is a block number and five digits. Rows of a block
(243 at most) meet in one task. Grouping by all digits but the last collects
the up to three children of a node in an array of structs and hashes them;
grouping the next digit away nests those structs, and so on until a block is
one row that holds its whole subtree. The blocks' hashes are the leaves of the
next pass, until each group has one block. The number of passes grows with the
logarithm of the largest group; no row ever holds more than one block.

**Proofs.** Nested transforms walk a block's subtree from the top and carry the
siblings met so far; exploding their result gives one row for each leaf with
its path inside the block. What lies above a block (its own path in the pass
above) is put beside it by grouping the union of both tables on the block; no
joins.

DataFrame functions only. Text is read once and leaves its task as two digests.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kassa.llm.common import stash
from kassa.operators.joins import sized_broadcast

ARITY, DIGITS = 3, 5
BLOCK = ARITY ** DIGITS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_LOW_BITS = (1 << 33) - 1
_NO_STEP = "array<struct<left:string,right:string>>"


def field(value: Column) -> Column:
    """One value as part of a leaf: ``-`` for null, else its length in bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def ranked(rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """``rows`` (all different) plus ``idx``, the rank from 0 within ``key`` by ``order``, and ``n``, the key's rows."""
    by = [F.col(c).asc_nulls_first() for c in (key, *order)]
    placed = rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id())
    placed = stash(placed).withColumns({"_part": F.shiftright("_at", 33), "_at": F.col("_at").bitwiseAND(F.lit(_LOW_BITS))})
    runs = placed.groupBy(key, "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    of_key = Window.partitionBy(key)
    earlier = of_key.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = stash(runs.select(F.col(key).alias("_key"), F.col("_part").alias("_run"),
                             (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
                             F.sum("_rows").over(of_key).alias("n")))
    # a row for each partition and key that meet; a key's rows of one partition are the most that one value joins
    on = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_part") == F.col("_run"))
    return (placed.join(sized_broadcast(runs), on)
                  .select(*rows.columns, (F.col("_at") + F.col("_shift")).alias("idx"), "n"))


def nest(rows: DataFrame) -> DataFrame:
    """One row for each block of ``rows`` (``key, idx, n, node``): ``key, block, n, node``.

    A node is ``struct(h, what)`` at the bottom and ``struct(h, kids)`` above.
    Where one node is all that a key has left, it goes up unhashed.
    """
    digits = [f"d{i}" for i in range(DIGITS)]
    cur = rows.select("key", F.expr(f"idx div {BLOCK}").alias("block"), "n", "node",
                      *[F.expr(f"idx div {ARITY ** i} % {ARITY}").cast("int").alias(d) for i, d in enumerate(digits)])
    cur = cur.repartition("key", "block")  # serves all groupings below
    for i, digit in enumerate(digits):
        kids = F.array_sort(F.collect_list(F.struct(F.col(digit).alias("d"), F.col("node").alias("node"))))
        grouped = cur.groupBy("key", "block", "n", *digits[i + 1:]).agg(kids.alias("kids"))
        joined = F.sha2(F.array_join(F.transform("kids", lambda k: k["node"]["h"]), ""), 256)
        h = F.when(F.col("n") <= ARITY ** i, F.col("kids")[0]["node"]["h"]).otherwise(joined)
        cur = grouped.select("key", "block", "n", *digits[i + 1:], F.struct(h.alias("h"), F.col("kids")).alias("node"))
    return cur


def walk(node: Column, level: int, path: Column) -> Column:
    """All leaves under ``node`` as an array of ``struct(h, what, path)``; paths run from the leaf up."""
    if level == 0:
        return F.array(F.struct(node["h"].alias("h"), node["what"].alias("what"), path.alias("path")))
    hashes = F.transform(node["kids"], lambda k: k["node"]["h"])

    def step(j: Column) -> Column:
        sides = F.struct(F.array_join(F.slice(hashes, 1, j), "").alias("left"), F.array_join(F.slice(hashes, j + 2, ARITY), "").alias("right"))
        return F.when(F.col("n") <= ARITY ** (level - 1), F.array().cast(_NO_STEP)).otherwise(F.array(sides))

    return F.flatten(F.transform(node["kids"], lambda k, j: walk(k["node"], level - 1, F.concat(step(j), path))))


def roll_up(rows: DataFrame, most: int) -> list[DataFrame]:
    """The passes from the leaves up, each one row a block; ``most`` is the largest ``n``."""
    passes = [stash(nest(rows))]
    while most > BLOCK:
        most = -(-most // BLOCK)
        below = passes[-1]
        up = below.select("key", F.col("block").alias("idx"), F.ceil(F.col("n") / BLOCK).cast("long").alias("n"),
                          F.struct(F.col("node.h").alias("h"), F.struct("block").alias("what")).alias("node"))
        passes.append(stash(nest(up)))
    return passes


def roll_down(passes: list[DataFrame], above: DataFrame) -> DataFrame:
    """Leaves of the lowest pass: ``key, h, what, path, subroot, root``.

    ``above`` has for each key what lies over its one top block: ``key, block, path, subroot, root``.
    """
    for k, blocks in enumerate(reversed(passes)):
        both = blocks.unionByName(above, allowMissingColumns=True)
        met = both.groupBy("key", "block").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("n", "node", "path", "subroot", "root")])
        below = met.select("key", F.explode(walk(F.col("node"), DIGITS, F.array().cast(_NO_STEP))).alias("leaf"),
                           F.col("path").alias("over"), "subroot", "root")
        found = below.select("key", "leaf.h", "leaf.what", F.concat("leaf.path", "over").alias("path"), "subroot", "root")
        if k < len(passes) - 1:
            above = found.select("key", F.col("what.block").alias("block"), "path", "subroot", "root")
    return found


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "source", fields: Sequence[str] = FIELDS,
             seen: Mapping[str, Column] | None = None) -> DataFrame:
    """Every row's leaf and its proof: ``doc_id, leaf, seen_leaf, subroot, root, path``.

    ``path`` is an array of ``struct(left, right)`` from the leaf to the root:
    the siblings' digests joined on either side. ``seen`` replaces fields by
    other values, for the leaf as it is found later (``seen_leaf``). Leaves of
    a group ascend by id, nulls first, rows of one id by their leaf; repeated
    rows are leaves of their own. A null group is a group (the first). Columns
    that are not fields are ignored, whatever their names; an empty table gives
    an empty result.
    """
    # no fixed names may meet the table's own: everything is picked by expression
    plain = [F.col(f"`{c}`") for c in fields]
    later = [(seen or {}).get(c, F.col(f"`{c}`")) for c in fields]
    leaf = leaf_hash(plain)
    rows = docs.select(F.col(f"`{group_col}`").alias("key"), F.col(f"`{id_col}`").alias("id"), leaf.alias("leaf"), leaf_hash(later).alias("seen"))
    # repeated rows are one row with a number until the order is cut into ranges, which their copies may straddle
    rows = stash(rows.groupBy("key", "id", "leaf", "seen").agg(F.count(F.lit(1)).alias("copies")))
    rows = rows.select("key", "id", "leaf", "seen", F.explode(F.expr("sequence(1L, copies)")).alias("copy"))
    leaves = ranked(rows, "key", ["id", "leaf", "seen", "copy"])
    leaves = leaves.select("key", "idx", "n", F.struct(F.col("leaf").alias("h"), F.struct("id", "seen").alias("what")).alias("node"))
    most = leaves.agg(F.max("n")).first()[0] or 0
    trees = roll_up(leaves, most)

    tops = trees[-1].select(F.lit(0).alias("all"), "key", F.col("node.h").alias("h"))
    groups = ranked(tops, "all", ["key"]).select(
        F.col("all").alias("key"), "idx", "n", F.struct("h", F.struct(F.col("key").alias("of")).alias("what")).alias("node"))
    crown = roll_up(groups, groups.agg(F.max("n")).first()[0] or 0)
    over = crown[-1].select("key", "block", F.array().cast(_NO_STEP).alias("path"), F.lit("").alias("subroot"), F.col("node.h").alias("root"))
    over = roll_down(crown, over).select(F.col("what.of").alias("key"), F.lit(0).cast("long").alias("block"), "path", F.col("h").alias("subroot"), "root")
    return roll_down(trees, over).select(F.col("what.id").alias("doc_id"), F.col("h").alias("leaf"), F.col("what.seen").alias("seen_leaf"),
                                         "subroot", "root", "path")


def manifest_report(docs: DataFrame) -> DataFrame:
    """Proofs of ``documents``, checked against rows of which some have lost their line feeds.

    Tampered are the rows of which crc32 of the decimal id is even (none with
    a null id): ``\\n`` is deleted from their text. Returns ``doc_id, leaf,
    subroot, root, proof_sha256, folded_root, verified``.
    """
    even = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.lit(False))
    cut = F.when(even, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    proofs = manifest(docs, seen={"text": cut})
    siblings = F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "")
    return (proofs.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"),
                          fold(F.col("seen_leaf"), F.col("path")).alias("folded_root"))
                  .withColumn("verified", F.col("folded_root") == F.col("root")))


def manifest_sql() -> str:
    """SQL twin: the levels by a recursive query, one row for each document."""
    def leaf(text: str) -> str:
        parts = ", ".join(f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c}::VARCHAR END"
                          for c in ("doc_id", "source", "lang", "n_chars", text))
        return f"sha256(concat({parts}))"

    def levels(name: str, start: str, part: str) -> str:
        digit = "CASE WHEN i % 3 = {d} THEN h END"
        h = [f"coalesce(max({digit.format(d=d)}) OVER w, '')" for d in range(3)]
        sides = " || ".join(f"CASE WHEN i % 3 = {d} THEN '' ELSE {h[d]} END" for d in range(3))
        seen = ", ".join(f"CASE WHEN i % 3 = {d} THEN s ELSE {h[d]} END" for d in range(3))
        return f"""{name} AS (
            SELECT row_id, doc_id, leaf, g, i, n, h, s, proof FROM {start}
            UNION ALL
            SELECT row_id, doc_id, leaf, g, i // 3, (n + 2) // 3, sha256(concat({', '.join(h)})), sha256(concat({seen})), proof || {sides}
            FROM {name} WHERE n > 1 WINDOW w AS (PARTITION BY {part}i // 3))"""

    crc = """list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
                 lambda a, b: list_reduce(range(8), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)), xor(a, b)), 4294967295)"""
    return f"""
        WITH RECURSIVE d AS (SELECT row_number() OVER () AS row_id, *, CASE WHEN xor({crc}, 4294967295) % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS cut
                             FROM documents),
        l AS (SELECT row_id, doc_id, source AS g, {leaf('text')} AS leaf, {leaf('cut')} AS s FROM d),
        l0 AS (SELECT *, leaf AS h, '' AS proof, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
                      count(*) OVER (PARTITION BY g) AS n FROM l),
        {levels('t', 'l0', 'g, ')},
        top AS (SELECT * FROM t WHERE n = 1),
        r AS (SELECT g, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS k, count(*) OVER () AS m FROM (SELECT DISTINCT g FROM top)),
        u0 AS (SELECT row_id, doc_id, leaf, top.g, k AS i, m AS n, h, s, proof FROM top JOIN r ON top.g IS NOT DISTINCT FROM r.g),
        {levels('u', 'u0', '')}
        SELECT u.doc_id, u.leaf, top.h AS subroot, u.h AS root, sha256(u.proof) AS proof_sha256, u.s AS folded_root, u.s = u.h AS verified
        FROM u JOIN top USING (row_id) WHERE u.n = 1"""
