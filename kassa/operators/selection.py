"""Order statistics by narrowing, without sorting.

The value at a rank is bracketed by a quantile sketch of the rows still in
question, exact counts then fix how many rows lie below the bracket and on its
ends, and the next round looks only between the ends. Each round leaves a few
thousandths of the rows, so a handful of passes over the narrow columns finds
the cuts of any number of rows; all measures and ranks share the passes. What
is left of a bracket at last, at most ``SMALL`` different values, is read off.

Where many rows have the value at a cut, the rank goes on among their keys:
counts by ever longer prefixes follow the one that holds it.

Aggregates only: nothing is shuffled but partial results, nothing is ordered.
"""

from __future__ import annotations

import os
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kassa.functions.clean import ceil_div

SMALL = 10_000
ACCURACY = 10_000  # of the sketch: ranks are off by one in so many at most


class Cut(NamedTuple):
    """The value at a rank (from 1, ascending)."""
    value: float
    below: int  # rows of smaller values


class _Search:
    """A rank of a column: it lies strictly between ``lo`` and ``hi``, where ``inside`` rows are, after ``below`` others."""

    def __init__(self, column: str, rank: int, rows: int):
        self.column, self.rank, self.below, self.inside = column, rank, 0, rows
        self.lo = self.hi = self.found = None

    def open(self) -> Column:
        c = F.col(self.column)
        cond = c.isNotNull()
        if self.lo is not None:
            cond = cond & (c > F.lit(self.lo))
        return cond if self.hi is None else cond & (c < F.lit(self.hi))


def values_at_ranks(df: DataFrame, wants: dict[str, Sequence[int]], small: int = SMALL) -> dict[str, dict[int, Cut]]:
    """For each numeric column the values at its ranks (1 to the number of its values that are not null)."""
    columns = [c for c in wants if wants[c]]
    if not columns:
        return {c: {} for c in wants}
    rows = df.agg(*[F.count(c).alias(f"n{i}") for i, c in enumerate(columns)]).first()
    todo = [_Search(c, int(r), rows[i]) for i, c in enumerate(columns) for r in sorted(set(wants[c]))]
    out: dict[str, dict[int, Cut]] = {c: {} for c in wants}
    while wide := [s for s in todo if s.found is None and s.inside > small]:
        _narrow(df, wide)
    _read_off(df, [s for s in todo if s.found is None])
    for s in todo:
        out[s.column][s.rank] = Cut(s.found, s.below)
    return out


def _narrow(df: DataFrame, searches: list[_Search]) -> None:
    # sketch of each bracket, asked a little below and above the rank
    asked = []
    for s in searches:
        p, e = (s.rank - s.below) / s.inside, 3 / ACCURACY
        asked.append(F.percentile_approx(F.when(s.open(), F.col(s.column)), [max(0.0, p - e), min(1.0, p + e)], ACCURACY))
    ends = df.agg(*[a.alias(f"q{i}") for i, a in enumerate(asked)]).first()
    counts = []
    for i, s in enumerate(searches):
        a, b = ends[i]
        c = F.col(s.column)
        for k, cond in enumerate((c < F.lit(a), c == F.lit(a), (c > F.lit(a)) & (c < F.lit(b)), c == F.lit(b))):
            counts.append(F.count_if(s.open() & cond).alias(f"c{i}_{k}"))
    n = df.agg(*counts).first()
    for i, s in enumerate(searches):
        a, b = ends[i]
        before, on_a, between, on_b = (n[f"c{i}_{k}"] for k in range(4))
        on_b = 0 if a == b else on_b
        place = s.rank - s.below
        if place <= before:             # the sketch was further off than it promises: what lies below stays open
            s.hi, s.inside = a, before
        elif place <= before + on_a:
            s.found, s.below = a, s.below + before
        elif place <= before + on_a + between:
            s.lo, s.hi, s.below, s.inside = a, b, s.below + before + on_a, between
        elif place <= before + on_a + between + on_b:
            s.found, s.below = b, s.below + before + on_a + between
        else:
            s.lo, s.below, s.inside = b, s.below + before + on_a + between + on_b, s.inside - before - on_a - between - on_b


def _read_off(df: DataFrame, searches: list[_Search]) -> None:
    """Ranks whose bracket has few rows: its values and their counts, at most ``SMALL`` for each, come to the driver."""
    if not searches:
        return
    brackets = {}
    for s in searches:
        brackets.setdefault((s.column, s.lo, s.hi), s)
    kinds = [F.when(s.open(), F.struct(F.lit(i).alias("b"), F.col(s.column).cast("double").alias("v"))) for i, s in enumerate(brackets.values())]
    counts = df.select(F.explode(F.array_compact(F.array(*kinds))).alias("x")).groupBy("x.b", "x.v").agg(F.count(F.lit(1)).alias("n")).collect()
    values: dict[int, list] = {}
    for r in counts:
        values.setdefault(r["b"], []).append((r["v"], r["n"]))
    for s in searches:
        place = s.rank - s.below
        for v, n in sorted(values[list(brackets).index((s.column, s.lo, s.hi))]):
            if place <= n:
                s.found = v
                break
            place -= n
            s.below += n


class _Tie:
    """Rows of one value, and the rank of a key among them: in byte order, from 1."""

    def __init__(self, rows: Column, rank: int):
        self.rows, self.rank, self.prefix, self.inside = rows, rank, "", 0


def keys_in_ties(df: DataFrame, key: str, ties: Sequence[_Tie], from_end: Sequence[bool], small: int = SMALL) -> list[str]:
    """The key (a text, unique) at each tie's rank; one marked ``from_end`` has its rank less the number of its rows added to it.

    That is how a rank counts that comes after all larger values.
    """
    cond = [t.rows for t in ties]
    ends = df.agg(*[f(F.when(c, F.col(key))).alias(f"{n}{i}") for i, c in enumerate(cond) for n, f in (("a", F.min), ("b", F.max), ("n", F.count))]).first()
    for i, t in enumerate(ties):
        t.inside = ends[f"n{i}"]
        t.rank += t.inside if from_end[i] else 0
        t.prefix = os.path.commonprefix([ends[f"a{i}"], ends[f"b{i}"]])  # of all keys

    def each(some: Sequence[_Tie], value) -> DataFrame:
        """A row (number, ``value(tie)``) for each of the ties that a row of ``df`` is part of."""
        parts = [F.when(t.rows & F.col(key).startswith(t.prefix), F.struct(F.lit(i).alias("i"), value(t).alias("k"))) for i, t in enumerate(some)]
        return df.select(F.explode(F.array_compact(F.array(*parts))).alias("x")).select("x.i", "x.k")

    while wide := [t for t in ties if t.inside > small]:
        counts: dict[int, list] = {}
        for r in each(wide, lambda t: F.substring(key, 1, len(t.prefix) + 2)).groupBy("i", "k").agg(F.count(F.lit(1)).alias("n")).collect():
            counts.setdefault(r["i"], []).append((r["k"], r["n"]))  # pairs of characters
        for i, t in enumerate(wide):
            for p, n in sorted(counts[i], key=lambda x: x[0].encode()):
                if t.rank <= n:
                    t.prefix, t.inside = p, n
                    break
                t.rank -= n
    found: dict[int, list[str]] = {}
    for r in each(ties, lambda t: F.col(key)).collect():  # at most SMALL for each
        found.setdefault(r["i"], []).append(r["k"])
    return [sorted(found[i], key=str.encode)[t.rank - 1] for i, t in enumerate(ties)]


def quantile_rank_scores(df: DataFrame, specs: Sequence[tuple[str, str, bool]], key: str, desired_bins: int = 5,
                         small: int = SMALL) -> DataFrame:
    """Quantile scores 1..desired_bins of rank(method='first') for several (value, score column, reverse).

    Rows are ranked by value, ties by ``key`` ascending. With n rows and
    q = min(desired_bins, n) bins, rank r falls in bin
    ``max(1, ceil((r-1)*q/(n-1)))``; fewer than ``desired_bins`` bins are
    stretched by ``ceil(s*desired/q)``; n <= 1 gives the middle score;
    ``reverse`` ranks descending and then flips (score -> desired+1-score).
    Values are not null.
    """
    n = df.count()
    q = min(desired_bins, n)
    if n <= 1:
        return df.withColumns({out: F.lit(desired_bins // 2 + 1).cast("int") for _, out, _ in specs})
    # rank r is in bin s + 1 or a later one exactly when r > s (n - 1) / q + 1
    ranks = [s * (n - 1) // q + 1 for s in range(1, q)]
    found = values_at_ranks(df, {v: [n - r + 1 if reverse else r for r in ranks] for v, _, reverse in specs}, small)
    cuts = [(value, reverse, r, found[value][n - r + 1 if reverse else r]) for value, _, reverse in specs for r in ranks]
    # descending, a rank comes after the n - below - ties rows of larger values
    ties = [_Tie(F.col(value) == F.lit(c.value), r - n + c.below if reverse else r - c.below) for value, reverse, r, c in cuts]
    last = iter(keys_in_ties(df, key, ties, [reverse for _, reverse, _, _ in cuts], small))
    scores = {}
    for value, out, reverse in specs:
        score = F.lit(1).cast("long")
        for r in ranks:
            cut, at = F.lit(found[value][n - r + 1 if reverse else r].value), F.lit(next(last))
            beyond = (F.col(value) < cut) if reverse else (F.col(value) > cut)
            score = score + F.when(beyond | ((F.col(value) == cut) & (F.col(key) > at)), 1).otherwise(0)
        if q < desired_bins:
            score = ceil_div(score * desired_bins, F.lit(q))
        if reverse:
            score = F.lit(desired_bins + 1) - score
        scores[out] = score.cast("int")
    return df.withColumns(scores)


def quantile_values(df: DataFrame, columns: Sequence[str], probs: Sequence[float], small: int = SMALL) -> dict[str, list[float]]:
    """Linear-interpolated quantiles (numpy 'linear') of several columns; null for a column without values."""
    rows = df.agg(*[F.count(c).alias(f"n{i}") for i, c in enumerate(columns)]).first()
    at: dict[str, list[tuple[int, int, float]]] = {}
    for i, c in enumerate(columns):
        n = rows[i]
        places = [(n - 1) * float(p) for p in probs] if n else []
        at[c] = [(int(h) + 1, min(int(h) + 1, n - 1) + 1, h - int(h)) for h in places]
    found = values_at_ranks(df, {c: [r for lo, hi, _ in at[c] for r in (lo, hi)] for c in columns}, small)
    out: dict[str, list] = {}
    for c in columns:
        out[c] = [None] * len(probs) if not at[c] else []
        for lo, hi, g in at[c]:
            a, b = float(found[c][lo].value), float(found[c][hi].value)
            out[c].append(b - (b - a) * (1.0 - g) if g >= 0.5 else a + (b - a) * g)
    return out
