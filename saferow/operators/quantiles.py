"""Exact quantiles (linear interpolation) of all columns from two scans, at any size.

Every quantile needs the values at one or two ranks of its column.

1. One scan makes mergeable rank sketches of all columns (Spark's approximate quantiles:
   tasks sketch, executors merge in a tree).  Their values ``2 * ERROR`` of the rows
   below and above a quantile bracket its ranks.
2. One scan counts, exactly and for all columns together, how many values each column
   has, how many lie below each bracket, and how often each value in a bracket occurs.
   A row is expanded into the bits of its comparisons (16 to a number) and
   the few values that lie in brackets; equal items are counted before they move.  The
   result, about ``4 * ERROR`` of the rows per quantile at most, is stored.
3. Running counts over the stored values (:func:`saferow.operators.ranks.prefix_agg`, so in
   many tasks) give the values at the ranks; only these reach the driver.

A bracket that misses its rank (the bound allows that in tiny tables only) is counted
again without limits.

The result is ``v[lo] + (pos - lo) * (v[hi] - v[lo])`` with ``pos = (n - 1) * p``,
and ``v[lo]`` itself where both values are equal (infinities included) or ``pos`` is
whole.  NULL and NaN are missing; a column without values gives None.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import Optional, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saferow.operators.ranks import prefix_agg
from saferow.session import scratch_path

#: Values of brackets that one task puts in order.
MAX_IN_MEMORY_DISTINCT = 200_000
#: Relative rank error of the sketches.
ERROR = 1e-3
#: Comparisons of a row that are counted as one number.
_BITS = 16


@dataclass
class _Bracket:
    """Closed interval of column ``col`` around the quantile ``p`` (None: no limit)."""

    col: int
    p: float
    lo: Optional[float] = None
    hi: Optional[float] = None

    def below(self) -> str:
        return "false" if self.lo is None else f"v{self.col} < {_literal(self.lo)}"

    def inside(self) -> str:
        low = "" if self.lo is None else f" AND v{self.col} >= {_literal(self.lo)}"
        high = "" if self.hi is None else f" AND v{self.col} <= {_literal(self.hi)}"
        return f"v{self.col} IS NOT NULL{low}{high}"


def _literal(v: float) -> str:
    return f"CAST('{v!r}' AS DOUBLE)"


def _sketched(vals: DataFrame, probs: Sequence[float]) -> list[_Bracket]:
    """Brackets of every quantile of every column; columns without values have none."""
    wanted = sorted({q for p in probs for q in (p - 2 * ERROR, p + 2 * ERROR) if 0 < q < 1})
    got = vals.approxQuantile(vals.columns, wanted or [0.5], ERROR)
    out = []
    for i, values in enumerate(got):
        at = dict(zip(wanted, values))
        if values:
            out += [_Bracket(i, p, at.get(p - 2 * ERROR), at.get(p + 2 * ERROR)) for p in probs]
    return out


def _counted(vals: DataFrame, brackets: list[_Bracket]) -> tuple[list[int], list[int], DataFrame]:
    """(values per column, values below per bracket, stored table j, v, n of the values in brackets)."""
    tests = [f"{c} IS NOT NULL" for c in vals.columns] + [b.below() for b in brackets]
    items = []
    for g in range(0, len(tests), _BITS):
        bits = " + ".join(f"if({t}, {1 << k}L, 0L)" for k, t in enumerate(tests[g:g + _BITS]))
        items.append(f"struct({-1 - g // _BITS} AS j, {bits} AS m, 0D AS v)")
    items += [f"if({b.inside()}, struct({j} AS j, 0L AS m, v{b.col} AS v), NULL)" for j, b in enumerate(brackets)]
    each = vals.selectExpr(f"explode(array_compact(array({', '.join(items)}))) AS e").select("e.*")
    path = scratch_path(vals.sparkSession, "brackets")
    each.groupBy("j", "m", "v").agg(F.count(F.lit(1)).alias("n")).write.parquet(path)
    found = vals.sparkSession.read.parquet(path)
    sums = [f"coalesce(sum(if(j = {-1 - t // _BITS} AND (m & {1 << t % _BITS}L) <> 0, n, 0L)), 0L) AS t{t}" for t in range(len(tests))]
    totals = list(found.where("j < 0").selectExpr("j", "m", "n").groupBy("j", "m").agg(F.sum("n").alias("n")).selectExpr(*sums).first())
    return totals[:len(vals.columns)], totals[len(vals.columns):], found.where("j >= 0").select("j", "v", "n")


def _at_ranks(inside: DataFrame, wanted: dict[int, list[int]], per_task: int) -> dict[tuple[int, int], float]:
    """Value at each wanted rank (0-based, within its bracket)."""
    sizes = {r["j"]: (r["n"], r["d"]) for r in
             inside.groupBy("j").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("d")).collect()}  # one row per bracket
    tasks = -(-sum(d for _, d in sizes.values()) // per_task) if per_task else None
    targets, base = {}, 0
    for j in sorted(sizes):
        for k in wanted.get(j, []):
            targets[base + k] = j, k
        base += sizes[j][0]
    upto = prefix_agg(inside, ["j", "v"], {"n": "sum"}, suffix="_upto", n_buckets=tasks)
    hit = " OR ".join(f"(n_upto - n <= {t}L AND {t}L < n_upto)" for t in targets)
    out = {}
    for row in upto.where(hit).select("v", (F.col("n_upto") - F.col("n")).alias("first"), F.col("n_upto").alias("end")).collect():
        out |= {key: row["v"] for t, key in targets.items() if row["first"] <= t < row["end"]}
    return out


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                    max_in_memory_distinct: int = MAX_IN_MEMORY_DISTINCT) -> dict[str, list[Optional[float]]]:
    """Exact linear-interpolated quantiles of every column (NULL and NaN ignored).

    ``max_in_memory_distinct``: values of brackets that one task puts in order (0: as many
    tasks as shuffle partitions)."""
    if not cols:
        return {}
    doubles = [F.col(f"`{c}`").cast("double") for c in cols]
    vals = df.select(*[F.when(~F.isnan(v), v).alias(f"v{i}") for i, v in enumerate(doubles)])
    found: dict[tuple[int, float], tuple[float, float, float]] = {}
    todo = _sketched(vals, list(dict.fromkeys(probs)))
    while todo:
        counts, below, inside = _counted(vals, todo)
        ranks = {}
        for j, b in enumerate(todo):
            pos = (counts[b.col] - 1) * b.p
            ranks[j] = sorted({math.floor(pos) - below[j], math.ceil(pos) - below[j]})
        values = _at_ranks(inside, ranks, max_in_memory_distinct)
        missed = []
        for j, b in enumerate(todo):
            got = [values.get((j, k)) for k in ranks[j]]
            if None in got:
                missed.append(_Bracket(b.col, b.p))
            else:
                found[b.col, b.p] = got[0], got[-1], (counts[b.col] - 1) * b.p
        todo = missed

    def quantile(i: int, p: float) -> Optional[float]:
        if (i, p) not in found:
            return None
        a, b, pos = found[i, p]
        return a if a == b else a + (pos - math.floor(pos)) * (b - a)

    return {c: [quantile(i, p) for p in probs] for i, c in enumerate(cols)}


def exact_medians(df: DataFrame, cols: Sequence[str], **kw) -> dict[str, Optional[float]]:
    return {c: v[0] for c, v in exact_quantiles(df, cols, [0.5], **kw).items()}
