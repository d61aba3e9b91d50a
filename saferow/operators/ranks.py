"""Scalable ordering primitives.

A window with ``orderBy`` and no ``partitionBy`` runs in one task.  These
helpers give the same answers (global row index, global running aggregates,
exact per-group rank) with the work spread over many tasks:

* :func:`ranged` - rows range-partitioned by all order columns and a hash of the whole
  row, sorted, numbered inside their range and written once.  The hash spreads rows that
  agree in every order column over several ranges, so a value that a third of the rows
  hold is no larger task than any other.  Spark samples the bounds in tasks; what is
  written is fixed, so later stages and retries see the same ranges.
* :func:`row_index` - place in the range plus the row counts of all earlier ranges
  (a table with one row per range, so its size is bounded by their number).
* :func:`prefix_agg` - the same structure for running sums / maxima.
* :func:`bucketed_rank` - an exact rank within a group, ordered by a hash: the
  hash prefix splits every group into many buckets, so a class holding a third
  (or all) of the rows is still ranked by thousands of tasks.
"""

from __future__ import annotations

from typing import Sequence, Union

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saferow.session import scratch_path

ColLike = Union[str, Column]
MAX_BROADCAST_ROWS = 300_000  # ~15 MB of (group, bucket, offset, size) rows


def _n_parts(df: DataFrame, n_parts: int | None) -> int:
    if n_parts:
        return int(n_parts)
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _sorted(order_cols: Sequence[str], descending: bool) -> list[Column]:
    return [F.col(c).desc() if descending else F.col(c).asc() for c in order_cols]


#: Bits of Spark's row numbers that count inside a partition.
_PLACE_BITS = 33


def ranged(df: DataFrame, order_cols: Sequence[str], n_buckets: int | None = None,
           descending: bool = False) -> DataFrame:
    """The rows of ``df`` with ``_bucket`` (number of their range of the order) and
    ``_place`` (0-based place in it), stored.

    Rows equal in all order columns follow each other by a hash of all their columns
    (map columns apart); only rows equal in every column are sure to share a range.
    """
    n = n_buckets or _n_parts(df, None)
    hashed = [f"`{f.name}`" for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    order = _sorted(order_cols, descending) + [F.col("_tie")]
    number = F.monotonically_increasing_id()  # partition number, then place in the sorted partition
    path = scratch_path(df.sparkSession, "ranges")
    (df.withColumn("_tie", F.xxhash64(*hashed)).repartitionByRange(n, *order).sortWithinPartitions(*order)
     .withColumn("_number", number).drop("_tie").write.parquet(path))
    stored = df.sparkSession.read.parquet(path)
    return (stored.withColumn("_bucket", F.shiftright("_number", _PLACE_BITS))
            .withColumn("_place", F.col("_number").bitwiseAND((1 << _PLACE_BITS) - 1)).drop("_number"))


def _before(totals: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """Aggregates over all earlier ranges.  One row per range, so one window task is bounded."""
    w = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return F.broadcast(totals.select("_bucket", *[e.over(w).alias(name) for name, e in sums.items()]))


def row_index(df: DataFrame, order_cols: Sequence[str], out: str = "row_idx",
              n_buckets: int | None = None, descending: bool = False) -> DataFrame:
    """0-based global row index in ``order_cols`` order, for any orderable columns.

    Rows equal in all order columns take consecutive numbers, ordered by a hash of the
    row.  Rows move once (the range partitioning); the numbers are places in the
    sorted ranges plus each range's offset.
    """
    b = ranged(df, order_cols, n_buckets, descending)
    offsets = _before(b.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n")), {"_off": F.sum("_n")})
    return (b.join(offsets, "_bucket").withColumn(out, F.coalesce("_off", F.lit(0)) + F.col("_place"))
            .drop("_bucket", "_place", "_off"))


_AGG = {"sum": F.sum, "max": F.max, "min": F.min}


def prefix_agg(df: DataFrame, order_cols: Sequence[str], aggs: dict[str, str],
               suffix: str = "_cum", n_buckets: int | None = None, descending: bool = False) -> DataFrame:
    """Running (inclusive) aggregates over a global order.

    ``aggs`` maps a column to ``sum``, ``max`` or ``min``; the result gets
    ``<column><suffix>``.  Rows with equal order values are distinct rows of the
    running sequence, so pass a unique order (or aggregate ties first).  Same
    structure as :func:`row_index`: running aggregates inside ranges of the order
    plus the broadcast totals of all earlier ranges.
    """
    b = ranged(df, order_cols, n_buckets, descending)
    w_local = Window.partitionBy("_bucket").orderBy("_place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = b.select("*", *[_AGG[a](F.col(c)).over(w_local).alias(c + "_local") for c, a in aggs.items()])
    totals = b.groupBy("_bucket").agg(*[_AGG[a](F.col(c)).alias(c + "_part") for c, a in aggs.items()])
    offsets = _before(totals, {c + "_prev": _AGG[a](F.col(c + "_part")) for c, a in aggs.items()})
    joined = local.join(offsets, "_bucket")
    outs = []
    for c, a in aggs.items():
        prev, cur = F.col(c + "_prev"), F.col(c + "_local")
        if a == "sum":
            val = F.coalesce(prev, F.lit(0)) + cur
        elif a == "max":
            val = F.greatest(prev, cur)
        else:
            val = F.least(prev, cur)
        outs.append(val.alias(c + suffix))
    drop = ["_bucket", "_place"] + [c + "_prev" for c in aggs] + [c + "_local" for c in aggs]
    return joined.select("*", *outs).drop(*drop)


def hash_order_key(key: ColLike, seed: int) -> Column:
    """A reproducible shuffled order: md5 of ``'<seed>:<key>'`` as hex text.

    md5 is the same function in Spark and DuckDB, so the plain
    ``row_number() over (order by md5(...))`` serves as the oracle.
    """
    k = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}:"), k.cast("string")))


def bucketed_rank(df: DataFrame, group_cols: Sequence[str], hash_col: str,
                  tiebreak: Sequence[str], digits: int = 4, out: str = "_rank",
                  total_out: str = "_group_n") -> DataFrame:
    """Exact 0-based rank within ``group_cols`` ordered by ``hash_col`` (hex text)
    then ``tiebreak``; also returns the group size in ``total_out``.

    The first ``digits`` hex characters of the hash cut each group into
    16**digits buckets.  The bucket count table (groups x buckets rows) gets each
    bucket's running offset; it is checkpointed once and broadcast when it has
    at most ``MAX_BROADCAST_ROWS`` rows (class labels: 2 x 65,536), else joined
    by shuffle.  Ranking runs as a window per (group, bucket).
    """
    bucket = F.substring(F.col(hash_col), 1, digits)
    with_b = df.withColumn("_bucket", bucket)
    keys = list(group_cols) + ["_bucket"]
    counts = with_b.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    w_prev = (Window.partitionBy(*group_cols).orderBy("_bucket")
              .rowsBetween(Window.unboundedPreceding, -1))
    w_all = Window.partitionBy(*group_cols)
    offsets = counts.select(*keys,
                            F.coalesce(F.sum("_n").over(w_prev), F.lit(0)).alias("_off"),
                            F.sum("_n").over(w_all).alias(total_out))
    w_local = Window.partitionBy(*keys).orderBy(F.col(hash_col), *[F.col(t) for t in tiebreak])
    # the offset table is small by aggregation but its size depends on how many
    # groups there are: cut it once, count it, and broadcast only under a cap
    from saferow.session import checkpoint_dir

    checkpoint_dir(df.sparkSession)
    offsets = offsets.checkpoint(eager=True)
    small = offsets.count() <= MAX_BROADCAST_ROWS
    # null-safe equality: an unlabeled (NULL) group is ranked like any other
    renamed = offsets.select(*[F.col(k).alias("_o" + k) for k in keys], "_off", total_out)
    side = F.broadcast(renamed) if small else renamed
    cond = [with_b[k].eqNullSafe(renamed["_o" + k]) for k in keys]
    return (with_b.join(side, cond, "inner")
            .withColumn(out, F.col("_off") + F.row_number().over(w_local) - 1)
            .drop("_bucket", "_off", *["_o" + k for k in keys]))
