"""Exact, reproducible splits and folds (F13, F14, T11) and class weights (T5).

Each row gets a shuffled position ``md5('<seed>:<key>')``; a NULL key is replaced
by a hash of the row's values.  Within each class (or over the whole table when not
stratified) the rank in that order decides.  Quotas are ``round(n_class * share)``,
so sizes are exact and stable under any partitioning when keys are unique; rows that
share a key share the position and stay in one split.

A split needs no ranking of all rows: per class the two positions at which test and
validation end are found from counts per hash prefix and the ranks inside the one
prefix that holds each end (:func:`split_ends`), and every row compares its own
position with them, so no data column is shuffled.  Folds need every rank
(:func:`saferow.operators.ranks.bucketed_rank`); no class is ranked by a single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saferow.operators.ranks import MAX_BROADCAST_ROWS, bucketed_rank, hash_order_key
from saferow.session import checkpoint_dir


def _position(df: DataFrame, key: str, seed: int) -> Column:
    """The shuffled position of a row; a NULL key falls back on the row's values."""
    row_hash = F.xxhash64(*[F.col(c) for c in df.columns]).cast("string")
    return hash_order_key(F.coalesce(F.col(key).cast("string"), row_hash), seed)


def _ranked(df: DataFrame, key: str, target: str | None, seed: int, digits: int) -> tuple[DataFrame, list[str]]:
    h = df.withColumn("_h", _position(df, key, seed))
    if target is None:
        h = h.withColumn("_strat", F.lit(0))
        groups = ["_strat"]
    else:
        groups = [target]
    return bucketed_rank(h, groups, "_h", [key], digits=digits, out="_rank", total_out="_n"), groups


def split_ends(rows: DataFrame, test_size: float, val_size: float, digits: int = 4) -> DataFrame:
    """Per class of ``rows`` (``_class``, ``_h``) the last position that is test
    (``_test_end``) and the last that is test or validation (``_val_end``); NULL
    where that share is empty.  One row per class.

    Counts per hash prefix (``16 ** digits`` for each class) locate the prefixes that
    hold the ends; only the distinct positions below those prefixes are ordered.
    """
    rows = rows.withColumn("_prefix", F.substring("_h", 1, digits))
    per_prefix = rows.groupBy("_class", "_prefix").agg(F.count(F.lit(1)).alias("_cnt"))
    upto = (Window.partitionBy("_class").orderBy("_prefix")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    running = per_prefix.select("_class", "_prefix", F.sum("_cnt").over(upto).alias("_upto"), "_cnt",
                                F.sum("_cnt").over(Window.partitionBy("_class")).alias("_n"))
    n = F.col("_n")
    n_test = F.round(n.cast("double") * F.lit(float(test_size)))
    n_val = F.round((n - n_test) * F.lit(float(val_size) / (1.0 - float(test_size)))) if val_size > 0 else F.lit(0.0)
    ends = F.explode(F.array(F.struct(F.lit("test").alias("_end"), n_test.cast("long").alias("_rank")),
                             F.struct(F.lit("val").alias("_end"), (n_test + n_val).cast("long").alias("_rank"))))
    before = F.col("_upto") - F.col("_cnt")
    holding = (running.withColumn("_e", ends).select("*", "_e.*")
               .where((before < F.col("_rank")) & (F.col("_rank") <= F.col("_upto")))
               .select(F.col("_class").alias("_c"), F.col("_prefix").alias("_p"), "_end",
                       (F.col("_rank") - before).alias("_k")))
    # at most two rows per class
    holding = _small(holding)
    counts = rows.join(holding.select("_c", "_p").distinct(),
                       rows["_class"].eqNullSafe(F.col("_c")) & (F.col("_prefix") == F.col("_p")), "left_semi") \
        .groupBy("_class", "_prefix", "_h").agg(F.count(F.lit(1)).alias("_cnt"))
    inner = (Window.partitionBy("_class", "_prefix").orderBy("_h")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = counts.withColumn("_upto", F.sum("_cnt").over(inner))
    at = (placed.join(holding, placed["_class"].eqNullSafe(F.col("_c")) & (F.col("_prefix") == F.col("_p")))
          .where((F.col("_upto") - F.col("_cnt") < F.col("_k")) & (F.col("_k") <= F.col("_upto"))))
    return at.groupBy("_c").agg(F.max(F.when(F.col("_end") == "test", F.col("_h"))).alias("_test_end"),
                                F.max(F.when(F.col("_end") == "val", F.col("_h"))).alias("_val_end"))


def _small(df: DataFrame) -> DataFrame:
    """``df`` computed once; broadcast in joins when it has few rows."""
    checkpoint_dir(df.sparkSession)
    df = df.checkpoint(eager=True)
    return F.broadcast(df) if df.count() <= MAX_BROADCAST_ROWS else df


def assign_split(df: DataFrame, key: str, target: str | None = None, test_size: float = 0.2,
                 val_size: float = 0.0, seed: int = 42, digits: int = 4,
                 out: str = "split") -> DataFrame:
    """add ``out`` in {train, val, test}.

    Per class (or overall when ``target`` is None): the first
    ``round(n * test_size)`` rows in hash order are test; of the rest, the next
    ``round(rest * val_size / (1 - test_size))`` are validation (``val_size`` is
    a share of the whole table); the remainder is train.
    """
    cls = F.lit(0) if target is None else F.col(target)
    position = _position(df, key, seed)
    ends = _small(split_ends(df.select(cls.alias("_class"), position.alias("_h")), test_size, val_size, digits))
    split = (F.when(F.col("_h") <= F.col("_test_end"), F.lit("test"))
             .when(F.col("_h") <= F.col("_val_end"), F.lit("val")).otherwise(F.lit("train")))
    return (df.withColumn("_h", position).join(ends, cls.eqNullSafe(F.col("_c")), "left")
            .withColumn(out, split).drop("_h", "_c", "_test_end", "_val_end"))


def split_frames(df: DataFrame, key: str, target: str | None = None, test_size: float = 0.2,
                 val_size: float = 0.0, seed: int = 42, materialize: bool = False) -> dict[str, DataFrame]:
    """F13/F14 as separate frames: ``{"train", "test"[, "val"]}``.

    Each frame scans the table again unless ``materialize`` cuts it once with a
    reliable checkpoint (to ``spark.checkpoint.dir``): use it when the frames feed
    several passes (fits, transforms)."""
    tagged = assign_split(df, key, target, test_size, val_size, seed)
    if materialize:
        checkpoint_dir(df.sparkSession)
        tagged = tagged.checkpoint(eager=True)
    out = {s: tagged.where(F.col("split") == s).drop("split") for s in ("train", "test")}
    if val_size > 0:
        out["val"] = tagged.where(F.col("split") == "val").drop("split")
    return out


def assign_folds(df: DataFrame, key: str, target: str | None = None, k: int = 5, seed: int = 42,
                 digits: int = 4, out: str = "fold") -> DataFrame:
    """Stratified k-fold number = rank within class mod k (each fold gets
    n//k or n//k + 1 rows of every class)."""
    ranked, _ = _ranked(df, key, target, seed, digits)
    drop = ["_h", "_rank", "_n"] + (["_strat"] if target is None else [])
    return ranked.withColumn(out, (F.col("_rank") % F.lit(k)).cast("int")).drop(*drop)


def balanced_weight(df: DataFrame, label: str, out: str = "weight",
                    sample_weight: str | None = None) -> DataFrame:
    """``n / (n_classes * n_class)`` per row, times an optional per-row
    sample weight.  The class counts (one row per class) are joined to the rows."""
    counts = _small(df.groupBy(F.col(label).alias("_c")).agg(F.count(F.lit(1)).alias("_n")))
    row = counts.agg(F.sum("_n").alias("total"), F.count(F.lit(1)).alias("k")).first()
    weight = F.lit(float(row["total"] or 0)) / (F.lit(row["k"]) * F.col("_n"))
    if sample_weight:
        weight = weight * F.col(sample_weight)
    return df.join(counts, F.col(label).eqNullSafe(F.col("_c")), "left").withColumn(out, weight).drop("_c", "_n")
