"""The synthetic sample table as a distributed generator job.

Every value is a column expression of the row key and the seed (hash-based
draws), so the table is identical under any partitioning or task retry and the
work scales with the number of keys.  The keys come from ``spark.range(n)`` or
from any key column of an existing table.  The distributions follow the
reference generator; numpy's random stream itself cannot be reproduced, so the
equivalence is distributional.
"""

from __future__ import annotations

import random
from typing import Optional

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from saferow.functions import rules
from saferow.functions.exprs import clip as _clip
from saferow.functions.exprs import hash_normal, hash_uniform
from saferow.session import scratch_path

# ---------------------------------------------------------------------------
# Fixed generator parameters (reference values).
# Food types with probabilities; packaging types with probabilities.
# Temperature offset by packaging; pH and moisture means by food type;
# mean storage days by packaging.
# ---------------------------------------------------------------------------
FOOD_TYPES = [("dairy", 0.2), ("meat", 0.2), ("seafood", 0.15), ("produce", 0.2), ("grain", 0.15),
              ("processed", 0.1)]
PACKAGING_TYPES = [("vacuum", 0.2), ("aerated", 0.1), ("canned", 0.15), ("frozen", 0.2),
                   ("refrigerated", 0.25), ("ambient", 0.1)]
TEMP_OFFSET = {"frozen": -18.0, "refrigerated": 0.0, "ambient": 15.0, "canned": 10.0, "vacuum": 2.0,
               "aerated": 5.0}
PH_MEAN = {"dairy": 6.5, "meat": 5.8, "seafood": 7.0, "produce": 5.5, "grain": 6.0, "processed": 5.0}
MOISTURE_MEAN = {"dairy": 85.0, "meat": 70.0, "seafood": 80.0, "produce": 90.0, "grain": 12.0,
                 "processed": 50.0}
STORAGE_MEAN = {"frozen": 180.0, "refrigerated": 14.0, "ambient": 30.0, "canned": 365.0, "vacuum": 45.0,
                "aerated": 7.0}
N_SUPPLIERS = 20
OUTLIER_RATE = 0.02
NOISE_RATE = 0.05
MISSING_RATE = (0.02, 0.05)

# stream numbers keep the draws of different columns independent
_S = {"food": 1, "pack": 2, "sup": 3, "temp": 4, "ph": 5, "moist": 6, "aw": 7, "store": 8, "plate": 9,
      "beta": 100, "out": 10, "out_p": 11, "out_c": 12, "noise": 13, "miss": 200}


def clip(c: Column, lo: float, hi: float) -> Column:
    """Every generated value is non-NULL until the missing cells are drawn."""
    return _clip(c, lo, hi, nullable=False)


def _choice(u: Column, items: list[tuple[str, float]]) -> Column:
    expr: Column = F.lit(items[-1][0])
    cum = 0.0
    bounds = []
    for name, p in items:
        cum += p
        bounds.append((name, cum))
    for name, c in reversed(bounds[:-1]):
        expr = F.when(u < F.lit(c), F.lit(name)).otherwise(expr)
    return expr


def _lookup(key: Column, table: dict[str, float]) -> Column:
    return F.create_map(*[x for k, v in table.items() for x in (F.lit(k), F.lit(v))])[key]


def _gamma_int(key: Column, seed: int, stream: int, shape: int) -> Column:
    """Gamma(shape, 1) for an integer shape: minus the sum of ``shape`` log-uniforms."""
    total = None
    for i in range(shape):
        term = -F.log(F.lit(1.0) - hash_uniform(key, seed, stream + i))
        total = term if total is None else total + term
    return total


def generate(spark: SparkSession, n: Optional[int] = None, keys: Optional[DataFrame] = None,
             key_col: str = "sample_key", seed: int = 42, contamination_ratio: float = 0.3,
             n_partitions: Optional[int] = None) -> DataFrame:
    """The generator: one sample per key (``spark.range(n)`` or ``keys``)."""
    if keys is None:
        base = spark.range(0, int(n or 1000), numPartitions=n_partitions).select(F.col("id").alias(key_col))
    else:
        base = keys.select(F.col(key_col))
        # generation is CPU-heavy per row: spread a key table that arrives in few
        # partitions (one small file) over the cluster; only the key column moves
        par = n_partitions or spark.sparkContext.defaultParallelism
        if base.rdd.getNumPartitions() < par:
            base = base.repartition(par)
    k = F.col(key_col)
    u = lambda s: hash_uniform(k, seed, _S[s])
    z = lambda s: hash_normal(k, seed, _S[s])

    df = base.select(
        key_col,
        _choice(u("food"), FOOD_TYPES).alias("food_type"),
        _choice(u("pack"), PACKAGING_TYPES).alias("packaging_type"),
        F.format_string("SUP%03d", (F.floor(u("sup") * N_SUPPLIERS) + 1).cast("int")).alias("supplier_id"),
    )
    temp = clip(F.lit(4.0) + F.lit(3.0) * z("temp") + F.coalesce(_lookup(F.col("packaging_type"), TEMP_OFFSET),
                                                                  F.lit(0.0)), -20.0, 30.0)
    ph = clip(F.coalesce(_lookup(F.col("food_type"), PH_MEAN), F.lit(6.0)) + F.lit(0.8) * z("ph"), 3.0, 9.0)
    moist = clip(F.coalesce(_lookup(F.col("food_type"), MOISTURE_MEAN), F.lit(50.0)) + F.lit(10.0) * z("moist"),
                 5.0, 98.0)
    df = df.select("*", temp.alias("temperature"), ph.alias("ph_level"), moist.alias("moisture_content"))
    aw = clip(F.lit(0.3) + F.col("moisture_content") / 100.0 * 0.65 + F.lit(0.05) * z("aw"), 0.3, 0.99)
    store_mean = F.coalesce(_lookup(F.col("packaging_type"), STORAGE_MEAN), F.lit(30.0))
    days = clip(-store_mean * F.log(F.lit(1.0) - u("store")), 0.0, 730.0).cast("int")
    df = df.select("*", aw.alias("water_activity"), days.alias("storage_time_days"))
    growth = clip((F.col("temperature") + 5.0) / 35.0 * 0.3 + (F.col("water_activity") - 0.3) / 0.69 * 0.3
                  + F.col("storage_time_days") / 730.0 * 0.4, 0.0, 1.0)
    plate = clip(F.exp(F.log(F.lit(1000.0)) + growth * 5.0 + F.lit(1.5) * z("plate")), 0.0, 1e8)
    # Beta(2, 20) = G2 / (G2 + G20); each gamma drawn once as its own column
    df = df.select("*", plate.alias("total_plate_count"), _gamma_int(k, seed, _S["beta"], 2).alias("_g2"),
                   _gamma_int(k, seed, _S["beta"] + 2, 20).alias("_g20"))
    coli = clip(F.col("total_plate_count") * (F.col("_g2") / (F.col("_g2") + F.col("_g20"))), 0.0, 1e7)
    df = df.select("*", coli.alias("coliform_count")).drop("_g2", "_g20")
    # outliers after the clip: both counts scaled by independent U(5, 20)
    out = u("out") < F.lit(OUTLIER_RATE)
    df = df.withColumn("total_plate_count", F.when(out, F.col("total_plate_count") * (5.0 + 15.0 * u("out_p")))
                       .otherwise(F.col("total_plate_count")))
    df = df.withColumn("coliform_count", F.when(out, F.col("coliform_count") * (5.0 + 15.0 * u("out_c")))
                       .otherwise(F.col("coliform_count")))
    # label rule XOR noise, then the ratio correction (one aggregate)
    df = df.withColumn("_label", rules.label_noise(rules.label_rule(), u("noise") < F.lit(NOISE_RATE)))
    df = df.withColumn("_risk", rules.risk_score())
    # stored here: the share, the cut and the result read it, and the draws are made once
    path = scratch_path(spark, "generated")
    df.write.parquet(path)
    df = spark.read.parquet(path)
    df = rules.ratio_correction(df, "_label", "_risk", contamination_ratio, 0.05, out="_final")
    df = df.withColumn("safety_status", F.when(F.col("_final"), "unsafe").otherwise("safe"))
    # rounding after labelling (numpy rounds half to even)
    for c in ("temperature", "ph_level", "moisture_content", "total_plate_count", "coliform_count"):
        df = df.withColumn(c, F.bround(c, 2))
    df = df.withColumn("water_activity", F.bround("water_activity", 4))
    # missing cells: one rate per numeric column, then Bernoulli per cell
    rng = random.Random(seed)
    numeric = ["temperature", "ph_level", "moisture_content", "total_plate_count", "coliform_count",
               "storage_time_days", "water_activity"]
    for i, c in enumerate(numeric):
        rate = rng.uniform(*MISSING_RATE)
        df = df.withColumn(c, F.when(hash_uniform(k, seed, _S["miss"] + i) < F.lit(rate), F.lit(None))
                           .otherwise(F.col(c)))
    return df.select(key_col, *numeric, "food_type", "packaging_type", "supplier_id", "safety_status")
