"""Small native column helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def nan_to_null(df: DataFrame) -> DataFrame:
    """Map NaN to NULL in every floating column (the read boundary rule).

    In Spark ``NaN > 100`` is true and ``avg`` returns NaN, so NaN cells must
    become NULL before range checks and statistics.
    """
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            cols.append(F.when(F.isnan(f.name), F.lit(None).cast(f.dataType))
                        .otherwise(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def safe_div(num: Column, den: Column) -> Column:
    """num / den, NULL when den is 0 or NULL (ANSI mode raises on x/0)."""
    return F.when(den != 0, num.cast("double") / den.cast("double"))


def zero_div(num: Column, den: Column) -> Column:
    """num / den, 0 when den is 0 (the zero_division=0 convention)."""
    return F.coalesce(safe_div(num, den), F.lit(0.0))


def clip(c: Column, lo: float, hi: float, nullable: bool = True) -> Column:
    """Clip to [lo, hi]; NULL stays NULL (least/greatest skip NULLs, so a NULL
    would otherwise become ``lo``).  ``nullable=False`` skips the guard for
    inputs that are never NULL, so the input expression appears only once."""
    bounded = F.least(F.greatest(c, F.lit(lo)), F.lit(hi))
    if not nullable:
        return bounded
    return F.when(c.isNull(), F.lit(None)).otherwise(bounded)


def r6(c: Column) -> Column:
    """Round a double to 6 places, the precision at which results are compared."""
    return F.round(c.cast("double"), 6)


def hash_uniform(key: Column, seed: int, stream: int) -> Column:
    """A uniform draw in [0, 1) that depends only on (key, seed, stream).

    Unlike ``rand(seed)`` it does not depend on partitioning, so a retried or
    re-planned task draws the same numbers.
    """
    h = F.xxhash64(key, F.lit(seed), F.lit(stream))
    # 53 random bits -> double in [0, 1)
    return F.shiftrightunsigned(h, 11).cast("double") / F.lit(float(1 << 53))


def hash_normal(key: Column, seed: int, stream: int) -> Column:
    """A standard normal draw (Box-Muller on two hash uniforms)."""
    u1 = hash_uniform(key, seed, stream)
    u2 = hash_uniform(key, seed, stream + 7919)
    return F.sqrt(-2.0 * F.log(1.0 - u1)) * F.cos(2.0 * 3.141592653589793 * u2)
