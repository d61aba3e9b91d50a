"""Rule expressions: the label rule, label noise, risk score, ratio correction
(R1-R4) and the risk-factor explanation (I8-I10).

All are native column expressions; R4 adds one aggregate (an exact percentile).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saferow.spec import (FOOD_SAFETY, RECOMMENDATION_ACCEPT, RECOMMENDATION_REJECT,
                          TableSpec)

# ---------------------------------------------------------------------------
# Fixed values of the labelling rule and the risk score (must equal the
# reference for labels to agree):
#   unsafe if  plate count > 1e6  OR  coliform > 1000
#          OR (temperature > 10 AND storage days > 7)
#          OR (water activity > 0.85 AND pH > 6.5 AND storage days > 14)
#   risk = ln1p(plate)/20 + ln1p(coliform)/15 + (temperature+5)/35
#          + days/730 + (water activity-0.3)/0.69
# ---------------------------------------------------------------------------


def label_rule(c=F.col) -> Column:
    """The unsafe rule; a missing term never fires (it counts as false)."""
    return (
        F.coalesce(c("total_plate_count") > 1e6, F.lit(False))
        | F.coalesce(c("coliform_count") > 1000.0, F.lit(False))
        | F.coalesce((c("temperature") > 10.0) & (c("storage_time_days") > 7), F.lit(False))
        | F.coalesce((c("water_activity") > 0.85) & (c("ph_level") > 6.5)
                     & (c("storage_time_days") > 14), F.lit(False))
    )


def label_noise(rule: Column, flip: Column) -> Column:
    """R2: XOR of the rule with a noise mask (both boolean)."""
    return rule != flip


def risk_score(c=F.col) -> Column:
    """The continuous risk score; NULL if any input is NULL."""
    return (
        F.log1p(c("total_plate_count")) / 20.0
        + F.log1p(c("coliform_count")) / 15.0
        + (c("temperature") + 5.0) / 35.0
        + c("storage_time_days") / 730.0
        + (c("water_activity") - 0.3) / 0.69
    )


def ratio_correction(df: DataFrame, label_col: str, score_col: str, ratio: float,
                     tolerance: float = 0.05, out: str = "label_corrected") -> DataFrame:
    """If the share of positive labels is more than ``tolerance`` away from
    ``ratio``, replace every label by ``score > percentile(score, 1 - ratio)``
    (linear interpolation); else keep the labels.

    One aggregate gives the share; the cut is an exact quantile with bounded
    memory (:mod:`saferow.operators.quantiles`); both come back as scalars.
    """
    from saferow.operators.quantiles import exact_quantiles

    share = df.agg(F.avg(F.col(label_col).cast("double")).alias("share")).first()["share"]
    if share is None or abs(share - ratio) <= tolerance:
        return df.withColumn(out, F.col(label_col))
    cut = exact_quantiles(df, [score_col], [1.0 - ratio])[score_col][0]
    if cut is None:
        return df.withColumn(out, F.col(label_col))
    return df.withColumn(out, F.coalesce(F.col(score_col) > F.lit(cut), F.lit(False)))


def risk_factor_codes(spec: TableSpec = FOOD_SAFETY) -> Column:
    """I8: codes of the rules that fire, in rule order (missing never fires)."""
    return F.array_compact(F.array(*[
        F.when(F.col(r.column) > F.lit(r.threshold), F.lit(r.code)) for r in spec.risk_rules
    ]))


def risk_factor_texts(spec: TableSpec = FOOD_SAFETY) -> Column:
    """I8: the message of each rule that fires, with the value formatted in."""
    return F.array_compact(F.array(*[
        F.when(F.col(r.column) > F.lit(r.threshold),
               F.format_string(r.text, F.col(r.column)))
        for r in spec.risk_rules
    ]))


def first_n(arr: Column, n: int) -> Column:
    """The first ``n`` elements."""
    return F.slice(arr, 1, n)


def recommendation(prediction: Column, positive: str = "unsafe") -> Column:
    """REJECT text for the positive class, ACCEPT text otherwise."""
    return F.when(prediction == F.lit(positive), F.lit(RECOMMENDATION_REJECT)) \
        .otherwise(F.lit(RECOMMENDATION_ACCEPT))
