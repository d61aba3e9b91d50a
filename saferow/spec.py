"""Table description: the data every operator is generic over.

A :class:`TableSpec` holds the column lists, value ranges, category domains,
label map and risk-factor rules of one table.  Operators read the spec and
build native Spark expressions from it; nothing in the operators is specific
to food samples.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Optional

from pyspark.sql import types as T


@dataclass(frozen=True)
class RiskRule:
    """One explanation rule: ``column > threshold`` fires ``text``.

    ``text`` is a ``format_string`` pattern taking the column value once.
    Missing values never fire.
    """

    code: str
    column: str
    threshold: float
    text: str


@dataclass(frozen=True)
class TableSpec:
    numeric_ranges: dict[str, tuple[float, Optional[float]]]
    integer_columns: tuple[str, ...]
    categorical_domains: dict[str, tuple[str, ...]]
    numeric_features: tuple[str, ...]
    categorical_features: tuple[str, ...]
    target: str
    class_names: tuple[str, ...]
    risk_rules: tuple[RiskRule, ...] = ()
    key: Optional[str] = None
    missing_threshold: float = 0.5
    duplicate_keys: tuple[str, ...] = ()
    extra_string_columns: tuple[str, ...] = field(default=())

    @property
    def feature_columns(self) -> tuple[str, ...]:
        return self.numeric_features + self.categorical_features

    @property
    def required_columns(self) -> tuple[str, ...]:
        return self.feature_columns + (self.target,)

    @property
    def label_map(self) -> dict[str, int]:
        return {name: i for i, name in enumerate(self.class_names)}

    def spark_schema(self, with_key: bool = False) -> T.StructType:
        fields = []
        if with_key and self.key:
            fields.append(T.StructField(self.key, T.LongType(), True))
        for c in self.numeric_features:
            t = T.IntegerType() if c in self.integer_columns else T.DoubleType()
            fields.append(T.StructField(c, t, True))
        for c in self.categorical_features:
            fields.append(T.StructField(c, T.StringType(), True))
        fields.append(T.StructField(self.target, T.StringType(), True))
        return T.StructType(fields)


# ---------------------------------------------------------------------------
# Fixed values of the food-safety table.  These must equal the reference's
# definitions for results to agree: column names, inclusive ranges (None = no
# upper bound), category domains, class names in label order, and the six
# risk-factor rules in their reporting order with their messages.
# ---------------------------------------------------------------------------
FOOD_SAFETY = TableSpec(
    numeric_ranges={
        "temperature": (-20.0, 100.0),
        "ph_level": (0.0, 14.0),
        "moisture_content": (0.0, 100.0),
        "total_plate_count": (0.0, None),
        "coliform_count": (0.0, None),
        "storage_time_days": (0.0, 3650.0),
        "water_activity": (0.0, 1.0),
    },
    integer_columns=("storage_time_days",),
    categorical_domains={
        "food_type": ("dairy", "meat", "seafood", "produce", "grain", "processed", "other"),
        "packaging_type": ("vacuum", "aerated", "canned", "frozen", "refrigerated", "ambient", "other"),
        "safety_status": ("safe", "unsafe"),
    },
    numeric_features=(
        "temperature", "ph_level", "moisture_content", "total_plate_count",
        "coliform_count", "storage_time_days", "water_activity",
    ),
    categorical_features=("food_type", "packaging_type", "supplier_id"),
    target="safety_status",
    class_names=("safe", "unsafe"),
    risk_rules=(
        RiskRule("high_temperature", "temperature", 10.0,
                 "High temperature (%s°C) increases contamination risk"),
        RiskRule("long_storage", "storage_time_days", 30.0,
                 "Extended storage time (%s days)"),
        RiskRule("high_plate_count", "total_plate_count", 1e5,
                 "Elevated microbial count (%.0f CFU/g)"),
        RiskRule("high_coliform", "coliform_count", 100.0,
                 "High coliform count (%.0f CFU/g)"),
        RiskRule("high_water_activity", "water_activity", 0.85,
                 "High water activity (%.2f) supports microbial growth"),
        RiskRule("alkaline_ph", "ph_level", 7.0,
                 "Alkaline pH (%s) may indicate spoilage"),
    ),
    key="sample_key",
    duplicate_keys=("supplier_id",),
)

RECOMMENDATION_REJECT = "REJECT - Unsafe for consumption"
RECOMMENDATION_ACCEPT = "ACCEPT - Safe for consumption"
