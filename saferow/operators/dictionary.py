"""One-hot coding over any number of categories (F8, F12) without the driver.

``StringIndexer`` brings every label to the driver and into each task.  Here the
categories of all columns are one stored table (column, category, slot): distinct pairs
from one scan (partial counts keep a frequent category inside its tasks), numbered in
order of column and category by :func:`saferow.operators.ranks.row_index`.  Only one count per
column comes to the driver.

Rows get their slots by one join per column with that table.  Spark broadcasts it if its
stored size is under ``spark.sql.autoBroadcastJoinThreshold``; otherwise both sides are
shuffled, and as the table is stored, AQE can split a category that a third of the
rows hold.  The slots and the numeric values become a sparse vector inside the JVM.

Same semantics as :class:`saferow.operators.features.FeaturePrep`: NULL is the category
``"missing"``, categories are sorted, an unseen one is all zeros.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saferow.operators.features import MISSING, FittedFeatures, numeric_expr
from saferow.operators.ranks import row_index
from saferow.session import scratch_path

_TABLE = "column_no int, column_name string, category string, slot long"


@dataclass
class CategoryDictionary:
    """``table`` (column_no, column_name, category, slot), slots counted over all columns from 0."""

    table: DataFrame
    columns: list[str]
    sizes: dict[str, int]

    @property
    def n_slots(self) -> int:
        return sum(self.sizes.values())

    def save(self, path: str) -> None:
        self.table.write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str, columns: Sequence[str]) -> "CategoryDictionary":
        table = spark.read.schema(_TABLE).parquet(path)
        return CategoryDictionary(table, list(columns), _sizes(table, columns))


def _value(c: str):
    return F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(MISSING))


def _sizes(table: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    found = {r["column_no"]: r["n"] for r in table.groupBy("column_no").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {c: found.get(i, 0) for i, c in enumerate(columns)}  # one count per column


def fit_dictionary(df: DataFrame, columns: Sequence[str]) -> CategoryDictionary:
    """The categories of ``columns`` and their slots; one scan of ``df``."""
    pairs = F.array(*[F.struct(F.lit(i).alias("column_no"), F.lit(c).alias("column_name"), _value(c).alias("category"))
                      for i, c in enumerate(columns)])
    distinct = df.select(F.explode(pairs).alias("p")).select("p.*").distinct()
    path = scratch_path(df.sparkSession, "dictionary")
    row_index(distinct, ["column_no", "category"], out="slot") \
        .select("column_no", "column_name", "category", "slot").write.parquet(path)
    return CategoryDictionary.load(df.sparkSession, path, columns)


def with_slots(df: DataFrame, dictionary: CategoryDictionary, prefix: str = "slot__") -> DataFrame:
    """``df`` with the slot of each categorical column (NULL: unseen)."""
    out = df
    for i, c in enumerate(dictionary.columns):
        side = dictionary.table.where(F.col("column_no") == i) \
            .select(F.col("category").alias(f"__value{i}"), F.col("slot").alias(f"{prefix}{c}"))
        out = out.join(side, _value(c) == F.col(f"__value{i}"), "left").drop(f"__value{i}")
    return out


def encode(df: DataFrame, dictionary: CategoryDictionary, fitted: FittedFeatures, output_col: str = "features") -> DataFrame:
    """``df`` with the sparse vector of its prepared numerics (``fitted``'s constants), then one slot per category."""
    m = len(fitted.numeric)
    size = m + dictionary.n_slots
    if size >= 1 << 31:
        raise ValueError(f"{size} slots: a vector has fewer than 2**31")
    nan = F.lit(float("nan"))
    numbers = [F.coalesce(numeric_expr(c, fitted.fill.get(c), fitted.center.get(c, 0.0), fitted.scale.get(c, 1.0)), nan)
               for c in fitted.numeric]
    slots = F.array_compact(F.array(*[F.col(f"slot__{c}") for c in dictionary.columns])) if dictionary.columns \
        else F.array().cast("array<bigint>")
    at = F.transform(slots, lambda s: (s + m).cast("int"))
    indices = F.concat(F.array(*[F.lit(i) for i in range(m)]).cast("array<int>"), at)
    values = F.concat(F.array(*numbers).cast("array<double>"), F.array_repeat(F.lit(1.0), F.size(slots)))
    vector = F.struct(F.lit(0).alias("type"), F.lit(size).alias("size"), indices.alias("indices"), values.alias("values"))
    as_vector = T.StructType([T.StructField("v", VectorUDT())])  # a vector is stored as this very structure
    coded = with_slots(df, dictionary).withColumn(output_col, F.from_json(F.to_json(F.struct(vector.alias("v"))), as_vector)["v"])
    return coded.drop(*[f"slot__{c}" for c in dictionary.columns])


def slot_counts(df: DataFrame, dictionary: CategoryDictionary) -> DataFrame:
    """F8: rows with a 1 in each slot, as (column_name, category, n_hot); unseen categories have none."""
    slots = F.array_compact(F.array(*[F.col(f"slot__{c}") for c in dictionary.columns]))
    hot = with_slots(df, dictionary).select(F.explode(slots).alias("slot")).groupBy("slot").agg(F.count(F.lit(1)).alias("n_hot"))
    return hot.join(dictionary.table, "slot").select("column_name", "category", "n_hot")


def names_table(dictionary: CategoryDictionary, numeric: Sequence[str]) -> DataFrame:
    """(position, feature_name): the numerics, then ``<column>_<category>`` by slot."""
    spark = dictionary.table.sparkSession
    first = spark.createDataFrame([(i, c) for i, c in enumerate(numeric)], "position int, feature_name string")
    rest = dictionary.table.select((F.col("slot") + len(numeric)).cast("int").alias("position"),
                                   F.concat("column_name", F.lit("_"), "category").alias("feature_name"))
    return first.unionByName(rest)
