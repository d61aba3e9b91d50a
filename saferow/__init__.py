"""saferow: quality control, splitting, featurizing, training, evaluation and
scoring of tabular sample data, written as Spark DataFrame / Spark ML jobs.

Every operator is generic over a :class:`saferow.spec.TableSpec`; the food
safety table is one instance (:data:`saferow.spec.FOOD_SAFETY`).
"""

from saferow.spec import FOOD_SAFETY, TableSpec

__all__ = ["FOOD_SAFETY", "TableSpec"]
__version__ = "0.1.0"
