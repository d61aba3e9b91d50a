"""Test views over the driver's tables (FIXTURES.md section 2).

``samples`` derives eleven sample columns from ``orders`` (unique key
``o_orderkey``); ``scored`` adds a 0/1 label ``y`` and a deterministic score
``p``.  The same SQL text runs in Spark (with ``orders`` bound to a DataFrame)
and in DuckDB (as CTEs in front of each oracle query).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

SAMPLES_SQL = """
SELECT f.*, CASE WHEN (
     coalesce(total_plate_count > 1e6, false)
  OR coalesce(coliform_count > 1000, false)
  OR coalesce(temperature > 10 AND storage_time_days > 7, false)
  OR coalesce(water_activity > 85e-2 AND ph_level > 65e-1 AND storage_time_days > 14, false)
  ) <> (sample_key % 20 = 0) THEN 'unsafe' ELSE 'safe' END AS safety_status
FROM (
  SELECT o_orderkey AS sample_key,
    CASE WHEN o_orderkey % 31 = 0 THEN CAST(NULL AS DOUBLE) ELSE round((o_custkey * 7 + o_orderkey) % 500 * 1e-1 - 21e0, 2) END AS temperature,
    CASE WHEN o_orderkey % 37 = 0 THEN CAST(NULL AS DOUBLE) ELSE round(3e0 + (o_custkey % 61) * 1e-1, 2) END AS ph_level,
    CASE WHEN o_orderkey % 41 = 0 THEN CAST(NULL AS DOUBLE) ELSE round(5e0 + (o_orderkey * 13 % 93), 2) END AS moisture_content,
    CASE WHEN o_orderkey % 43 = 0 THEN CAST(NULL AS DOUBLE) ELSE round(o_totalprice * o_totalprice * 1e-5, 2) END AS total_plate_count,
    CASE WHEN o_orderkey % 47 = 0 THEN CAST(NULL AS DOUBLE) ELSE round(o_totalprice * (o_custkey % 11) * 5e-4 - 5e0, 2) END AS coliform_count,
    CASE WHEN o_orderkey % 53 = 0 THEN CAST(NULL AS INTEGER) ELSE CAST((o_custkey * 3 + o_orderkey * 5) % 60 AS INTEGER) END AS storage_time_days,
    CASE WHEN o_orderkey % 59 = 0 THEN CAST(NULL AS DOUBLE) ELSE round(3e-1 + (o_orderkey * 13 % 93) * 75e-4, 4) END AS water_activity,
    CASE o_orderkey % 8 WHEN 0 THEN 'dairy' WHEN 1 THEN 'MEAT' WHEN 2 THEN 'seafood' WHEN 3 THEN 'produce'
      WHEN 4 THEN 'grain' WHEN 5 THEN 'processed' WHEN 6 THEN 'plastic' ELSE CAST(NULL AS VARCHAR(10)) END AS food_type,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'vacuum' WHEN '2-HIGH' THEN 'frozen' WHEN '3-MEDIUM' THEN 'refrigerated'
      WHEN '4-NOT SPECIFIED' THEN 'Ambient' ELSE 'crate' END AS packaging_type,
    concat('SUP', lpad(CAST(o_custkey % 20 + 1 AS VARCHAR(10)), 3, '0')) AS supplier_id
  FROM {orders}) f
"""

SCORED_SQL = """
SELECT s.*, CASE WHEN safety_status = 'unsafe' THEN 1 ELSE 0 END AS y,
  round(1/(1+exp(-((
      ln(1 + coalesce(total_plate_count, 0e0)) / 20e0
    + ln(1 + coalesce(greatest(coliform_count, 0e0), 0e0)) / 15e0
    + (coalesce(temperature, 0e0) + 5e0) / 35e0
    + coalesce(storage_time_days, 0) / 730e0
    + (coalesce(water_activity, 3e-1) - 3e-1) / 69e-2) - 2e0))), 3) AS p
FROM {samples} s
"""

# The oracle side: the same text as CTEs over DuckDB's pre-registered views.
ORACLE_CTE = ("WITH samples AS (" + SAMPLES_SQL.replace("{orders}", "orders") + "),\n"
              "scored AS (" + SCORED_SQL.replace("{samples}", "samples") + ")\n")


def oracle(sql_body: str) -> str:
    """Prefix an oracle query with the ``samples`` / ``scored`` CTEs."""
    body = sql_body.strip()
    if body.upper().startswith("WITH "):
        return ORACLE_CTE.rstrip("\n") + ",\n" + body[5:]
    return ORACLE_CTE + body


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(SAMPLES_SQL, orders=table(spark, sf_dir, "orders"))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(SCORED_SQL, samples=samples(spark, sf_dir))
