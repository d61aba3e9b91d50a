"""Column-expression helpers and rule expressions (all native Spark SQL)."""
