"""Record migration and reconciliation jobs on PySpark DataFrames."""
