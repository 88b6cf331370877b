"""Spark-first analytics over trip records and operational event logs."""
