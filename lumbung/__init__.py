"""Spark-first engine for batch medallion analytics and corpus preparation."""
