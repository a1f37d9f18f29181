"""Operators: each is a DataFrame -> DataFrame function built from Spark
built-ins (joins, aggregations, windows, higher-order functions)."""
