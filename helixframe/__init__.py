"""Structural-sequence analytics on Spark: sources, operators, queries and streaming feeds."""
