"""Numeric kernels without Spark: alignment, clustering, trees."""
