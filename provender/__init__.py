"""Supplier-compliance data jobs on Spark: DataFrame in, DataFrame out."""
