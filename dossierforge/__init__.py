"""Spark-first engine for company-research datasets: DataFrame in, DataFrame out."""
