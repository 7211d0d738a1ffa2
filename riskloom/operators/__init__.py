"""Operators of the reference, re-expressed on Spark DataFrames and pyspark.ml."""
