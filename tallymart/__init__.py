"""Retail analytics on Spark: table operators and named reports, DataFrame in, DataFrame out."""
