"""Queries over the test tables: raw responses rendered by Spark, then the operators."""
