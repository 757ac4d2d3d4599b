"""Similarity joins and collaborative filtering on Spark DataFrames."""
