"""Typed knowledge graphs and document collections on Spark DataFrames."""
