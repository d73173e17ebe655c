"""Reconciliation, validation and ranking operators on Spark DataFrames."""
