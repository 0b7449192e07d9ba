"""Medallion analytics for customer-relationship and billing data on PySpark.

Every operator takes DataFrames (plus plain parameters) and returns a lazy
DataFrame. Nothing reads the wall clock or the environment: run dates, salts
and paths are arguments.
"""
