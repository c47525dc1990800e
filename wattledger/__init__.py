"""Utility-metering analytics on Spark DataFrames.

Readings are validated and de-duplicated, kept as live windowed views, settled
into exact daily bills, rolled up by zone and served as one merged view. Every
operator is a function from DataFrames to a DataFrame; nothing in the package
runs row-at-a-time Python.
"""
