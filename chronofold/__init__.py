"""Temporal history engine on PySpark DataFrames."""
