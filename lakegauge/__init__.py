"""Typed landing, quality reports and catalog views for event feeds, on Spark DataFrames."""
