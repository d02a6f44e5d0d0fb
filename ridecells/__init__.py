"""Point events on a city grid joined with hourly weather, on Spark.

Everything is a function from DataFrame to DataFrame or to Column, built from
Spark's own expressions, so that the same code serves batch and streaming
frames and stays inside generated JVM code.
"""
