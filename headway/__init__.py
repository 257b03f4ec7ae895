"""headway: transit delay analytics on PySpark.

Every operator is a function from DataFrame to DataFrame (or Column to
Column) built from Spark's own expressions, so the same code serves batch
tables and Structured Streaming.
"""
