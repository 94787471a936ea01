"""Operators for large training-data pipelines.

Nothing else in the library imports this subpackage. Every operator takes a DataFrame and
column names, selects only the columns it needs (extra or clashing columns are ignored) and
returns a new DataFrame; tables that must outlive a job go to the folder of
``spark.checkpoint.dir``.
"""
