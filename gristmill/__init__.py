"""gristmill: analytics operators for PySpark.

Every operator takes DataFrames and returns DataFrames; nothing runs until the
caller asks for an action, except where a docstring says that a small, bounded
statistic is read first.
"""
