"""Operators: functions from DataFrames to DataFrames, and write jobs that
return a small report DataFrame."""
