"""Operators: functions from DataFrames to DataFrames, with no session of their own."""
