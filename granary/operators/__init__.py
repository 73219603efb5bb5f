"""Operators: functions from DataFrames to DataFrames, none of which collects rows."""
