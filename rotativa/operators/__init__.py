"""Operators: functions from DataFrames to DataFrames; they run nothing by themselves."""
