"""The data operations: functions from DataFrames to DataFrames."""
