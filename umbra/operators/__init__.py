"""Operators: functions from DataFrames to DataFrames.

Every operator takes `by`, the columns that identify an experiment, so many
experiments run as one job.
"""
