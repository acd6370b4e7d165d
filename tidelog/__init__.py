"""tidelog: activity-stream analytics as plain Spark jobs.

Operators are functions from DataFrames to a DataFrame.  Every operator that
depends on the clock takes an explicit ``as_of`` (string, datetime, Column, or
None for the current time).
"""
