"""Migration jobs.

Every job takes DataFrames and parameters and returns a DataFrame.  No job runs
an action, collects or writes; writing lives in `sources.sinks`.
"""
