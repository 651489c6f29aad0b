"""A Spark engine for keyed, irregularly sampled, gappy time series.

Operators take and return DataFrames and are given column names; the plans in ``plans``
compose them into whole jobs.
"""
