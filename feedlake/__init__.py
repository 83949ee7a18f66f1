"""Nested observation feeds on Spark: land, flatten, cover, merge and view.

Every function takes and returns DataFrames (or Columns). Nothing holds state, nothing
loops over files on the driver and there is no Python UDF: Catalyst sees the whole plan.
"""
